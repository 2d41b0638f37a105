"""Export archives: ``result.json`` files of messages with media files beside them.

Messages are open JSON objects whose text may be a string, a number, null or a list of strings and objects nested to
any depth, and whose media paths may stand anywhere inside. That walk has no relational form, so one Arrow pass
flattens texts and lists media candidates; whether a candidate exists is a join with the file inventory.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Keys that always name media, extensions of media paths, texts that stand for media left out.
MEDIA_KEYS = ("photo", "file", "thumbnail")
MEDIA_EXTENSIONS = (".jpg", ".jpeg", ".png", ".webp", ".tgs", ".webm", ".m4a", ".mp3", ".mp4", ".mov", ".pdf")
PLACEHOLDERS = ("file not included", "change data exporting settings to download")
EXTERNAL = ("http://", "https://", "tg://", "mailto:")

CANDIDATE = "struct<field_path:string,media_kind:string,value:string,reason:string,target:string,always:boolean>"
MESSAGES = f"json_path string, folder string, error string, pos int, message_id long, text_plain string, raw_json string, candidates array<{CANDIDATE}>"


def flat_text(value) -> str:
    """A message's text: strings joined, objects by their ``text``, other values as written."""
    if value is None:
        return ""
    if isinstance(value, list):
        return "".join(flat_text(x.get("text")) if isinstance(x, dict) else flat_text(x) if not isinstance(x, list) else str(x) for x in value)
    return value if isinstance(value, str) else str(value)


def whole_number(value) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def media_kind(key: str, value: str) -> str:
    if key in ("photo", "thumbnail"):
        return key
    if key == "document_id":
        return "sticker" if "sticker" in value.replace("\\", "/").lower() else "document"
    return "file"


def is_placeholder(value: str) -> bool:
    own = value.strip().lower()
    return not own or any(p in own for p in PLACEHOLDERS)


def media_target(folder: str, value: str) -> str | None:
    """Where a relative media path leads; null for external references, absolute paths and paths out of the folder."""
    own = value.strip()
    if own.lower().startswith(EXTERNAL) or own.startswith("/"):
        return None
    path = posixpath.normpath(posixpath.join(folder, own))
    return path if path.startswith(folder.rstrip("/") + "/") else None


def candidates(message: dict, folder: str) -> list[dict]:
    """Media candidates of a message in document order. ``always``: kept even if the file is missing."""
    out: list[dict] = []
    seen: set[tuple[str, str]] = set()

    def add(path: str, kind: str, value: str, always: bool) -> None:
        row = {"field_path": path, "media_kind": kind, "value": value, "reason": None, "target": None, "always": always}
        if not value.strip():
            out.append(row | {"reason": "empty"})
        elif is_placeholder(value):
            out.append(row | {"reason": "placeholder"})
        elif (path, value.strip()) not in seen:
            seen.add((path, value.strip()))
            out.append(row | {"target": media_target(folder, value)})

    def is_path(value) -> bool:
        return isinstance(value, str) and not is_placeholder(value) and posixpath.splitext(value)[1].lower() in MEDIA_EXTENSIONS and media_target(folder, value) is not None

    stack: list[tuple[object, str]] = [(message, "")]
    while stack:
        value, path = stack.pop()
        later: list[tuple[object, str]] = []
        pairs = value.items() if isinstance(value, dict) else enumerate(value)
        for key, child in pairs:
            own = (f"{path}.{key}" if path else str(key)) if isinstance(value, dict) else f"{path}[{key}]"
            if isinstance(value, dict) and key in MEDIA_KEYS:
                if isinstance(child, str):
                    add(own, media_kind(key, child), child, True)
            elif is_path(child):
                add(own, media_kind(key, child) if isinstance(value, dict) else "document", child, False)
            if isinstance(child, (dict, list)):
                later.append((child, own))
        stack.extend(reversed(later))
    return out


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["json_path", "folder", "error", "pos", "message_id", "text_plain", "raw_json", "candidates"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("field_path", pa.string()), ("media_kind", pa.string()), ("value", pa.string()), ("reason", pa.string()), ("target", pa.string()), ("always", pa.bool_())]))]

    def put(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    for batch in batches:
        for uri, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            path = local_path(unquote(uri))
            folder = posixpath.dirname(path)
            try:
                doc = json.loads(value.lstrip("﻿"))
                error = "top level is not an object" if not isinstance(doc, dict) else None if isinstance(doc.get("messages"), list) else "no list of messages"
            except ValueError as e:
                doc, error = None, f"not JSON: {e}"
            if error:
                yield put([(path, folder, error, None, None, None, None, [])])
                continue
            rows = [(path, folder, None, None, None, None, None, [])]  # the export itself
            for pos, m in enumerate(x for x in doc["messages"] if isinstance(x, dict)):
                raw = json.dumps(m, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
                rows.append((path, folder, None, pos, whole_number(m.get("id")), flat_text(m.get("text")), raw, candidates(m, folder)))
                if len(rows) >= 1000:
                    yield put(rows)
                    rows = []
            if rows:
                yield put(rows)


def local_path(uri: str) -> str:
    """A path without scheme and authority of the file scheme; other stores keep theirs."""
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri


def read_exports(spark: SparkSession, root: str, name: str = "result.json") -> DataFrame:
    """All exports under root: a row with pos null for each file (with ``error`` if it is not an export) and one for
    each message; objects among the messages only. Files without messages have their one row."""
    raw = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).text(root)
    return raw.select(F.col("_metadata.file_path").alias("path"), "value").mapInArrow(_parse, MESSAGES)


def file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Every file under root: path, length, extension (lower-cased, empty without one). Contents are not read."""
    own = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    path = F.regexp_replace("path", "^file:/+", "/")
    return own.select(path.alias("path"), F.col("length").alias("length"), F.lower(F.regexp_extract(F.element_at(F.split(path, "/"), -1), r"^.+(\.[^.]+)$", 1)).alias("extension"))


def file_hashes(wanted: DataFrame) -> DataFrame:
    """path, sha256 of the files of wanted(path). Only these are opened, each once, and hashed a
    megabyte at a time; files that are gone have no row."""
    return wanted.select("path").where("path is not null").distinct().mapInArrow(_hashed, "path string, sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow import fs

    for batch in batches:
        paths, sums = [], []
        for path in batch.column(0).to_pylist():
            files, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
            if files.get_file_info(name).type != fs.FileType.File:
                continue
            own = hashlib.sha256()
            with files.open_input_stream(name) as f:
                while block := f.read(1 << 20):
                    own.update(block)
            paths.append(path)
            sums.append(own.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sums, pa.string())], names=["path", "sha256"])
