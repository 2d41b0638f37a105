"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A shard is, one after another:

* data frames: each a whole zstandard frame with its own content checksum, holding the ids of some whole documents as
  little-endian unsigned integers of 2 or 4 bytes;
* a skippable frame (magic 0x184D2A50): the document index, a zstandard frame of the JSON header and of the arrays
  doc_id (int64), number of ids (uint32) and frame number (uint32), in the order written;
* a skippable frame (magic 0x184D2A5E): the seek table of zstandard's seekable format - compressed size, plain size and
  the low 32 bits of XXH64 for each data frame - ending in the number of frames, the flags and 0x8F92EAB1.

So ``zstd -d`` still reads a shard, and a reader finds the seek table from the end, the documents in the index, and
decompresses the frames of the requested documents only. Shards hold ascending ranges of ids: a task writes one under a
name of its attempt and renames it when whole, so a repeated task leaves the same file.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _io
from ._pieces import encoder
from ._text import parts

INDEX_MAGIC, SEEK_MAGIC, SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
#: Plain bytes after which a frame ends (a longer document is a frame of its own).
FRAME_BYTES = 1 << 18
END_ID = 1
NO_ID = -(1 << 63)  # stands for a null id in a shard
#: Bytes of text encoded at a time, and of a shard.
PART_BYTES, SHARD_BYTES = 1 << 20, 256 << 20


class ShardWriter:
    def __init__(self, out, width: int, header: dict):
        self.out, self.width, self.header = out, width, header
        self.zstd = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.of_frame: list[np.ndarray] = []

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Whole documents, as one frame."""
        data = ids.astype(f"<u{self.width}").tobytes()
        frame = self.zstd.compress(data)
        self.out.write(frame)
        self.of_frame.append(np.full(len(doc_ids), len(self.frames), dtype="<u4"))
        self.frames.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.ids.append(doc_ids.astype("<i8"))
        self.counts.append(counts.astype("<u4"))

    def close(self) -> None:
        arrays = b"".join(np.concatenate(x).tobytes() if x else b"" for x in (self.ids, self.counts, self.of_frame))
        head = json.dumps(self.header | {"width": self.width, "documents": sum(map(len, self.ids))}, sort_keys=True).encode()
        index = self.zstd.compress(struct.pack("<I", len(head)) + head + arrays)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, SEEK_END)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to the documents of a shard; ``source`` is a seekable binary file."""

    def __init__(self, source, size: int):
        self.source = source
        n, flags, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEK_END or flags != 0x80:
            raise ValueError("no seek table at the end of the shard")
        start = size - 9 - 12 * n
        if struct.unpack("<II", self._read(start - 8, 8)) != (SEEK_MAGIC, 12 * n + 9):
            raise ValueError("the seek table is damaged")
        self.frames = np.frombuffer(self._read(start, 12 * n), dtype="<u4").reshape(n, 3)
        self.begin = np.concatenate(([0], np.cumsum(self.frames[:, 0].astype(np.int64))))
        at = int(self.begin[-1])
        magic, length = struct.unpack("<II", self._read(at, 8))
        if magic != INDEX_MAGIC:
            raise ValueError("no document index after the last frame")
        raw = zstandard.ZstdDecompressor().decompress(self._read(at + 8, length))
        head = struct.unpack("<I", raw[:4])[0]
        self.header = json.loads(raw[4 : 4 + head])
        m, at = self.header["documents"], 4 + head
        self.doc_ids = np.frombuffer(raw, "<i8", m, at)
        self.counts = np.frombuffer(raw, "<u4", m, at + 8 * m)
        self.of_frame = np.frombuffer(raw, "<u4", m, at + 12 * m)
        self.zstd = zstandard.ZstdDecompressor()

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, k: int) -> np.ndarray:
        packed, plain, check = (int(x) for x in self.frames[k])
        data = self.zstd.decompress(self._read(int(self.begin[k]), packed), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} does not match its checksum")
        return np.frombuffer(data, dtype=f"<u{self.header['width']}")

    def documents(self, wanted=None) -> Iterator[tuple[int, np.ndarray]]:
        """(position in the shard, ids) of every document, or of those whose id is in ``wanted``."""
        rows = np.arange(len(self.doc_ids)) if wanted is None else np.flatnonzero(np.isin(self.doc_ids, list(wanted)))
        first = np.cumsum(self.counts, dtype=np.int64) - self.counts
        frame_of = self.of_frame[rows]
        for k in np.unique(frame_of).tolist():  # only these frames are decompressed
            ids = self.frame(k)
            base = int(first[np.searchsorted(self.of_frame, k)])
            for r in rows[frame_of == k].tolist():
                at = int(first[r]) - base
                yield r, ids[at : at + int(self.counts[r])]


def _ended(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some texts with end_id behind each text."""
    stops = np.cumsum(counts + 1)
    out = np.full(len(ids) + len(counts), end_id, dtype=np.uint32)
    inner = np.ones(len(out), dtype=bool)
    inner[stops - 1] = False
    out[inner] = ids
    return out, counts + 1


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get()
    shard = task.partitionId()
    code = encoder(tokenizer)
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    name = f"{path}/shard-{shard:06d}.tok.zst"
    draft = f"{path}/.{shard:06d}-{task.taskAttemptId()}"
    docs = tokens = 0
    with fs.open_output_stream(draft) as out:
        writer = ShardWriter(out, code.width, {"end_id": end_id, "tokenizer": tokenizer.rsplit("/", 1)[-1]})
        for batch in batches:
            keys = batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            for lo, data, at in parts(batch.column(1), PART_BYTES):
                ids, counts = _ended(*code.encode(data, at), end_id)
                stop = np.cumsum(counts)
                i = 0
                while i < len(counts):
                    began = int(stop[i - 1]) if i else 0
                    j = max(i + 1, int(np.searchsorted(stop, began + FRAME_BYTES // code.width, side="right")))
                    writer.add(keys[lo + i : lo + j], ids[began : int(stop[j - 1])], counts[i:j])
                    i = j
                docs, tokens = docs + len(counts), tokens + len(ids)
        writer.close()
    code.clear()
    if docs:
        fs.move(draft, name)
    else:
        fs.delete_file(draft)
    yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/shard-{shard:06d}.tok.zst"], "docs": [docs], "tokens": [tokens]})


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write docs in ascending id_col order (ties by text) to shards in ``folder``, a URI that all executors reach.

    Returns the manifest, one row for each shard: shard, path, docs, tokens, start (ids in all shards before it). A
    null or empty text has the end id only. A null id is written first, as NO_ID. No documents: no shard.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(_io.parts_for(spark, size, SHARD_BYTES), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())
    done = _io.written(rows.transform(_io.arrow(lambda b: _write(b, folder, tokenizer, end_id), "shard long, path string, docs long, tokens long")), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    return done.where("docs > 0").withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch], wanted, digest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, begin in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            fs, path = pyarrow.fs.FileSystem.from_uri(uri)
            with fs.open_input_file(path) as source:
                shard = ShardReader(source, source.size())
                first = begin + np.cumsum(shard.counts, dtype=np.int64) - shard.counts
                rows, last = [], []
                for r, ids in shard.documents(wanted):
                    rows.append(r)
                    last.append(zlib.crc32(ids.astype("<u4").tobytes()) if digest else ids.astype(np.int64))
                    if len(rows) >= (10_000 if digest else 500):
                        yield _out(shard, first, rows, last, digest)
                        rows, last = [], []
                yield _out(shard, first, rows, last, digest)


def _out(shard: ShardReader, first: np.ndarray, rows: list[int], last: list, digest: bool) -> pa.RecordBatch:
    ids = shard.doc_ids[rows].astype(np.int64)
    arrays = [pa.array(ids, mask=ids == NO_ID), pa.array(first[rows].astype(np.int64)), pa.array(shard.counts[rows].astype(np.int64)), pa.array(last, pa.int64() if digest else pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(arrays, names=["id", "start", "n_tokens", "ids_crc32" if digest else "ids"])


def read_tokens(manifest: DataFrame, id_col: str = "doc_id", wanted: list[int] | None = None, digest: bool = False) -> DataFrame:
    """Documents read back from the shards of a manifest: id_col, start, n_tokens and ids (or ids_crc32 with ``digest``).

    ``wanted``: only documents with these ids, by decompressing only the frames that hold them.
    """
    last = "ids_crc32 long" if digest else "ids array<long>"
    spark = manifest.sparkSession
    found = manifest.select("path", "start").repartition(_io.parts_for(spark, manifest.count(), 1), "path").transform(_io.arrow(lambda b: _read(b, wanted, digest), f"id long, start long, n_tokens long, {last}"))
    return found.withColumnRenamed("id", id_col)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Setting that names the folder of token files; where it is unset they go with the process that wrote them.
FOLDER = "spark.oreloom.tokens.dir"


def written_and_read(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of docs, read back from files written into a new folder inside FOLDER."""
    folder = spark.conf.get(FOLDER, None) or spark.sparkContext.getConf().get(FOLDER, None)
    folder = f"{folder.rstrip('/')}/tokens-{uuid.uuid4().hex}" if folder else _io.shared_path(spark, "tokens")
    return read_tokens(write_tokens(docs, folder, default_tokenizer()), digest=True)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_and_read(spark, _io.table(spark, sf_dir, "documents"))
