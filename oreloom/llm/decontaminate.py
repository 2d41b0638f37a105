"""Benchmark decontamination by winnowing.

Every run of ``window`` words has ``window - k + 1`` word k-grams; its fingerprint is the smallest of their hashes.
Equal runs have equal fingerprints, so joining the fingerprints of documents with those of the benchmark finds every
shared run of at least ``window`` words. A joined fingerprint is extended to its whole run, first by the run's hash
and then word for word. Items shorter than ``window`` words are one run of their own length, for which winnowing
guarantees nothing: for them every run of that length is hashed.

The benchmark is a stated query set. It is cut into blocks of bounded size (``block_bytes``); each block's index is
shipped to the executors and the documents stream past it without a shuffle. A benchmark beyond one block adds a pass
per block, never a larger broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io
from ._text import ALNUM, Words, parts

WINDOW, K = 10, 6
#: Benchmark text shipped to the executors at a time.
BLOCK_BYTES = 16 << 20
_BITS = 22


class Runs:
    """The runs of some number of words of benchmark items: 32 bits of their hashes, sorted, and their places in the text."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray, items: np.ndarray, text: bytes, ends: np.ndarray):
        order = np.lexsort((places, items, hashes))
        hashes, places, items, ends = hashes[order], places[order], items[order], ends[order]
        keep = np.ones(len(hashes), bool)
        for k in np.flatnonzero((hashes[1:] == hashes[:-1]) & (items[1:] == items[:-1])).tolist():  # an item's run that repeats
            keep[k + 1] = text[places[k] : ends[k]] != text[places[k + 1] : ends[k + 1]]
        self.hashes, self.places = (hashes[keep] >> np.uint64(32)).astype(np.uint32), places[keep].astype(np.uint32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = (hashes >> np.uint64(32)).astype(np.uint32)
        return np.searchsorted(self.hashes, h), np.searchsorted(self.hashes, h, side="right")


class Index:
    """Fingerprints and runs of some benchmark items, beside their words: lower-cased, each with a space behind it.

    In all about three times the text: 8 bytes for each run, 4 for each fingerprint, and the words.
    """

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW, k: int = K):
        self.window, self.k = window, min(k, window)
        self.ids = [i for i, _ in items]
        self.item_at = np.zeros(len(items), np.int64)  # where the words of an item begin
        text, prints, total = [], [], 0
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for lo, data, at in parts(pa.array([t for _, t in items], pa.large_string())):
            w = Words(data, at, ALNUM)
            size = w.end - w.start
            place = np.concatenate(([0], np.cumsum(size + 1)))
            own = np.full(int(place[-1]), 0x20, np.uint8)
            step = np.repeat(w.start - place[:-1], size)
            inner = np.ones(len(own), bool)
            inner[place[1:] - 1] = False
            target = np.flatnonzero(inner)
            own[target] = w.data[target + step]
            text.append(own.tobytes())
            many = np.diff(w.first)
            self.item_at[lo : lo + len(many)] = total + place[w.first[:-1]]
            for n in np.unique(np.minimum(many, window)).tolist():
                if not n:
                    continue
                pos = w.starts(n)
                item = w.text_of(pos)
                pos, item = (pos, item) if n == window else (pos[many[item] == n], item[many[item] == n])
                if n == window:
                    prints.append(np.unique(self.fingerprint(w, pos) >> np.uint64(32)).astype(np.uint32))
                found.setdefault(n, []).append((w.grams(pos, n), total + place[pos], lo + item, total + place[pos + n]))
            total += len(own)
        self.text = b"".join(text)
        self.prints = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint32)
        self.seen = self.bitmap(self.prints)
        self.runs = {}
        for n, some in found.items():
            h, place, item, end = (np.concatenate(x) for x in zip(*some, strict=True))
            self.runs[n] = Runs(h, place, item, self.text, end)
        self.maps = {n: self.bitmap(r.hashes) for n, r in self.runs.items() if n < window}

    @staticmethod
    def bitmap(hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << _BITS, dtype=bool)
        out[hashes >> np.uint32(32 - _BITS)] = True
        return out

    def fingerprint(self, w: Words, pos: np.ndarray) -> np.ndarray:
        """The smallest k-gram hash of each run of ``window`` words that begins at pos."""
        if not len(pos):
            return np.zeros(0, np.uint64)
        grams = w.grams(np.arange(len(w.hash) - self.k + 1), self.k)
        span = self.window - self.k
        n = len(grams) - span
        least = grams[:n].copy()
        for j in range(1, span + 1):
            np.minimum(least, grams[j : n + j], out=least)
        return least[pos]

    def joined(self, prints: np.ndarray) -> np.ndarray:
        """Which fingerprints the benchmark has."""
        if not len(self.prints):
            return np.zeros(len(prints), bool)
        h = (prints >> np.uint64(32)).astype(np.uint32)
        keep = self.seen[h >> np.uint32(32 - _BITS)]
        i = np.searchsorted(self.prints, h[keep])
        i[i == len(self.prints)] = 0
        keep[keep] = self.prints[i] == h[keep]
        return keep

    def hits(self, w: Words) -> dict[int, list[tuple[int, int, list[int]]]]:
        """By text: (first word, number of words, items) of every run that occurs in the benchmark."""
        out: dict[int, list[tuple[int, int, list[int]]]] = {}
        words: dict[int, list[bytes]] = {}
        for size, runs in self.runs.items():
            pos = w.starts(size)
            if size == self.window:
                pos = pos[self.joined(self.fingerprint(w, pos))]  # the join of fingerprints
                h = w.grams(pos, size)
            else:
                h = w.grams(pos, size)
                keep = self.maps[size][h >> np.uint64(64 - _BITS)]
                pos, h = pos[keep], h[keep]
            lo, hi = runs.find(h)
            keep = hi > lo
            pos, lo, hi = pos[keep], lo[keep], hi[keep]
            for p, i, a, b in zip(pos.tolist(), w.text_of(pos).tolist(), lo.tolist(), hi.tolist(), strict=True):
                if i not in words:
                    words[i] = w.words(i)
                p -= int(w.first[i])
                run = b" ".join(words[i][p : p + size]) + b" "
                places = [x for x in runs.places[a:b].tolist() if self.text.startswith(run, x)]  # word for word
                if places:
                    items = np.unique(np.searchsorted(self.item_at, places, side="right") - 1).tolist()
                    out.setdefault(i, []).append((p, size, items))
        return out


_SPANS = "array<struct<start:int,end:int,item:string>>"


def _find(batches: Iterator[pa.RecordBatch], index: Index, text: str) -> Iterator[pa.RecordBatch]:
    """Columns row, words, spans; the spans of this index are put behind those of earlier ones."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("item", pa.string())]))
    for batch in batches:
        column = pc.struct_field(batch.column(0), text)
        counts, spans = [], []
        for _, data, at in parts(column):
            w = Words(data, at, ALNUM)
            found = index.hits(w)
            counts.extend(np.diff(w.first).tolist())
            for i in range(len(at) - 1):
                own = []
                last: dict[int, int] = {}  # an item's run that grows by the next window is one span
                for p, size, items in sorted(found.get(i, ()), key=lambda x: (x[0], x[1])):
                    for j in items:
                        k = last.get(j)
                        if k is not None and p <= own[k]["end"]:
                            own[k]["end"] = max(own[k]["end"], p + size)
                        else:
                            last[j] = len(own)
                            own.append({"start": p, "end": p + size, "item": index.ids[j]})
                spans.append(own)
        if batch.num_columns > 1:
            spans = [[*a, *b] for a, b in zip(batch.column(2).to_pylist(), spans, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, kind)], names=["row", "words", "spans"])


def _searched(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Columns row (of docs), words, spans."""
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("i"), F.col(f"`{item_text}`").alias("t")).where("t is not null")
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = _io.blocks_of(total, block_bytes)
    out = _io.packed(docs)
    schema = _io.schema_with(out, "words bigint", f"spans {_SPANS}")
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == b) if n > 1 else items
        sent = spark.sparkContext.broadcast(Index([(r.i, r.t) for r in own.collect()], window, k))  # about three times block_bytes
        out = out.transform(_io.arrow(lambda batches, sent=sent: _find(batches, sent.value, text), schema))
    return out


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """docs with ``_words`` (number of words) and ``_spans`` (start, end, item: maximal joined runs, in words).

    A null or empty text has no words. A null item_id counts as the string ``null``; an item whose text is null or
    has no word matches nothing. Repeated rows stay as they are; columns of docs with these two names are replaced.
    """
    own = docs.select(*(docs[f"`{c}`"] for c in docs.columns if c.lower() not in ("_words", "_spans")))
    return _searched(own, benchmark, text, **how).select("row.*", F.col("words").alias("_words"), F.col("spans").alias("_spans"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, n_words, spans -> id, n_words, n_hit, n_items, items_sha256."""
    for batch in batches:
        hit, many, sha = [], [], []
        for spans in batch.column(2).to_pylist():
            total, end = 0, 0
            for s in sorted(spans, key=lambda s: s["start"]):
                total += max(0, s["end"] - max(end, s["start"]))
                end = max(end, s["end"])
            items = sorted({s["item"] for s in spans})
            hit.append(total)
            many.append(len(items))
            sha.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hit, pa.int64()), pa.array(many, pa.int64()), pa.array(sha, pa.string())], names=[*batch.schema.names[:2], "n_hit", "n_items", "items_sha256"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row per row of docs: id_col, n_words, n_hit, n_items, items_sha256, contaminated."""
    own = docs.select(docs[f"`{id_col}`"].alias("id"), docs[f"`{text}`"].alias("text"))
    found = _searched(own, benchmark, **how).select(F.col("row.id").alias("id"), F.col("words").alias("n_words"), "spans")
    schema = _io.schema_with(found.drop("spans"), "n_hit bigint", "n_items bigint", "items_sha256 string")
    return found.transform(_io.arrow(_digest, schema)).withColumn("contaminated", F.col("n_hit") > 0).withColumnRenamed("id", id_col)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of docs, with their own columns as they are, in which no run of the benchmark occurs."""
    return _searched(docs, benchmark, text, **how).where(F.size("spans") == 0).select("row.*")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_io.table(spark, sf_dir, "documents"), _io.table(spark, sf_dir, "benchmark"))


_WORDS = "regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
runs AS (
  SELECT DISTINCT item, least(len(w), {WINDOW}) AS n, array_to_string(list_slice(w, s, s + least(len(w), {WINDOW}) - 1), ' ') AS run
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) AS s FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM runs),
docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
doc_runs AS (
  SELECT doc_id, s, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS run
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS s FROM docs, sizes WHERE len(w) >= n)
),
hits AS (SELECT d.doc_id, d.s, d.n, r.item FROM doc_runs d JOIN runs r ON d.run = r.run AND d.n = r.n),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
own AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(o.n_items, 0) AS BIGINT) AS n_items,
  coalesce(o.items_sha256, sha256('')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit h USING (doc_id) LEFT JOIN own o USING (doc_id)
"""
