"""Near-duplicate embeddings by PCA-ordered tiled comparison.

1. Vectors with equal bytes and label are one class with a multiplicity. Vectors that are null, zero or hold null or
   non-finite components, and those without label or id, take no part.
2. The second moments of the unit vectors, summed on the executors, give the principal axes (one d x d matrix for each
   vector length; its size depends on the length of the vectors only).
3. Classes are dealt by (label, length, first coordinate) into tiles of at most ``TILE`` vectors with the bounding box
   of their leading coordinates. Two tiles whose boxes are further apart than the threshold allows never meet; groups
   of tiles are met first, by a band join on the first axis.
4. For two tiles the products of the leading coordinates are summed segment by segment; what the remaining coordinates
   can add is at most the product of the suffix norms, and pairs whose bound falls below the threshold are dropped.
   Pairs within 1e-9 of the threshold are decided by the plain cosine of the unrotated vectors.
   A task puts out link counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io
from ._graph import Forest, components
from .near_duplicates import _groups

TILE, BOX = 2048, 4
#: Tiles whose common box is met before their own (a power of two); bytes of vectors and tile pairs of a task.
GROUP, TASK_BYTES, TASK_PAIRS = 64, 64 << 20, 64
SEGMENTS = (8, 16, 32)


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns id, label, vec -> id, label, dim, key, raw (the vector's bytes; null where it takes no part)."""
    for batch in batches:
        raw, dims, keys = [], [], []
        for i, v, label in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(1).to_pylist(), strict=True):
            data = None
            if i is not None and label is not None and v.is_valid and len(v.values) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all() and x.any():
                    data = x.tobytes()
            raw.append(data)
            dims.append(0 if data is None else len(v.values))
            keys.append(None if data is None else hashlib.blake2b(data + label.encode(), digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()), pa.array(raw, pa.binary())], names=["id", "label", "dim", "key", "raw"])


def _rows(raw, n: int, kind: str) -> np.ndarray:
    """n vectors as unit rows in double precision."""
    x = np.frombuffer(raw, dtype=kind).astype(np.float64).reshape(n, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _unit(raw: list, kind: str) -> np.ndarray:
    return _rows(b"".join(raw), len(raw), kind)


def _moments(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """Sums of the products of coordinates, by vector length, one set for each task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for d in np.unique(dims).tolist():
            x = _unit(batch.column(1).filter(pa.array(dims == d)).to_pylist(), kind)
            total[d] = total.get(d, 0) + x.T @ x
    for d, m in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d)), pa.array(m.reshape(-1))], names=["dim", "k", "v"])


def _axes(classes: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """By vector length: the principal axes as columns, the one of largest second moment first."""
    parts = classes.select("dim", "raw").transform(_io.arrow(lambda b: _moments(b, kind), "dim int, k long, v double"))
    by: dict[int, np.ndarray] = {}
    for r in parts.groupBy("dim", "k").agg(F.sum("v").alias("v")).collect():  # d * d rows
        by.setdefault(r.dim, np.zeros(r.dim * r.dim))[r.k] = r.v
    return {d: np.linalg.eigh(m.reshape(d, d))[1][:, ::-1] for d, m in by.items()}


def _tiles(batches: Iterator[pa.RecordBatch], axes, kind: str, tile: int) -> Iterator[pa.RecordBatch]:
    """Columns label, dim, first, id, times, raw, sorted by the first three -> one row for each tile."""
    from pyspark import TaskContext

    part, k, rows, key = TaskContext.get().partitionId(), 0, [], None

    def put():
        nonlocal k, rows
        dim = key[1]
        x = _unit([r[2] for r in rows], kind) @ axes.value[dim][:, :BOX]
        x = np.pad(x, ((0, 0), (0, BOX - x.shape[1])))
        out = {"label": [key[0]], "dim": [dim], "tile": [(part << 32) | k], "lo": [x.min(axis=0).tolist()], "hi": [x.max(axis=0).tolist()], "ids": [np.array([r[0] for r in rows], np.int64).tobytes()], "times": [np.array([r[1] for r in rows], np.int64).tobytes()], "raw": [b"".join(r[2] for r in rows)]}
        k, rows = k + 1, []
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([("label", pa.string()), ("dim", pa.int32()), ("tile", pa.int64()), ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())), ("ids", pa.binary()), ("times", pa.binary()), ("raw", pa.binary())]))

    for batch in batches:
        for label, dim, i, times, raw in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "id", "times", "raw")), strict=True):
            if rows and (key != (label, dim) or len(rows) >= tile):
                yield put()
            key = (label, dim)
            rows.append((i, times, raw))
    if rows:
        yield put()


def linked_pairs(x: np.ndarray, y: np.ndarray, ux: np.ndarray, uy: np.ndarray, threshold: float, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the linked pairs of rotated unit vectors x and y; ux and uy are the same vectors unrotated."""
    d = x.shape[1]
    cuts = [c for c in SEGMENTS if c < d] + [d]
    norm = lambda v, c: np.sqrt(np.maximum(0, 1 - (v[:, :c] * v[:, :c]).sum(axis=1))) if c < d else np.zeros(len(v))
    lead = cuts[0]
    p = x[:, :lead] @ y[:, :lead].T
    keep = p + norm(x, lead)[:, None] * norm(y, lead)[None, :] >= threshold - 1e-9
    if within:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    p = p[i, j]
    for a, b in zip(cuts, cuts[1:], strict=False):
        sx, sy = norm(x, b), norm(y, b)
        for lo in range(0, len(i), 1 << 17):
            s = slice(lo, lo + (1 << 17))
            p[s] += np.einsum("ij,ij->i", x[i[s], a:b], y[j[s], a:b])
        keep = p + sx[i] * sy[j] >= threshold - 1e-9
        i, j, p = i[keep], j[keep], p[keep]
    link = p >= threshold
    for k in np.flatnonzero(np.abs(p - threshold) < 1e-9):
        link[k] = ux[i[k]] @ uy[j[k]] >= threshold
    return i[link], j[link]


def _meet(batches: Iterator[pa.RecordBatch], axes, kind: str, threshold: float) -> Iterator[pa.RecordBatch]:
    """Columns a, b, tile, dim, ids, times, raw: the one or two tiles of each pair. Puts out a, b (forest) or a, links."""
    for batch in _groups(batches, 2):
        first: dict = {}
        for a, b, tile, dim, ids, times, raw in zip(*(batch.column(c) for c in range(7)), strict=True):
            own = (tile.as_py(), dim.as_py(), ids.as_buffer(), times.as_buffer(), raw.as_buffer())
            pair = (a.as_py(), b.as_py())
            if pair[0] != pair[1] and pair not in first:
                first = {pair: own}
                continue
            left, right = first.get(pair, own), own
            data = []
            for _, d, i, t, r in (left, right):
                i = np.frombuffer(i, np.int64)
                u = _rows(r, len(i), kind)
                data.append((i, np.frombuffer(t, np.int64), u, u @ axes.value[d]))
            (ix, tx, ux, x), (iy, ty, uy, y) = data
            p, q = linked_pairs(x, y, ux, uy, threshold, pair[0] == pair[1])
            many = [np.zeros(len(ix), np.int64), np.zeros(len(iy), np.int64)]
            np.add.at(many[0], p, ty[q])
            np.add.at(many[1], q, tx[p])
            forest = Forest()
            for u, v in zip(ix[p].tolist(), iy[q].tolist(), strict=True):
                forest.join(u, v)
            stars = np.array(forest.stars(), np.int64).reshape(-1, 2)
            count_ids, counts = np.concatenate([ix[many[0] > 0], iy[many[1] > 0]]), np.concatenate([many[0][many[0] > 0], many[1][many[1] > 0]])
            n, m = len(stars), len(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([stars[:, 0], count_ids])), pa.array(np.concatenate([stars[:, 1], np.zeros(m, np.int64)]), mask=np.arange(n + m) >= n), pa.array(np.concatenate([np.zeros(n, np.int64), counts]))], names=["a", "b", "links"])
            first = {}


def embedding_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding", label: str = "label", threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """One row per row of vectors: id_col, n_links, component_id (smallest id reachable by links), kept.

    Vectors are compared only with those of the same label and length; copies link with each other. A vector that is
    null, empty, zero or holds null or non-finite components, or has no label or id, has no link, is its own component
    and is kept. Rows that share an id are one node with the links of each of its rows. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    with _io.steps(spark):
        kind = "f4" if "float" in dict(vectors.dtypes)[vec] else "f8"
        base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vec).cast("array<float>" if kind == "f4" else "array<double>").alias("vec"))
        rows = _io.written(base.transform(_io.arrow(_valid, "id long, label string, dim int, key binary, raw binary")), "vectors")
        valid = rows.where("key is not null")
        classes = _io.written(valid.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("raw").alias("raw")), "classes")
        axes = spark.sparkContext.broadcast(_axes(classes, kind))  # d * d numbers for each vector length

        lead = classes.transform(_io.arrow(lambda b: _lead(b, axes, kind), _io.schema_with(classes, "first double")))
        size = classes.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
        laid = lead.repartitionByRange(_io.parts_for(spark, size, TASK_BYTES), "label", "dim", "first").sortWithinPartitions("label", "dim", "first")
        tiles = _io.written(laid.select("label", "dim", "id", "times", "raw").transform(_io.arrow(lambda b: _tiles(b, axes, kind, tile), "label string, dim int, tile long, lo array<double>, hi array<double>, ids binary, times binary, raw binary")), "tiles")

        pairs = _io.written(_near_tiles(tiles.select("label", "dim", "tile", "lo", "hi"), 2 - 2 * threshold + 1e-9), "pairs")
        parts = pairs.select("a", "b", F.col("a").alias("tile")).union(pairs.where("a <> b").select("a", "b", "b"))
        met = parts.join(tiles.select("tile", "dim", "ids", "times", "raw"), "tile").select("a", "b", "tile", "dim", "ids", "times", "raw")
        met = met.repartition(_io.parts_for(spark, pairs.count(), TASK_PAIRS), "a", "b").sortWithinPartitions("a", "b", "tile")
        found = _io.written(met.transform(_io.arrow(lambda b: _meet(b, axes, kind, threshold), "a long, b long, links long")), "links")
        comp = components(found.where("b is not null").select("a", "b"))
        links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
        per_class = classes.select("key", F.col("id").alias("rep"), "times").join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        per_class = per_class.select("key", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
        out = valid.select("id", "key").join(per_class, "key").select("id", "n_links", "component_id")
        out = out.union(rows.where("key is null").select("id", F.lit(0).cast("long"), "id"))
        return _io.result(out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")), "groups")


def _near_tiles(box: DataFrame, reach: float) -> DataFrame:
    """(a, b), a <= b, of tiles of one label and length whose boxes are at most ``reach`` (squared) apart.

    Boxes of GROUP tiles that lie side by side are met first, by a band join on the first axis: each box is posted in the
    cells it covers, and in those within reach on the other side; a pair counts in the first cell that both have. Only
    tiles of near groups are compared one by one, dealt by group.
    """
    def gap(k: int, a: str, b: str):
        return F.pow(F.greatest(F.lit(0.0), F.col(f"lo{a}")[k] - F.col(f"hi{b}")[k], F.col(f"lo{b}")[k] - F.col(f"hi{a}")[k]), 2)

    def near(a: str, b: str):
        return sum((gap(k, a, b) for k in range(1, BOX)), gap(0, a, b)) <= reach

    def side(df: DataFrame, n: str) -> DataFrame:
        return df.select("label", "dim", *(F.col(c).alias(f"{c}{n}") for c in df.columns[2:]))

    box = box.select("label", "dim", F.shiftright("tile", int(math.log2(GROUP))).alias("group"), "tile", "lo", "hi")
    ends = (F.array(*(f(F.col(c)[k]) for k in range(BOX))).alias(c) for c, f in (("lo", F.min), ("hi", F.max)))
    groups = box.groupBy("label", "dim", "group").agg(*ends)
    width = math.sqrt(reach)
    cell = lambda x: F.floor(x / F.lit(width)).cast("int")
    left = side(groups, "1").withColumn("first1", cell(F.col("lo1")[0])).withColumn("cell", F.explode(F.sequence("first1", cell(F.col("hi1")[0]))))
    first, last = cell(F.col("lo2")[0] - width), cell(F.col("hi2")[0] + width)
    right = side(groups, "2").withColumn("first2", first).withColumn("cell", F.explode(F.sequence("first2", last)))
    met = left.join(right, ["label", "dim", "cell"]).where((F.col("cell") == F.greatest("first1", "first2")) & (F.col("group1") <= F.col("group2")) & near("1", "2"))
    met = met.select("label", "dim", "group1", "group2").join(side(box, "1"), ["label", "dim", "group1"]).join(side(box, "2"), ["label", "dim", "group2"])
    return met.where((F.col("tile1") <= F.col("tile2")) & near("1", "2")).select(F.col("tile1").alias("a"), F.col("tile2").alias("b"))


def _lead(batches: Iterator[pa.RecordBatch], axes, kind: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims, raw = batch.column(batch.schema.get_field_index("dim")).to_numpy(), batch.column(batch.schema.get_field_index("raw"))
        first = np.zeros(batch.num_rows)
        for d in np.unique(dims).tolist():
            own = dims == d
            first[own] = _unit(raw.filter(pa.array(own)).to_pylist(), kind) @ axes.value[d][:, 0]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first)], names=[*batch.schema.names, "first"])


def op2_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_duplicates(_io.table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
many AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN many USING (vec_id)
"""
