"""Connected components of an edge table, without bringing edges or labels to the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _io

EDGES = "a long, b long"


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (y := up.get(root, root)) != root:
            root = y
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        x, y = min(x, y), max(x, y)
        self.up[y] = x
        self.up.setdefault(x, x)
        return True

    def stars(self) -> list[tuple[int, int]]:
        return [(x, r) for x in list(self.up) if (r := self.find(x)) != x]


def edge_batch(pairs) -> pa.RecordBatch:
    a = np.array(list(pairs), dtype=np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["a", "b"])


def _contract(batches: Iterator[pa.RecordBatch], most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each task's edges, as stars; it is put out whenever it holds ``most`` nodes."""
    forest = Forest()
    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(x, y)
        if len(forest.up) > most:
            yield edge_batch(forest.stars())
            forest = Forest()
    yield edge_batch(forest.stars())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b): component is the smallest node reachable.

    Large-star and small-star steps on a table in the shared folder until every component is a star. Neighbour minima
    are partial aggregates written before they are joined, so a node with very many neighbours is split by AQE.
    Rows with a null end are ignored. No edges: an empty table.
    """
    with _io.steps(edges.sparkSession):
        own = edges.where("a is not null and b is not null and a <> b").select("a", "b").transform(_io.arrow(_contract, EDGES))
        now = _io.written(own.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        while True:
            ends = now.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(now.select("v", F.lit(0), F.lit(1)))
            if ends.groupBy("n").agg(F.sum("up").alias("ups"), F.max("down").alias("downs")).where("ups > 1 or (ups = 1 and downs = 1)").isEmpty():
                return _io.result(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct()), "components")
            both = now.union(now.select("v", "u"))
            least = _io.written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
            large = _io.written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
            lower = _io.written(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
            small = large.join(lower, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower)
            after = _io.written(small.distinct(), "edges")
            for old in (now, least, large, lower):
                _io.remove(old)
            now = after
