"""Numbering, counting and picking rows under total orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, order: Sequence[Column], name: str = "id") -> DataFrame:
    """df with the place of each row in a total order, from 1.

    The range-partitioned sort gives each row its partition and its place in it; places before a partition come from
    the partition sizes, a table of one row for each partition.
    """
    laid = df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id())
    laid = laid.withColumns({"_part": F.shiftright("_m", 33), "_row": F.col("_m").bitwiseAND((1 << 33) - 1)})
    sizes = laid.groupBy("_part").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_size")
    return laid.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_m", "_part", "_row", "_before")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; ``place`` counts from 1."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= k)


def first_of_each(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_k(df, by, order, 1).drop("place")


def histogram(df: DataFrame, value: Column, n: int | None = None) -> DataFrame:
    """Counts of a value that is not null or blank: by count descending, then value; the first n if given."""
    own = df.select(value.cast("string").alias("value")).where(F.trim(F.coalesce("value", F.lit(""))) != "").groupBy("value").agg(F.count("*").alias("n"))
    own = own.orderBy(F.desc("n"), F.asc("value"))
    return own if n is None else own.limit(n)


def last_wins(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The last row of each key in an order, by one partial aggregate."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*")


def ordered_union(*tables: DataFrame) -> DataFrame:
    """Tables one after another with ``source_no``, the number of the table from 0."""
    out = None
    for k, t in enumerate(tables):
        own = t.withColumn("source_no", F.lit(k))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def anti_seen(planned: DataFrame, seen: DataFrame, key: Sequence[str]) -> DataFrame:
    """Planned rows whose key has not been seen."""
    return planned.join(seen.select(*key).distinct(), list(key), "left_anti")
