"""Streaming extensions: exports that keep arriving, and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import ranking


def windowed_counts(events: DataFrame, every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and users by window and type. On a stream users are approximate and late rows beyond ``late`` are dropped."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    users = F.approx_count_distinct("user_id") if events.isStreaming else F.count_distinct("user_id")
    out = own.groupBy(F.window("ts", every).alias("w"), "event_type").agg(F.count("*").alias("n"), users.alias("users"))
    return out.select(F.col("w.start").alias("hour"), "event_type", "n", "users")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Session windows by user."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    out = own.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return out.select("user_id", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "n")


#: Micro-batches after which the changes are merged into one state.
COMPACT = 16


def merge_stream(variants: DataFrame, target: str, checkpoint: str, key: str = "message_id", order: str = "ord") -> StreamingQuery:
    """Keep the last variant of each key in a table, of equal ones that of the later micro-batch.

    A micro-batch writes its own changes only; every COMPACT batches the state and the changes since then become a new
    state. Folders are named by the batch and listed when they are whole, so a repeated batch gives one state.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = ranking.last_wins(batch, key, [F.col(order)]).withColumn("_batch", F.lit(number))
        own.write.mode("overwrite").parquet(f"{target}/change-{number}")
        _note(spark, target, "change", number)
        if number % COMPACT == COMPACT - 1:
            _current(spark, target, key, order).write.mode("overwrite").parquet(f"{target}/state-{number}")
            _note(spark, target, "state", number)

    return variants.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _note(spark: SparkSession, target: str, kind: str, number: int) -> None:
    spark.range(1).select(F.lit(kind).alias("kind"), F.lit(number).alias("number")).coalesce(1).write.mode("append").json(f"{target}/states")


def _current(spark: SparkSession, target: str, key: str, order: str) -> DataFrame | None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/states")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    noted = spark.read.schema("kind string, number long").json(f"{target}/states").distinct()
    state = noted.where("kind = 'state'").agg(F.coalesce(F.max("number"), F.lit(-1))).first()[0]
    changes = sorted(r.number for r in noted.where(F.col("number") > state).where("kind = 'change'").collect())  # at most COMPACT
    folders = [f"{target}/state-{state}"] * (state >= 0) + [f"{target}/change-{n}" for n in changes]
    return ranking.last_wins(spark.read.parquet(*folders), key, [F.col(order), F.col("_batch")])


def read_state(spark: SparkSession, target: str, key: str = "message_id", order: str = "ord") -> DataFrame | None:
    """The latest state of merge_stream(), or None before the first batch."""
    own = _current(spark, target, key, order)
    return own if own is None else own.drop("_batch")
