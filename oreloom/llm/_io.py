"""Tables, shared folders and cut lineage for the operators of this subpackage."""

from __future__ import annotations

import atexit
import math
import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, over all cores where it has fewer files and less than SPLIT bytes for each core: the work on a text costs
    far more than moving it. Larger tables are read as they lie."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    few = len(df._jdf.inputFiles()) < cores and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < cores * SPLIT
    return df.repartition(cores) if few else df


#: Bytes of a file that a scan reads in one task anyway.
SPLIT = 128 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session. Where it is unset, a local
    session (tests) gets one of its own; a cluster has no folder to guess, which is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="oreloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: The part of the shared folder that belongs to this driver process; what is left of it goes when the process ends.
_RUN = uuid.uuid4().hex
_ROOTS: set[str] = set()


def shared_path(spark: SparkSession, kind: str) -> str:
    root = f"{shared_dir(spark)}/oreloom/{_RUN}"
    if root not in _ROOTS:
        _ROOTS.add(root)
        atexit.register(_delete, root, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration())
    return f"{root}/{kind}-{uuid.uuid4().hex}"


def _delete(path: str, jvm, conf) -> None:
    try:
        own = jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(conf).delete(own, True)
    except (Py4JError, OSError):  # the JVM, or the folder, has gone before
        pass


_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open steps", default=())


@contextmanager
def steps(spark: SparkSession):
    """Tables written inside go when the block ends, whether it ends well or not; result() keeps one of them for longer."""
    own: list[str] = []
    token = _OPEN.set((*_OPEN.get(), own))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in own:
            _delete(path, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration())


#: Bounds of an Arrow batch: what a Python worker and its JVM task hold of the input at a time.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def bound_batches(spark: SparkSession) -> None:
    """Lower, never raise, the session's bounds of Arrow batches: texts of any length pass through Python workers."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def arrow(run, schema):
    """For DataFrame.transform: mapInArrow with bounded batches, whose workers give memory back when a task ends."""

    def apply(df: DataFrame) -> DataFrame:
        bound_batches(df.sparkSession)
        return df.mapInArrow(lambda batches: _released(run, batches), schema)

    return apply


def _released(run, batches):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    try:
        yield from run(batches)
    finally:
        import ctypes
        import gc

        import pyarrow as pa

        from . import _text

        _text.forget()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def written(df: DataFrame, kind: str, outer: int = 0) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and survives lost executors. It goes with the innermost steps()."""
    spark = df.sparkSession
    path = shared_path(spark, kind)
    scopes = _OPEN.get()
    if len(scopes) > outer:
        scopes[-1 - outer].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def result(df: DataFrame, kind: str = "result") -> DataFrame:
    """As written(), for what a block of steps() returns: it goes with the block around that one, or with the process."""
    return written(df, kind, outer=1)


def remove(table: DataFrame) -> None:
    """Delete a written table that no later step reads."""
    sc = table.sparkSession.sparkContext
    for p in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        if f"/oreloom/{_RUN}/" in p:
            _delete(p, sc._jvm, sc._jsc.hadoopConfiguration())


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def parts_for(spark: SparkSession, size: float, each: float) -> int:
    """Partitions of about ``each`` of ``size``; never fewer than the session shuffles into."""
    return max(parallelism(spark), blocks_of(size, each))


def packed(docs: DataFrame, **inputs) -> DataFrame:
    """docs with its row in one struct ``row``, beside inputs by name: no name of docs can clash with those of an operator."""
    return docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), *(c.alias(n) for n, c in inputs.items()))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    have = {c.lower() for c in docs.columns}
    while name.lower() in have:
        name += "_"
    return name


def blocks_of(total: float, each: float) -> int:
    return max(1, math.ceil((total or 0) / each))


def schema_with(df: DataFrame, *columns: str) -> StructType:
    """df's schema without columns of the same names, then the columns given as ``name type`` (DDL)."""
    more = [StructField(n, _parse_datatype_string(kind)) for n, _, kind in (c.partition(" ") for c in columns)]
    names = {f.name for f in more}
    return StructType([f for f in df.schema.fields if f.name not in names] + more)
