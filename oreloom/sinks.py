"""Edge sinks: parquet tables between stages, CSV and JSON lines with flattened columns, Markdown tables, an index."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Each table as parquet under its name; a table that exists is replaced."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in tables]


def flat(df: DataFrame) -> DataFrame:
    """Arrays of strings joined by semicolons, other nested columns as JSON: a form that CSV can hold."""

    def one(f):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType):
            return F.array_join(c, "; ").alias(f.name)
        return F.to_json(c).alias(f.name) if isinstance(f.dataType, (ArrayType, MapType, StructType)) else c

    return df.select(*(one(f) for f in df.schema.fields))


def write_csv(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    flat(df).write.mode("overwrite").partitionBy(*by).csv(path, header=True, escape='"', encoding="UTF-8")


def write_jsonl(df: DataFrame, path: str, by: Iterable[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*by).json(path)


def write_facts(facts: DataFrame, folder: str) -> None:
    """Facts by category and review flag as parquet and CSV, and as JSON lines."""
    facts.write.mode("overwrite").partitionBy("category", "needs_review").parquet(f"{folder}/facts")
    write_csv(facts, f"{folder}/facts_csv", ("needs_review",))
    write_jsonl(facts, f"{folder}/facts_jsonl")


def read_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Facts of write_facts() with the types of their partition columns."""
    own = spark.read.parquet(f"{folder}/facts")
    return own.withColumns({"category": F.col("category").cast("string"), "needs_review": F.col("needs_review").cast("boolean")})


def token_postings(df: DataFrame, key: str, text: str) -> DataFrame:
    """(token, key), each once, of the lower-cased words of texts that are not blank: an inverted index to write
    partitioned by token."""
    own = df.where(F.trim(F.coalesce(text, F.lit(""))) != "")
    return own.select(F.col(key), F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))).alias("token"))


def markdown_table(df: DataFrame, limit: int, whole: str = "") -> str:
    """The first rows of a report table as Markdown. A table that is longer says so, and where it is whole."""
    rows = flat(df).limit(limit + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    more = [f"\nOnly the first {limit} rows{f'; all are in `{whole}`' if whole else ''}."] if len(rows) > limit else []
    return "\n".join(lines + ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows[:limit]] + more) + "\n"


def write_report(spark: SparkSession, path: str, title: str, sections: Mapping[str, DataFrame | str], limit: int = 50) -> None:
    """A Markdown report: a heading and one table or text for each section, as one text file through Spark's file system.

    The Markdown shows up to ``limit`` rows of a table; each table is written whole as parquet beside it, in a folder
    named like the report (``report_tables`` for ``report.md``).
    """
    parts = [f"# {title}\n"]
    folder = path.removesuffix(".md") + "_tables"
    for name, body in sections.items():
        parts.append(f"## {name}\n")
        if isinstance(body, str):
            parts.append(body)
            continue
        own = name.lower().replace(" ", "_")
        write_tables({own: body}, folder)
        parts.append(markdown_table(body, limit, f"{folder.rsplit('/', 1)[-1]}/{own}"))
    write_text(spark, path, "\n".join(parts))


def write_markdown(spark: SparkSession, path: str, title: str, sections: Mapping[str, DataFrame], limit: int, whole: str) -> None:
    """A Markdown report whose tables stand whole in ``whole``, another output of the same command."""
    parts = [f"# {title}\n"]
    for name, body in sections.items():
        parts += [f"## {name}\n", markdown_table(body, limit, whole)]
    write_text(spark, path, "\n".join(parts))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One text file, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text, "utf-8"))
    out.close()


def copy_photos(selected: DataFrame, folder: str, key: str = "project_id", per_project: int = 2, most: int = 100) -> dict[str, list[str]]:
    """Copy the first photos of the selected projects of a report (at most ``most``) beside it, emptying the folder first.

    Returns the copies by project. Files that are gone are left out. Report selections are a few rows by definition.
    """
    spark = selected.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    target = path(folder).getFileSystem(conf)
    target.delete(path(folder), True)
    out: dict[str, list[str]] = {}
    for r in selected.select(key, F.slice("photo_paths", 1, per_project).alias("photos")).orderBy(key).limit(most).collect():
        for k, photo in enumerate(r.photos or []):
            own = path(photo)
            source = own.getFileSystem(conf)
            if source.exists(own):
                copy = f"{folder}/{r[key]}-{k + 1}{photo[photo.rfind('.') :] if '.' in photo.rsplit('/', 1)[-1] else ''}"
                jvm.org.apache.hadoop.fs.FileUtil.copy(source, own, target, path(copy), False, conf)
                out.setdefault(str(r[key]), []).append(copy)
    return out


def contact_sheet(photos: list[str], path: str, cell: tuple[int, int] = (420, 315)) -> bool:
    """One JPEG of local photos: two columns up to four of them, else three. False where no image library is installed
    or fewer than three can be read."""
    try:
        from PIL import Image
    except ImportError:
        return False
    images = []
    for p in photos:
        try:
            images.append(Image.open(p).convert("RGB"))
        except OSError:
            continue
    if len(images) < 3:
        return False
    columns = 2 if len(images) <= 4 else 3
    sheet = Image.new("RGB", (cell[0] * columns, cell[1] * -(-len(images) // columns)), "white")
    for k, image in enumerate(images):
        image.thumbnail(cell)
        sheet.paste(image, (k % columns * cell[0], k // columns * cell[1]))
    sheet.save(path, "JPEG")
    return True
