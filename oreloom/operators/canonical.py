"""Canonical messages: one row per message id from its variants in several exports, with media, profile and statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import meaningful, preview
from ..sources import archive


@dataclass
class Archive:
    """The tables of an ingested archive, lazy."""

    exports: DataFrame
    rejects: DataFrame
    variants: DataFrame
    candidates: DataFrame
    messages: DataFrame
    media: DataFrame


def _field(name: str) -> Column:
    """A field of the raw message as text: strings bare, anything else as JSON; null if it is missing or null."""
    return F.expr(f"try_variant_get(try_parse_json(raw_json), '$[\"{name}\"]', 'string')")


_FIELDS = ("type", "date", "date_unixtime", "from", "from_id", "author", "edited", "edited_unixtime", "reply_to_message_id", "forwarded_from", "forwarded_from_id", "reactions", "text_entities", "photo", "file", "mime_type", "media_type", "width", "height", "photo_file_size", "thumbnail_file_size", "file_size")


def ingest(spark: SparkSession, root: str, hashes: bool = True) -> Archive:
    """Read all exports under root and merge them. ``hashes``: read media contents for their SHA-256."""
    base = archive.local_path(root.rstrip("/"))
    rows = archive.read_exports(spark, root)
    inventory = archive.file_inventory(spark, root)
    return merge(rows, inventory, base, archive.file_hashes(_wanted(rows)) if hashes else None)


def _wanted(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("candidates").alias("c")).where("c.target is not null").select(F.col("c.target").alias("path")).distinct()


def merge(rows: DataFrame, inventory: DataFrame, root: str, hashes: DataFrame | None = None) -> Archive:
    """Tables from the rows of read_exports() and a file inventory.

    Order of the variants of a message: the export at the root first, then lower-cased path, then position.
    """
    is_root = F.col("json_path") == F.lit(f"{root}/result.json")
    rejects = rows.where("error is not null").select("json_path", "error")
    own = rows.where("error is null and pos is not null").withColumn("is_root", is_root)
    own = own.withColumns({f"f_{n}": _field(n) for n in _FIELDS})
    variants = own.where("message_id is not null").withColumn("ord", F.struct((~F.col("is_root")).alias("late"), F.lower("json_path").alias("path"), "pos"))

    cand = own.select("json_path", "message_id", "pos", "is_root", F.posexplode("candidates").alias("n", "c")).select("json_path", "message_id", "pos", "is_root", "n", "c.*")
    cand = cand.join(inventory.select(F.col("path").alias("target"), "length", "extension"), "target", "left")
    real = F.col("length").isNotNull()
    cand = cand.where(F.col("always") | real).withColumn("is_real", real).withColumn("missing_reason", F.when(~real, F.coalesce("reason", F.lit("missing"))))

    exports = _exports(rows, own, cand, is_root)
    media = _media(variants, cand, hashes)
    flags = cand.where("is_real").groupBy("json_path", "message_id", "pos").agg(F.lit(True).alias("has_real_media"))
    variants = variants.join(flags, ["json_path", "message_id", "pos"], "left").withColumn("has_real_media", F.coalesce("has_real_media", F.lit(False)))
    return Archive(exports, rejects, variants, cand, _messages(variants, media), media)


def _exports(rows: DataFrame, own: DataFrame, cand: DataFrame, is_root: Column) -> DataFrame:
    """One row per export: counts, date range, media and type. Ids follow depth, then lower-cased path."""
    files = rows.where("error is null and pos is null").select("json_path", "folder").distinct().withColumn("is_root", is_root)
    text = F.trim("text_plain") != ""
    has_key = lambda k: F.count_if(F.expr(f"try_variant_get(try_parse_json(raw_json), '$[\"{k}\"]', 'variant')").isNotNull())
    counts = own.groupBy("json_path").agg(F.count("*").alias("message_count"), F.min(F.nullif("f_date", F.lit(""))).alias("date_min"), F.max(F.nullif("f_date", F.lit(""))).alias("date_max"), F.count_if(text).alias("text_messages"), F.sum(F.when(text, F.length("text_plain")).otherwise(0)).alias("text_chars"), has_key("photo").alias("photo_keys"), has_key("file").alias("file_keys"))
    found = cand.groupBy("json_path").agg(F.count_if("is_real").alias("real_media"), F.count_if(~F.col("is_real")).alias("missing_media"), F.bool_or(F.col("is_real") & (F.col("media_kind") == "photo")).alias("photos"), F.bool_or(F.col("is_real") & (F.col("media_kind") != "photo")).alias("others"))
    out = files.join(counts, "json_path", "left").join(found, "json_path", "left").fillna(0).fillna(False, ["photos", "others"])
    kind = F.when(F.col("is_root"), "full_text_export").when(F.col("photos") & F.col("others"), "mixed_export").when(F.col("photos"), "photo_export").otherwise("file_export")
    from .ranking import numbered

    out = out.withColumn("detected_export_type", kind).drop("photos", "others")
    return numbered(out, [F.size(F.split("json_path", "/")), F.lower("json_path"), F.col("json_path")], "export_id")


def best_text_first(root: str = "is_root", text: str = "text_plain", path: str = "json_path") -> Column:
    """Sort key whose largest value is the best text: any root text, then length, then path; the first variant if none
    has text."""
    has_text = F.trim(F.col(text)) != ""
    late = F.coalesce(F.col(root), F.lit(False))
    return F.struct(has_text.alias("t"), (has_text & late).alias("r"), F.when(has_text, F.length(text)).otherwise(0).alias("n"), F.when(has_text & ~late, F.lower(path)).otherwise(F.lit("")).alias("p"))


def _messages(variants: DataFrame, media: DataFrame) -> DataFrame:
    """The canonical merge: one partial aggregation by message id."""
    first = lambda f: F.min_by(f"f_{f}", F.when(meaningful(F.col(f"f_{f}")), F.col("ord")))
    # among the best texts the first variant wins: the largest key, then the smallest order
    ranked = variants.withColumn("rank", F.row_number().over(Window.partitionBy("message_id").orderBy(best_text_first().desc(), "ord")))
    best = lambda f: F.max(F.when(F.col("rank") == 1, F.col(f)))
    of_best = lambda f: F.coalesce(F.max(F.when((F.col("rank") == 1) & meaningful(F.col(f"f_{f}")), F.col(f"f_{f}"))), first(f))
    # of values of one length the first variant's wins
    richest = lambda f: F.max(F.when(meaningful(F.col(f"f_{f}")), F.struct(F.length(f"f_{f}").alias("n"), (-F.col("place")).alias("o"), F.col(f"f_{f}").alias("v"))))["v"]
    ranked = ranked.withColumn("place", F.row_number().over(Window.partitionBy("message_id").orderBy("ord")))
    has_text = F.max(F.when(F.col("rank") == 1, F.trim("text_plain") != ""))
    out = ranked.groupBy("message_id").agg(
        of_best("type").alias("message_type"), of_best("date").alias("date"), of_best("date_unixtime").alias("date_unixtime"), best("text_plain").alias("text_plain"), F.length(best("text_plain")).alias("text_char_count"), best("json_path").alias("best_text_source"),
        *(of_best(k).alias(n) for k, n in (("from", "from_name"), ("from_id", "from_id"), ("author", "author"), ("edited", "edited"), ("edited_unixtime", "edited_unixtime"))),
        first("reply_to_message_id").try_cast("bigint").alias("reply_to_message_id"), first("forwarded_from").alias("forwarded_from"), first("forwarded_from_id").alias("forwarded_from_id"), richest("reactions").alias("reactions_json"),
        F.coalesce(F.max(F.when((F.col("rank") == 1) & meaningful(F.col("f_text_entities")), F.col("f_text_entities"))), richest("text_entities")).alias("text_entities_json"),
        F.when(has_text, best("raw_json")).otherwise(F.coalesce(F.min_by("raw_json", F.when(F.col("has_real_media"), F.col("ord"))), best("raw_json"))).alias("raw_best_json"), F.count("*").alias("source_variant_count"),
    )
    kinds = media.groupBy("message_id").agg(F.bool_or(F.col("media_kind") == "photo").alias("has_real_photo"), F.bool_or(F.col("media_kind") == "file").alias("has_real_file"))
    return out.join(kinds, "message_id", "left").fillna(False, ["has_real_photo", "has_real_file"])


def _media(variants: DataFrame, cand: DataFrame, hashes: DataFrame | None) -> DataFrame:
    """Real media of messages, each file once by (path, field) and then once by content."""
    own = cand.where("is_real and message_id is not null").join(variants.select("json_path", "message_id", "pos", "ord", *(f"f_{n}" for n in ("mime_type", "media_type", "width", "height", "photo_file_size", "thumbnail_file_size", "file_size"))), ["json_path", "message_id", "pos"])
    own = own.withColumn("o", F.struct("ord", "n"))
    first = lambda df, *key: df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy("o"))).where("_n = 1").drop("_n")
    own = first(own.withColumn("_low", F.lower("target")), "message_id", "_low", "field_path")
    if hashes is not None:
        own = first(own.join(hashes.withColumnRenamed("path", "target"), "target", "left"), "message_id", "sha256")
    else:
        own = own.withColumn("sha256", F.lit(None).cast("string"))
    size = F.when(F.col("media_kind") == "photo", F.col("f_photo_file_size")).when(F.col("media_kind") == "thumbnail", F.col("f_thumbnail_file_size")).otherwise(F.col("f_file_size"))
    own = own.select("message_id", "json_path", "media_kind", F.trim("value").alias("relative_path"), F.col("target").alias("absolute_path"), F.element_at(F.split("target", "/"), -1).alias("file_name"), "extension", F.col("f_mime_type").alias("mime_type"), F.col("f_media_type").alias("media_type"), F.col("f_width").try_cast("bigint").alias("width"), F.col("f_height").try_cast("bigint").alias("height"), size.try_cast("bigint").alias("file_size_from_json"), F.col("length").alias("actual_file_size"), "sha256", "field_path", "o")
    from .ranking import numbered

    return numbered(own, [F.col("message_id"), F.col("o")], "id").drop("o")


def key_histogram(rows: DataFrame) -> DataFrame:
    """How often each key occurs in messages: by count descending, then key."""
    keys = rows.where("raw_json is not null").select(F.explode(F.json_object_keys("raw_json")).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "key")


def extension_profile(inventory: DataFrame) -> DataFrame:
    own = inventory.groupBy(F.when(F.col("extension") == "", "[no extension]").otherwise(F.col("extension")).alias("extension")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return own.orderBy(F.desc("files"), "extension")


def id_profile(rows: DataFrame) -> DataFrame:
    """One row: distinct message ids, ids seen more than once, smallest and largest id."""
    by = rows.where("message_id is not null").groupBy("message_id").agg(F.count("*").alias("n"))
    return by.agg(F.count("*").alias("unique_ids"), F.count_if(F.col("n") > 1).alias("repeated_ids"), F.min("message_id").alias("id_min"), F.max("message_id").alias("id_max"))


def statistics(messages: DataFrame, variants: DataFrame, media: DataFrame) -> DataFrame:
    """One row of eleven scalars over an ingested archive."""
    own = messages.agg(F.count("*").alias("canonical_posts"), F.count_if(F.trim("text_plain") != "").alias("posts_with_text"), F.count_if("has_real_photo").alias("posts_with_photos"), F.count_if("has_real_file").alias("posts_with_files"), F.min("date").alias("date_min"), F.max("date").alias("date_max"), F.count("reactions_json").alias("reactions_records"), F.count("reply_to_message_id").alias("reply_records"), F.count_if(F.coalesce("forwarded_from", "forwarded_from_id").isNotNull()).alias("forwarded_records"))
    return own.crossJoin(variants.agg(F.count("*").alias("source_variants"))).crossJoin(media.agg(F.count("*").alias("media_files")))  # one row each


def top_extensions(media: DataFrame, n: int = 10) -> DataFrame:
    return media.groupBy("extension").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "extension").limit(n)


def sample_posts(messages: DataFrame, media: DataFrame, variants: DataFrame, n: int = 50) -> DataFrame:
    """The first n messages by what they hold (text and photo, text and file, text, media, nothing) and id, with their
    media and exports as lists. The sample is taken first; its children come by joins."""
    text = F.trim("text_plain") != ""
    priority = F.when(text & F.col("has_real_photo"), 0).when(text & F.col("has_real_file"), 1).when(text, 2).when(F.col("has_real_photo") | F.col("has_real_file"), 3).otherwise(4)
    own = messages.withColumn("priority", priority).orderBy("priority", "message_id").limit(n).select("message_id", "priority", "date", "source_variant_count", "has_real_photo", "has_real_file", preview(F.col("text_plain"), 500).alias("preview"))
    of_media = media.join(own.select("message_id"), "message_id", "left_semi").groupBy("message_id").agg(F.array_sort(F.collect_list(F.struct("media_kind", "relative_path", "absolute_path"))).alias("media"))
    of_exports = variants.join(own.select("message_id"), "message_id", "left_semi").groupBy("message_id").agg(F.array_sort(F.collect_set("json_path")).alias("exports"))
    return own.join(of_media, "message_id", "left").join(of_exports, "message_id", "left").orderBy("priority", "message_id")
