"""Rankings over mentions: distinct projects and messages, never mentions, decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import first_of, match_form, ordered_distinct
from .ranking import numbered


def high_confidence(mentions: DataFrame) -> DataFrame:
    """Mentions with a project key of high confidence; the others never reach a ranking's shuffle."""
    return mentions.where("link_confidence = 'high' and project_key is not null")


def _examples(value: Column, order: Column, k: int = 5) -> Column:
    own = F.transform(F.array_sort(F.filter(F.collect_list(F.struct(order.alias("o"), value.alias("v"))), lambda x: x["v"].isNotNull())), lambda x: x["v"])
    return F.slice(ordered_distinct(own, match_form), 1, k)


def ranked(groups: DataFrame, key: str) -> DataFrame:
    """groups with ``rank``: by distinct projects, then messages, then key."""
    own = numbered(groups, [F.desc("unique_projects"), F.desc("unique_messages"), F.asc(key)], "rank")
    return own.withColumn("rank", F.col("rank").cast("int"))


def rank_paints(mentions: DataFrame, raw_counts: DataFrame | None = None) -> DataFrame:
    """Paints by code (without one, by manufacturer and product): distinct projects and messages, messages that name a
    manufacturer, projects linked across posts and those known from one post only, up to five examples."""
    own = high_confidence(mentions).withColumn("paint", F.coalesce("color_code", F.when(F.col("product_line").isNotNull(), F.concat_ws(" ", "manufacturer", "product_line")))).where("paint is not null")
    order = F.struct("message_id", "start")
    across = F.col("link_method").isin("explicit_project_link", "mapped_project_post")
    out = own.groupBy("paint").agg(
        F.array_join(_examples(F.col("manufacturer"), order), "; ").alias("manufacturer"), F.array_join(_examples(F.col("product_line"), order), "; ").alias("product_line"), F.count_distinct("project_key").alias("unique_projects"), F.count_distinct("message_id").alias("unique_messages"),
        F.count_distinct(F.when(F.col("manufacturer").isNotNull(), F.col("message_id"))).alias("branded_messages"), F.collect_set(F.when(across, F.col("project_key"))).alias("_linked"), F.collect_set(F.when(F.col("link_method") == "same_message", F.col("project_key"))).alias("_same"),
        _examples(F.coalesce("project_name", "project_key"), order).alias("examples"),
    )
    out = out.withColumns({"linked_projects": F.size("_linked"), "single_post_projects": F.size(F.array_except("_same", "_linked"))}).drop("_linked", "_same")
    out = out.join(raw_counts.select(F.col("code").alias("paint"), F.col("n").alias("raw_facts")), "paint", "left") if raw_counts is not None else out.withColumn("raw_facts", F.lit(None).cast("long"))
    return ranked(out.withColumn("raw_facts", F.coalesce("raw_facts", F.lit(0))), "paint")


def raw_code_counts(facts: DataFrame) -> DataFrame:
    """(code, n): wall colour facts by normalized code."""
    from .mentions import paint_code

    return facts.where("category = 'wall_colors' and color_code is not null").groupBy(paint_code(F.col("color_code")).alias("code")).agg(F.count("*").alias("n"))


def rank_shades(mentions: DataFrame) -> DataFrame:
    """Shade families that a text names, with up to five descriptions and codes."""
    own = high_confidence(mentions).where("shade_method = 'explicit_text' and shade_family <> 'other'")
    order = F.struct("message_id", "start")
    out = own.groupBy("shade_family").agg(F.count_distinct("project_key").alias("unique_projects"), F.count_distinct("message_id").alias("unique_messages"), _examples(F.col("shade_description"), order).alias("descriptions"), _examples(F.col("color_code"), order).alias("codes"))
    return ranked(out, "shade_family")


def merchant_counts(appliances: DataFrame) -> DataFrame:
    own = appliances.where("evidence_class = 'direct_product_link' and merchant is not null").groupBy("merchant").agg(F.count_distinct("message_id").alias("messages"))
    return own.orderBy(F.desc("messages"), "merchant")


def makers(mentions: DataFrame) -> DataFrame:
    """Makers by classification: distinct messages, and of each message its richest mention."""
    contacts = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in ("phone", "telegram", "whatsapp", "instagram", "website")), F.lit(0))
    order = [contacts.desc(), F.col("person_name").isNotNull().desc(), F.col("what_was_made").isNotNull().desc(), F.least(F.length("evidence_quote"), F.lit(500)).desc(), F.asc("start")]
    best = mentions.withColumn("_n", F.row_number().over(Window.partitionBy("classification", "maker_name", "message_id").orderBy(*order))).where("_n = 1")
    out = best.groupBy("classification", "maker_name").agg(F.count_distinct("message_id").alias("messages"), F.slice(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("message_id")).alias("o"), "evidence_quote"))), lambda x: x["evidence_quote"]), 1, 5).alias("quotes"))
    return out.orderBy("classification", F.desc("messages"), "maker_name")


def record_types(**tables: DataFrame) -> DataFrame:
    """(message_id, record_types): which tables name a message, sorted and joined."""
    every = None
    for name, t in tables.items():
        own = t.select("message_id", F.lit(name).alias("record_type"))
        every = own if every is None else every.union(own)
    return every.groupBy("message_id").agg(F.array_join(F.array_sort(F.collect_set("record_type")), "; ").alias("record_types"))


def best_links(links: DataFrame) -> DataFrame:
    """By project: the link of the best method, then the smallest message."""
    priority = F.when(F.col("link_method") == "explicit_project_link", 0).when(F.col("link_method") == "mapped_project_post", 1).when(F.col("link_method") == "same_message", 2).otherwise(3)
    own = links.where("project_key is not null")
    rest = [c for c in own.columns if c != "project_key"]
    return own.groupBy("project_key").agg(F.min_by(F.struct(*rest), F.struct(priority.alias("p"), "message_id")).alias("l")).select("project_key", "l.*")


def kitchen_paints(projects: DataFrame, paints: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Kitchen projects (project_id) with the codes, shades and messages of the paints linked to them, in order of first
    mention; projects without one stay, with empty lists. ``links`` adds the method of a project's best link."""
    order = F.struct("message_id", "start")
    own = high_confidence(paints).groupBy("project_key").agg(_examples(F.coalesce("color_code", "product_line"), order, 100).alias("paint_codes"), _examples(F.when(F.col("shade_family") != "other", F.col("shade_family")), order, 100).alias("shades"), F.array_sort(F.collect_set("message_id")).alias("paint_messages"))
    out = projects.withColumn("project_key", F.concat(F.lit("telegram:"), F.col("project_id").cast("string"))).join(own, "project_key", "left")
    out = out.withColumns({c: F.coalesce(c, F.array().cast(k)) for c, k in (("paint_codes", "array<string>"), ("shades", "array<string>"), ("paint_messages", "array<bigint>"))})
    if links is not None:
        out = out.join(best_links(links.select("project_key", "message_id", "link_method")).select("project_key", F.col("link_method").alias("best_link")), "project_key", "left")
    return out.orderBy((F.size("paint_codes") > 0).desc(), F.coalesce("date", F.lit("")).desc(), F.desc("project_id"))


# Sub-families of wood and neutral palettes in order.
WOOD = (("wood_cappuccino", ("капучино",)), ("wood_cashmere", ("кашемир",)), ("wood_latte", ("латте",)), ("wood_milk_offwhite", ("молоч", "меренг", "бел", "тальк", "нубук")), ("wood_light_greige", ("грейдж", "greige", "теплый сер", "светло-сер")), ("wood_beige", ("беж", "крем", "песоч")))


def wood_subfamily(text: Column) -> Column:
    """Sub-family of a wood and neutral palette: the first whose token the text has."""
    return F.coalesce(first_of(match_form(text), [(n, "|".join(t)) for n, t in WOOD]), F.lit("wood_other_warm_neutral"))
