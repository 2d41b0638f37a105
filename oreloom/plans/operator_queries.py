"""Registered queries that call the archive operators themselves, on columns of the driver's tables renamed to fit.

Each stands beside SQL that states the same rows plainly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse as P
from ..functions import text as T
from ..operators import candidates, canonical, effective, facts, links, mentions, projects, ranking, rankings, reporting, review, sampling, spans
from .queries import query, table

def _none() -> Column:
    return F.lit(None).cast("string")


def _key(name: str, *parts) -> Column:
    return F.concat(F.lit(name), *(F.col(p).cast("string") for p in parts))


@query("""SELECT (SELECT count(*) FROM documents) AS canonical_posts, (SELECT count(*) FROM documents WHERE trim(coalesce(text, '')) <> '') AS posts_with_text, (SELECT count(*) FROM documents WHERE n_chars % 2 = 0) AS posts_with_photos, (SELECT count(*) FROM documents WHERE n_chars % 5 = 0) AS posts_with_files,
(SELECT min(lang) FROM documents) AS date_min, (SELECT max(lang) FROM documents) AS date_max, (SELECT count(source) FROM documents) AS reactions_records, CAST(0 AS BIGINT) AS reply_records, (SELECT count(lang) FROM documents) AS forwarded_records, (SELECT count(*) FROM conversations) AS source_variants, (SELECT count(*) FROM pages) AS media_files""")
def archive_statistics(spark, sf_dir):
    """Eleven scalars over an archive (A5)."""
    c = F.col
    messages = table(spark, sf_dir, "documents").select(F.coalesce("text", F.lit("")).alias("text_plain"), (c("n_chars") % 2 == 0).alias("has_real_photo"), (c("n_chars") % 5 == 0).alias("has_real_file"), c("lang").alias("date"), c("source").alias("reactions_json"), F.lit(None).cast("long").alias("reply_to_message_id"), _none().alias("forwarded_from"), c("lang").alias("forwarded_from_id"))
    return canonical.statistics(messages, table(spark, sf_dir, "conversations"), table(spark, sf_dir, "pages"))


@query("""WITH m AS (SELECT doc_id, n_chars, trim(coalesce(text, '')) <> '' AS t FROM documents),
s AS (SELECT doc_id AS message_id, CASE WHEN t AND n_chars % 2 = 0 THEN 0 WHEN t AND n_chars % 5 = 0 THEN 1 WHEN t THEN 2 WHEN n_chars % 2 = 0 OR n_chars % 5 = 0 THEN 3 ELSE 4 END AS priority FROM m ORDER BY priority, doc_id LIMIT 60)
SELECT message_id, priority, (SELECT count(*) FROM pages p WHERE p.page_id = message_id) AS media, (SELECT string_agg(DISTINCT role, ';' ORDER BY role) FROM conversations c WHERE c.conv_id = message_id) AS exports FROM s""")
def sample_posts_report(spark, sf_dir):
    """The first posts by what they hold, with their media and exports."""
    c = F.col
    messages = table(spark, sf_dir, "documents").select(c("doc_id").alias("message_id"), F.coalesce("text", F.lit("")).alias("text_plain"), c("lang").alias("date"), (c("n_chars") % 2 == 0).alias("has_real_photo"), (c("n_chars") % 5 == 0).alias("has_real_file"), F.lit(1).alias("source_variant_count"))
    media = table(spark, sf_dir, "pages").select(c("page_id").alias("message_id"), F.lit("photo").alias("media_kind"), c("url").alias("relative_path"), c("url").alias("absolute_path"))
    variants = table(spark, sf_dir, "conversations").select(c("conv_id").alias("message_id"), c("role").alias("json_path"))
    out = canonical.sample_posts(messages, media, variants, 60)
    return out.select("message_id", "priority", F.greatest(F.lit(0), F.coalesce(F.size("media"), F.lit(0))).cast("long").alias("media"), F.array_join("exports", ";").alias("exports"))


@query("""WITH f AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, 'p' || l_partkey) AS k, 'p' || l_partkey AS path FROM lineitem WHERE l_returnflag = 'R')
SELECT o_orderkey AS message_id, coalesce(count(k), 0) AS photo_count, coalesce(string_agg(path, ';' ORDER BY k) FILTER (k <= 3), '') AS photo_paths FROM orders LEFT JOIN f ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F' GROUP BY o_orderkey""")
def post_photos(spark, sf_dir):
    """Posts that are not blank with the number and first paths of their photos."""
    messages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), F.when(F.col("o_orderstatus") == "F", " ").otherwise(F.col("o_orderstatus")).alias("text_plain"))
    media = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").alias("id"), _key("p", "l_partkey").alias("absolute_path"), F.when(F.col("l_returnflag") == "R", "photo").otherwise("file").alias("media_kind"))
    return candidates.posts_with_photos(messages, media).select("message_id", "photo_count", F.array_join("photo_paths", ";").alias("photo_paths"))


@query("""WITH a AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 4 ELSE 0 END AS s, CAST(o_orderdate AS VARCHAR) AS d FROM orders)
SELECT o_orderkey AS message_id, s AS article_score, CAST(row_number() OVER (ORDER BY s DESC, d DESC, o_orderkey DESC) AS BIGINT) AS place FROM a WHERE s >= 2""")
def article_order(spark, sf_dir):
    """Article posts by score, date and id, all descending."""
    text = F.when(F.col("o_orderkey") % 4 == 0, "Артикулы  проекта в посте").when(F.col("o_orderkey") % 4 == 1, "Артикулы проекта. Покупки: стол").otherwise("просто покупки стола")
    posts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), text.alias("text"))
    own = candidates.article_posts(posts).select("message_id", "article_score", "date")
    return ranking.numbered(own, [F.desc("article_score"), F.desc("date"), F.desc("message_id")], "place").select("message_id", "article_score", "place")


@query("""WITH g AS (SELECT p_brand AS shade_family, count(DISTINCT o_custkey) AS unique_projects, count(DISTINCT l_orderkey) AS unique_messages FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_tax > 0.04 AND l_returnflag <> 'N' AND p_brand <> 'Brand#11' GROUP BY p_brand)
SELECT *, CAST(row_number() OVER (ORDER BY unique_projects DESC, unique_messages DESC, shade_family) AS INTEGER) AS rank FROM g""")
def shade_families(spark, sf_dir):
    """Shade families that a text names, of links of high confidence."""
    own = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    family = F.when(F.col("p_brand") == "Brand#11", "other").otherwise(F.col("p_brand"))
    own = own.select(F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").alias("start"), _key("k", "o_custkey").alias("project_key"), family.alias("shade_family"), F.when(F.col("l_tax") > 0.04, "explicit_text").otherwise("unknown").alias("shade_method"), F.when(F.col("l_returnflag") != "N", "high").otherwise("low").alias("link_confidence"), _none().alias("shade_description"), _none().alias("color_code"))
    return rankings.rank_shades(own).select("shade_family", "unique_projects", "unique_messages", "rank")


@query("SELECT 'm' || l_suppkey AS merchant, count(DISTINCT l_orderkey) AS messages FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 7 <> 0 GROUP BY l_suppkey")
def merchants(spark, sf_dir):
    """Messages with direct product links by merchant."""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("message_id"), F.when(F.col("l_returnflag") == "R", "direct_product_link").otherwise("context").alias("evidence_class"), F.when(F.col("l_suppkey") % 7 != 0, _key("m", "l_suppkey")).alias("merchant"))
    return rankings.merchant_counts(own)


@query("""WITH b AS (SELECT l_returnflag AS classification, 's' || l_suppkey AS maker_name, l_orderkey, 'q' || l_linenumber AS q, row_number() OVER (PARTITION BY l_returnflag, l_suppkey, l_orderkey ORDER BY CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END DESC, l_linenumber) AS k FROM lineitem),
p AS (SELECT *, row_number() OVER (PARTITION BY classification, maker_name ORDER BY l_orderkey DESC) AS n FROM b WHERE k = 1)
SELECT classification, maker_name, count(*) AS messages, string_agg(q, ';' ORDER BY n) FILTER (n <= 5) AS quotes FROM p GROUP BY ALL""")
def maker_groups(spark, sf_dir):
    """Makers by classification: messages, and the quotes of each message's richest mention."""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("classification"), _key("s", "l_suppkey").alias("maker_name"), F.col("l_orderkey").alias("message_id"), F.col("l_linenumber").alias("start"), _key("q", "l_linenumber").alias("evidence_quote"), F.when(F.col("l_tax") > 0.04, "1").alias("phone"), *(_none().alias(n) for n in ("telegram", "whatsapp", "instagram", "website", "person_name", "what_was_made")))
    return rankings.makers(own).select("classification", "maker_name", "messages", F.array_join("quotes", ";").alias("quotes"))


@query("""SELECT CASE o_custkey % 3 WHEN 0 THEN 'RAL ' || (1000 + o_custkey % 50) WHEN 1 THEN 'G' || (100 + o_custkey % 50) ELSE 'S ' || (1000 + o_custkey % 50) || '-Y60R' END AS code, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def color_code_counts(spark, sf_dir):
    """Wall colour facts by code in one spelling."""
    n = lambda base: (F.lit(base) + F.col("o_custkey") % 50).cast("string")
    kind = F.col("o_custkey") % 3
    code = F.when(kind == 0, F.concat(F.lit("ral-"), n(1000))).when(kind == 1, F.concat(F.lit(" g "), n(100))).otherwise(F.concat(F.lit("ncs s "), n(1000), F.lit(" – y60r")))
    own = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "P", "kitchens").otherwise("wall_colors").alias("category"), code.alias("color_code"))
    return rankings.raw_code_counts(own)


@query("""WITH l AS (SELECT o_custkey, o_orderkey, o_orderkey % 4 AS p FROM orders) SELECT 'k' || o_custkey AS project_key, arg_min(o_orderkey, (p, o_orderkey)) AS message_id, arg_min(p, (p, o_orderkey)) AS method_no FROM l GROUP BY o_custkey""")
def best_project_links(spark, sf_dir):
    """The best link of each project: by method, then message."""
    p = F.col("o_orderkey") % 4
    method = F.when(p == 0, "explicit_project_link").when(p == 1, "mapped_project_post").when(p == 2, "same_message").otherwise("ambiguous_metadata_match")
    own = table(spark, sf_dir, "orders").select(_key("k", "o_custkey").alias("project_key"), F.col("o_orderkey").alias("message_id"), method.alias("link_method"), p.alias("method_no"))
    return rankings.best_links(own).select("project_key", "message_id", "method_no")


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'wood_cappuccino' WHEN 1 THEN 'wood_latte' WHEN 2 THEN 'wood_milk_offwhite' WHEN 3 THEN 'wood_cashmere' ELSE 'wood_other_warm_neutral' END AS family FROM orders""")
def wood_families(spark, sf_dir):
    """Sub-families of wood and neutral palettes, the first in order."""
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, "Дуб + КАПУЧИНО, латте").when(k == 1, "Дуб и Латте, белый").when(k == 2, "молочный дуб").when(k == 3, "Кашемир, белый").otherwise("oak")
    return table(spark, sf_dir, "orders").select("o_orderkey", rankings.wood_subfamily(text).alias("family"))


@query("""WITH j AS (SELECT 's' || l_suppkey AS v, 'c' || l_partkey % 7 AS c, l_returnflag || l_linestatus AS t, l_orderkey * 10 + l_linenumber AS id FROM lineitem),
c AS (SELECT v, c, row_number() OVER (PARTITION BY v ORDER BY count(*) DESC, c) AS k FROM j GROUP BY v, c), t AS (SELECT v, t, row_number() OVER (PARTITION BY v ORDER BY count(*) DESC, t) AS k FROM j GROUP BY v, t),
q AS (SELECT v, id, row_number() OVER (PARTITION BY v ORDER BY id DESC) AS k FROM j)
SELECT v AS vendor, (SELECT count(*) FROM j WHERE j.v = x.v) AS facts, (SELECT string_agg(c, '; ' ORDER BY k) FROM c WHERE c.v = x.v AND k <= 3) AS categories, (SELECT string_agg(t, '; ' ORDER BY k) FROM t WHERE t.v = x.v AND k <= 3) AS item_types, (SELECT string_agg('q' || id, ';' ORDER BY k) FROM q WHERE q.v = x.v AND k <= 2) AS quotes FROM (SELECT DISTINCT v FROM j) x""")
def supplier_sections(spark, sf_dir):
    """By vendor: facts, commonest categories and item types, two quotes."""
    i = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    own = _used(table(spark, sf_dir, "lineitem"), e_vendor=_key("s", "l_suppkey"), e_category=F.concat(F.lit("c"), (F.col("l_partkey") % 7).cast("string")), e_item_type=F.concat("l_returnflag", "l_linestatus"), id=i, evidence_quote=F.concat(F.lit("q"), i.cast("string")))
    return reporting.suppliers(own).select(F.col("e_vendor").alias("vendor"), "facts", "categories", "item_types", F.array_join("quotes", ";").alias("quotes"))


@query("""WITH j AS (SELECT 's' || l_suppkey AS v, 'c' || l_partkey % 7 AS c, CASE WHEN l_suppkey % 3 <> 1 THEN l_returnflag END AS t, CASE WHEN l_suppkey % 3 = 0 THEN 'Слипсон ' || l_linenumber END AS m FROM lineitem), x AS (SELECT v, CASE WHEN m IS NOT NULL THEN m WHEN t IS NOT NULL THEN t ELSE c END AS item FROM j),
r AS (SELECT v, item, row_number() OVER (PARTITION BY v ORDER BY count(*) DESC, item) AS k FROM x GROUP BY v, item) SELECT v AS vendor, string_agg(item, '; ' ORDER BY k) FILTER (k <= 3) AS items FROM r GROUP BY v""")
def supplier_items(spark, sf_dir):
    """The commonest items of a vendor: values that may be shown, else item types, else categories."""
    k = F.col("l_suppkey") % 3
    model = F.when(k == 0, F.concat(F.lit("Слипсон "), F.col("l_linenumber").cast("string")))
    own = _used(table(spark, sf_dir, "lineitem"), e_vendor=_key("s", "l_suppkey"), e_category=F.concat(F.lit("c"), (F.col("l_partkey") % 7).cast("string")), e_item_type=F.when(k != 1, F.col("l_returnflag")), id=F.col("l_orderkey"), evidence_quote=F.lit("q"), e_model=model)
    return reporting.suppliers(own).select(F.col("e_vendor").alias("vendor"), "items")


_USED = ("e_finish", "e_material", "e_color", "e_color_code", "e_article_id", "e_brand", "e_vendor", "e_model")


def _used(df: DataFrame, **given) -> DataFrame:
    """df with the columns of facts in use that are not given as null."""
    return df.select("*", *(c.alias(n) for n, c in given.items()), *(_none().alias(n) for n in _USED if n not in given))


@query("""SELECT o_orderkey, o_orderkey % 5 NOT IN (1, 2) AND (o_orderkey % 7 <> 0) AND (o_custkey % 3 <> 0) AS living, o_orderkey % 5 <> 2 AS hallway FROM orders""")
def section_filters(spark, sf_dir):
    """Facts that the living-room and hallway sections keep."""
    k = F.col("o_orderkey") % 5
    kind = F.when(k == 1, "coffee_table").when(k == 2, "Bundle_purchase").when(k == 3, "shelves").otherwise("cabinet")
    own = _used(table(spark, sf_dir, "orders"), e_item_type=kind, e_category=F.lit("living_room_furniture"), evidence_quote=F.when(F.col("o_orderkey") % 7 == 0, "Шкаф в прихожей").otherwise("Шкаф в гостиной"), e_vendor=F.when(F.col("o_custkey") % 3 != 0, "V"))
    return own.select("o_orderkey", reporting.living_room_keep().alias("living"), reporting.hallway_keep().alias("hallway"))


@query("""SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey % 3 = 0 DESC, CASE o_orderpriority[1] WHEN '1' THEN 2 WHEN '2' THEN 1 ELSE 0 END DESC, o_custkey % 2 = 0 DESC, CAST(o_orderdate AS VARCHAR) DESC, o_orderkey LIMIT 12""")
def section_examples(spark, sf_dir):
    """The best examples of a section."""
    first = F.left("o_orderpriority", F.lit(1))
    own = _used(table(spark, sf_dir, "orders"), id=F.col("o_orderkey"), e_category=F.col("o_orderstatus"), e_vendor=F.when(F.col("o_custkey") % 2 == 0, "V"), decision=F.when(F.col("o_orderkey") % 3 == 0, "keep"), confidence=F.when(first == "1", "high").when(first == "2", "medium").otherwise("low"), date=F.col("o_orderdate").cast("string"), e_price_value=F.lit(None).cast("double"), first_photo_path=_none(), evidence_quote=_none())
    return reporting.examples(own, "O", 12).select("id")


_VALUES = """v AS (SELECT o_orderstatus AS category, ['Слипсон', 'арт', '12 345', 'Вельвет зеленый', 'на кухне', 'ab', '14 990 ₽'][1 + o_orderkey % 7] AS value, o_orderkey % 7 IN (0, 3) AS shown FROM orders)"""


def _displayed(spark, sf_dir) -> DataFrame:
    values = F.array(*map(F.lit, ("Слипсон", "арт", "12 345", "Вельвет  зеленый", "на кухне", "ab", "14 990 ₽")))
    return _used(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("e_category"), F.get(values, (F.col("o_orderkey") % 7).cast("int")).alias("e_model"), F.lit("sofa").alias("e_item_type")).withColumnRenamed("e_model", "m"), e_model=F.col("m"))


@query(f"WITH {_VALUES} SELECT category, value, count(*) AS n, CAST(row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, value) AS INTEGER) AS place FROM v WHERE shown GROUP BY category, value")
def display_values(spark, sf_dir):
    """Values that a report may show, by category."""
    return reporting.display_counts(_displayed(spark, sf_dir), 15).select(F.col("e_category").alias("category"), "value", "n", "place")


@query(f"WITH {_VALUES} SELECT category, count(*) AS n FROM v WHERE NOT shown GROUP BY category")
def hidden_values(spark, sf_dir):
    """Facts in use whose value is not shown, by category."""
    return reporting.suppressed(_displayed(spark, sf_dir)).select(F.col("e_category").alias("category"), "n")


_FACTS_SQL = """f AS (SELECT l_returnflag AS category, l_tax > 0.05 AS review, CASE WHEN l_quantity > 30 THEN 'high' WHEN l_quantity > 10 THEN 'medium' ELSE 'low' END AS c, l_linenumber % 4 AS k FROM lineitem)"""


def _facts(spark, sf_dir) -> DataFrame:
    k = F.col("l_linenumber") % 4
    notes = F.when(k == 0, "bundle purchase: detected; multiple prices in quote").when(k == 1, "Low confidence deterministic match").when(k == 2, "non-target room context: ванная")
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("category"), (F.col("l_tax") > 0.05).alias("needs_review"), F.when(F.col("l_quantity") > 30, "high").when(F.col("l_quantity") > 10, "medium").otherwise("low").alias("confidence"), notes.alias("notes"))


@query(f"WITH {_FACTS_SQL} SELECT category, count(*) AS facts, count(*) FILTER (NOT review) AS clean, count(*) FILTER (review) AS to_review, count(*) FILTER (c = 'high') AS high, count(*) FILTER (c = 'medium') AS medium, count(*) FILTER (c = 'low') AS low FROM f GROUP BY category")
def fact_counts(spark, sf_dir):
    """Facts by category, review flag and confidence."""
    return reporting.fact_summary(_facts(spark, sf_dir))


@query(f"WITH {_FACTS_SQL} SELECT count(*) FILTER (k = 0) AS bundle, count(*) FILTER (k = 0) AS several_prices, count(*) FILTER (k = 1) AS low_confidence, count(*) FILTER (k = 2) AS non_target_room FROM f WHERE review")
def review_reasons(spark, sf_dir):
    """How many notes speak of each reason for a review (A10)."""
    return reporting.review_signals(_facts(spark, sf_dir)).select("bundle", "several_prices", "low_confidence", "non_target_room")


@query("SELECT count(*) FILTER (o_orderkey % 1000 = 0) >= 2 AS wood_and_neutral FROM orders WHERE o_orderstatus = 'O'")
def wood_and_neutral(spark, sf_dir):
    """Whether kitchens name oak with a neutral tone at least twice."""
    own = _used(table(spark, sf_dir, "orders"), e_category=F.when(F.col("o_orderstatus") == "O", "kitchens").otherwise("sofas"), evidence_quote=F.when(F.col("o_orderkey") % 1000 == 0, "Дуб и капучино").otherwise("Дуб"))
    return reporting.wood_and_neutral(own)


@query("""SELECT o_orderkey, 'RAL ' || (1000 + o_custkey % 9000) || ';G' || (100 + o_custkey % 900) AS codes FROM orders""")
def code_extract(spark, sf_dir):
    """Colour codes of a line, each in one spelling."""
    line = F.concat(F.lit("Цвет стен ral "), (1000 + F.col("o_custkey") % 9000).cast("string"), F.lit(", ниша g"), (100 + F.col("o_custkey") % 900).cast("string"), F.lit(" и RAL "), (1000 + F.col("o_custkey") % 9000).cast("string"))
    codes = F.transform(P.color_codes(line), mentions.paint_code)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(F.reverse(F.array_sort(codes)), ";").alias("codes"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'HOME' || o_custkey END AS promo_code, 'ЖК Север ' || o_custkey AS project FROM orders")
def code_and_name(spark, sf_dir):
    """Promo codes and project names of posts."""
    text = F.concat(F.lit("Артикулы проекта\nЖК Север "), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("\nПо промокоду нет, промокод HOME"), F.col("o_custkey").cast("string"), F.lit("!"))).otherwise(F.lit("\nбез кода")))
    return table(spark, sf_dir, "orders").select("o_orderkey", P.promo_code(text).alias("promo_code"), P.project_name(text).alias("project"))


@query(r"""SELECT doc_id, CASE WHEN length(c) <= 50 THEN c ELSE rtrim(substr(c, 1, 47)) || '...' END AS preview, CASE WHEN text IS NULL THEN NULL WHEN length(text) <= 20 THEN text ELSE rtrim(substr(text, 1, 17), chr(32) || chr(10) || chr(9) || chr(13)) || '...' END AS cut
FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM documents)""")
def truncate_preview(spark, sf_dir):
    """Previews and cut texts."""
    return table(spark, sf_dir, "documents").select("doc_id", T.preview(F.col("text"), 50).alias("preview"), T.truncate(F.col("text"), 20).alias("cut"))


@query("""WITH a AS (SELECT l_orderkey AS m, l_linenumber * 20 AS s, l_linenumber * 20 + 5 AS e FROM lineitem WHERE l_returnflag <> 'R'), b AS (SELECT l_orderkey AS m, l_linenumber * 20 + 2 AS s, l_linenumber * 20 + 9 AS e, 'b' || l_linenumber || '-' || l_partkey AS n FROM lineitem WHERE l_returnflag = 'R')
SELECT a.m AS message_id, a.s AS start, arg_min(b.n, (greatest(0, b.s - a.e, a.s - b.e), b.s, b.n)) AS nearest FROM a LEFT JOIN b ON a.m = b.m GROUP BY a.m, a.s""")
def nearest_by_gap(spark, sf_dir):
    """The nearest other span by distance, start and name."""
    own, at = table(spark, sf_dir, "lineitem"), F.col("l_linenumber") * 20
    mine = own.where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("message_id"), at.alias("start"), (at + 5).alias("end")).distinct()
    other = own.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("message_id"), (at + 2).alias("start"), (at + 9).alias("end"), F.concat(F.lit("b"), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("l_partkey").cast("string")).alias("name"))
    return spans.nearest(mine, other, ["message_id"]).select("message_id", "start", "nearest")


@query("""WITH a AS (SELECT DISTINCT l_orderkey AS m, l_linenumber * 20 AS s FROM lineitem), u AS (SELECT DISTINCT l_orderkey AS m, l_linenumber * 40 - 40 AS s FROM lineitem)
SELECT a.m AS message_id, a.s AS start, u.s AS unit_start FROM a JOIN u ON a.m = u.m AND u.s <= a.s AND u.s + 40 >= a.s + 5""")
def span_overlap_join(spark, sf_dir):
    """Spans with the unit that holds them."""
    own, line = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    mine = own.select(F.col("l_orderkey").alias("message_id"), (line * 20).alias("start"), (line * 20 + 5).alias("end")).distinct()
    units = own.select(F.col("l_orderkey").alias("message_id"), F.lit("line").alias("kind"), (line * 40 - 40).alias("start"), (line * 40).alias("end"), _none().alias("span")).distinct()
    return spans.inside_unit(mine, units, "line").select("message_id", "start", "unit_start")


@query("""WITH p AS (SELECT o_orderkey, date_trunc('month', o_orderdate) AS d FROM orders WHERE o_orderkey % 4 = 0), m AS (SELECT o_orderkey, date_trunc('month', o_orderdate) AS d, o_orderstatus FROM orders),
e AS (SELECT o_orderkey AS p, 0 AS k, o_orderkey AS m FROM p UNION ALL SELECT p.o_orderkey, 2, m.o_orderkey FROM p JOIN m ON m.o_orderkey > p.o_orderkey AND m.o_orderkey <= p.o_orderkey + 8 AND m.d = p.d AND m.o_orderstatus <> 'F')
SELECT p AS project_id, string_agg('f' || m, ';' ORDER BY k, m) AS photos FROM e GROUP BY p""")
def neighbour_album(spark, sf_dir):
    """Photos of a post and of the short posts of its day behind it."""
    day = F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd")
    own = table(spark, sf_dir, "orders")
    posts = own.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("project_id"), F.array().cast("array<bigint>").alias("source_ids"), day.alias("date"))
    messages = own.select(F.col("o_orderkey").alias("message_id"), day.alias("date"), F.when(F.col("o_orderstatus") == "F", F.repeat(F.lit("x"), F.lit(200))).otherwise("album").alias("text_plain"))
    photos = own.select(F.col("o_orderkey").alias("message_id"), F.lit(1).alias("photo_no"), _key("f", "o_orderkey").alias("path"))
    return projects.neighbour_photos(posts, messages, photos).select("project_id", F.array_join("photo_paths", ";").alias("photos"))


@query("""WITH t AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey))) AS x FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_orderkey)
SELECT o_orderkey AS message_id, CASE WHEN len(x) = 1 THEN 'explicit_project_link' WHEN len(x) > 1 THEN 'ambiguous_metadata_match' WHEN o_orderstatus = 'O' THEN 'same_message' ELSE 'ambiguous_metadata_match' END AS link_method,
  CASE WHEN len(x) = 1 THEN x[1] WHEN len(x) > 1 THEN NULL WHEN o_orderstatus = 'O' THEN o_orderkey END AS project_id, CASE WHEN len(x) = 1 OR (x IS NULL AND o_orderstatus = 'O') THEN 'high' ELSE 'low' END AS link_confidence FROM orders LEFT JOIN t ON o_orderkey = l_orderkey""")
def project_links(spark, sf_dir):
    """Messages linked to projects by the first method that holds."""
    messages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("ЖК Север "), F.col("o_custkey").cast("string"))).otherwise("подборка").alias("text_plain"))
    visible = F.when(F.col("l_returnflag") == "R", "проект").otherwise("подборка проектов")
    entities = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("message_id"), F.lit("text_link").alias("entity_type"), visible.alias("visible_text"), F.concat(F.lit("https://t.me/home/"), F.col("l_suppkey").cast("string")).alias("href"), F.lit("").alias("context"), (F.col("l_linenumber") * 10).alias("start"), (F.col("l_linenumber") * 10 + 6).alias("end"))
    return links.link_projects(messages, entities, "home").select("message_id", "link_method", "project_id", "link_confidence")


@query("""WITH c AS (SELECT l_suppkey AS p, l_orderkey AS m, 'd' || (l_suppkey % 9) AS d FROM lineitem WHERE l_returnflag = 'R'), last AS (SELECT m, arg_min(p, (d, p)) AS p FROM c GROUP BY m)
SELECT m AS message_id, p AS mapped_id FROM last UNION ALL SELECT s, s FROM (SELECT DISTINCT l_suppkey AS s FROM lineitem WHERE l_returnflag = 'R') WHERE s NOT IN (SELECT m FROM last)""")
def source_projects(spark, sf_dir):
    """The project that a message is a source of."""
    own = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("project_id")).agg(F.collect_set("l_orderkey").alias("source_ids"))
    return links.source_to_project(own.withColumn("date", F.concat(F.lit("d"), (F.col("project_id") % 9).cast("string"))))


@query("""WITH p AS (SELECT o_orderkey, o_orderkey % 2 = 0 AS facade, o_orderkey % 3 = 0 AS top, o_orderkey % 5 = 0 AS photo, o_orderkey % 7 = 0 AS named, o_custkey % 2 = 0 AS wall FROM orders),
s AS (SELECT *, CASE WHEN facade THEN 4 ELSE -3 END + CASE WHEN top THEN 2 ELSE 0 END + CASE WHEN wall THEN 1 ELSE 0 END + CASE WHEN named THEN 1 ELSE -2 END + CASE WHEN photo THEN 2 ELSE -2 END AS score FROM p)
SELECT o_orderkey AS project_id, CAST(score AS INTEGER) AS quality_score, CASE WHEN score >= 8 AND facade THEN 'high' WHEN score >= 5 AND facade THEN 'medium' ELSE 'low' END AS quality_tier,
  CASE WHEN facade THEN 'wood_neutral' END AS palette FROM s""")
def project_quality(spark, sf_dir):
    """Quality scores, tiers and palettes of projects."""
    k = F.col("o_orderkey")
    texts = lambda: F.array().cast("array<string>")
    named = k % 7 == 0
    own = table(spark, sf_dir, "orders").select(
        k.alias("project_id"), F.when(k % 2 == 0, "Дуб каселла + Капучино").alias("facade"), F.array().cast("array<string>").alias("facade_parts"), F.when(k % 3 == 0, "Столешница орех 1234").alias("countertop"), _none().alias("backsplash"), F.when(F.col("o_custkey") % 2 == 0, "RAL 7047").alias("wall_color"), _none().alias("flooring"),
        F.struct(F.when(named, "ЖК Север").otherwise("Пост").alias("name"), F.when(named, "complex").otherwise("fallback_post_id").alias("source")).alias("object"), F.struct(F.lit("").alias("name"), F.lit("default").alias("source")).alias("designer"), texts().alias("vendors"), texts().alias("quotes"), F.array(F.lit("kitchen_facades")).alias("item_types"), F.when(k % 5 == 0, F.array(F.lit("a.jpg"))).otherwise(texts()).alias("photo_paths"),
    )
    return projects.classify_palettes(projects.score_quality(own)).select("project_id", "quality_score", "quality_tier", "palette")


@query("""WITH k AS (SELECT l_orderkey AS m, l_linenumber AS i, 'Дуб каселла ' || (l_linenumber % 3) AS v, CAST(l_shipdate AS VARCHAR) AS d FROM lineitem WHERE l_returnflag = 'R'),
u AS (SELECT m, v, min(i) AS i FROM k GROUP BY m, v), w AS (SELECT DISTINCT l_orderkey AS m, 'RAL ' || (1000 + l_linenumber) AS v, l_linenumber AS i, l_shipdate FROM lineitem WHERE l_returnflag = 'N')
SELECT p.m AS project_id, (SELECT string_agg(v, '; ' ORDER BY i) FROM u WHERE u.m = p.m) AS facade, (SELECT string_agg(DISTINCT v, '; ' ORDER BY v) FROM (SELECT v, i FROM w WHERE w.m = p.m ORDER BY i LIMIT 5)) AS wall_color, CAST(o_orderdate AS VARCHAR) AS date
FROM (SELECT DISTINCT m FROM k) p JOIN orders ON o_orderkey = p.m""")
def built_projects(spark, sf_dir):
    """Projects from kitchen and context facts, with ordered lists of distinct values."""
    own, line = table(spark, sf_dir, "lineitem"), F.col("l_linenumber")
    fields = ("finish", "material", "model", "color_code", "color", "brand_normalized", "brand_raw", "item_name", "vendor_normalized", "vendor_raw", "marketplace", "price_currency", "price_unit", "evidence_quote")

    def fact(df, category, kind, **given):
        return df.select(F.col("l_orderkey").alias("message_id"), line.alias("id"), F.lit(category).alias("category"), F.lit(kind).alias("item_type"), F.col("l_shipdate").cast("string").alias("date"), F.lit(None).cast("decimal(12,2)").alias("price_value"), *(given.get(f, _none()).alias(f) for f in fields)).distinct()

    kitchen = fact(own.where("l_returnflag = 'R'"), "kitchens", "kitchen_facades", finish=F.concat(F.lit("Дуб каселла "), (line % 3).cast("string")))
    walls = fact(own.where("l_returnflag = 'N'"), "wall_colors", "wall_color", color_code=F.concat(F.lit("RAL "), (1000 + line).cast("string")))
    messages = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), F.lit("текст").alias("text_plain"), _none().alias("text_entities_json"))
    photos = messages.where("message_id < 0").select("message_id", F.lit(1).alias("photo_no"), F.lit("p").alias("path"))
    return projects.build_projects(kitchen, walls, messages, photos, "home").select("project_id", "facade", "wall_color", "date")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 'диван;кресло' END AS heads, CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE 'sofas' END AS category FROM orders""")
def bundle_detect(spark, sf_dir):
    """Lines that sell several items at once."""
    k = F.col("o_orderkey") % 3
    line = F.when(k == 0, F.concat(F.lit("Диван и кресло "), F.lit("10 000₽"))).when(k == 1, "Диван, кресло Арт. 1550292417").otherwise(F.concat(F.lit("Диван "), (F.col("o_custkey") + 1000).cast("string"), F.lit("₽")))
    own = table(spark, sf_dir, "orders", spread=True).select("o_orderkey", facts.bundle(line).alias("b"))
    return own.select("o_orderkey", F.array_join("b.heads", ";").alias("heads"), F.col("b.category").alias("category"))


@query("""SELECT o_orderkey, unnest(range(4)) AS block_no, unnest(['Диван Слипсон' || chr(10) || 'зеленый' || chr(10) || 'Арт. ' || (o_custkey + 10000) || chr(10) || 'Стол дуб', 'Диван Слипсон' || chr(10) || 'зеленый' || chr(10) || 'Арт. ' || (o_custkey + 10000), 'Стол дуб', 'Покупки']) AS block FROM orders""")
def line_window(spark, sf_dir):
    """Evidence blocks: paragraphs, and windows from item lines to the line with a number."""
    text = F.concat(F.lit("Диван Слипсон\n • зеленый\nАрт. "), (F.col("o_custkey") + 10000).cast("string"), F.lit("\nСтол дуб\n\n \n\nПокупки\n\nПокупки"))
    own = table(spark, sf_dir, "orders", spread=True).select("o_orderkey", F.posexplode(facts.evidence_blocks(text)).alias("block_no", "block"))
    return own.select("o_orderkey", F.col("block_no").cast("long").alias("block_no"), "block")





@query("""SELECT o_orderkey AS message_id, unnest(['sofas', 'wall_colors', 'tables']) AS category, unnest(['sofa', 'wall_color', 'table']) AS item_type, unnest(['Divan.ru', NULL, 'OZON']) AS vendor, unnest([NULL, 'RAL ' || (o_custkey % 9000 + 1000), NULL]) AS color_code, unnest([NULL, NULL, '1550292417']) AS article_id,
  unnest([CAST(floor(o_totalprice) AS BIGINT), NULL, 14157]) AS price, unnest(['high', 'high', 'high']) AS confidence FROM orders""")
def fact_assembly(spark, sf_dir):
    """Facts of posts with a sofa, a wall colour and a table: vendor, code, article, price, confidence."""
    own = table(spark, sf_dir, "orders", spread=True)
    line = F.concat_ws("\n\n", F.concat(F.lit("Диван Divan.ru Слипсон Вельвет Зеленый "), F.floor("o_totalprice").cast("string"), F.lit("₽")), F.concat(F.lit("Цвет стен RAL "), (F.col("o_custkey") % 9000 + 1000).cast("string")), F.lit("Стол OZON Арт. 1550292417 14 157₽"))
    posts = own.select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), line.alias("text"), F.lit("all_text").alias("source_scope"), _none().alias("first_photo_path"))
    out = facts.deduplicate_facts(facts.extract_facts(posts))
    return out.select("message_id", "category", "item_type", F.col("vendor_normalized").alias("vendor"), "color_code", "article_id", F.col("price_value").cast("long").alias("price"), "confidence")


@query("""SELECT o_orderkey AS message_id, unnest(['chairs', 'flooring', 'hallway', 'kitchens', 'living_room_furniture']) AS category, unnest(['dining_chair', 'flooring_laminate', 'mirror', 'backsplash', 'chest']) AS item_type,
  unnest([CAST(5000 + o_orderkey % 1000 AS BIGINT), NULL, 3990, 2990, 7990]) AS price, unnest([NULL, CAST(10000 + o_custkey AS VARCHAR), NULL, NULL, NULL]) AS article_id FROM orders""")
def product_extractors(spark, sf_dir):
    """Chairs, flooring, hallway, kitchen and living-room facts."""
    own = table(spark, sf_dir, "orders", spread=True)
    line = F.concat_ws("\n\n", F.concat(F.lit("Обеденный стул Loft "), (5000 + F.col("o_orderkey") % 1000).cast("string"), F.lit("₽")), F.concat(F.lit("Ламинат Север Арт. "), (10000 + F.col("o_custkey")).cast("string")), F.lit("Зеркало в прихожей 3 990₽"), F.lit("Фартук Kerama 2 990₽"), F.lit("Комод Malm 7 990₽"))
    posts = own.select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), line.alias("text"), F.lit("all_text").alias("source_scope"), _none().alias("first_photo_path"))
    return facts.deduplicate_facts(facts.extract_facts(posts)).select("message_id", "category", "item_type", F.col("price_value").cast("long").alias("price"), "article_id")


@query("""SELECT o_orderkey, 'Слипсон ' || o_custkey AS model, 'Вельвет' AS material, 'Зеленый' AS color FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'Слипсон ' || o_custkey, NULL, NULL FROM orders WHERE o_orderkey % 2 = 1""")
def descriptor_fields(spark, sf_dir):
    """Model, material and colour of what is said behind a keyword."""
    text = F.concat(F.lit("Диван Слипсон "), F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, " Вельвет Зеленый 10 000₽").otherwise(" Арт. 1550292417"))
    own = table(spark, sf_dir, "orders", spread=True).select("o_orderkey", P.model_material_color(P.descriptor(P.descriptor_text(text), ("диваны", "диван"))).alias("m"))
    return own.select("o_orderkey", "m.model", "m.material", "m.color")


@query("""SELECT o_orderkey AS message_id, unnest(['RAL ' || (1000 + o_custkey % 9000), 'G' || (100 + o_custkey % 900)]) AS color_code, unnest(['Tikkurila', NULL]) AS manufacturer, CASE WHEN o_orderkey % 2 = 0 THEN 'high' ELSE 'low' END AS link_confidence FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, 'RAL ' || (1000 + o_custkey % 9000), 'Tikkurila', CASE WHEN o_orderkey % 2 = 0 THEN 'high' ELSE 'low' END FROM orders WHERE o_orderstatus = 'F'""")
def paint_mention_rows(spark, sf_dir):
    """Paint codes in sentences that speak of walls, with the nearest brand and the message's link."""
    own = table(spark, sf_dir, "orders", spread=True)
    ral, g = F.concat(F.lit("RAL "), (1000 + F.col("o_custkey") % 9000).cast("string")), F.concat(F.lit("G"), (100 + F.col("o_custkey") % 900).cast("string"))
    said = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Шкаф "), g, F.lit("."))).otherwise(F.concat(F.lit("Стены цвет "), g, F.lit(".")))
    text = F.concat(F.lit("Краска Tikkurila "), ral, F.lit(".\n"), said, F.lit("\nКраска Tikkurila "), ral, F.lit("."))
    links_ = own.select(F.col("o_orderkey").alias("message_id"), F.col("o_custkey").alias("project_id"), _key("k", "o_custkey").alias("project_key"), _none().alias("project_name"), F.lit("same_message").alias("link_method"), F.when(F.col("o_orderkey") % 2 == 0, "high").otherwise("low").alias("link_confidence"))
    return mentions.paint_mentions(own.select(F.col("o_orderkey").alias("message_id"), text.alias("text_plain")), links_).select("message_id", "color_code", "manufacturer", "link_confidence")


@query("""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang) SELECT lang, CAST(least(n, 8) AS BIGINT) AS n FROM c""")
def strata_counts(spark, sf_dir):
    """Rows drawn of each stratum (P2): the counts are checked, the rows follow a hash."""
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return sampling.stratified(own, F.col("lang"), 32, 42).groupBy("lang").agg(F.count("*").alias("n"))


@query("""SELECT CASE WHEN l_tax > 0.06 THEN 'discard' WHEN l_tax > 0.03 THEN 'fix' ELSE 'keep' END AS decision, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS category_correct, count(*) FILTER (l_linenumber > 3) AS retried, count(*) FILTER (l_linenumber % 2 = 0) AS recovered, count(*) FILTER (l_linenumber % 2 = 1) AS invalid FROM lineitem GROUP BY 1""")
def review_summary(spark, sf_dir):
    """Reviews by decision: flags, retries and statuses."""
    c = F.col
    flags = [(c("l_returnflag") == "R").alias(f) for f in review.FLAGS]
    own = table(spark, sf_dir, "lineitem").select(F.when(c("l_tax") > 0.06, "discard").when(c("l_tax") > 0.03, "fix").otherwise("keep").alias("decision"), *flags, F.when(c("l_linenumber") > 3, 1).otherwise(0).alias("retry_count"), F.when(c("l_linenumber") % 2 == 0, "recovered").otherwise("invalid").alias("status"))
    return review.summary(own).select("decision", "n", "category_correct", "retried", "recovered", "invalid")


@query("""SELECT d.doc_id, CASE WHEN trim(coalesce(substr(d.text, 1, 60), '')) <> '' AND d.doc_id % 3 <> 0 THEN trim(substr(d.text, 1, 60)) ELSE 'quote ' || d.doc_id END AS excerpt, '{"category":"' || lang || '","message_id":"' || doc_id || '"}' AS fact_json FROM documents d""")
def review_plan(spark, sf_dir):
    """Facts with the beginning of their post, else their quote, and their JSON."""
    own = table(spark, sf_dir, "documents")
    facts_ = own.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("message_id"), F.col("lang").alias("category"), F.concat(F.lit("quote "), F.col("doc_id").cast("string")).alias("evidence_quote"))
    planned = review.plan(facts_, own.where("doc_id % 3 <> 0").select(F.col("doc_id").alias("message_id"), "text"), 60, ("category", "message_id"))
    return planned.select(F.col("id").alias("doc_id"), "excerpt", "fact_json")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'ЖК Север ' || o_custkey WHEN 1 THEN 'ул. Мира ' || o_custkey ELSE 'Пост от 2024-01-02, message_id=' || o_orderkey END AS name, CASE o_orderkey % 3 WHEN 0 THEN 'complex' WHEN 1 THEN 'street' ELSE 'fallback_post_id' END AS source, CASE WHEN o_orderkey % 2 = 0 THEN 'Казань' END AS city FROM orders""")
def object_names(spark, sf_dir):
    """The object and city that a post shows."""
    k = F.col("o_orderkey")
    n = F.col("o_custkey").cast("string")
    head = F.when(k % 3 == 0, F.concat(F.lit("#ЖК Север "), n, F.lit(" | 60 м²"))).when(k % 3 == 1, F.concat(F.lit("ул. Мира "), n)).otherwise("Новый пост")
    text = F.concat(head, F.when(k % 2 == 0, "\nКазань").otherwise("\nгород"))
    own = table(spark, sf_dir, "orders", spread=True).select(k, projects.object_name(text, F.lit("2024-01-02T10:00:00"), k).alias("o"), projects.city(text).alias("city"))
    return own.select("o_orderkey", "o.name", "o.source", "city")


@query("""SELECT o_orderkey, o_orderkey % 2 = 0 AS numbers, o_orderkey % 3 = 0 AS code FROM orders""")
def evidence_support(spark, sf_dir):
    """Whether numbers and codes stand in a quote as such."""
    k = F.col("o_orderkey")
    quote = F.concat(F.lit("Диван 1"), (10000 + k).cast("string"), F.when(k % 2 == 0, F.concat(F.lit(" цена "), (10000 + k).cast("string"), F.lit("₽"))).otherwise(""), F.when(k % 3 == 0, " RAL 7047").otherwise(" RAL 70471"))
    own = table(spark, sf_dir, "orders").select(k, quote.alias("q"))
    return own.select("o_orderkey", F.coalesce(effective.number_supported((10000 + k).cast("double"), F.col("q")), F.lit(False)).alias("numbers"), F.exists(P.color_codes(F.col("q")), lambda c: mentions.paint_code(c) == "RAL 7047").alias("code"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '64 990 ₽/шт' ELSE '5 ₽' END AS price, '1996-01-02' AS day, CASE o_orderkey % 3 WHEN 0 THEN '512 B' WHEN 1 THEN '1.5 KB' ELSE '2.0 MB' END AS size FROM orders""")
def format_values(spark, sf_dir):
    """Prices, days and sizes as reports write them."""
    k = F.col("o_orderkey")
    own = table(spark, sf_dir, "orders")
    price = T.format_price(F.when(k % 2 == 0, F.lit(64990)).otherwise(F.lit(5)), F.lit("RUB"), F.when(k % 2 == 0, "шт"))
    size = T.format_bytes(F.when(k % 3 == 0, F.lit(512)).when(k % 3 == 1, F.lit(1536)).otherwise(F.lit(2 << 20)))
    return own.select("o_orderkey", price.alias("price"), T.format_day(F.lit("1996-01-02T10:00:00")).alias("day"), size.alias("size"))


def _reviewed(spark, sf_dir) -> DataFrame:
    own, k = table(spark, sf_dir, "orders", spread=True), F.col("o_orderkey")
    text = {"evidence_quote": F.lit("Диван Слипсон Вельвет 14 990₽"), "category": F.lit("sofas"), "item_type": F.lit("sofa"), "model": F.when(k % 10 != 1, "Слип"), "confidence": F.when(k % 2 == 0, "high").otherwise("low")}
    names = ("vendor_raw", "vendor_normalized", "brand_raw", "brand_normalized", "material", "finish", "color", "color_code", "article_id", "marketplace", "price_unit", "price_currency", "promo_code", "room_context", "project_name", "item_name", "notes", "first_photo_path")
    rows = own.select(k.alias("id"), F.lit("2024").alias("date"), *(v.alias(n) for n, v in text.items()), F.lit(False).alias("needs_review"), F.lit(None).cast("decimal(12,2)").alias("price_value"), *(_none().alias(n) for n in names))
    model = F.when(k % 5 == 0, "Слипсон").when(k % 5 == 1, "Вымысел")
    price = F.when(k % 5 == 2, 14990.0).when(k % 5 == 3, 990.0)
    corrected = F.struct(*(model.alias(n) if n == "model" else price.alias(n) if n == "price_value" else F.lit(None).cast("string").alias(n) for n in review.CORRECTED))
    terms = F.struct(*(F.lit(None).cast("array<string>" if n == "facade_materials" else "string").alias(n) for n in review.TERMS))
    reviews = own.where("o_orderkey % 5 <> 4").select(k.alias("fact_id"), F.lit("fix").alias("decision"), *(F.lit(f.endswith("_correct")).alias(f) for f in review.FLAGS), F.lit(True).alias("price_correct"), corrected.alias("corrected"), terms.alias("normalized_terms"), F.lit("ok").alias("rationale_short"), F.lit("high").alias("confidence"))
    return effective.build(rows, reviews)


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 3 OR o_orderkey % 10 = 1 THEN 'review_fix_not_coherent' WHEN o_orderkey % 5 = 4 AND o_orderkey % 2 = 1 THEN 'below_min_confidence' END AS exclusion_reason, CASE WHEN o_orderkey % 5 = 0 THEN 'Слипсон' WHEN o_orderkey % 10 <> 1 THEN 'Слип' END AS model, CAST(CASE WHEN o_orderkey % 5 = 2 THEN 14990 END AS BIGINT) AS price FROM orders""")
def review_overlay(spark, sf_dir):
    """Corrections that the evidence bears out take the place of a fact's values; a fix that it does not is left out."""
    return _reviewed(spark, sf_dir).select("id", "exclusion_reason", F.col("e_model").alias("model"), F.col("e_price_value").cast("long").alias("price"))
