"""Registered queries: the operators applied to the driver's tables, each beside its SQL where SQL can express it.

The tables hold no archive, so scored text uses the neutral rule pack and structured tables stand in for facts, links
and projects. Patterns are lookaround-free in SQL; both forms give the same answer on these texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import parse as P
from ..functions import text as T
from ..operators import candidates, canonical, effective, facts, mentions, projects, ranking, rankings, reporting, review, sampling, spans

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A table; ``spread``: for work that costs more than moving the rows, over all cores where it has fewer files and is
    small (128 MB for each core); larger tables are read as they lie."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    small = spread and len(df._jdf.inputFiles()) < cores and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < cores << 27
    return df.repartition(cores) if small else df


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", spread=True).select(F.col("doc_id").alias("message_id"), F.col("lang").alias("date"), "text")


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates.score_posts(_posts(spark, sf_dir), rules.NEUTRAL.categories, article_terms_of=("license", "copyright"), article_patterns=(r"public license",))


# SQL of the neutral pack
_FORM = r"trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g'))"


def _word_sql(term: str) -> str:
    return f"(CASE WHEN regexp_matches(form, '(^|[^A-Za-zА-Яа-яЁё0-9]){re.escape(term)}($|[^A-Za-zА-Яа-яЁё0-9])') THEN 1 ELSE 0 END)"


def _regex_sql(pattern: str) -> str:
    return f"(CASE WHEN regexp_matches(form, '{pattern}') THEN 1 ELSE 0 END)"


def _sum_sql(parts: list[str]) -> str:
    return "(" + (" + ".join(parts) or "0") + ")"


def _names_sql(named: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {test} = 1 THEN '{n}' END" for n, test in named) + "], lambda x: x IS NOT NULL)"


_ARTICLE = _sum_sql([_word_sql("license"), _word_sql("copyright"), _regex_sql("public license")])


def _category_sql(c: rules.Category) -> str:
    strong, weak = [(t, _word_sql(t)) for t in c.strong], [(t, _word_sql(t)) for t in c.weak]
    patterns, negative = [(p, _regex_sql(p)) for p in c.patterns], [(p, _regex_sql(p)) for p in c.negative]
    s, w, p, n = (_sum_sql([x for _, x in own]) for own in (strong, weak, patterns, negative))
    other = _sum_sql([x for t, x in weak if t not in c.lone_weak])
    lone = f"({s} = 0 AND {p} = 0 AND {other} = 0)" if c.lone_weak else "FALSE"
    return f"""SELECT message_id, date, '{c.name}' AS category, article, {s} * 3 + {p} * 4 + {w} + CASE WHEN article > 0 THEN 2 ELSE 0 END - {n} * 2 AS score,
  {s} + {p} + {w} AS found, {lone} AS lone, {"TRUE" if c.suppress_lone else "FALSE"} AS suppress, {_names_sql(strong + weak + patterns)} AS terms FROM posts"""


_HITS_SQL = f"""posts AS (SELECT *, {_ARTICLE} AS article FROM (SELECT doc_id AS message_id, lang AS date, {_FORM} AS form FROM documents)),
raw AS ({" UNION ALL ".join(_category_sql(c) for c in rules.NEUTRAL.categories)}),
hits AS (SELECT message_id, date, category, article > 0 AS is_article, score, terms,
  CASE WHEN lone AND NOT suppress THEN 0 WHEN score >= 7 THEN 2 WHEN score >= 4 THEN 1 ELSE 0 END AS rank
  FROM raw WHERE found > 0 AND score > 0 AND NOT (lone AND suppress))"""


@query(f"""WITH {_HITS_SQL}, placed AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY rank DESC, is_article DESC, score DESC, coalesce(date, '') DESC, message_id DESC) AS place FROM hits WHERE score >= 2 AND rank > 0)
SELECT category, CAST(place AS INTEGER) AS place, message_id, CAST(score AS INTEGER) AS score, CAST(rank AS INTEGER) AS rank, is_article, array_to_string(terms, '; ') AS terms FROM placed WHERE place <= 50""")
def rule_score_topk(spark, sf_dir):
    """The 50 best posts of each category."""
    best = candidates.best_candidates(_hits(spark, sf_dir), per_category=50)
    return best.select("category", "place", "message_id", "score", "rank", "is_article", F.array_join(F.concat("strong", "weak", "patterns"), "; ").alias("terms"))


@query(f"WITH {_HITS_SQL} SELECT category, count(*) FILTER (rank = 2) AS high, count(*) FILTER (rank = 1) AS medium, count(*) FILTER (rank = 0) AS low, CAST(0 AS BIGINT) AS with_photo, count(*) FILTER (is_article) AS in_articles, count(*) AS total FROM hits GROUP BY category")
def rule_score_summary(spark, sf_dir):
    """Candidate counts by category and confidence."""
    return candidates.summary(_hits(spark, sf_dir))


@query(f"WITH {_HITS_SQL}, t AS (SELECT category, term, count(*) AS n FROM (SELECT category, unnest(terms) AS term FROM hits) GROUP BY ALL), p AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, term) AS place FROM t) SELECT category, term, n, CAST(place AS INTEGER) AS place FROM p WHERE place <= 12")
def rule_top_terms(spark, sf_dir):
    """Commonest matched terms of each category."""
    return candidates.top_terms(_hits(spark, sf_dir))


@query(f"WITH {_HITS_SQL} SELECT message_id, CAST(article * 2 AS INTEGER) AS article_score FROM posts WHERE article > 0")
def article_detect(spark, sf_dir):
    """Article posts by terms and patterns."""
    own = _posts(spark, sf_dir).withColumn("t", candidates.article_terms(T.match_form(F.coalesce("text", F.lit(""))), "", ("license", "copyright"), ("public license",)))
    return own.where(F.size("t") > 0).select("message_id", (F.size("t") * 2).alias("article_score"))


@query(f"""WITH d AS (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g')) AS c FROM documents),
f AS (SELECT *, CASE WHEN strpos(lower(c), 'license') > 0 THEN strpos(lower(c), 'license') - 1 END AS first, length(c) AS n FROM d),
e AS (SELECT *, least(n, greatest(0, first - 100) + 200) AS stop FROM f), b AS (SELECT *, greatest(0, stop - 200) AS start FROM e)
SELECT doc_id, CASE WHEN first IS NULL THEN CASE WHEN n <= 200 THEN c ELSE rtrim(substr(c, 1, 197)) || '...' END
  ELSE CASE WHEN start > 0 THEN '...' ELSE '' END || trim(substr(c, CAST(start + 1 AS BIGINT), CAST(stop - start AS BIGINT))) || CASE WHEN stop < n THEN '...' ELSE '' END END AS excerpt FROM b""")
def excerpt_window(spark, sf_dir):
    """Excerpt around the first match, else the beginning."""
    return table(spark, sf_dir, "documents", spread=True).select("doc_id", T.excerpt(F.coalesce("text", F.lit("")), ["license"], width=200).alias("excerpt"))


@query(r"""SELECT conv_id, turn, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS form, CASE WHEN length(c) <= 80 THEN c ELSE rtrim(substr(c, 1, 77)) || '...' END AS preview
FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM conversations)""")
def text_normalize(spark, sf_dir):
    """Match form and preview of every turn."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.match_form(F.col("text")).alias("form"), T.preview(F.col("text"), 80).alias("preview"))


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY trim(text) <> '' DESC, (trim(text) <> '' AND role = 'system') DESC, CASE WHEN trim(text) <> '' THEN length(text) ELSE 0 END DESC, CASE WHEN trim(text) <> '' AND role <> 'system' THEN role ELSE '' END DESC, turn) AS k FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations))
SELECT conv_id, max(CASE WHEN k = 1 THEN text END) AS text, max(CASE WHEN k = 1 THEN turn END) AS turn, count(*) AS variants FROM r GROUP BY conv_id""")
def canonical_merge(spark, sf_dir):
    """One text for each conversation: any system text first, else the longest."""
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), (F.col("role") == "system").alias("is_root"))
    w = Window.partitionBy("conv_id").orderBy(canonical.best_text_first("is_root", "text", "role").desc(), "turn")
    return own.withColumn("k", F.row_number().over(w)).groupBy("conv_id").agg(F.max(F.when(F.col("k") == 1, F.col("text"))).alias("text"), F.max(F.when(F.col("k") == 1, F.col("turn"))).alias("turn"), F.count("*").alias("variants"))


@query("SELECT user_id, arg_max(props, (length(props), -event_id)) AS props, arg_min(event_type, event_id) AS first_type FROM events GROUP BY user_id")
def richest_field(spark, sf_dir):
    """Richest and first value of a field by key."""
    own = table(spark, sf_dir, "events")
    return own.groupBy("user_id").agg(F.max_by("props", F.struct(F.length("props"), -F.col("event_id"))).alias("props"), F.min_by("event_type", "event_id").alias("first_type"))


@query("""SELECT l_orderkey, l_partkey, confidence, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY rank DESC, l_linenumber, l_extendedprice, l_shipdate) AS k
FROM (SELECT *, CASE WHEN l_quantity >= 35 THEN 2 WHEN l_quantity >= 15 THEN 1 ELSE 0 END AS rank, CASE WHEN l_quantity >= 35 THEN 'high' WHEN l_quantity >= 15 THEN 'medium' ELSE 'low' END AS confidence FROM lineitem)) WHERE k = 1""")
def dedup_keep_best(spark, sf_dir):
    """One row a key: the first of the highest confidence."""
    own = table(spark, sf_dir, "lineitem").withColumns({"confidence": F.when(F.col("l_quantity") >= 35, "high").when(F.col("l_quantity") >= 15, "medium").otherwise("low"), "ord": F.struct("l_linenumber", "l_extendedprice", "l_shipdate")})
    return facts.deduplicate_facts(own, ("l_orderkey", "l_partkey")).select("l_orderkey", "l_partkey", "confidence", "l_linenumber", "l_extendedprice")


@query("""WITH f AS (SELECT conv_id, role, min(turn) AS t FROM conversations GROUP BY ALL) SELECT conv_id, string_agg(role, '; ' ORDER BY t) AS roles FROM f GROUP BY conv_id""")
def ordered_distinct(spark, sf_dir):
    """Values of a key, each once, in order of first appearance."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"])
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(listed.alias("r")).select("conv_id", F.array_join(T.ordered_distinct(F.col("r"), F.lower), "; ").alias("roles"))


@query("""SELECT source, count(*) AS messages, min(lang) AS lang_min, max(lang) AS lang_max, count(*) FILTER (trim(text) <> '') AS text_messages, CAST(sum(CASE WHEN trim(text) <> '' THEN length(text) ELSE 0 END) AS BIGINT) AS text_chars, bool_or(contains(text, '|')) AS has_table FROM documents GROUP BY source""")
def audit_profile(spark, sf_dir):
    """Profile of each source (A3)."""
    text = F.trim("text") != ""
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("messages"), F.min("lang").alias("lang_min"), F.max("lang").alias("lang_max"), F.count_if(text).alias("text_messages"), F.sum(F.when(text, F.length("text")).otherwise(0)).alias("text_chars"), F.bool_or(F.contains("text", F.lit("|"))).alias("has_table"))


@query("""SELECT (SELECT count(*) FROM documents) AS posts, (SELECT count(*) FROM conversations) AS variants, (SELECT count(*) FROM pages) AS media, (SELECT count(*) FROM documents WHERE trim(text) <> '') AS with_text, (SELECT min(doc_id) FROM documents) AS id_min, (SELECT max(doc_id) FROM documents) AS id_max""")
def db_stats(spark, sf_dir):
    """Scalars over an archive in one row."""
    own = table(spark, sf_dir, "documents").agg(F.count("*").alias("posts"), F.count_if(F.trim("text") != "").alias("with_text"), F.min("doc_id").alias("id_min"), F.max("doc_id").alias("id_max"))
    one = lambda t, n: table(spark, sf_dir, t).agg(F.count("*").alias(n))
    return own.crossJoin(one("conversations", "variants")).crossJoin(one("pages", "media")).select("posts", "variants", "media", "with_text", "id_min", "id_max")  # one row each


_HOST_SQL = "regexp_extract(url, '^[a-z]+://(?:www\\.)?([^/?#]+)', 1)"


@query(f"SELECT host AS extension, count(*) AS n FROM (SELECT {_HOST_SQL} AS host FROM pages) GROUP BY host ORDER BY n DESC, extension LIMIT 10")
def top_extensions(spark, sf_dir):
    """The ten commonest values, ties by value."""
    return canonical.top_extensions(table(spark, sf_dir, "pages").select(mentions.host(F.col("url")).alias("extension")))


@query("SELECT count(*) AS unique_ids, count(*) FILTER (n > 1) AS repeated_ids, min(k) AS id_min, max(k) AS id_max FROM (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def dup_ids_having(spark, sf_dir):
    """Distinct and repeated ids (A4)."""
    return canonical.id_profile(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("message_id")))


@query("""SELECT doc_id, CAST(priority AS INTEGER) AS priority, quality FROM (SELECT d.doc_id, CASE WHEN trim(d.text) <> '' AND l.quality = 1 THEN 0 WHEN trim(d.text) <> '' AND l.toxic = 1 THEN 1 WHEN trim(d.text) <> '' THEN 2 WHEN l.quality = 1 OR l.toxic = 1 THEN 3 ELSE 4 END AS priority, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)) ORDER BY priority, doc_id LIMIT 50""")
def sample_priority(spark, sf_dir):
    """First rows by a priority and id, with a left join."""
    own = table(spark, sf_dir, "documents").select("doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    text = F.trim("text") != ""
    priority = F.when(text & (F.col("quality") == 1), 0).when(text & (F.col("toxic") == 1), 1).when(text, 2).when((F.col("quality") == 1) | (F.col("toxic") == 1), 3).otherwise(4)
    return own.select("doc_id", priority.alias("priority"), "quality").orderBy("priority", "doc_id").limit(50)


@query("""SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS value, CASE WHEN o_orderkey % 3 = 0 THEN 'шт' WHEN o_orderkey % 3 = 1 THEN 'м2' END AS unit, CAST(o_custkey + 1000 AS VARCHAR) AS article_id, CASE o_orderkey % 4 WHEN 0 THEN 'OZON' WHEN 1 THEN 'Wildberries' WHEN 2 THEN 'HOFF' END AS vendor FROM orders""")
def price_parse(spark, sf_dir):
    """Prices, units, article numbers and vendors parsed from lines written for them."""
    own = table(spark, sf_dir, "orders", spread=True)
    vendor = F.when(F.col("o_orderkey") % 4 == 0, "Озон ").when(F.col("o_orderkey") % 4 == 1, "вб ").when(F.col("o_orderkey") % 4 == 2, "Хофф ").otherwise("")
    unit = F.when(F.col("o_orderkey") % 3 == 0, "/шт.").when(F.col("o_orderkey") % 3 == 1, " / м²").otherwise("")
    line = F.concat(F.lit("Стол "), vendor, F.lit("Арт. "), (F.col("o_custkey") + 1000).cast("string"), F.lit(", цена "), F.floor("o_totalprice").cast("string"), F.lit("₽"), unit)
    own = own.select("o_orderkey", line.alias("line")).withColumns({"p": P.price(F.col("line")), "a": P.article(F.col("line"))})
    return own.select("o_orderkey", F.col("p.value").alias("value"), F.col("p.unit").alias("unit"), F.col("a.article_id").alias("article_id"), F.col("a.vendor_normalized").alias("vendor"))


@query("""WITH v AS (SELECT p_partkey, least(CASE WHEN strpos(s, 'economy') > 0 THEN strpos(s, 'economy') ELSE 999 END, CASE WHEN strpos(s, 'widget') > 0 THEN strpos(s, 'widget') ELSE 999 END) AS pos, s FROM (SELECT p_partkey, lower(p_type || ' ' || p_name) AS s FROM part))
SELECT p_partkey, CASE WHEN pos = 999 THEN NULL WHEN pos = strpos(s, 'economy') THEN 'Economy' ELSE 'Widget' END AS vendor FROM v""")
def vendor_earliest(spark, sf_dir):
    """The alias that comes first in a text."""
    pack = (("Economy", ("economy",)), ("Widget", ("widget",)))
    return table(spark, sf_dir, "part").select("p_partkey", P.vendor(F.concat_ws(" ", "p_type", "p_name"), pack)["normalized"].alias("vendor"))


@query(r"""WITH l AS (SELECT doc_id, unnest(range(len(ls))) AS block_no, unnest(ls) AS block FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents WHERE text IS NOT NULL))
SELECT doc_id, count(*) AS n_lines, CAST(max(length(block)) AS INTEGER) AS longest FROM l GROUP BY doc_id""")
def block_split(spark, sf_dir):
    """Lines of documents that are not blank."""
    own = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.filter(T.lines(F.col("text")), lambda x: F.trim(x) != "")).alias("block"))
    return own.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.max(F.length("block")).alias("longest"))


@query()
def evidence_blocks(spark, sf_dir):
    """Paragraphs and line windows of documents."""
    own = table(spark, sf_dir, "documents", spread=True).select("doc_id", F.posexplode(facts.evidence_blocks(F.col("text"))).alias("block_no", "block"))
    return own.select("doc_id", "block_no", F.length("block").alias("chars"))


@query()
def fact_extraction(spark, sf_dir):
    """Facts of posts written from orders and parts."""
    own = table(spark, sf_dir, "orders", spread=True)
    line = F.concat_ws("\n\n", F.concat(F.lit("Диван Divan.ru Слипсон Вельвет Зеленый "), F.floor("o_totalprice").cast("string"), F.lit("₽")), F.concat(F.lit("Цвет стен RAL "), (F.col("o_custkey") % 9000 + 1000).cast("string")), F.lit("Стол OZON Арт. 1550292417 14 157₽"))
    posts = own.select(F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").cast("string").alias("date"), line.alias("text"), F.lit("all_text").alias("source_scope"), F.lit(None).cast("string").alias("first_photo_path"))
    return facts.deduplicate_facts(facts.extract_facts(posts)).select("message_id", "category", "item_type", "vendor_normalized", "model", "material", "color", "color_code", "price_value", "confidence", "needs_review")


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, CASE WHEN l_discount > 0.05 THEN 'high' WHEN l_discount > 0.02 THEN 'medium' ELSE 'low' END AS hint, l_tax > 0.06 AS extra, l_quantity > 10 AS sold, CAST(l_linenumber % 5 AS INTEGER) AS details FROM lineitem),
r AS (SELECT *, CASE WHEN details >= 3 AND hint <> 'low' THEN 2 WHEN details <= 1 AND hint = 'high' THEN 1 WHEN hint = 'high' THEN 2 WHEN hint = 'medium' THEN 1 ELSE 0 END AS r0 FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(CASE WHEN extra AND hint = 'medium' THEN 1 WHEN NOT sold THEN CASE WHEN hint = 'high' THEN 1 ELSE 0 END ELSE r0 END AS INTEGER) AS rank FROM r""")
def fact_confidence(spark, sf_dir):
    """The confidence ladder."""
    own = table(spark, sf_dir, "lineitem")
    hint = F.when(F.col("l_discount") > 0.05, "high").when(F.col("l_discount") > 0.02, "medium").otherwise("low")
    rank = facts.confidence_of(hint, F.col("l_tax") > 0.06, F.col("l_linenumber") % 5, F.col("l_quantity") > 10)
    return own.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", rank.alias("rank"))


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.toxic = 1 THEN 'review_discard' WHEN l.quality = 0 THEN 'review_needs_human' END
  ELSE CASE WHEN d.lang NOT IN ('en', 'de') THEN 'outside_categories' WHEN d.n_chars < 200 THEN 'below_min_confidence' END END AS exclusion_reason FROM documents d LEFT JOIN labels l USING (doc_id)""")
def effective_filter(spark, sf_dir):
    """Facts under reviews: the first reason that excludes them."""
    docs = table(spark, sf_dir, "documents", spread=True)
    own = docs.select(F.col("doc_id").alias("id"), F.lit("2024").alias("date"), F.when(F.col("lang").isin("en", "de"), "sofas").otherwise("garden").alias("category"), F.lit("sofa").alias("item_type"), F.lit("evidence 10₽").alias("evidence_quote"), F.when(F.col("n_chars") < 200, "low").otherwise("high").alias("confidence"), F.lit(False).alias("needs_review"), *(F.lit(None).cast("decimal(12,2)" if n == "price_value" else "string").alias(n) for n in ("vendor_raw", "vendor_normalized", "brand_raw", "brand_normalized", "model", "material", "finish", "color", "color_code", "article_id", "marketplace", "price_value", "price_unit", "price_currency", "room_context")))
    decision = F.when(F.col("toxic") == 1, "discard").when(F.col("quality") == 0, "needs_human").otherwise("keep")
    corrected = F.struct(*((F.lit("sofas") if n == "category" else F.lit(None)).cast("double" if n == "price_value" else "string").alias(n) for n in review.CORRECTED))
    terms = F.struct(*(F.lit(None).cast("array<string>" if n == "facade_materials" else "string").alias(n) for n in review.TERMS))
    reviews = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("fact_id"), decision.alias("decision"), *(F.lit(f.endswith("_correct")).alias(f) for f in review.FLAGS), F.lit(None).cast("boolean").alias("price_correct"), corrected.alias("corrected"), terms.alias("normalized_terms"), F.lit("ok").alias("rationale_short"), F.lit("high").alias("confidence"))
    return effective.build(own, reviews).select(F.col("id").alias("doc_id"), "exclusion_reason")


@query("""WITH u AS (SELECT *, 0 AS s FROM orders UNION ALL SELECT * REPLACE ('corrected' AS o_orderstatus), 1 AS s FROM orders WHERE o_totalprice > 200000)
SELECT o_custkey, arg_max(o_orderkey, (s, o_orderkey)) AS o_orderkey, arg_max(o_orderstatus, (s, o_orderkey)) AS o_orderstatus FROM u GROUP BY o_custkey""")
def multi_db_last_wins(spark, sf_dir):
    """Several stores: the later store, then the later row wins."""
    own = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")
    later = own.where("o_totalprice > 200000").withColumn("o_orderstatus", F.lit("corrected"))
    every = ranking.ordered_union(own.drop("o_totalprice"), later.drop("o_totalprice"))
    return ranking.last_wins(every, "o_custkey", [F.col("source_no"), F.col("o_orderkey")]).drop("source_no")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_antijoin(spark, sf_dir):
    """Planned rows that have no result yet."""
    return ranking.anti_seen(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("SELECT doc_id, substr(text, 1, 100) AS excerpt FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def semi_join_excerpts(spark, sf_dir):
    """Excerpts of the posts of an id list."""
    ids = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return table(spark, sf_dir, "documents").join(ids, "doc_id", "left_semi").select("doc_id", F.left("text", F.lit(100)).alias("excerpt"))


@query("SELECT category, flagged, CAST(least(n, m) AS BIGINT) AS n FROM (SELECT lang AS category, n_chars % 2 = 0 AS flagged, count(*) AS n FROM documents GROUP BY ALL) JOIN (VALUES ('en', 8), ('de', 4), ('fr', 4), ('es', 4)) q(category, m) USING (category)")
def quota_sample(spark, sf_dir):
    """Rows drawn of each quota (P3): counts are checked, the rows follow a hash."""
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"), (F.col("n_chars") % 2 == 0).alias("flagged"))
    got = sampling.mixed(own, 40, 42, category="category", flag="flagged", targets={"en": 16, "de": 8, "fr": 8, "es": 8})
    return got.groupBy("category", "flagged").agg(F.count("*").alias("n"))


@query()
def stratified_sample(spark, sf_dir):
    """A stratified sample of documents by language."""
    own = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return sampling.stratified(own, F.col("lang"), 100, 42)


@query("SELECT l_returnflag || '/' || l_linestatus AS value, count(*) AS n FROM lineitem GROUP BY 1")
def value_histogram(spark, sf_dir):
    """Counts of any expression."""
    return ranking.histogram(table(spark, sf_dir, "lineitem"), F.concat_ws("/", "l_returnflag", "l_linestatus"))


@query("""WITH j AS (SELECT s.s_name AS vendor, n.n_name AS nation, p.p_type AS kind FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey),
c AS (SELECT vendor, kind, count(*) AS n FROM j GROUP BY ALL), t AS (SELECT *, row_number() OVER (PARTITION BY vendor ORDER BY n DESC, kind) AS k FROM c)
SELECT vendor, nation, total, kinds FROM (SELECT vendor, min(nation) AS nation, count(*) AS total FROM j GROUP BY vendor) JOIN (SELECT vendor, string_agg(kind, '; ' ORDER BY k) AS kinds FROM t WHERE k <= 3 GROUP BY vendor) USING (vendor)""")
def supplier_rollup(spark, sf_dir):
    """By supplier: rows, nation and its three commonest kinds."""
    own = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("kind")), "l_partkey")
    counts = own.groupBy("l_suppkey", "kind").agg(F.count("*").alias("n"))  # suppliers and nations join the counts, not the lines
    top = ranking.top_k(counts, ["l_suppkey"], [F.desc("n"), F.asc("kind")], 3).groupBy("l_suppkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "kind"))), lambda x: x["kind"]), "; ").alias("kinds"))
    total = counts.groupBy("l_suppkey").agg(F.sum("n").alias("total"))
    who = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("vendor"), F.col("n_name").alias("nation"))
    return total.join(top, "l_suppkey").join(who, "l_suppkey").select("vendor", "nation", "total", "kinds")


@query("""SELECT o.o_orderkey, o.o_orderstatus, count(*) AS n_facts, string_agg(CAST(l_linenumber AS VARCHAR) || ':' || l_returnflag, '; ' ORDER BY l_linenumber, l_partkey, l_returnflag) AS lines, count(DISTINCT l_suppkey) AS vendors FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY ALL""")
def project_build(spark, sf_dir):
    """Facts grouped under their project with ordered lists."""
    own = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_facts"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))), lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_returnflag"])), "; ").alias("lines"), F.count_distinct("l_suppkey").alias("vendors"))
    return own.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey").select("o_orderkey", "o_orderstatus", "n_facts", "lines", "vendors")


@query("SELECT a.o_orderkey AS project_id, b.o_orderkey AS neighbour_id FROM orders a JOIN orders b ON b.o_orderkey > a.o_orderkey AND b.o_orderkey <= a.o_orderkey + 8 AND date_trunc('month', a.o_orderdate) = date_trunc('month', b.o_orderdate)")
def neighbour_interval_join(spark, sf_dir):
    """The next eight ids of the same month, as an equi-join on exploded ids."""
    own = table(spark, sf_dir, "orders").select("o_orderkey", F.date_trunc("month", "o_orderdate").alias("m"))
    near = own.select(F.col("o_orderkey").alias("project_id"), F.col("m").alias("pm"), F.explode(F.sequence(F.col("o_orderkey") + 1, F.col("o_orderkey") + projects.NEIGHBOURS)).alias("neighbour_id"))
    return near.join(own.withColumnRenamed("o_orderkey", "neighbour_id"), "neighbour_id").where("m = pm").select("project_id", "neighbour_id")


_TIER_SQL = """f AS (SELECT l_orderkey, bool_or(l_returnflag = 'R') AS a, bool_or(l_tax > 0.07) AS b, max(l_quantity) > 40 AS c, bool_or(l_linestatus = 'O') AS d FROM lineitem GROUP BY l_orderkey),
q AS (SELECT *, CASE WHEN a THEN 4 ELSE -3 END + CASE WHEN b THEN 2 ELSE 0 END + CASE WHEN c THEN 2 ELSE -2 END AS score FROM f)"""


def _tiers(spark, sf_dir):
    own = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.bool_or(F.col("l_returnflag") == "R").alias("a"), F.bool_or(F.col("l_tax") > 0.07).alias("b"), (F.max("l_quantity") > 40).alias("c"), F.bool_or(F.col("l_linestatus") == "O").alias("d"))
    points = lambda c, yes, no: F.when(F.col(c), yes).otherwise(no)
    return own.withColumn("score", points("a", 4, -3) + points("b", 2, 0) + points("c", 2, -2))


@query(f"WITH {_TIER_SQL} SELECT l_orderkey, CAST(score AS INTEGER) AS score, CASE WHEN score >= 8 AND a THEN 'high' WHEN score >= 4 AND (a OR (b AND c)) THEN 'medium' ELSE 'low' END AS tier FROM q")
def quality_tiers(spark, sf_dir):
    """Additive quality score and tier."""
    own = _tiers(spark, sf_dir)
    tier = F.when((F.col("score") >= 8) & F.col("a"), "high").when((F.col("score") >= 4) & (F.col("a") | (F.col("b") & F.col("c"))), "medium").otherwise("low")
    return own.select("l_orderkey", "score", tier.alias("tier"))


@query(f"""WITH {_TIER_SQL}, s AS (SELECT l_orderkey, 'x' AS label, 0 AS k, CASE WHEN a THEN 4 + CASE WHEN b THEN 1 ELSE 0 END END AS s FROM q UNION ALL SELECT l_orderkey, 'y', 1, CASE WHEN c THEN 5 END FROM q UNION ALL SELECT l_orderkey, 'z', 2, CASE WHEN d THEN 4 END FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY s DESC, k) AS place FROM s WHERE s IS NOT NULL)
SELECT q.l_orderkey, max(CASE WHEN place = 1 THEN label END) AS label, CAST(coalesce(max(CASE WHEN place = 1 THEN s END), 0) AS INTEGER) AS score, coalesce(string_agg(label, ';' ORDER BY place) FILTER (place > 1), '') AS others FROM q LEFT JOIN r USING (l_orderkey) GROUP BY q.l_orderkey""")
def argmax_label(spark, sf_dir):
    """Best scored label with a fixed order of ties, and the others."""
    own = _tiers(spark, sf_dir)
    best = projects.argmax_label([("x", F.when(F.col("a"), 4 + F.when(F.col("b"), 1).otherwise(0))), ("y", F.when(F.col("c"), 5)), ("z", F.when(F.col("d"), 4))])
    return own.withColumn("best", best).select("l_orderkey", F.col("best.label").alias("label"), F.coalesce("best.score", F.lit(0)).alias("score"), F.coalesce(F.array_join("best.others", ";"), F.lit("")).alias("others"))


@query("""WITH t AS (SELECT c_custkey, c_mktsegment, CASE WHEN c_acctbal > 9800 THEN 'high' WHEN c_acctbal > 5000 THEN 'medium' ELSE 'low' END AS tier, c_acctbal FROM customer),
p AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, tier ORDER BY c_acctbal DESC, c_custkey) AS place, least(6, count(*) FILTER (tier = 'high') OVER (PARTITION BY c_mktsegment)) AS high FROM t)
SELECT c_custkey, c_mktsegment, tier FROM p WHERE (tier = 'high' AND place <= 6) OR (tier = 'medium' AND high < 3 AND place <= 6 - high)""")
def quota_topk_fill(spark, sf_dir):
    """Top rows of a tier, filled up from the next one."""
    own = table(spark, sf_dir, "customer").withColumn("tier", F.when(F.col("c_acctbal") > 9800, "high").when(F.col("c_acctbal") > 5000, "medium").otherwise("low"))
    return projects.quota_fill(own, "c_mktsegment", "tier", [F.desc("c_acctbal"), F.asc("c_custkey")], 6).where("selected").select("c_custkey", "c_mktsegment", "tier")


@query("""WITH t AS (SELECT l_orderkey, list_sort(list_distinct(list(l_suppkey) FILTER (l_returnflag = 'R'))) AS targets FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, CASE WHEN len(targets) = 1 THEN 'explicit' WHEN len(targets) > 1 THEN 'ambiguous' WHEN o_custkey % 5 = 0 THEN 'mapped' WHEN o_orderstatus = 'O' THEN 'same' ELSE 'ambiguous' END AS link_method,
  CASE WHEN len(targets) = 1 THEN targets[1] WHEN len(targets) > 1 THEN -1 WHEN o_custkey % 5 = 0 THEN o_custkey WHEN o_orderstatus = 'O' THEN o_orderkey ELSE -1 END AS project_id FROM orders LEFT JOIN t ON o_orderkey = l_orderkey""")
def link_cascade(spark, sf_dir):
    """The first linking method that holds, over a set of explicit targets."""
    found = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_set("l_suppkey")).alias("targets"))
    own = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").join(found, "o_orderkey", "left")
    n = F.coalesce(F.size("targets"), F.lit(0))
    mapped, same = F.col("o_custkey") % 5 == 0, F.col("o_orderstatus") == "O"
    return own.select("o_orderkey", F.when(n == 1, "explicit").when(n > 1, "ambiguous").when(mapped, "mapped").when(same, "same").otherwise("ambiguous").alias("link_method"), F.when(n == 1, F.get("targets", F.lit(0))).when(n > 1, -1).when(mapped, F.col("o_custkey")).when(same, F.col("o_orderkey")).otherwise(-1).alias("project_id"))


@query("""WITH c AS (SELECT l_orderkey, p_name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL) SELECT l_orderkey, arg_min(p_name, (-n, p_name)) AS project_name FROM c GROUP BY l_orderkey""")
def top1_name(spark, sf_dir):
    """The commonest name of a key, ties by name."""
    from ..operators.links import project_names

    own = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("message_id"), F.col("p_name").alias("project_name"))
    return project_names(own).withColumnRenamed("message_id", "l_orderkey")


@query("""WITH v AS (SELECT l_returnflag AS category, unnest(['mode', 'status', 'line']) AS field, unnest([CASE WHEN l_quantity > 25 THEN 'bulk' ELSE 'small' END, l_linestatus, CAST(l_linenumber AS VARCHAR)]) AS value FROM lineitem),
c AS (SELECT category, field, value, count(*) AS n FROM v GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY category, field ORDER BY n DESC, value) AS place FROM c)
SELECT category, field, value, n, CAST(place AS INTEGER) AS place FROM r WHERE place <= 3""")
def top_values(spark, sf_dir):
    """Commonest values of several fields in one pass."""
    own = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("category"), F.when(F.col("l_quantity") > 25, "bulk").otherwise("small").alias("mode"), F.col("l_linestatus").alias("status"), F.col("l_linenumber").alias("line"))
    return reporting.top_values(own, ("mode", "status", "line"), 3)


@query()
def nearest_span(spark, sf_dir):
    """Keyword spans of documents and the nearest brand word in their line."""
    every = spans.annotate(table(spark, sf_dir, "documents", spread=True), [("code", "version", r"\b\d\.\d\b"), ("code", "number", r"\b\d+\b"), ("brand", "license", r"\blicensed?\b"), ("brand", "released", r"\breleased\b")], ("code",), "doc_id", "text")
    unit = lambda kind: spans.inside_unit(every.where(F.col("kind") == kind), every, "line")
    return spans.nearest(unit("code"), unit("brand").select("message_id", "unit_start", "start", "end", "name"), ("message_id", "unit_start")).select("message_id", "name", "start", "end", "nearest")


@query(f"""SELECT page_id, {_HOST_SQL} AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""")
def url_parts(spark, sf_dir):
    """Host without www, path and a query value."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", mentions.host(url).alias("host"), F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")).alias("path"), F.try_parse_url(url, F.lit("QUERY"), F.lit("page")).alias("page"))


@query("""WITH m AS (SELECT l.l_partkey AS paint, l.l_orderkey AS message_id, o.o_custkey AS project FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag = 'R'),
g AS (SELECT paint, count(DISTINCT project) AS unique_projects, count(DISTINCT message_id) AS unique_messages FROM m GROUP BY paint)
SELECT CAST(paint AS VARCHAR) AS paint, unique_projects, unique_messages, CAST(row_number() OVER (ORDER BY unique_projects DESC, unique_messages DESC, CAST(paint AS VARCHAR)) AS INTEGER) AS rank FROM g""")
def exact_ranking(spark, sf_dir):
    """Codes by distinct projects, then messages."""
    own = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    none = F.lit(None).cast("string")
    m = own.select(F.col("l_orderkey").alias("message_id"), F.col("l_partkey").cast("string").alias("color_code"), none.alias("manufacturer"), none.alias("product_line"), F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("project_key"), none.alias("project_name"), F.lit("same_message").alias("link_method"), F.lit("high").alias("link_confidence"), F.col("l_linenumber").alias("start"))
    return rankings.rank_paints(m).select("paint", "unique_projects", "unique_messages", "rank")


@query("""WITH g AS (SELECT p_brand AS shade_family, count(DISTINCT o_custkey) AS unique_projects, count(DISTINCT l_orderkey) AS unique_messages FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_tax > 0.05 GROUP BY p_brand)
SELECT *, CAST(row_number() OVER (ORDER BY unique_projects DESC, unique_messages DESC, shade_family) AS INTEGER) AS rank FROM g""")
def shade_ranking(spark, sf_dir):
    """Families by distinct projects, then messages."""
    own = table(spark, sf_dir, "lineitem").where("l_tax > 0.05").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey").join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    groups = own.groupBy(F.col("p_brand").alias("shade_family")).agg(F.count_distinct("o_custkey").alias("unique_projects"), F.count_distinct("l_orderkey").alias("unique_messages"))
    return rankings.ranked(groups, "shade_family")


@query("SELECT user_id AS message_id, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS record_types FROM events GROUP BY user_id")
def distinct_source_counts(spark, sf_dir):
    """Which kinds of record name a key."""
    own = table(spark, sf_dir, "events")
    kinds = ("click", "error", "purchase", "signup", "view")
    return rankings.record_types(**{k: own.where(F.col("event_type") == k).select(F.col("user_id").alias("message_id")) for k in kinds})


@query("SELECT event_id, CASE WHEN props IS NULL OR NOT json_valid(props) THEN 'not JSON' WHEN json_type(props) <> 'OBJECT' THEN 'not an object' ELSE 'decision' END AS error, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_validate(spark, sf_dir):
    """Why a payload is not a review, and a number in it."""
    return table(spark, sf_dir, "events").select("event_id", review.payload_error(F.col("props")).alias("error"), F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query("SELECT doc_id, sha256(text) AS text_hash, sha256(lang || chr(10) || source) AS key_hash FROM documents")
def hash_keys(spark, sf_dir):
    """Hashes of texts and of composed keys."""
    return table(spark, sf_dir, "documents").select("doc_id", T.sha256(F.col("text")).alias("text_hash"), T.sha256(F.concat_ws("\n", "lang", "source")).alias("key_hash"))


@query("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS id FROM orders")
def total_order_ids(spark, sf_dir):
    """Ids by place in a total order, by a distributed sort."""
    return ranking.numbered(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "id")


@query("SELECT token, count(DISTINCT doc_id) AS documents FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM documents) GROUP BY token")
def token_index(spark, sf_dir):
    """Posting sizes of a full-text index (K2)."""
    from ..sinks import token_postings

    return token_postings(table(spark, sf_dir, "documents", spread=True), "doc_id", "text").groupBy("token").agg(F.count("*").alias("documents"))


@query("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL")
def hourly_events(spark, sf_dir):
    """Tumbling windows over events; the batch form of the streaming extension."""
    from ..streaming.ingest import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events"))
