"""URL filtering by fixed rules and by mined association rules. DataFrame operations only.

FP-growth mines combinations of URL tokens from labelled pages, with the label ``block`` as one more item. A rule
``tokens -> block`` stays if enough blocked pages have the tokens, and if pages with the tokens are blocked often enough, in
itself and against the share of all labelled pages that are. Rules are posted in an inverted index under their rarest
token; a page looks up its own tokens and a posted rule matches if the page holds all its tokens.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io

#: A rule needs so many blocked pages, this share of the labelled pages (which bounds the rules of very large tables), this
#: confidence, and this multiple of the share of labelled pages that are blocked.
MIN_PAGES, MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 5, 0.0002, 0.5, 2.0
BLOCK, ALLOW = "block", "allow"
_LABEL = "=block"
#: Mined rules up to this number are broadcast to the scan of the pages; beyond it the join shuffles.
BROADCAST_RULES = 50_000

#: (host, path prefix, verdict)
RULES = (
    ("com", "/en/", BLOCK),
    ("example.com", "/en/7", ALLOW),
    ("net", "/de/", ALLOW),
    ("example.net", "/de/8", BLOCK),
    ("org", "/es/", BLOCK),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to /, ? or #, A-Z lower-cased; path: from there up to ? or #. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits host or one of its parent domains and the start of path; null if none does."""
    fits = []
    for h, p, verdict in rules:
        same = (host == F.lit(h)) | host.endswith(F.lit(f".{h}"))
        fits.append(F.when(same & path.startswith(p), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def tokens(host: Column, path: Column) -> Column:
    """Distinct URL tokens: words of the host, its domain suffix and first label, every path part by place with digits as 0,
    and the number of path parts."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    words = F.filter(F.split(host, r"[.\-]"), lambda x: x != "")
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    places = F.transform(steps, lambda x, i: F.concat(F.lit("p"), i.cast("string"), F.lit(":"), F.regexp_replace(x, r"\d", "0")))
    more = F.array(F.concat(F.lit("tld:"), F.coalesce(F.try_element_at(labels, F.lit(-1)), F.lit(""))), F.concat(F.lit("sub:"), F.coalesce(F.try_element_at(labels, F.lit(1)), F.lit(""))), F.concat(F.lit("depth:"), F.size(steps).cast("string")))
    return F.array_distinct(F.concat(F.transform(words, lambda x: F.concat(F.lit("h:"), x)), more, places))


def mine(labelled: DataFrame, items: str = "items", blocked: str = "blocked", min_pages: int = MIN_PAGES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, min_lift: float = MIN_LIFT) -> DataFrame:
    """Rules (rule_id, tokens, post, support, confidence) that say ``block``, from rows with an array of tokens and a flag.

    support: the share of labelled rows that have the tokens and are blocked; post: the rarest token, among equals the
    first by name.
    """
    spark = labelled.sparkSession
    baskets = labelled.where(F.col(blocked).isNotNull()).select(F.when(F.col(blocked), F.array_union(F.col(items), F.array(F.lit(_LABEL)))).otherwise(F.col(items)).alias("items"))
    n, bad = baskets.agg(F.count("*"), F.coalesce(F.sum(F.array_contains("items", _LABEL).cast("long")), F.lit(0))).first()
    least = max(min_pages, 1, min_support * n)
    if bad < least:
        return spark.createDataFrame([], "rule_id long, tokens array<string>, post string, support double, confidence double")
    with _io.steps(spark):
        # the smallest share that stands for ``least`` rows, whatever the rounding
        model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n, minConfidence=1.0).fit(baskets)
        sets = _io.written(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"), "itemsets")
        both = sets.where(F.array_contains("items", _LABEL) & (F.size("items") > 1) & (F.col("freq") >= least)).select(F.array_remove("items", _LABEL).alias("tokens"), F.col("freq").alias("hits"))
        rules = both.join(sets.select(F.col("items").alias("tokens"), F.col("freq").alias("pages")), "tokens").withColumn("confidence", F.col("hits") / F.col("pages"))
        rules = rules.where((F.col("confidence") >= min_confidence) & (F.col("confidence") >= F.lit(min_lift * bad / n)))
        one = sets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
        posted = rules.select("tokens", "hits", "confidence", F.explode("tokens").alias("token")).join(one, "token").groupBy("tokens").agg(F.min(F.struct("freq", "token")).alias("rarest"), F.first("hits").alias("hits"), F.first("confidence").alias("confidence"))
        return _io.result(posted.select(F.xxhash64("tokens").alias("rule_id"), "tokens", F.col("rarest.token").alias("post"), (F.col("hits") / F.lit(n)).alias("support"), "confidence"), "rules")


def judge(pages: DataFrame, labelled: DataFrame, id_col: str = "page_id", url: str = "url", rules=RULES, **how) -> DataFrame:
    """One row per row of pages: id_col, host, path, rule, verdict, and of the mined rule that matches best (by
    confidence, then support, then tokens) its tokens and confidence.

    ``labelled`` has id_col and ``blocked``; rows with a null flag are ignored and an id that comes twice is blocked if
    either row says so. The verdict is the fixed rule's; else block if a mined rule matches, else allow. A null url or
    one without ``://`` has an empty host and path. Nothing labelled: no mined rule. Repeated rows are judged alike, an
    empty table gives an empty one; other columns of pages are not returned, whatever their names. Among rules of equal
    confidence the one of more support matches, then the last by its tokens.
    """
    host, path = host_and_path(F.col(url))
    base = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("items", tokens(F.col("host"), F.col("path")))
    flags = labelled.where("blocked is not null").groupBy(F.col(id_col).alias("id")).agg(F.max("blocked").alias("blocked"))
    mined = mine(base.join(flags, "id").select("items", "blocked"), **how)
    few = mined.count() <= BROADCAST_RULES
    fixed = fixed_rule(F.col("host"), F.col("path"), rules)
    # each distinct host and path is looked up once, however many pages have it
    urls = base.groupBy("host", "path").agg(F.first("items").alias("items")).withColumn("token", F.explode("items"))
    index = mined.select(F.col("post").alias("token"), "tokens", "support", "confidence")
    hits = urls.join(F.broadcast(index) if few else index, "token").where(F.size(F.array_except("tokens", "items")) == 0)
    best = hits.groupBy("host", "path").agg(F.max(F.struct("confidence", "support", "tokens")).alias("best"))
    out = base.join(best, ["host", "path"], "left").withColumn("fixed", fixed)
    verdict = F.coalesce("fixed.verdict", F.when(F.col("best").isNotNull(), F.lit(BLOCK)), F.lit(ALLOW))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), F.col("best.tokens").alias("mined_tokens"), F.col("best.confidence").alias("mined_confidence"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: the rows of ``labels`` by number; toxic or low-quality ones are blocked."""
    labels = _io.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    out = judge(_io.table(spark, sf_dir, "pages"), labels)
    return out.withColumn("mined_tokens", F.when(F.col("mined_tokens").isNotNull(), F.concat_ws(" ", "mined_tokens")))
