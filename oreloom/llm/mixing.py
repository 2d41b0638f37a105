"""Mixing sources to target weights by iterative proportional fitting. DataFrame operations only.

Documents are summed to cells of (source, language, topic); only cells are raked. One round scales the cells to each
marginal in turn; a cell's multiplier is its raked weight over its own tokens. A document is drawn by a hash of its id,
so a draw is repeatable and needs no state.

No document can be drawn more than once, so a cell gives at most its tokens. mix() rakes within these bounds: cells that
are taken whole stay so and the others make up for them. A value with fewer tokens than its share of the drawn tokens is
taken whole, and the values beside it share the rest by their targets; achieved() says which values these are. The query
op7_mix_sources keeps to its SQL, which rakes without bounds and cuts at 1: min(1, rate * multiplier).

Targets of a marginal are shares by value; values without a share get none. Without explicit shares they are the
observed token shares to the power ``alpha``, which lifts small values and damps large ones. Shares are made to sum to
one over the values that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io

ROUNDS, RATE, ALPHA, SEED = 8, 0.5, 0.5, "mix"
#: Languages of the production mix; None: tempered by ALPHA.
LANG_SHARES = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
TARGETS: dict[str, dict[str, float] | None] = {"source": None, "lang": LANG_SHARES, "topic": None}
#: Cells up to this number are broadcast to the scan of the documents; beyond it the join shuffles.
BROADCAST_CELLS = 100_000


def word_count(text: Column) -> Column:
    """Space-separated tokens; 0 for a null or empty text."""
    text = F.coalesce(text, F.lit(""))
    return F.when(text == "", F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit(" "))) + 1).cast("long")


def layout_topic(text: Column) -> Column:
    """A topic by layout: table, note (under 50 tokens), lines (a line end in 40 tokens or more often), prose."""
    text, words = F.coalesce(text, F.lit("")), word_count(text)
    ends = F.length(text) - F.length(F.replace(text, F.lit("\n")))
    return F.when(F.contains(text, F.lit(" | ")), "table").when(words < 50, "note").when(ends * 40 >= words, "lines").otherwise("prose")


def _keyed(docs: DataFrame, source: str, lang: str, text: str, topic: Column | None) -> DataFrame:
    """docs with _source, _lang, _topic and _tokens (nulls become empty strings)."""
    own = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kind = layout_topic(F.col(text)) if topic is None else topic
    return docs.withColumns({"_source": own(F.col(source)), "_lang": own(F.col(lang)), "_topic": own(kind), "_tokens": word_count(F.col(text))})


def _wish(dim: str, shares: dict[str, float] | None, alpha: float) -> Column:
    """The wish of a value of dim with ``t`` tokens, before wishes are made to sum to one."""
    if shares is None:
        return F.pow("t", F.lit(alpha))
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in shares.items() for x in kv)), F.col(dim)), F.lit(0.0)) if shares else F.lit(0.0)


def rake(cells: DataFrame, targets: dict[str, dict[str, float] | None], rounds: int = ROUNDS, alpha: float = ALPHA) -> DataFrame:
    """cells (one column for each target, and tokens > 0) with ``weight``, raked to the targets; the weights sum to the tokens."""
    spark = cells.sparkSession
    total = F.lit(cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0)
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, shares in targets.items():  # every cell carries the goals of its values
        seen = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t")).select(dim, _wish(dim, shares, alpha).alias("wish"))
        every = F.lit(seen.agg(F.sum("wish")).first()[0] or 0.0)
        now = now.join(seen.select(dim, F.when(every > 0, total * F.col("wish") / every).otherwise(F.lit(0.0)).alias(f"goal{dim}")), dim)
    now = _io.written(now.coalesce(_few(spark)), "cells")
    for _ in range(rounds):
        for dim in targets:
            have = now.groupBy(dim).agg(F.sum("weight").alias("have"))
            now = now.join(have, dim).withColumn("weight", F.when(F.col("have") > 0, F.col("weight") * (F.col(f"goal{dim}") / F.col("have"))).otherwise(F.lit(0.0))).drop("have")
        now = _io.written(now.coalesce(_few(spark)), "cells")
    return now.drop(*(f"goal{dim}" for dim in targets))


def _level(values: DataFrame, asked: float) -> float:
    """The level at which values with ``wish`` and ``room`` that give min(room, level * wish) give ``asked`` in all."""
    level = 0.0
    while True:
        full = F.col("room") <= F.lit(level) * F.col("wish")
        taken, rest = values.agg(F.sum(F.when(full, F.col("room"))), F.sum(F.when(~full, F.col("wish")))).first()
        higher = (asked - (taken or 0.0)) / rest if rest else level
        if higher <= level * (1 + 1e-12):
            return level
        level = higher


def rake_within(cells: DataFrame, targets: dict[str, dict[str, float] | None], rate: float = RATE, rounds: int = ROUNDS, alpha: float = ALPHA) -> DataFrame:
    """cells (as for rake()) with ``weight`` of at most their tokens, raked to the targets; the weights sum to rate times
    the tokens, or to all that cells of wished values have if that is less. Cells of a value that is not wished go."""
    spark = cells.sparkSession
    now = cells.withColumn("tokens", F.col("tokens").cast("double"))
    for dim, shares in targets.items():
        seen = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("t"))
        now = now.join(seen.select(dim, _wish(dim, shares, alpha).alias(f"wish{dim}")), dim)
    every = now.agg(F.sum("tokens")).first()[0] or 0.0
    now = _io.written(now.where(" and ".join(f"`wish{dim}` > 0" for dim in targets)).coalesce(_few(spark)), "cells")
    asked = min(rate * every, now.agg(F.sum("tokens")).first()[0] or 0.0)
    open_cells = now
    for dim in targets:  # every cell carries the goals of its values, which they have the tokens for
        values = open_cells.groupBy(dim).agg(F.sum("tokens").alias("room"), F.max(f"wish{dim}").alias("wish"))
        now = now.join(values.select(dim, F.least("room", F.lit(_level(values, asked)) * F.col("wish")).alias(f"goal{dim}")), dim)
    # the wanted weight of a cell may be beyond its tokens: only multipliers of its values change it
    now = _io.written(now.drop(*(f"wish{dim}" for dim in targets)).withColumn("want", F.col("tokens") * F.lit(float(rate))).coalesce(_few(spark)), "cells")
    for _ in range(rounds):
        for dim in targets:
            whole = F.col("want") >= F.col("tokens")
            have = now.groupBy(dim).agg(F.sum(F.when(whole, F.col("tokens")).otherwise(F.lit(0.0))).alias("whole"), F.sum(F.when(whole, F.lit(0.0)).otherwise(F.col("want"))).alias("free"))
            goal, given = F.col(f"goal{dim}"), F.col("whole") + F.col("free")
            by = F.when((F.col("free") > 0) & (given < goal), (goal - F.col("whole")) / F.col("free")).otherwise(goal / given)
            now = now.join(have, dim).withColumn("want", F.least(F.col("want") * by, F.col("tokens") * F.lit(1e12))).drop("whole", "free")
        now = _io.written(now.coalesce(_few(spark)), "cells")
    return now.withColumn("weight", F.least("want", "tokens")).drop("want", *(f"goal{dim}" for dim in targets))


def _few(spark: SparkSession) -> int:
    return max(1, _io.parallelism(spark) // 4)


def draw(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) by hash of an id (null: as the string ``null``)."""
    text = F.concat(F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


NAMES = {"source": "_source", "lang": "_lang", "topic": "_topic"}


def _wanted(targets) -> dict[str, dict[str, float] | None]:
    return {NAMES[k]: v for k, v in (targets or TARGETS).items()}


def with_probability(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None, targets=None, rounds: int = ROUNDS, rate: float = RATE, alpha: float = ALPHA, seed: str = SEED, clipped: bool = False) -> DataFrame:
    """docs with _source, _lang, _topic, _tokens, _probability and _kept.

    ``clipped``: probabilities of a raking without bounds, cut at 1, which miss targets where cells are cut. Documents
    without tokens have probability 0. A null source, language or topic is the value "". Repeated rows are drawn alike. An
    empty table gives an empty table. Columns of docs with these six names are replaced; mix() returns docs as it is.
    """
    spark = docs.sparkSession
    names, wanted = NAMES, _wanted(targets)
    clash = {*names.values(), "_tokens", "_probability", "_kept"}
    keyed = _keyed(docs.select(*(docs[f"`{c}`"] for c in docs.columns if c.lower() not in clash)), source, lang, text, topic)
    with _io.steps(spark):
        cells = _io.written(keyed.where("_tokens > 0").groupBy(*names.values()).agg(F.sum("_tokens").alias("tokens")), "cells")
        if clipped:
            raked = rake(cells, wanted, rounds, alpha).select(*names.values(), F.least(F.lit(1.0), F.lit(rate) * F.col("weight") / F.col("tokens")).alias("_probability"))
        else:
            raked = rake_within(cells, wanted, rate, rounds, alpha).select(*names.values(), (F.col("weight") / F.col("tokens")).alias("_probability"))
        raked = _io.result(raked.coalesce(_few(spark)), "probabilities")
    few = raked.count() <= BROADCAST_CELLS
    out = keyed.join(F.broadcast(raked) if few else raked, list(names.values()), "left")
    out = out.withColumn("_probability", F.when(F.col("_tokens") > 0, F.coalesce("_probability", F.lit(0.0))).otherwise(F.lit(0.0)))
    return out.withColumn("_kept", draw(F.col(id_col), seed) < F.col("_probability"))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", topic: Column | None = None, **how) -> DataFrame:
    """The drawn rows of docs, with their own columns as they are."""
    inputs = {"id": docs[f"`{id_col}`"], "text": docs[f"`{text}`"], "source": docs[f"`{source}`"], "lang": docs[f"`{lang}`"]}
    own = _io.packed(docs, **inputs, **({} if topic is None else {"topic": topic}))
    return with_probability(own, "id", topic=None if topic is None else F.col("topic"), **how).where("_kept").select("row.*")


def achieved(drawn: DataFrame, targets=None, rate: float = RATE, alpha: float = ALPHA) -> DataFrame:
    """One row a value of source, lang and topic of a table of with_probability(): its tokens, and of all drawn tokens its
    target, expected and drawn share; ``feasible`` is false if it has fewer tokens than its target asks."""
    own = drawn.where("_tokens > 0")
    p = F.col("_probability")
    cells = _io.written(own.groupBy(*NAMES.values()).agg(F.sum("_tokens").cast("double").alias("tokens"), F.sum(F.when(p > 0, F.col("_tokens")).otherwise(F.lit(0))).cast("double").alias("room"), F.sum(F.col("_tokens") * p).alias("expected"), F.sum(F.when(F.col("_kept"), F.col("_tokens")).otherwise(F.lit(0))).cast("double").alias("drawn")), "cells")
    sums = cells.agg(*(F.sum(c) for c in ("tokens", "room", "expected", "drawn"))).first()
    tokens, room, expected, kept = (x or 0.0 for x in sums)
    share = lambda c, n: (F.col(c) / F.lit(n) if n else F.lit(0.0)).alias(c)
    out = None
    for name, dim in NAMES.items():
        shares = (targets or TARGETS).get(name)
        values = cells.groupBy(dim).agg(*(F.sum(c).alias(c) for c in ("tokens", "room", "expected", "drawn"))).withColumn("t", F.col("tokens")).withColumn("wish", _wish(dim, shares, alpha))
        every = values.agg(F.sum("wish")).first()[0] or 0.0
        target = F.col("wish") / F.lit(every) if every else F.lit(0.0)
        one = values.select(F.lit(name).alias("dimension"), F.col(dim).alias("value"), F.col("tokens").cast("long").alias("tokens"), target.alias("target"), share("expected", expected), share("drawn", kept), (target * F.lit(min(rate * tokens, room)) <= F.col("room") * F.lit(1 + 1e-9)).alias("feasible"))
        out = one if out is None else out.union(one)
    return out


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_probability(_io.table(spark, sf_dir, "documents"), clipped=True)  # as its SQL says
    return out.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.round("_probability", 6).alias("probability"), F.col("_kept").alias("kept"))


def oracle(table: str = "documents", rounds: int = ROUNDS, rate: float = RATE) -> str:
    """DuckDB SQL for op7_mix_sources: the rounds written out as common table expressions."""
    wish = {"source": f"pow(sum(tokens), {ALPHA})", "topic": f"pow(sum(tokens), {ALPHA})", "lang": "CASE lang " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_SHARES.items()) + " ELSE 0 END"}
    parts = [
        f"""docs AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(text, '') AS text,
    CASE WHEN coalesce(text, '') = '' THEN 0 ELSE length(text) - length(replace(text, ' ', '')) + 1 END AS n_tokens FROM {table}
)""",
        """keyed AS (
  SELECT doc_id, source, lang, n_tokens,
    CASE WHEN contains(text, ' | ') THEN 'table' WHEN n_tokens < 50 THEN 'note' WHEN (length(text) - length(replace(text, chr(10), ''))) * 40 >= n_tokens THEN 'lines' ELSE 'prose' END AS topic FROM docs
)""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM keyed WHERE n_tokens > 0 GROUP BY ALL)",
    ]
    for dim in ("source", "lang", "topic"):
        parts.append(f"goal_{dim} AS MATERIALIZED (SELECT {dim}, (SELECT sum(tokens) FROM cells) * wish / sum(wish) OVER () AS goal FROM (SELECT {dim}, CAST({wish[dim]} AS DOUBLE) AS wish FROM cells GROUP BY {dim}))")
    parts.append("w0 AS MATERIALIZED (SELECT *, tokens AS weight FROM cells)")
    k = 0
    for _ in range(rounds):
        for dim in ("source", "lang", "topic"):
            parts.append(f"w{k + 1} AS MATERIALIZED (SELECT w.* REPLACE (CASE WHEN sum(weight) OVER (PARTITION BY w.{dim}) > 0 THEN weight * goal / sum(weight) OVER (PARTITION BY w.{dim}) ELSE 0 END AS weight) FROM w{k} w JOIN goal_{dim} g ON w.{dim} = g.{dim})")
            k += 1
    u = f"CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{SEED}'), 1, 8) AS BIGINT) / 4294967296.0"
    return f"""WITH {", ".join(parts)}
SELECT doc_id, k.source, k.lang, k.topic, CAST(n_tokens AS BIGINT) AS n_tokens, round(p, 6) AS probability, {u} < p AS kept
FROM (SELECT k.*, CASE WHEN n_tokens > 0 THEN least(1.0, {rate} * weight / tokens) ELSE 0.0 END AS p FROM keyed k LEFT JOIN w{k} w ON k.source = w.source AND k.lang = w.lang AND k.topic = w.topic) k"""


ORACLE = oracle()
