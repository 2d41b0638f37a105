"""Deterministic samples. A row's place in its stratum follows a hash of (seed, id), so a seed always gives the same rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import contains_any

# Rows wanted of each category in a mixed sample of their sum.
MIXED_TARGETS = {"wall_colors": 8, "kitchens": 20, "sofas": 18, "tables": 14, "chairs": 10, "hallway": 10, "living_room_furniture": 14, "flooring": 12}


def draw(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def simple(pool: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """n rows, in order of key. The first n by hash: a distributed top-n."""
    return pool.orderBy(draw(key, seed), key).limit(max(0, n)).orderBy(key)


def _filled(ranked: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Of rows with ``chosen``: the chosen ones first, then others by hash, n in all."""
    return ranked.orderBy(F.desc("chosen"), draw(key, seed + 1), key).limit(max(0, n)).drop("chosen").orderBy(key)


def stratified(pool: DataFrame, strata: Column, n: int, seed: int, key: str = "id") -> DataFrame:
    """max(1, n // strata) rows of each stratum, filled up from the rest and cut to n."""
    own = pool.withColumn("_stratum", strata)
    count = max(1, own.select("_stratum").distinct().count())
    each = max(1, n // count)
    place = F.row_number().over(Window.partitionBy("_stratum").orderBy(draw(key, seed), key))
    return _filled(own.withColumn("chosen", place <= each).drop("_stratum"), n, seed, key)


def review_signal(notes: Column) -> Column:
    """Why a fact needs review, by its notes."""
    own = F.lower(F.coalesce(notes, F.lit("")))
    cases = (("bundle", ("bundle",)), ("non_target_room", ("non-target", "non target")), ("suspicious_descriptor", ("suspicious",)), ("context", ("lighting", "context")), ("multiple_items", ("several unrelated",)))
    out = F.lit("other")
    for name, parts in reversed(cases):
        out = F.when(contains_any(own, parts), name).otherwise(out)
    return out


def mixed(pool: DataFrame, n: int, seed: int, key: str = "id", category: str = "category", flag: str = "needs_review", targets: Mapping[str, int] = MIXED_TARGETS) -> DataFrame:
    """Targets scaled to n (half to even), half of each from flagged and half from clean rows, at least one of either;
    filled up from the rest and cut to n."""
    total = sum(targets.values())
    place = F.row_number().over(Window.partitionBy(category, flag).orderBy(draw(key, seed), key))
    wanted = {c: max(1, round(t * n / total)) for c, t in targets.items()}
    flagged = {c: max(1, t // 2) for c, t in wanted.items()}
    clean = {c: max(1, t - flagged[c]) for c, t in wanted.items()}
    pick = lambda m: F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in m.items() for x in kv)), F.col(category)), F.lit(0))
    return _filled(pool.withColumn("chosen", place <= F.when(F.col(flag), pick(flagged)).otherwise(pick(clean))), n, seed, key)


def select_sample(facts: DataFrame, source: str, n: int, seed: int, category: str | None = None, key: str = "id") -> DataFrame:
    """A sample of facts: ``category``, ``clean``, ``needs_review`` or ``mixed``."""
    if source == "mixed":
        return mixed(facts, n, seed, key)
    if source == "category":
        return simple(facts.where(F.col("category") == category), n, seed, key)
    if source not in ("clean", "needs_review"):
        raise ValueError(f"unknown source {source!r}")
    pool = facts.where(F.col("needs_review") if source == "needs_review" else ~F.col("needs_review"))
    pool = pool.where(F.col("category") == category) if category else pool
    strata = F.concat_ws("|", "category", review_signal(F.col("notes"))) if source == "needs_review" else F.col("category")
    return stratified(pool, strata, n, seed, key)


__all__ = ["MIXED_TARGETS", "draw", "mixed", "review_signal", "rules", "select_sample", "simple", "stratified"]
