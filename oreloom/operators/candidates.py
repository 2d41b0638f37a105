"""Candidate mining: posts scored against category rules, and the best ones of each category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import compact, excerpt, has, keyword_pattern, match_form, match_form_of, matched_names
from ..rules import Category


def _form(pattern: str) -> str:
    return pattern.lower().replace("ё", "е")


def article_terms(form: Column, owner: str = "", terms=rules.ARTICLE_TERMS, patterns=rules.ARTICLE_PATTERNS) -> Column:
    """Names of the article terms and patterns in a text in match form. ``owner``: the owner's promo code."""
    own = (*terms, *([f"промокод {owner}"] if owner else []))
    return F.array_distinct(matched_names(form, [*((t, keyword_pattern(t)) for t in own), *((p, _form(p)) for p in patterns)], own))


def scored(category: Category, form: Column, is_article: Column, photos: Column) -> Column:
    """Struct (category, score, rank, strong, weak, patterns, negative, capped) of one category; null without a match.

    The score adds terms and patterns, the article and photo bonus, less the negative patterns. Order of tests:
    suppression, score above zero, confidence by score, cap.
    """
    strong = matched_names(form, [(t, keyword_pattern(t)) for t in category.strong], category.strong)
    weak = matched_names(form, [(t, keyword_pattern(t)) for t in category.weak], category.weak)
    patterns = matched_names(form, [(p, _form(p)) for p in category.patterns])
    negative = matched_names(form, [(p, _form(p)) for p in category.negative])
    return _assemble(category, form, is_article, photos, strong, weak, patterns, negative)


def _assemble(category, form, is_article, photos, strong, weak, patterns, negative) -> Column:
    score = F.size(strong) * rules.STRONG + F.size(patterns) * rules.PATTERN + F.size(weak) * rules.WEAK
    score = score + F.when(is_article, rules.ARTICLE_BONUS).otherwise(0) + F.when(photos > 0, rules.PHOTO_BONUS).otherwise(0) + F.size(negative) * rules.NEGATIVE
    lone_weak = (F.size(strong) == 0) & (F.size(patterns) == 0) & (F.size(F.array_except(weak, F.array(*map(F.lit, category.lone_weak)).cast("array<string>"))) == 0) if category.lone_weak else F.lit(False)
    lone_strong = (F.size(F.array_except(strong, F.array(*map(F.lit, category.lone_strong)))) == 0) & (F.size(patterns) == 0) & has(form, f"(?iU){category.context}") if category.lone_strong else F.lit(False)
    capped = (F.lit(False) if category.suppress_lone else lone_weak) | lone_strong
    rank = F.when(capped, 0).when(score >= rules.HIGH_SCORE, 2).when(score >= rules.MEDIUM_SCORE, 1).otherwise(0)
    matched = (F.size(strong) + F.size(weak) + F.size(patterns)) > 0
    kept = matched & (score > 0) & (form != "") & (~lone_weak if category.suppress_lone else F.lit(True))
    return F.when(kept, F.struct(F.lit(category.name).alias("category"), score.alias("score"), rank.alias("rank"), strong.alias("strong"), weak.alias("weak"), patterns.alias("patterns"), negative.alias("negative"), capped.alias("capped")))


def score_posts(posts: DataFrame, categories: tuple[Category, ...] = rules.CATEGORIES, text: str = "text", photos: Column | None = None, owner: str = "", article_terms_of=rules.ARTICLE_TERMS, article_patterns=rules.ARTICLE_PATTERNS) -> DataFrame:
    """One row for each post and category that it matches: posts' columns, is_article, article_score, article_terms,
    and the fields of scored(). The rules are unrolled into one projection and exploded: no join, no shuffle.
    """
    base = posts.withColumn("_form", match_form(F.coalesce(F.col(text), F.lit(""))))
    base = base.withColumn("article_terms", article_terms(F.col("_form"), owner, article_terms_of, article_patterns)).withColumn("is_article", F.size("article_terms") > 0).withColumn("article_score", F.size("article_terms") * 2)
    # each list of terms is computed once per row; the score reads the lists
    lists = {}
    for c in categories:
        for kind, named in (("strong", [(t, keyword_pattern(t)) for t in c.strong]), ("weak", [(t, keyword_pattern(t)) for t in c.weak]), ("patterns", [(p, _form(p)) for p in c.patterns]), ("negative", [(p, _form(p)) for p in c.negative])):
            lists[f"_{c.name}_{kind}"] = matched_names(F.col("_form"), named, (*c.strong, *c.weak) if kind in ("strong", "weak") else ())
    base = base.withColumns(lists)
    own = [_assemble(c, F.col("_form"), F.col("is_article"), F.lit(0) if photos is None else photos, *(F.col(f"_{c.name}_{k}") for k in ("strong", "weak", "patterns", "negative"))) for c in categories]
    hits = base.withColumn("_hit", F.explode(F.filter(F.array(*own), lambda x: x.isNotNull())))
    return hits.select(*posts.columns, "article_terms", "is_article", "article_score", "_hit.*")


def best_candidates(hits: DataFrame, per_category: int = 100, min_score: int = 2, with_low: bool = False, key: str = "message_id", date: str = "date") -> DataFrame:
    """The first ``per_category`` rows of each category: by confidence, article, score, date, id, all descending."""
    kept = hits.where(F.col("score") >= min_score)
    kept = kept if with_low else kept.where("rank > 0")
    order = [F.desc("rank"), F.desc("is_article"), F.desc("score"), F.coalesce(F.col(date), F.lit("")).desc(), F.col(key).desc()]
    return kept.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(*order))).where(F.col("place") <= per_category)


def with_excerpt(hits: DataFrame, categories: tuple[Category, ...] = rules.CATEGORIES, text: str = "text", width: int = 500) -> DataFrame:
    """hits with the excerpt around the first matched term or pattern of their category."""
    out = F.lit(None).cast("string")
    for c in categories:
        own = excerpt(F.col(text), (*c.strong, *c.weak), tuple(map(_form, c.patterns)), F.concat("strong", "weak", F.transform("patterns", lambda x: F.translate(F.lower(x), "ё", "е"))), width)
        out = F.when(F.col("category") == c.name, own).otherwise(out)
    return hits.withColumn("excerpt", out)


def article_posts(posts: DataFrame, min_score: int = 2, text: str = "text", owner: str = "", key: str = "message_id", date: str = "date") -> DataFrame:
    """Posts with article terms: by score, date, id, all descending."""
    own = posts.withColumn("article_terms", article_terms(match_form(F.coalesce(F.col(text), F.lit(""))), owner)).withColumn("article_score", F.size("article_terms") * 2)
    return own.where((F.size("article_terms") > 0) & (F.col("article_score") >= min_score)).orderBy(F.desc("article_score"), F.coalesce(F.col(date), F.lit("")).desc(), F.col(key).desc())


def summary(hits: DataFrame, photos: Column | None = None) -> DataFrame:
    """By category: rows of each confidence, with photos, in articles, and all."""
    n = lambda c: F.count_if(c)
    return hits.groupBy("category").agg(n(F.col("rank") == 2).alias("high"), n(F.col("rank") == 1).alias("medium"), n(F.col("rank") == 0).alias("low"), n(F.lit(False) if photos is None else photos > 0).alias("with_photo"), n(F.col("is_article")).alias("in_articles"), F.count("*").alias("total"))


def top_terms(hits: DataFrame, n: int = 12) -> DataFrame:
    """The n commonest matched terms and patterns of each category; ties by name."""
    terms = hits.select("category", F.explode(F.concat("strong", "weak", "patterns")).alias("term")).groupBy("category", "term").agg(F.count("*").alias("n"))
    return terms.withColumn("place", F.row_number().over(Window.partitionBy("category").orderBy(F.desc("n"), "term"))).where(F.col("place") <= n)


def posts_with_photos(messages: DataFrame, media: DataFrame, first: int = 3) -> DataFrame:
    """Messages with text, photo_count and the paths of their first photos, by media id."""
    photo = media.where("media_kind = 'photo'").groupBy("message_id").agg(F.count("*").alias("photo_count"), F.slice(F.transform(F.array_sort(F.collect_list(F.struct("id", "absolute_path"))), lambda x: x["absolute_path"]), 1, first).alias("photo_paths"))
    own = messages.where(F.trim(F.coalesce("text_plain", F.lit(""))) != "").select("message_id", "date", F.col("text_plain").alias("text"))
    return own.join(photo, "message_id", "left").withColumns({"photo_count": F.coalesce("photo_count", F.lit(0)), "photo_paths": F.coalesce("photo_paths", F.array().cast("array<string>"))})


__all__ = ["article_posts", "article_terms", "best_candidates", "compact", "match_form_of", "posts_with_photos", "score_posts", "scored", "summary", "top_terms", "with_excerpt"]
