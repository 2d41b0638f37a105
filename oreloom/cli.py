"""Command line: each stage reads and writes tables in folders. Exit codes: 0 done, 2 bad input, 3 provider unreachable."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rules, sinks
from .functions.text import post_url
from .operators import candidates, canonical, effective, facts, links, mentions, projects, rankings, reporting, review, sampling
from .sources import archive

KITCHEN = "kitchens"
CONTEXT = ("wall_colors", "flooring")


def _photos(media: DataFrame) -> DataFrame:
    return media.where("media_kind = 'photo'").select("message_id", F.col("id").alias("photo_no"), F.col("absolute_path").alias("path"))


def audit(spark: SparkSession, a) -> dict:
    own = canonical.ingest(spark, a.root, hashes=False)
    inventory = archive.file_inventory(spark, a.root)
    rows = archive.read_exports(spark, a.root)
    sections = {"Exports": own.exports, "Rejected": own.rejects, "Extensions": canonical.extension_profile(inventory), "Keys": canonical.key_histogram(rows), "Message ids": canonical.id_profile(rows)}
    sinks.write_report(spark, f"{a.out}/audit.md", "Archive audit", sections)
    return {"exports": own.exports.count(), "rejected": own.rejects.count()}


def ingest(spark: SparkSession, a) -> dict:
    own = canonical.ingest(spark, a.root)
    variants = own.variants.select("message_id", "json_path", "raw_json", F.col("text_plain").alias("text"), F.col("f_photo").alias("photo_value"), F.col("f_file").alias("file_value"), "has_real_media")
    sinks.write_tables({"exports": own.exports, "messages": own.messages, "variants": variants, "media": own.media, "tokens": sinks.token_postings(own.messages, "message_id", "text_plain")}, a.out)
    return {"messages": spark.read.parquet(f"{a.out}/messages").count(), "media": spark.read.parquet(f"{a.out}/media").count()}


def _tables(spark: SparkSession, a, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{a.db}/{n}") for n in names]


def stats(spark: SparkSession, a) -> dict:
    messages, variants, media = _tables(spark, a, "messages", "variants", "media")
    out = canonical.statistics(messages, variants, media).first().asDict()
    return out | {"extensions": [tuple(r) for r in canonical.top_extensions(media).collect()]}


def sample(spark: SparkSession, a) -> dict:
    messages, media, variants = _tables(spark, a, "messages", "media", "variants")
    own = canonical.sample_posts(messages, media, variants, a.limit)
    sinks.write_report(spark, f"{a.out}/sample.md", "Sample posts", {"Posts": own}, a.limit)
    return {"posts": a.limit}


def mine(spark: SparkSession, a) -> dict:
    messages, media = _tables(spark, a, "messages", "media")
    posts = candidates.posts_with_photos(messages, media)
    hits = candidates.score_posts(posts, photos=F.col("photo_count"), owner=a.owner)
    best = candidates.with_excerpt(candidates.best_candidates(hits, a.limit, a.min_score, a.include_low))
    for kind, write in (("csv", sinks.write_csv), ("jsonl", sinks.write_jsonl)):
        if kind in a.format:
            write(best, f"{a.out}/candidates_{kind}", ("category",))
    if "markdown" in a.format:
        sinks.write_report(spark, f"{a.out}/candidates.md", "Candidates", {"Summary": candidates.summary(hits, F.col("photo_count")), "Terms": candidates.top_terms(hits), "Best": best.drop("text")}, 200)
    sinks.write_jsonl(candidates.article_posts(posts, a.min_score, owner=a.owner), f"{a.out}/article_posts")
    return {"candidates": best.count()}


def extract(spark: SparkSession, a) -> dict:
    messages, media = _tables(spark, a, "messages", "media")
    posts = candidates.posts_with_photos(messages, media)
    posts = facts.source_posts(posts, a.source, a.min_article_score, a.limit, a.owner).withColumn("first_photo_path", F.get("photo_paths", F.lit(0)))
    own = facts.with_ids(facts.deduplicate_facts(facts.extract_facts(posts, a.owner))).drop("ord")
    sinks.write_facts(own, a.out)
    written = sinks.read_facts(spark, a.out)
    for folder, rows in (("all", written), ("clean", written.where("not needs_review")), ("needs_review", written.where("needs_review"))):
        for c in rules.STRICT:
            columns = ("id", "date", "item_type", "vendor_normalized", "model", "material", "color", "color_code", "price_value", "confidence", "notes", "evidence_quote")
            sinks.write_markdown(spark, f"{a.out}/categories/{folder}/{c}.md", f"{c}: {folder}", {"Facts": rows.where(F.col("category") == c).orderBy("id").select(*columns)}, 200, f"facts_csv, category {c}")
    sinks.write_report(spark, f"{a.out}/facts.md", "Facts", {"Categories": reporting.fact_summary(written), "Values": reporting.top_values(written), "Reasons for review": reporting.review_signals(written)}, 2000)
    return {"facts": written.count(), "clean": written.where("not needs_review").count()}


def model_review(spark: SparkSession, a) -> dict:
    (messages,) = _tables(spark, a, "messages")
    own = sinks.read_facts(spark, a.facts)
    chosen = sampling.select_sample(own, a.source, a.sample_size, a.seed, a.category)
    planned = review.plan(chosen, messages.select("message_id", F.col("text_plain").alias("text")), a.excerpt_chars)
    if a.resume:
        planned = review.pending(planned, spark.read.parquet(f"{a.out}/reviews"), a.provider, a.model)
    if a.dry_run:
        sinks.write_csv(planned, f"{a.out}/planned")
        return {"planned": planned.count()}
    handler = review.mock_handler if a.provider == "mock" else review.http_handler(a.base_url, a.model, a.timeout)
    if a.provider != "mock":
        try:
            review.probe(a.base_url)
        except OSError as e:
            raise ConnectionError(str(e)) from e
    review.run(planned, handler, a.provider, a.model, a.strict_json).write.mode("append" if a.resume else "overwrite").parquet(f"{a.out}/reviews")
    done = spark.read.parquet(f"{a.out}/reviews")
    latest = review.latest(done)
    sinks.write_report(spark, f"{a.out}/reviews.md", "Reviews", {"Decisions": review.summary(done), "Categories": review.by_category(latest, own), "Corrected fields": review.corrected_fields(latest)})
    sinks.write_csv(done, f"{a.out}/reviews_csv")
    sinks.write_jsonl(done, f"{a.out}/reviews_jsonl")
    rows = latest.join(own.select(F.col("id").alias("fact_id"), "category", "item_type", "evidence_quote"), "fact_id").select("fact_id", "category", "item_type", "decision", "rationale_short", "evidence_quote")
    for name, values in (("decision", review.DECISIONS), ("category", rules.STRICT)):
        for v in values:
            sinks.write_markdown(spark, f"{a.out}/by_{name}/{v}.md", v, {"Reviews": rows.where(F.col(name) == v).orderBy("fact_id")}, 200, "reviews_csv")
    sinks.write_text(spark, f"{a.out}/prompt_templates/system.txt", review.SYSTEM_PROMPT)
    sinks.write_text(spark, f"{a.out}/prompt_templates/user.txt", review.USER_PROMPT)
    return {"reviews": done.count()}


def report(spark: SparkSession, a) -> dict:
    own = sinks.read_facts(spark, a.facts)
    reviews = review.latest(*(spark.read.parquet(f"{p}/reviews") for p in a.reviews)) if a.reviews else spark.createDataFrame([], f"fact_id long, {review.PAYLOAD}")
    payload = [c.split()[0] for c in review.PAYLOAD.replace("struct<", "").split(", ") if " " in c]
    dataset = effective.build(own, reviews.select("fact_id", *[c for c in payload if c in reviews.columns]), a.min_confidence, not a.lenient, a.include_low)
    sinks.write_tables({"dataset": dataset}, a.out)
    dataset = spark.read.parquet(f"{a.out}/dataset")
    used = effective.used(dataset)
    sinks.write_csv(used, f"{a.out}/used_csv")
    sinks.write_csv(dataset.where("exclusion_reason is not null"), f"{a.out}/excluded_csv")
    counters, reliable = effective.counters(dataset), reporting.reliability(dataset)
    sections = reporting.value_sections(used, a.top)
    sinks.write_report(spark, f"{a.out}/report.md", "Facts in use", {"Counters": counters, "Reliability": reliable} | sections | {"To review by hand": reporting.to_review(dataset)}, 1000)
    for c in rules.STRICT:
        sinks.write_markdown(spark, f"{a.out}/category_sections/{c}.md", c, reporting.category_sections(used, c, a.top), 1000, "used_csv")
    short = {"Values": reporting.display_counts(reporting.kept_in_sections(used), 5).orderBy("e_category", "place"), "Wood and neutral": sections["Wood and neutral"], "Suppliers": sections["Suppliers"].select("e_vendor", "facts", "categories")}
    sinks.write_markdown(spark, f"{a.out}/report_short.md", "In short", short, 200, "report_tables")
    sinks.write_markdown(spark, f"{a.out}/report_summary.md", "Summary", {"Reliability": reliable, "Counters": counters}, 200, "report_tables")
    sinks.write_markdown(spark, f"{a.out}/quality_notes.md", "Quality notes", {"Not shown": sections["Not shown"], "To review by hand": reporting.to_review(dataset)}, 1000, "report_tables")
    return {"used": used.count()}


def palette(spark: SparkSession, a) -> dict:
    messages, media = _tables(spark, a, "messages", "media")
    own = sinks.read_facts(spark, a.facts)
    out = projects.palette_report(own.where(F.col("category") == KITCHEN), own.where(F.col("category").isin(*CONTEXT)), messages, _photos(media), a.channel, a.designer, a.examples)
    sinks.write_tables({"projects": out}, a.out)
    out = spark.read.parquet(f"{a.out}/projects")
    sinks.write_csv(out, f"{a.out}/projects_csv")
    sinks.write_csv(out.where("selected"), f"{a.out}/selected_csv")
    sinks.write_jsonl(out, f"{a.out}/projects_jsonl")
    todo = out.select("project_id", F.array_join(F.transform("source_ids", lambda x: x.cast("string")), ";").alias("source_ids"), post_url(a.channel, F.col("project_id")).alias("candidate_url"), F.lit("to check").alias("status"))
    sinks.write_csv(todo, f"{a.out}/link_todo_csv")
    copies = sinks.copy_photos(out.where("selected"), f"{a.out}/photos")
    sheet = sinks.contact_sheet([f.removeprefix("file://") for p, files in sorted(copies.items()) for f in files], f"{a.out}/contact_sheet.jpg")
    listed = "\n".join(f"* {p}: {', '.join(files)}" for p, files in sorted(copies.items())) or "none"
    sinks.write_report(spark, f"{a.out}/palettes.md", "Palettes", {"Selected": out.where("selected"), "Photos": listed, "Contact sheet": "contact_sheet.jpg" if sheet else "none", "Excluded": out.where("not selected").groupBy("exclusion_reason").count().orderBy(F.desc("count"), "exclusion_reason")})
    families = out.where("selected and palette = 'wood_neutral'").groupBy(rankings.wood_subfamily(F.concat_ws(" ", "facade", "countertop", "backsplash")).alias("family")).count().orderBy(F.desc("count"), "family")
    short = out.where("selected").select("palette", "project_id", "object.name", "summary_clean").orderBy("palette", "project_id")
    sinks.write_markdown(spark, f"{a.out}/palettes_short.md", "Palettes in short", {"Selected": short, "Wood and neutral": families}, 100, "projects_csv")
    tiers = out.groupBy("palette", "quality_tier").count().orderBy("palette", "quality_tier")
    sinks.write_markdown(spark, f"{a.out}/quality_notes.md", "Quality notes", {"Tiers": tiers, "Excluded": out.where("not selected").groupBy("exclusion_reason", "quality_tier").count().orderBy("exclusion_reason", "quality_tier")}, 200, "projects_csv")
    return {"projects": out.count()}


def index(spark: SparkSession, a) -> dict:
    """Entities, project links, mentions and rankings: the index and its reports."""
    messages, media, variants = _tables(spark, a, "messages", "media", "variants")
    own = sinks.read_facts(spark, a.facts)
    entities = links.extract_entities(messages, variants)
    built = projects.build_projects(own.where(F.col("category") == KITCHEN), own.where(F.col("category").isin(*CONTEXT)), messages, _photos(media), a.channel)
    found = links.link_projects(messages, entities, a.channel, links.source_to_project(built), links.project_names(own))
    sinks.write_tables({"entities": entities, "project_links": found}, a.out)
    entities, found = spark.read.parquet(f"{a.out}/entities"), spark.read.parquet(f"{a.out}/project_links")
    tables: dict[str, DataFrame] = {}
    if a.what in ("all", "paints"):
        tables["paints"] = mentions.paint_mentions(messages, found)
    if a.what in ("all", "appliances"):
        tables["appliances"] = mentions.appliance_mentions(messages, entities, found)
    if a.what in ("all", "makers"):
        tables["makers"] = mentions.maker_mentions(messages, entities, found)
    sinks.write_tables(tables, a.out)
    written = {n: spark.read.parquet(f"{a.out}/{n}") for n in tables}
    sections: dict[str, DataFrame | str] = {}
    if "paints" in written:
        sections |= {"Paints": rankings.rank_paints(written["paints"], rankings.raw_code_counts(own)), "Shades": rankings.rank_shades(written["paints"])}
    if "appliances" in written:
        sections |= {"Merchants": rankings.merchant_counts(written["appliances"]), "Appliances": written["appliances"].groupBy("appliance_type", "evidence_class").count()}
    if "makers" in written:
        sections["Makers"] = rankings.makers(written["makers"])
    reports = {"paints": ("Paints", "Shades"), "appliances": ("Merchants", "Appliances"), "makers": ("Makers",)}
    order = {"paints": ("message_id", "start"), "appliances": ("message_id",), "makers": ("classification", "maker_name", "message_id")}
    for n, t in written.items():
        sinks.write_csv(t.orderBy(*order[n]), f"{a.out}/{n}_csv")
        sinks.write_markdown(spark, f"{a.out}/{n}.md", n.capitalize(), {s: sections[s] for s in reports[n]}, 1000, "index_tables")
    if "paints" in written:
        kitchens = rankings.kitchen_paints(built.select("project_id", "date", F.col("object.name").alias("object"), "facade", "wall_color"), written["paints"], found)
        sinks.write_tables({"kitchen_wall_colors": kitchens}, a.out)
        kitchens = spark.read.parquet(f"{a.out}/kitchen_wall_colors")
        sinks.write_csv(kitchens, f"{a.out}/kitchen_wall_colors_csv")
        sinks.write_markdown(spark, f"{a.out}/kitchen_wall_colors.md", "Kitchens and wall paints", {"With paints": kitchens.where("size(paint_codes) > 0"), "Counts": kitchens.groupBy((F.size("paint_codes") > 0).alias("with_paints")).count()}, 1000, "kitchen_wall_colors")
    checks = entities.select("message_id", "entity_type", "visible_text", "href", mentions.host(F.col("href")).alias("host"), F.lit("to check").alias("status")).where("href is not null").dropDuplicates(["message_id", "href"]).orderBy("message_id", "href")
    sinks.write_csv(checks, f"{a.out}/link_validation_csv")
    if written:
        seen = rankings.record_types(**written)
        sinks.write_csv(found.join(seen, "message_id", "left_semi").where("link_confidence <> 'high'"), f"{a.out}/link_review_csv")
        sinks.write_csv(seen, f"{a.out}/record_types_csv")
    sinks.write_report(spark, f"{a.out}/index.md", "Index", sections)
    return {n: t.count() for n, t in written.items()}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="oreloom")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name, run, *flags):
        own = sub.add_parser(name)
        own.set_defaults(run=run)
        own.add_argument("--out", default=None if name == "stats" else "out")
        for flag, options in flags:
            own.add_argument(flag, **options)

    root, db, fact = ("--root", {"required": True}), ("--db", {"required": True}), ("--facts", {"required": True})
    owner, channel = ("--owner", {"default": ""}), ("--channel", {"required": True})
    number = lambda flag, n: (flag, {"type": int, "default": n})
    yes = lambda flag: (flag, {"action": "store_true"})
    add("audit", audit, root)
    add("ingest", ingest, root)
    add("stats", stats, db)
    add("sample", sample, db, number("--limit", 50))
    add("candidates", mine, db, owner, number("--limit", 100), number("--min-score", 2), yes("--include-low"), ("--format", {"nargs": "+", "choices": ["csv", "jsonl", "markdown"], "default": ["csv", "jsonl", "markdown"]}))
    add("extract-facts", extract, db, owner, ("--source", {"choices": ["all_text", "project_articles", "candidates"], "default": "project_articles"}), number("--min-article-score", 2), ("--limit", {"type": int}))
    add("review", model_review, db, fact, ("--source", {"choices": ["clean", "needs_review", "mixed", "category"], "default": "mixed"}), ("--category", {}), number("--sample-size", 100), number("--seed", 42), number("--excerpt-chars", 2500), ("--provider", {"default": "mock"}), ("--model", {"default": "mock"}), ("--base-url", {"default": "http://localhost:1234/v1"}), ("--timeout", {"type": float, "default": 120.0}), yes("--strict-json"), yes("--resume"), yes("--dry-run"))
    add("report", report, fact, ("--reviews", {"nargs": "*", "default": []}), ("--min-confidence", {"choices": ["low", "medium", "high"], "default": "medium"}), yes("--lenient"), yes("--include-low"), number("--top", 15))
    add("palettes", palette, db, fact, channel, ("--designer", {"default": ""}), number("--examples", 6))
    for name, what in (("index", "none"), ("paints", "paints"), ("appliances", "appliances"), ("makers", "makers"), ("index-all", "all")):
        add(name, index, db, fact, channel, ("--what", {"default": what, "help": argparse.SUPPRESS}))
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("oreloom").getOrCreate()
    try:
        found = a.run(spark, a)
    except ConnectionError as e:
        print(f"provider unreachable: {e}", file=sys.stderr)
        return 3
    except Exception as e:
        if type(e).__name__ not in ("AnalysisException", "ValueError", "FileNotFoundError"):
            raise
        print(f"bad input: {e}", file=sys.stderr)
        return 2
    for k, v in found.items():
        print(f"{k}: {v}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
