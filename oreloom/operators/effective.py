"""Effective facts: facts under their reviews, each used or excluded for the first reason that holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.parse import normalize_vendor
from ..functions.text import clean_optional, compact, confidence_rank, contains_any, has, let, strip

# Tokens of a rationale that contradicts its decision, and of evidence that names something concrete.
CONFLICT = ("mismatch", "wrong category", "not a target", "false positive", "context only", "ambiguous price", "ambiguous category", "несоответ", "неоднознач", "ложнополож", "только контекст", "не целев")
CONCRETE = ("арт", "руб", "₽", "ozon", "wb", "divan", "mebel", "g482", "ral", "ncs")
_DETAILS = ("vendor_raw", "vendor_normalized", "brand_raw", "brand_normalized", "model", "material", "finish", "color", "color_code", "article_id", "marketplace", "price_value")
_PRICE_LIMIT = 20_000_000


def evidence_form(c: Column) -> Column:
    """Lower-cased words, digits and slashes, single spaces between."""
    return compact(F.regexp_replace(F.translate(F.lower(c), "ё", "е"), r"(?U)[^\w/]+", " "))


def wall_code(c: Column) -> Column:
    """A wall colour code in one spelling: G482, RAL 7047, NCS with single spaces, 30 YY 56/060; else in capitals."""

    def of(text):
        out = F.nullif(text, F.lit(""))
        for p, r in ((r"\b(\d{2})\s*([A-Z]{2})\s*(\d{2}/\d{3})\b", "$1 $2 $3"), (r"\bNCS\s*([A-Z0-9\s/-]+)", "NCS $1"), (r"\bRAL\s*(\d{3,4})\b", "RAL $1"), (r"\bG\s*(\d{3})\b", "G$1")):
            out = F.when(has(text, p), compact(F.regexp_replace(F.regexp_extract(text, p, 0), p, r))).otherwise(out)
        return out

    return let(compact(strip(F.upper(c), " .,:;")), of)


def facade_finish(c: Column) -> Column:
    """A facade finish with single spaces and `` + `` between its parts."""
    return compact(F.regexp_replace(c, r"\s*\+\s*", " + "))


_CODES = r"(?i)\b(G\s*\d{3}|\d{2}\s*[A-Z]{2}\s*\d{2}/\d{3})\b"


def _vendors_named(c: Column, form: Column) -> Column:
    """Vendors with an alias in a text or in its evidence form."""
    own = [F.when(has(c, p) | has(form, p), F.lit(n)) for n, aliases in rules.VENDORS for p in [rf"(?iU)(?<![\w.])(?:{'|'.join(aliases)})(?![\w.])"]]
    return F.filter(F.array(*own), lambda x: x.isNotNull())


def evidence_facts(evidence: Column) -> dict[str, Column]:
    """What supported() looks up, to be computed once for each row: form, colour codes and vendors of the evidence."""
    codes = F.transform(F.regexp_extract_all(evidence, F.lit(_CODES), F.lit(1)), wall_code)
    return {"_ev_form": evidence_form(evidence), "_ev_codes": codes, "_ev_vendors": _vendors_named(evidence, evidence_form(evidence))}


def supported(value: Column) -> Column:
    """The evidence says the value: literally, as a colour code in another spelling, or as a vendor by an alias. Reads
    the columns of evidence_facts()."""

    def of(form):
        said = F.contains(F.col("_ev_form"), form) & (form != "")
        return said | F.array_contains("_ev_codes", wall_code(value)) | F.arrays_overlap(_vendors_named(value, form), F.col("_ev_vendors"))

    return F.coalesce(F.when(value.isNotNull(), let(evidence_form(value), of)), F.lit(False))


def number_supported(value: Column, evidence: Column) -> Column:
    """The evidence has a number of these digits, whatever separates its thousands."""
    whole = F.floor(value).cast("bigint").cast("string")
    numbers = F.transform(F.regexp_extract_all(evidence, F.lit(r"(\d{1,3}(?:[   .]\d{3})+|\d+)"), F.lit(1)), lambda x: F.regexp_replace(x, r"\D", ""))
    return F.coalesce((value > 0) & F.array_contains(numbers, whole), F.lit(False))


def plausible(value: Column) -> Column:
    return F.coalesce((value > 0) & (value < _PRICE_LIMIT), F.lit(False))


def essay(row: str = "") -> Column:
    """Long evidence without any parsed detail or concrete token."""
    c = lambda n: F.col(f"{row}{n}")
    detailed = reduce(lambda a, b: a | b, (F.coalesce(c(n).cast("string") != "", F.lit(False)) for n in _DETAILS))
    return F.coalesce((F.length(c("evidence_quote")) >= 350) & ~detailed & ~contains_any(F.lower(c("evidence_quote")), CONCRETE), F.lit(False))


def _first(*cases: tuple[str, Column]) -> Column:
    out = F.lit(None).cast("string")
    for label, test in reversed(cases):
        out = F.when(F.coalesce(test, F.lit(False)), label).otherwise(out)
    return out


def build(facts: DataFrame, reviews: DataFrame, min_confidence: str = "medium", strict: bool = True, include_low: bool = False) -> DataFrame:
    """facts (with id) under at most one review each (fact_id and the payload's fields).

    Adds reviewed, decision, exclusion_reason (null: used) and the effective category, item_type, vendor, brand, model,
    material, finish, color, color_code, article_id, price_value, price_unit, price_currency, price_reliable,
    room_context and report_note as ``e_*``.
    """
    own = facts.join(reviews.withColumns({"_r": F.struct(*[c for c in reviews.columns if c != "fact_id"])}).select("fact_id", "_r"), F.col("id") == F.col("fact_id"), "left").drop("fact_id")
    r = lambda n: F.col(f"_r.{n}")
    fix = lambda n: clean_optional(F.col(f"_r.corrected.{n}"), " ")
    term = lambda n: clean_optional(F.col(f"_r.normalized_terms.{n}"), " ")
    evidence = F.col("evidence_quote")
    own = own.withColumns(evidence_facts(evidence))
    own = own.withColumns({"reviewed": F.col("_r").isNotNull(), "decision": r("decision"), "_c_category": fix("category"), "_c_type": fix("item_type"), "_c_vendor": F.coalesce(fix("vendor_normalized"), term("vendor")), "_essay": essay()})
    known = lambda c: F.coalesce(c.isin(*rules.STRICT), F.lit(False))
    target = F.when(F.col("_c_category").isNotNull() & ((r("decision") == "fix") | r("category_correct")), F.col("_c_category")).otherwise(F.col("category"))
    own = own.withColumn("_target", target)
    unreviewed = _first(
        ("outside_categories", ~known(F.col("category"))), ("missing_evidence_quote", F.coalesce(F.trim(evidence), F.lit("")) == ""), ("needs_review_without_review", F.col("needs_review")),
        ("below_min_confidence", F.lit(not include_low) & (F.coalesce(confidence_rank(F.col("confidence")), F.lit(0)) < rules.CONFIDENCE[min_confidence])), ("general_or_non_concrete_evidence", F.lit(strict) & F.col("_essay")),
    )
    reviewed = _first(
        ("missing_evidence_quote", F.coalesce(F.trim(evidence), F.lit("")) == ""), ("review_discard", r("decision") == "discard"), ("review_needs_human", r("decision") == "needs_human"), ("review_unknown_decision", ~F.coalesce(r("decision").isin("keep", "fix"), F.lit(False))),
        ("review_context_false_positive", r("is_context_false_positive")), ("review_non_target_room", F.lit(strict) & r("is_non_target_room")),
        ("corrected_category_outside", F.col("_c_category").isNotNull() & ~known(F.col("_c_category"))), ("outside_categories", ~known(F.col("_target"))), ("review_category_conflict", ~r("category_correct") & (r("decision") != "fix")),
        ("review_item_type_conflict", ~r("item_type_correct") & F.col("_c_type").isNull()), ("review_rationale_conflict", F.lit(strict) & contains_any(F.lower(r("rationale_short")), CONFLICT)), ("general_or_non_concrete_evidence", F.lit(strict) & F.col("_essay")),
    )
    names = ("vendor_normalized", "model", "material", "finish", "color", "color_code", "article_id")
    own = own.withColumns({f"_fix_{n}": fix(n) for n in names} | {f"_term_{n}": term(n) for n in ("sofa_fabric", "sofa_color", "wall_color_code", "flooring_brand_or_collection")})
    own = own.withColumns({f"_ok_{n}": supported(F.col(f"_fix_{n}")) for n in names} | {f"_ok_{n}": supported(F.col(f"_term_{n}")) for n in ("sofa_fabric", "sofa_color", "wall_color_code", "flooring_brand_or_collection")} | {"_ok_vendor": supported(F.col("_c_vendor"))})
    own = _overlay(own, r, fix, evidence)
    # a fix must not rest on corrections that the evidence does not bear out
    open_fields = F.filter(F.array(*(F.when(F.col(f"_fix_{n}").isNotNull() & ~F.col(f"_ok_{n}") & ((F.lit(n) != "vendor_normalized") | ~F.coalesce(F.lower(F.col(f"_fix_{n}")) == "spc", F.lit(False))), F.coalesce(F.col(f"e_{'vendor' if n == 'vendor_normalized' else n}"), F.lit(""))) for n in names)), lambda x: x.isNotNull())
    price = F.col("_r.corrected.price_value")
    bad_price = price.isNotNull() & F.coalesce(r("price_correct"), F.lit(True)) & ~(plausible(price) & number_supported(price, evidence))
    incoherent = (r("decision") == "fix") & (bad_price | ((F.size(open_fields) > 0) & ~F.exists(open_fields, lambda x: x != "")))
    reason = F.when(F.col("reviewed"), F.coalesce(reviewed, F.when(F.coalesce(incoherent, F.lit(False)), "review_fix_not_coherent"))).otherwise(unreviewed)
    own = own.withColumn("exclusion_reason", reason)
    return own.drop(*(c for c in own.columns if c.startswith("_")))


def _overlay(own: DataFrame, r, fix, evidence: Column) -> DataFrame:
    """The effective fields: a correction that the evidence bears out, else the fact's own value."""
    is_spc = lambda v: F.coalesce(F.lower(v) == "spc", F.lit(False))
    own = own.withColumns({"_vendor": normalize_vendor(F.coalesce("vendor_normalized", "vendor_raw"), rules.REPORT_VENDORS), "_new_vendor": normalize_vendor(F.col("_c_vendor"), rules.REPORT_VENDORS)})
    spc = is_spc(F.col("_vendor")) | is_spc(F.col("_new_vendor"))
    keep = lambda n: F.when(F.col(f"_ok_{n}"), F.col(f"_fix_{n}" if f"_fix_{n}" in own.columns else f"_term_{n}"))
    category = F.col("_target")
    vendor = F.coalesce(F.when(~is_spc(F.col("_new_vendor")) & F.col("_ok_vendor"), F.col("_new_vendor")), F.when(~is_spc(F.col("_vendor")), F.col("_vendor")))
    flooring = F.col("_term_flooring_brand_or_collection")
    brand = F.coalesce("brand_normalized", "brand_raw", F.when(spc & has(evidence, r"(?iU)alpine\s*floor"), F.lit("Alpine Floor")), F.when((category == "flooring") & ~F.coalesce(F.lower(flooring).isin("арт", "art", "spc"), F.lit(False)), keep("flooring_brand_or_collection")))
    sofa = (F.col("category") == "sofas") | (category == "sofas")
    material = F.coalesce(F.when(sofa, keep("sofa_fabric")), keep("material"), F.col("material"), F.when(spc, F.lit("SPC")))
    parts = F.filter(F.transform(F.col("_r.normalized_terms.facade_materials"), lambda x: clean_optional(x, " ")), lambda x: x.isNotNull() & F.contains(F.col("_ev_form"), evidence_form(x)))
    finish = F.coalesce(keep("finish"), F.col("finish"), F.when(category == "kitchens", F.nullif(F.array_join(parts, " + "), F.lit(""))))
    code = F.coalesce(keep("color_code"), F.col("color_code"), keep("wall_color_code"))
    price_ok = F.coalesce(r("price_correct"), F.lit(True))
    new_price = F.col("_r.corrected.price_value")
    price = F.coalesce(F.when(price_ok & plausible(new_price) & number_supported(new_price, evidence), new_price.cast("decimal(12,2)")), F.col("price_value"))
    hide = lambda c: F.when(price_ok, c)
    own = own.withColumns({
        "e_category": category, "e_item_type": F.coalesce("_c_type", "item_type"), "e_vendor": vendor, "e_brand": brand, "e_model": F.coalesce(keep("model"), F.col("model")), "e_material": material, "e_finish": facade_finish(finish),
        "e_color": F.coalesce(F.when(sofa, keep("sofa_color")), keep("color"), F.col("color")), "e_color_code": wall_code(code), "e_article_id": F.coalesce(keep("article_id"), F.col("article_id")), "e_marketplace": normalize_vendor(F.col("marketplace"), rules.REPORT_VENDORS),
        "e_price_value": hide(price), "e_price_unit": hide(F.coalesce(fix("price_unit"), F.col("price_unit"))), "e_price_currency": hide(F.col("price_currency")), "e_price_reliable": price_ok, "e_room_context": F.coalesce(fix("room_context"), F.col("room_context")),
        "e_note": F.concat_ws("; ", F.when(r("decision") == "fix", F.concat(F.lit("fix: "), F.coalesce(r("rationale_short"), F.lit("")))), F.when(~price_ok, F.lit("price hidden: marked as unreliable by review"))),
    })
    return own


def used(dataset: DataFrame) -> DataFrame:
    """The facts in use: by confidence, reviewed ones first, date and id, all descending."""
    return dataset.where("exclusion_reason is null").orderBy(F.coalesce(confidence_rank(F.col("confidence")), F.lit(0)).desc(), F.desc(F.coalesce(F.col("decision").isin("keep", "fix"), F.lit(False))), F.coalesce("date", F.lit("")).desc(), F.desc("id"))


def counters(dataset: DataFrame) -> DataFrame:
    """Long table kind, name, n: decisions, exclusion reasons, fixes in use and hidden prices."""
    one = lambda kind, name, own: own.groupBy(F.lit(kind).alias("kind"), name.alias("name")).agg(F.count("*").alias("n"))
    inside = dataset.where("exclusion_reason is null")
    return (
        one("decision", F.col("decision"), dataset.where("reviewed"))
        .union(one("excluded", F.col("exclusion_reason"), dataset.where("exclusion_reason is not null")))
        .union(one("applied", F.lit("fix"), inside.where("decision = 'fix'")))
        .union(one("applied", F.lit("price_hidden"), inside.where("not e_price_reliable")))
    )
