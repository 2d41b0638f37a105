"""URL entities of messages and the project that a message belongs to."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any, has, let, match_form
from .projects import area_type, channel_link, designer, meaningful_lines, object_name

ENTITY = "message_id long, visible_text string, href string, entity_type string, start int, end int, context string, source string"
URL = re.compile(r"https?://[^\s<>\"']+", re.IGNORECASE)
_STREET = r"(?iU)(?<![\p{L}])(?:ул\.|улица|проспект|пр-т|бульвар|шоссе|переулок|наб\.|набережная)(?![\p{L}])"
_PLACE = r"(?iU)(?:^|\s)(?:жк|жилой\s+комплекс|ул\.?|улица|проспект|пр-т|бульвар|шоссе|переулок|наб\.?|набережная)(?:\s|$)"


def _payload(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def _raw_entities(raw):
    if not isinstance(raw, dict):
        return None
    for key in ("text_entities", "caption_entities"):
        if isinstance(raw.get(key), list):
            return raw[key]
    return [x for x in raw["text"] if isinstance(x, dict)] if isinstance(raw.get("text"), list) else None


def paragraph(text: str, start: int, end: int) -> tuple[int, int]:
    left = 0
    for m in re.finditer(r"\n\s*\n", text[: max(0, start)]):
        left = m.end()
    right = re.search(r"\n\s*\n", text[max(end, 0) :])
    return left, end + right.start() if right else len(text)


def context(text: str, start: int, end: int) -> str:
    """The paragraph around a span, or 220 characters on either side of it if that is over 500."""
    a, b = paragraph(text, start, end)
    own = " ".join(text[a:b].split())
    return own if len(own) <= 500 else " ".join(text[max(a, start - 220) : min(b, end + 220)].split())


def message_entities(text: str, entities: str | None, raw_best: str | None, variants: list[str]) -> list[dict]:
    """URL entities from the first source that has any (own entities, best raw message, variants), with offsets found
    by walking through the text; then URLs in the text that none of them names."""
    sources = [("entities", _payload(entities)), ("raw_best", _raw_entities(_payload(raw_best))), *(("variant", _raw_entities(_payload(v))) for v in variants)]
    found: list[dict] = []
    used = "text"
    for name, items in sources:
        if not isinstance(items, list):
            continue
        cursor = offset = 0
        for x in items:
            if not isinstance(x, dict):
                continue
            visible = str(x.get("text") or "")
            at = min(cursor, len(text))
            if visible:
                places = (cursor if text.startswith(visible, cursor) else -1, text.find(visible, cursor), offset if text.startswith(visible, offset) else -1, text.find(visible))
                at = next((p for p in places if p >= 0), at)
                cursor, offset = max(cursor, at + len(visible)), offset + len(visible)
            href, kind = str(x.get("href") or "").strip(), str(x.get("type") or "")
            if not href and kind in ("link", "url") and URL.fullmatch(visible.strip()):
                href = visible.strip()
            if href:
                found.append({"visible_text": " ".join(visible.split()), "href": href, "entity_type": kind, "start": at, "end": at + len(visible), "context": context(text, at, at + len(visible)), "source": name})
        if found:
            used = name
            break
    known = {x["href"].rstrip(".,;)") for x in found}
    for m in URL.finditer(text):
        href = m[0].rstrip(".,;)")
        if href not in known:
            known.add(href)
            found.append({"visible_text": href, "href": href, "entity_type": "raw_url", "start": m.start(), "end": m.start() + len(href), "context": context(text, m.start(), m.end()), "source": used})
    return sorted(found, key=lambda x: (x["start"], x["end"], x["href"]))


def extract_entities(messages: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """URL entities of messages (message_id, text_plain, text_entities_json, raw_best_json) with offsets.

    ``variants`` (message_id, raw_json) may be missing. Their JSON is gathered by message in sorted order.
    """
    own = messages.select("message_id", F.coalesce("text_plain", F.lit("")).alias("text"), "text_entities_json", "raw_best_json" if "raw_best_json" in messages.columns else F.lit(None).cast("string").alias("raw_best_json"))
    if variants is not None:
        own = own.join(variants.groupBy("message_id").agg(F.array_sort(F.collect_list("raw_json")).alias("raws")), "message_id", "left")
    else:
        own = own.withColumn("raws", F.array().cast("array<string>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in ENTITY.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            rows = [{"message_id": r["message_id"]} | x for r in batch.to_pylist() for x in message_entities(r["text"], r["text_entities_json"], r["raw_best_json"], r["raws"] or [])]
            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)

    return own.mapInArrow(run, ENTITY)


def explicit_project(text: Column, kind: Column, around: Column) -> Column:
    """An entity that names a project of its own, not a collection, tariff, service or the channel."""

    def of(anchor):
        refused = contains_any(anchor, ("подборк", "других", "тариф", "услуг", "канал"))
        plain = anchor.isin("проекта", "проект", "о проекте", "пост о проекте", "артикулы проекта")
        named = F.contains(anchor, F.lit("проект")) & ~contains_any(anchor, ("купить", "подбор"))
        form = match_form(around)
        raw = (kind == "raw_url") & has(form, r"(?U)(?:пост|артикулы)\s+(?:о\s+)?проект") & ~has(form, r"(?U)подборк\w*\s+друг")
        return ~refused & (plain | named | raw)

    return F.coalesce(let(match_form(text), of), F.lit(False))


def street(text: Column) -> Column:
    return let(meaningful_lines(text), lambda ls: F.get(F.filter(F.slice(ls, 1, 30), lambda x: has(x, _STREET)), F.lit(0)))


def source_to_project(projects: DataFrame) -> DataFrame:
    """(message_id, mapped_id): the last project, in output order, that has a message as source; a project's own post
    maps to itself where no project claims it."""
    claims = projects.select(F.explode("source_ids").alias("message_id"), F.col("project_id"), F.coalesce("date", F.lit("")).alias("d"))
    # output is by date and id descending, so the last one is the earliest
    last = claims.groupBy("message_id").agg(F.min_by("project_id", F.struct("d", "project_id")).alias("mapped_id"))
    own = projects.select(F.col("project_id").alias("message_id"), F.col("project_id").alias("mapped_id"))
    return last.union(own.join(last, "message_id", "left_anti"))


def project_names(facts: DataFrame) -> DataFrame:
    """(message_id, project_name): the name most facts of a message give; ties by name."""
    n = facts.where(F.trim(F.coalesce("project_name", F.lit(""))) != "").groupBy("message_id", "project_name").agg(F.count("*").alias("n"))
    return n.groupBy("message_id").agg(F.min_by("project_name", F.struct((-F.col("n")).alias("n"), "project_name")).alias("project_name"))


def link_projects(messages: DataFrame, entities: DataFrame, channel: str, mapping: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """One row per message: project_id, project_key, project_name, object_name, street, designer, link_method,
    link_confidence, evidence.

    In this order: one explicit project link; several (ambiguous); a mapped project that an explicit entity confirms;
    a project of the message's own; ambiguous. Names never merge projects: keys are post ids.
    """
    p = channel_link(channel)
    links = entities.withColumn("target", F.nullif(F.regexp_extract("href", p, 1), F.lit("")).try_cast("bigint")).where("target is not null").where(explicit_project(F.col("visible_text"), F.col("entity_type"), F.col("context")))
    found = links.groupBy("message_id").agg(F.array_sort(F.collect_set("target")).alias("targets"), F.min_by(F.concat_ws(": ", "visible_text", "href"), F.struct("start", "end", "href")).alias("first_link"))
    own = messages.select("message_id", "date", F.coalesce("text_plain", F.lit("")).alias("text")).join(found, "message_id", "left")
    own = own.join(mapping, "message_id", "left") if mapping is not None else own.withColumn("mapped_id", F.lit(None).cast("bigint"))
    own = own.join(names.withColumnRenamed("project_name", "_name"), "message_id", "left") if names is not None else own.withColumn("_name", F.lit(None).cast("string"))
    own = own.withColumns({"_object": object_name(F.col("text"), F.col("date"), F.col("message_id")), "_designer": designer(F.col("text"), ""), "street": street(F.col("text"))})
    own = own.withColumns({"object_name": F.when(F.col("_object.source") != "fallback_post_id", F.col("_object.name")), "designer": F.when(F.col("_designer.source") == "credited_in_post", F.col("_designer.name")), "_label": F.when(has(F.col("_name"), _PLACE), F.col("_name"))})
    n = F.coalesce(F.size("targets"), F.lit(0))
    mapped = F.col("mapped_id").isNotNull() & (F.col("mapped_id") != F.col("message_id")) & F.coalesce(F.array_contains("targets", F.col("mapped_id")), F.lit(False))
    direct = F.col("object_name").isNotNull() | F.col("street").isNotNull() | has(F.col("text"), r"(?iU)(?:^|\n)\s*(?:#?ЖК|Артикулы\s+проекта|Проект\s+квартиры)")
    method = F.when(n == 1, "explicit_project_link").when(n > 1, "ambiguous_metadata_match").when(mapped, "mapped_project_post").when(direct, "same_message").otherwise("ambiguous_metadata_match")
    own = own.withColumn("link_method", method)
    target = F.when(n == 1, F.get("targets", F.lit(0))).when(F.col("link_method") == "mapped_project_post", F.col("mapped_id")).when(F.col("link_method") == "same_message", F.col("message_id"))
    own = own.withColumns({"project_id": target, "project_key": F.when(target.isNotNull(), F.concat(F.lit("telegram:"), target.cast("string"))), "link_confidence": F.when(target.isNotNull(), "high").otherwise("low"), "project_name": F.coalesce("object_name", "_label")})
    evidence = F.when(n == 1, F.col("first_link")).when(n > 1, F.concat(F.lit("several project links: "), F.array_join(F.transform("targets", lambda x: x.cast("string")), ", "))).when(F.col("link_method") == "same_message", "project and evidence in one message").otherwise("too little to link")
    return own.select("message_id", "project_id", "project_key", "project_name", "object_name", "street", "designer", "link_method", "link_confidence", evidence.alias("evidence"))


__all__ = ["area_type", "extract_entities", "explicit_project", "link_projects", "message_entities", "project_names", "source_to_project", "street"]
