"""Model reviews of facts: prompts, strict payloads, one repair, resume.

The model is any callable (system prompt, user prompt) -> text. It runs in mapInPandas, so a session belongs to a
partition; everything before and after is relational.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.text import truncate

# Fields of a review.
DECISIONS = ("keep", "fix", "discard", "needs_human")
CONFIDENCES = ("low", "medium", "high")
CORRECTED = ("category", "item_type", "vendor_normalized", "model", "material", "finish", "color", "color_code", "article_id", "price_value", "price_unit", "room_context")
TERMS = ("vendor", "facade_materials", "sofa_fabric", "sofa_color", "wall_color_code", "flooring_brand_or_collection")
FLAGS = ("category_correct", "item_type_correct", "is_bundle", "is_context_false_positive", "is_non_target_room")

SYSTEM_PROMPT = "You check facts extracted from posts about interiors. Answer with one JSON object and nothing else."
USER_PROMPT = "Fact:\n{fact}\n\nEvidence:\n{evidence}\n\nPost {message_id}:\n{excerpt}\n\nAnswer with the fields decision, category_correct, item_type_correct, price_correct, is_bundle, is_context_false_positive, is_non_target_room, corrected, normalized_terms, rationale_short, confidence."
REPAIR_PROMPT = "Your answer was not valid: {error}. Answer again with one JSON object of these fields only."

Handler = Callable[[str, str], str]
PAYLOAD = (
    "decision string, category_correct boolean, item_type_correct boolean, price_correct boolean, is_bundle boolean, is_context_false_positive boolean, is_non_target_room boolean, "
    "corrected struct<" + ",".join(f"{n}:{'double' if n == 'price_value' else 'string'}" for n in CORRECTED) + ">, "
    "normalized_terms struct<" + ",".join(f"{n}:{'array<string>' if n == 'facade_materials' else 'string'}" for n in TERMS) + ">, rationale_short string, confidence string"
)


class InvalidPayload(ValueError):
    """A model's answer that is not a review."""


def validate(data) -> dict:
    """A review with all fields, or InvalidPayload. Booleans are not numbers; missing corrections are null."""

    def need(ok: bool, what: str) -> None:
        if not ok:
            raise InvalidPayload(what)

    need(isinstance(data, dict), "the answer is not an object")
    need(data.get("decision") in DECISIONS, f"decision must be one of {', '.join(DECISIONS)}")
    need(data.get("confidence") in CONFIDENCES, f"confidence must be one of {', '.join(CONFIDENCES)}")
    need(isinstance(data.get("rationale_short"), str), "rationale_short must be a string")
    for f in FLAGS:
        need(isinstance(data.get(f), bool), f"{f} must be a boolean")
    need(data.get("price_correct") is None or isinstance(data["price_correct"], bool), "price_correct must be a boolean or null")
    given = {k: data.get(k) if data.get(k) is not None else {} for k in ("corrected", "normalized_terms")}
    for k, v in given.items():
        need(isinstance(v, dict), f"{k} must be an object")
    corrected, terms = {}, {}
    for f in CORRECTED:
        v = given["corrected"].get(f)
        if f == "price_value":
            need(v is None or (isinstance(v, (int, float)) and not isinstance(v, bool)), "corrected.price_value must be a number or null")
            v = None if v is None else float(v)
        else:
            need(v is None or isinstance(v, str), f"corrected.{f} must be a string or null")
        corrected[f] = v
    need(not corrected["category"] or corrected["category"] in rules.STRICT, "corrected.category must be a known category or null")
    for f in TERMS:
        v = given["normalized_terms"].get(f)
        if f == "facade_materials":
            need(v is None or (isinstance(v, list) and all(isinstance(x, str) for x in v)), "normalized_terms.facade_materials must be a list of strings")
            v = v or []
        else:
            need(v is None or isinstance(v, str), f"normalized_terms.{f} must be a string or null")
        terms[f] = v
    return {k: data.get(k) for k in ("decision", *FLAGS[:2], "price_correct", *FLAGS[2:])} | {"corrected": corrected, "normalized_terms": terms, "rationale_short": data["rationale_short"], "confidence": data["confidence"]}


def parse(text: str | None, strict: bool = False):
    """The JSON of an answer; unless strict, the outermost braces of one with other text around it."""
    own = (text or "").strip()
    try:
        return json.loads(own)
    except json.JSONDecodeError:
        found = None if strict else re.search(r"\{.*\}", own, re.DOTALL)
        if not found:
            raise
        return json.loads(found[0])


def needs_human(error: str) -> dict:
    """The review that stands for a failed one."""
    return {"decision": "needs_human", "category_correct": False, "item_type_correct": False, "price_correct": None, "is_bundle": False, "is_context_false_positive": False, "is_non_target_room": False, "corrected": dict.fromkeys(CORRECTED), "normalized_terms": dict.fromkeys(TERMS) | {"facade_materials": []}, "rationale_short": error[:237] + "..." if len(error) > 240 else error, "confidence": "low"}


def review_one(handler: Handler, prompt: str, strict: bool = False) -> dict:
    """The handler's review of a prompt: one repair after an invalid answer, then needs_human. With raw_response,
    retry_count, error and status (valid, recovered, invalid or failed)."""
    raw, error = "", ""
    for attempt in (0, 1):
        try:
            answer = handler(SYSTEM_PROMPT, prompt if not attempt else f"{prompt}\n\n{REPAIR_PROMPT.format(error=error[:200])}")
        except Exception as e:  # whatever a provider raises ends in a row for a person
            return needs_human(f"provider error: {e}") | {"raw_response": raw, "retry_count": attempt, "error": f"provider error: {e}", "status": "failed"}
        raw = f"{raw}\n---REPAIR---\n{answer}" if attempt else answer
        try:
            return validate(parse(answer, strict)) | {"raw_response": raw, "retry_count": attempt, "error": f"recovered: {error}" if attempt else None, "status": "recovered" if attempt else "valid"}
        except (InvalidPayload, json.JSONDecodeError) as e:
            error = str(e)
    return needs_human(f"invalid answer: {error}") | {"raw_response": raw, "retry_count": 1, "error": f"invalid answer: {error}", "status": "invalid"}


def mock_handler(system: str, prompt: str) -> str:
    """Keeps everything; for tests and dry runs."""
    return json.dumps({"decision": "keep", "category_correct": True, "item_type_correct": True, "price_correct": None, "is_bundle": False, "is_context_false_positive": False, "is_non_target_room": False, "corrected": {}, "normalized_terms": {}, "rationale_short": "ok", "confidence": "high"})


class Recorder:
    """A handler that answers like another one and keeps what it was asked, in ``calls``."""

    def __init__(self, handler: Handler = mock_handler):
        self.handler, self.calls = handler, []

    def __call__(self, system: str, prompt: str) -> str:
        self.calls.append((system, prompt))
        return self.handler(system, prompt)


def probe(url: str, timeout: float = 5.0) -> None:
    """Asks an endpoint for its models; OSError if it does not answer in time."""
    import urllib.request

    with urllib.request.urlopen(f"{url.rstrip('/')}/models", timeout=timeout) as answer:
        answer.read()


def http_handler(url: str, model: str, timeout: float = 120.0, temperature: float = 0.0) -> Handler:
    """A handler that posts to an endpoint of the common chat-completion form."""
    import urllib.request

    def call(system: str, prompt: str) -> str:
        body = {"model": model, "temperature": temperature, "messages": [{"role": "system", "content": system}, {"role": "user", "content": prompt}]}
        request = urllib.request.Request(f"{url.rstrip('/')}/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return json.load(answer)["choices"][0]["message"]["content"]

    return call


def plan(facts: DataFrame, posts: DataFrame, excerpt_chars: int = 2500, fields: tuple[str, ...] = ("category", "item_type", "item_name", "vendor_normalized", "model", "material", "finish", "color", "color_code", "article_id", "price_value", "price_unit", "room_context", "evidence_quote", "confidence", "needs_review", "notes"), key: str = "id") -> DataFrame:
    """Facts with excerpt, fact_json, prompt, input_hash and prompt_hash. The excerpt is the post's, else the quote.

    JSON has sorted keys and leaves nulls out, so equal facts have equal hashes.
    """
    own = facts.join(posts.select("message_id", F.left("text", F.lit(excerpt_chars)).alias("_text")), "message_id", "left")
    own = own.withColumn("excerpt", F.coalesce(F.nullif(F.trim("_text"), F.lit("")), F.left("evidence_quote", F.lit(excerpt_chars)), F.lit(""))).drop("_text")
    own = own.withColumn("fact_json", F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in sorted(fields)))))
    prompt = F.lit(USER_PROMPT)
    for k, v in (("fact", F.col("fact_json")), ("evidence", F.coalesce("evidence_quote", F.lit("(none)"))), ("message_id", F.col("message_id").cast("string")), ("excerpt", F.col("excerpt"))):
        prompt = F.replace(prompt, F.lit("{" + k + "}"), v)
    own = own.withColumn("prompt", prompt)
    return own.withColumns({"input_hash": F.sha2(F.concat_ws("\n", F.col(key).cast("string"), "fact_json", "excerpt"), 256), "prompt_hash": F.sha2(F.concat_ws("\n", F.lit(SYSTEM_PROMPT), "prompt"), 256)})


def pending(planned: DataFrame, done: DataFrame, provider: str, model: str) -> DataFrame:
    """Planned rows that the provider and requested model have not answered yet."""
    seen = done.where((F.col("provider") == provider) & (F.col("requested_model") == model)).select("input_hash").distinct()
    return planned.join(seen, "input_hash", "left_anti")


def run(planned: DataFrame, handler: Handler, provider: str, model: str, strict: bool = False, key: str = "id") -> DataFrame:
    """One review for each planned row: fact_id, hashes, provider, requested_model, the payload, raw_response,
    retry_count, error, status."""
    schema = f"fact_id long, input_hash string, prompt_hash string, {PAYLOAD}, raw_response string, retry_count int, error string, status string"

    def answer(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            rows = [{"fact_id": i, "input_hash": a, "prompt_hash": b} | review_one(handler, p, strict) for i, a, b, p in frame.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in ("fact_id", "input_hash", "prompt_hash", "decision", *FLAGS[:2], "price_correct", *FLAGS[2:], "corrected", "normalized_terms", "rationale_short", "confidence", "raw_response", "retry_count", "error", "status")])

    return planned.select(F.col(key).cast("long"), "input_hash", "prompt_hash", "prompt").mapInPandas(answer, schema).withColumns({"provider": F.lit(provider), "requested_model": F.lit(model)})


def latest(*runs: DataFrame) -> DataFrame:
    """One review for each fact over several stores: a later store wins, within a store the later row."""
    from .ranking import last_wins, ordered_union

    own = ordered_union(*runs)
    return last_wins(own, "fact_id", [F.col("source_no"), F.col("id") if "id" in own.columns else F.col("input_hash")]).drop("source_no")


def payload_error(payload: Column) -> Column:
    """Why a JSON text is not a review: the first label that fits, null if it is one. Built-in functions only."""
    doc = F.try_parse_json(payload)
    kind = lambda f: F.schema_of_variant(F.try_variant_get(doc, f"$.{f}", "variant"))
    text = lambda f: F.try_variant_get(doc, f"$.{f}", "string")
    out = F.lit(None).cast("string")
    for f in ("corrected", "normalized_terms"):
        out = F.when(F.coalesce(~(F.startswith(kind(f), F.lit("OBJECT")) | (kind(f) == "VOID")), F.lit(False)), f).otherwise(out)
    out = F.when(F.coalesce(~kind("price_correct").isin("BOOLEAN", "VOID"), F.lit(False)), "price_correct").otherwise(out)
    for f in reversed(FLAGS):
        out = F.when(~F.coalesce(kind(f) == "BOOLEAN", F.lit(False)), f).otherwise(out)
    out = F.when(~F.coalesce(kind("rationale_short") == "STRING", F.lit(False)), "rationale_short").otherwise(out)
    out = F.when(~F.coalesce((kind("confidence") == "STRING") & text("confidence").isin(*CONFIDENCES), F.lit(False)), "confidence").otherwise(out)
    out = F.when(~F.coalesce((kind("decision") == "STRING") & text("decision").isin(*DECISIONS), F.lit(False)), "decision").otherwise(out)
    out = F.when(~F.coalesce(F.startswith(F.schema_of_variant(doc), F.lit("OBJECT")), F.lit(False)), "not an object").otherwise(out)
    return F.when(doc.isNull(), "not JSON").otherwise(out)


def summary(reviews: DataFrame) -> DataFrame:
    """Counts by decision: all, of each flag, retried and of each status."""
    n = lambda c: F.count_if(c)
    return reviews.groupBy("decision").agg(F.count("*").alias("n"), *(n(F.col(f)).alias(f) for f in FLAGS), n(F.col("retry_count") > 0).alias("retried"), n(F.col("status") == "recovered").alias("recovered"), n(F.col("status") == "invalid").alias("invalid"))


def by_category(reviews: DataFrame, facts: DataFrame) -> DataFrame:
    """Counts by category of the fact and decision."""
    own = reviews.join(facts.select(F.col("id").alias("fact_id"), "category"), "fact_id")
    return own.groupBy("category", "decision").agg(F.count("*").alias("n")).orderBy("category", "decision")


def corrected_fields(reviews: DataFrame) -> DataFrame:
    """How many reviews correct each field: by count descending, then name."""
    given = F.array(*(F.when(F.trim(F.col(f"corrected.{n}").cast("string")) != "", F.lit(n)) for n in CORRECTED))
    own = reviews.select(F.explode(F.filter(given, lambda x: x.isNotNull())).alias("field"))
    return own.groupBy("field").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "field")


__all__ = ["Recorder", "by_category", "corrected_fields", "probe", "latest", "mock_handler", "http_handler", "parse", "payload_error", "pending", "plan", "run", "summary", "truncate", "validate"]
