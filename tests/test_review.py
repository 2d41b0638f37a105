import json

import pytest
from pyspark.sql import functions as F

from oreloom.operators import effective as E
from oreloom.operators import review as R
from oreloom.operators import sampling as S

GOOD = json.loads(R.mock_handler("", ""))
FACT = "id long, message_id long, date string, category string, item_type string, item_name string, vendor_raw string, vendor_normalized string, brand_raw string, brand_normalized string, model string, material string, finish string, color string, color_code string, article_id string, marketplace string, price_value decimal(12,2), price_currency string, price_unit string, room_context string, evidence_quote string, confidence string, needs_review boolean, notes string"


def fact(i, **k):
    from decimal import Decimal

    own = {"id": i, "message_id": 100 + i, "date": f"2024-01-{i:02d}", "category": "sofas", "item_type": "sofa", "evidence_quote": "Диван Divan.ru Слипсон 64 990₽", "confidence": "high", "needs_review": False, "price_value": Decimal(64990)} | k
    return tuple(own.get(c.split()[0]) for c in FACT.split(", "))


def review(i, **k):
    return {"fact_id": i} | R.validate(GOOD | k)


@pytest.fixture(scope="module")
def dataset(spark):
    facts = spark.createDataFrame([
        fact(1), fact(2, needs_review=True), fact(3, needs_review=True, model=None), fact(4, category="tables", item_type="table"), fact(5), fact(6, needs_review=True), fact(7), fact(8), fact(9), fact(10, confidence="low"),
        fact(11, category="garden"), fact(12, evidence_quote="о жизни " * 60, price_value=None), fact(13),
    ], FACT)
    rows = [
        review(3, corrected={"model": "Слипсон", "vendor_normalized": "диван ру"}), review(4, decision="fix", category_correct=False, corrected={"category": "sofas", "item_type": "sofa"}), review(5, decision="discard"), review(6, decision="needs_human"),
        review(7, category_correct=False), review(8, is_context_false_positive=True), review(9, price_correct=False), review(13, decision="fix", corrected={"model": "Неназванный"}),
    ]
    reviews = spark.createDataFrame([tuple(r.values()) for r in rows], f"fact_id long, {R.PAYLOAD}")
    return E.build(facts, reviews)


def test_decisions(dataset):
    rows = {r.id: r for r in dataset.collect()}
    reasons = {i: r.exclusion_reason for i, r in rows.items()}
    assert reasons == {1: None, 2: "needs_review_without_review", 3: None, 4: None, 5: "review_discard", 6: "review_needs_human", 7: "review_category_conflict", 8: "review_context_false_positive", 9: None, 10: "below_min_confidence", 11: "outside_categories", 12: "general_or_non_concrete_evidence", 13: "review_fix_not_coherent"}
    assert (rows[3].e_model, rows[3].e_vendor) == ("Слипсон", "Divan.ru")
    assert rows[4].e_category == "sofas" and rows[9].e_price_value is None and not rows[9].e_price_reliable and rows[1].e_price_value == 64990
    assert [r.id for r in E.used(dataset).collect()] == [9, 4, 3, 1]
    counts = {(r.kind, r.name): r.n for r in E.counters(dataset).collect()}
    assert counts["decision", "keep"] == 4 and counts["applied", "fix"] == 1 and counts["applied", "price_hidden"] == 1


@pytest.mark.parametrize("change", [{"decision": "maybe"}, {"confidence": 1}, {"is_bundle": 1}, {"price_correct": "yes"}, {"corrected": {"price_value": True}}, {"corrected": {"category": "garden"}}, {"normalized_terms": {"facade_materials": [1]}}, {"rationale_short": None}, {"corrected": []}])
def test_payload_errors(spark, change):
    with pytest.raises(R.InvalidPayload):
        R.validate(GOOD | change)


def test_payload_errors_as_columns(spark):
    texts = [json.dumps(GOOD), "{", "[]", json.dumps(GOOD | {"decision": "maybe"}), json.dumps(GOOD | {"is_bundle": 1}), json.dumps(GOOD | {"price_correct": "x"}), json.dumps(GOOD | {"corrected": 3}), None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", R.payload_error(F.col("t")).alias("e"))
    assert [r.e for r in df.orderBy("i").collect()] == [None, "not JSON", "not an object", "decision", "is_bundle", "price_correct", "corrected", "not JSON"]


def test_retry_and_fallback():
    answers = iter(["no json", "still none"])
    bad = R.review_one(lambda s, p: next(answers), "p")
    assert (bad["decision"], bad["retry_count"], bad["status"]) == ("needs_human", 1, "invalid")
    answers = iter(["{}", "text " + json.dumps(GOOD) + " more"])
    good = R.review_one(lambda s, p: next(answers), "p")
    assert (good["decision"], good["status"]) == ("keep", "recovered")

    def down(s, p):
        raise OSError("down")

    assert R.review_one(down, "p")["status"] == "failed"


def test_run_and_resume(spark):
    facts = spark.createDataFrame([fact(i) for i in range(1, 6)], FACT)
    posts = spark.createDataFrame([(101, "пост"), (102, " ")], "message_id long, text string")
    planned = R.plan(facts, posts)
    assert [r.excerpt for r in planned.where("id <= 2").orderBy("id").collect()] == ["пост", "Диван Divan.ru Слипсон 64 990₽"]
    done = R.run(planned.where("id <= 2"), R.mock_handler, "mock", "m")
    rows = done.collect()
    assert len(rows) == 2 and {r.status for r in rows} == {"valid"}
    assert R.pending(planned, done, "mock", "m").count() == 3 and R.pending(planned, done, "mock", "other").count() == 5
    assert R.summary(done).first().n == 2


def test_later_reviews_win(spark):
    a = spark.createDataFrame([(1, 1, "keep"), (2, 1, "fix"), (3, 2, "keep")], "id long, fact_id long, decision string")
    b = spark.createDataFrame([(1, 2, "discard")], "id long, fact_id long, decision string")
    assert {r.fact_id: r.decision for r in R.latest(a, b).collect()} == {1: "fix", 2: "discard"}


def test_samples(spark):
    cats = ["sofas", "tables", "chairs"]
    df = spark.createDataFrame([(i, cats[i % 7 % 3], i % 4 == 0, "bundle purchase" if i % 8 == 0 else None) for i in range(300)], "id long, category string, needs_review boolean, notes string")
    for source, k in (("clean", {}), ("needs_review", {}), ("mixed", {}), ("category", {"category": "sofas"})):
        one = [r.id for r in S.select_sample(df, source, 30, 42, **k).collect()]
        assert one == [r.id for r in S.select_sample(df.repartition(5), source, 30, 42, **k).collect()] == sorted(one) and len(one) == 30
    got = S.select_sample(df, "mixed", 30, 42).collect()
    assert {r.needs_review for r in got} == {True, False}
    by = S.stratified(df, F.col("category"), 30, 1).groupBy("category").count().collect()
    assert min(r["count"] for r in by) >= 10
    assert S.simple(df, 500, 1).count() == 300 and S.simple(df, 0, 1).count() == 0
