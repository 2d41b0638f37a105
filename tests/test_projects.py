import json

import pytest
from pyspark.sql import functions as F

from oreloom.operators import projects as P

CH = "homechannel"
FACTS = "id long, message_id long, date string, category string, item_type string, item_name string, vendor_normalized string, vendor_raw string, marketplace string, brand_normalized string, brand_raw string, model string, material string, finish string, color string, color_code string, price_value double, price_currency string, price_unit string, evidence_quote string"


def fact(i, m, kind, **k):
    own = {"id": i, "message_id": m, "date": "2024-03-01T10:00:00", "category": "kitchens", "item_type": kind, "evidence_quote": f"{kind} {i}"} | k
    return tuple(own.get(c.split()[0]) for c in FACTS.split(", "))


@pytest.fixture(scope="module")
def report(spark):
    link = json.dumps([{"type": "text_link", "text": "Артикулы проекта", "href": f"https://t.me/{CH}/200"}])
    other = json.dumps([{"type": "text_link", "text": "тариф проекта, скидка", "href": f"https://t.me/{CH}/999"}])
    messages = spark.createDataFrame([
        (100, "2024-03-01T10:00:00", "Артикулы проекта здесь", link), (101, "2024-03-01T11:00:00", f"о проекте https://t.me/{CH}/200?single", None), (200, "2024-03-01T09:00:00", "ЖК Северный парк\nМосква\nСтудия 30 м2\nДизайнер: Анна Иванова", None),
        (201, "2024-03-01T09:01:00", "", None), (205, "2024-03-02T09:01:00", "", None), (206, "2024-03-01T09:02:00", "длинный текст " * 30, None), (300, "2024-03-03T10:00:00", "просто кухня", other), (700, "2024-03-04T10:00:00", None, None),
    ], "message_id long, date string, text_plain string, text_entities_json string")
    photos = spark.createDataFrame([(200, 1, "/a.jpg"), (201, 1, "/b.jpg"), (201, 2, "/a.jpg"), (205, 1, "/c.jpg"), (206, 1, "/d.jpg"), (300, 1, "/e.jpg"), (100, 1, "/f.jpg")], "message_id long, photo_no int, path string")
    kitchen = spark.createDataFrame([
        fact(1, 100, "kitchen_facades", finish="Дуб каселла + Капучино", vendor_normalized="Mebel.in", price_value=270000.0), fact(2, 101, "countertop", material="Столешница камень белый"), fact(3, 101, "backsplash", material="Плитка мрамор"),
        fact(4, 300, "kitchen_facades", finish="задача"), fact(5, 700, "bundle_purchase"), fact(6, 100, "kitchen_facades", finish="дуб Каселла + капучино"),
    ], FACTS)
    context = spark.createDataFrame([fact(7, 200, "wall_color", category="wall_colors", color_code="RAL 7047 белый"), fact(8, 101, "flooring_tile", category="flooring", material="плитка форст")], FACTS)
    return {r.project_id: r for r in P.palette_report(kitchen, context, messages, photos, CH, "автор").collect()}


def test_grouping(report):
    assert sorted(report) == [200, 300, 700] and report[200].source_ids == [100, 101]
    p = report[200]
    assert (p.object.name, p.object.source, p.city, p.area_type, p.designer.name) == ("ЖК Северный парк", "complex", "Москва", "Студия 30 м2", "Дизайнер Анна Иванова")
    assert p.facade == "Дуб каселла + Капучино" and p.facade_parts == ["Дуб каселла", "Капучино"] and p.vendors == ["Mebel.in"] and p.prices == ["kitchen_facades: 270000 ₽"]
    assert p.wall_color == "RAL 7047 белый" and p.flooring == "плитка форст"
    assert p.photo_paths == ["/a.jpg", "/f.jpg", "/b.jpg"]
    assert report[300].designer.name == "автор" and report[700].object.source == "fallback_post_id"


def test_quality_and_palette(report):
    assert (report[200].quality_tier, report[200].palette, report[200].selected, report[200].exclusion_reason) == ("high", "wood_neutral", True, None)
    assert "light_facade_stone_accent" in report[200].other_palettes
    assert report[700].exclusion_reason == "bundle_only" and report[300].quality_tier == "low" and not report[300].selected


def test_value_predicates(spark):
    rows = spark.createDataFrame([("Дуб каселла + Капучино",), ("задача",), ("Premium white",), (None,), ("сдать квартиру",), ("Алюмика",)], "t string").select(P.noise(F.col("t")), P.clean_palette(F.col("t")), P.strong_facade(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(False, True, True), (True, False, False), (False, True, True), (True, False, False), (True, False, False), (True, False, False)]


def test_quota(spark):
    rows = [("a", "high", i) for i in range(2)] + [("a", "medium", i) for i in range(5)] + [("b", "high", i) for i in range(8)] + [("b", "medium", 1), (None, "high", 1)]
    out = P.quota_fill(spark.createDataFrame(rows, "g string, t string, s int"), "g", "t", [F.desc("s")], 6).where("selected").groupBy("g", "t").count().collect()
    assert {(r.g, r.t): r["count"] for r in out} == {("a", "high"): 2, ("a", "medium"): 4, ("b", "high"): 6}
