import json

import pytest
from pyspark.sql import functions as F

from oreloom.operators import links as L
from oreloom.operators import mentions as M
from oreloom.operators import rankings as R

CH = "homechannel"


def ent(*items):
    return json.dumps([{"type": "text_link", "text": t, "href": h} for t, h in items], ensure_ascii=False)


ROWS = [
    (1, "2024-01-01", "Стены RAL 7047 тёплый серый. Потолок S123", ent(("о проекте", f"https://t.me/{CH}/50"))),
    (2, "2024-01-02", "ЖК Север\nКраска Tikkurila Luja Extra, цвет стен зелёный G482", None),
    (3, "2024-01-03", "цвет стен 30YY 56/060 Dulux, рядом Tikkurila RAL 9016", ent(("о проекте", f"https://t.me/{CH}/50"), ("проект", f"https://t.me/{CH}/51"))),
    (4, "2024-01-04", "Духовка DEXP\nАрт. 1234567 в ДНС\n\nхолодильник от заказчика привезли", ent(("Духовка DEXP", "https://www.dns-shop.ru/product/duhovoj-skaf-dexp-m3/"))),
    (5, "2024-01-05", "Встроенный холодильник Bosch KIR81 купили", None),
    (6, "2024-01-06", "Шкаф и стеллаж сделали в VERESK\nМенеджер Анна +7 999 123-45-67\n\nКровать на заказ у мастера", ent(("VERESK", "https://wa.me/79991234567"), ("канал", f"https://t.me/{CH}/60"))),
    (7, "2024-01-07", "смотрите https://example.ru/page, цены", None),
    (8, "2024-01-08", None, None),
    (9, "2024-01-09", "стены RAL 7047", ent(("подборка других проектов", f"https://t.me/{CH}/50"))),
]


@pytest.fixture(scope="module")
def world(spark):
    messages = spark.createDataFrame(ROWS, "message_id long, date string, text_plain string, text_entities_json string")
    entities = L.extract_entities(messages).cache()
    mapping = spark.createDataFrame([(2, 50), (1, 50)], "message_id long, mapped_id long")
    links = L.link_projects(messages, entities, CH, mapping).cache()
    return messages, entities, links


def test_entities(world):
    rows = {(r.message_id, r.href): r for r in world[1].collect()}
    oven = rows[4, "https://www.dns-shop.ru/product/duhovoj-skaf-dexp-m3/"]
    assert (oven.start, oven.end, oven.source) == (0, 12, "entities")
    assert rows[7, "https://example.ru/page"].entity_type == "raw_url"
    raw = json.dumps({"text": [{"type": "link", "text": "https://a.ru/x"}]})
    assert L.message_entities("см. https://a.ru/x", None, raw, [])[0]["source"] == "raw_best"
    assert L.message_entities("нет", "[", None, ["{}", json.dumps({"caption_entities": [{"text": "нет", "href": "https://b.ru"}]})])[0]["source"] == "variant"


def test_cascade(world):
    rows = {r.message_id: (r.link_method, r.project_id, r.link_confidence) for r in world[2].collect()}
    assert rows[1] == ("explicit_project_link", 50, "high")
    assert rows[2] == ("same_message", 2, "high")
    assert rows[3] == ("ambiguous_metadata_match", None, "low")
    assert rows[9] == ("ambiguous_metadata_match", None, "low") and rows[8][0] == "ambiguous_metadata_match"


def test_paints(world):
    rows = M.paint_mentions(world[0], world[2]).collect()
    got = {(r.message_id, r.color_code): r for r in rows}
    assert set(got) == {(1, "RAL 7047"), (2, "G482"), (3, "30YY 56/060"), (3, "RAL 9016"), (9, "RAL 7047")}
    assert (got[2, "G482"].manufacturer, got[2, "G482"].product_line, got[2, "G482"].shade_family) == ("Tikkurila", "Luja Extra", "green")
    assert got[3, "30YY 56/060"].manufacturer == "Dulux" and got[3, "RAL 9016"].manufacturer == "Tikkurila"
    assert got[1, "RAL 7047"].shade_family == "greige" and got[1, "RAL 7047"].manufacturer is None


def test_codes_and_shades(spark):
    raw = ["Little Greene 59", "ral-7047", "NCS S 5030 - y60r", "30 yy  56 / 060", "g 482", "x"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string")
    assert [r.c for r in df.select("i", M.paint_code(F.col("t")).alias("c")).orderBy("i").collect()] == ["59", "RAL 7047", "S 5030-Y60R", "30YY 56/060", "G482", "X"]
    texts = {"терракотовый": "terracotta", "тёплый белый": "warm_white_milk", "светло-серый": "light_gray", "RAL 7047": "other", "серо-бежевый": "greige", "бежевые": "warm_beige", "синие": "blue"}
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", M.shade(F.col("t"))["family"].alias("f")).collect()
    assert {r.t: r.f for r in got} == texts


def test_appliances(world):
    rows = {(r.message_id, r.appliance_type): r for r in M.appliance_mentions(world[0], world[1], world[2]).collect()}
    oven = rows[4, "oven"]
    assert (oven.brand, oven.article_id, oven.merchant, oven.evidence_class, oven.confidence) == ("DEXP", "1234567", "DNS", "direct_product_link", "high")
    assert rows[4, "refrigerator_unconfirmed"].evidence_class == "customer_supplied"
    fridge = rows[5, "built_in_refrigerator"]
    assert (fridge.brand, fridge.model, fridge.evidence_class) == ("Bosch", "KIR81", "model_without_link")


def test_makers(world):
    rows = {r.maker_name: r for r in M.maker_mentions(world[0], world[1], world[2]).collect() if r.message_id == 6}
    own = rows["VERESK"]
    assert (own.classification, own.whatsapp, own.phone, own.person_name, own.what_was_made) == ("confirmed_maker", "https://wa.me/79991234567", "+79991234567", "Анна", "шкафы / гардеробная; стеллаж")
    assert rows[M.UNNAMED].confidence == "low" and rows[M.UNNAMED].whatsapp is None


def test_rankings(spark):
    rows = [(1, "RAL 7047", None, "a", "telegram:1", "P", "explicit_project_link", "high", "gray", "серый", "explicit_text", 0), (2, "RAL 7047", "Dulux", None, "telegram:1", "P", "same_message", "high", "gray", "серый", "explicit_text", 0), (3, "RAL 7047", None, None, "telegram:2", None, "same_message", "high", "other", None, "unknown", 0), (4, "G482", None, None, None, None, None, "low", "green", "зелёный", "explicit_text", 0)]
    m = spark.createDataFrame(rows, "message_id long, color_code string, manufacturer string, product_line string, project_key string, project_name string, link_method string, link_confidence string, shade_family string, shade_description string, shade_method string, start int")
    (p,) = R.rank_paints(m, spark.createDataFrame([("RAL 7047", 9)], "code string, n long")).collect()
    assert (p.unique_projects, p.unique_messages, p.branded_messages, p.linked_projects, p.single_post_projects, p.raw_facts, p.examples) == (2, 3, 1, 1, 1, 9, ["P", "telegram:2"])
    (s,) = R.rank_shades(m).collect()
    assert (s.shade_family, s.unique_projects, s.unique_messages, s.descriptions) == ("gray", 1, 2, ["серый"])
    assert {r.message_id: r.record_types for r in R.record_types(a=m, b=m.where("message_id = 1")).collect()}[1] == "a; b"
