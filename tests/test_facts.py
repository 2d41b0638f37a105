import pytest
from pyspark.sql import functions as F

from oreloom.operators import facts as X

TEXTS = {
    "wall": "Цвет стен G482\nЦвет стен акцентный 30YY 56/060\nTikkurila Symphony RAL 7047",
    "sofa": "Диван Divan.ru\nСлипсон Вельвет Зеленый 64 990₽",
    "coffee": "Журнальный столик Divan.ru Лимм Древесный 14 990₽",
    "facade": "Кухня фасады Дуб каселла натуральный+ Капучино гринвуд Mebel.in\n270 000₽",
    "facade2": "Кухня фасады Дуб каселла+Капучино Mebel.in 210 000₽",
    "splash": "Плитка на фартук Kerama Marazzi 2590₽/м2",
    "floor": "Плитка на полу Kerama Marazzi 2590₽/м2",
    "bathfloor": "Плитка в ванной на полу Kerama Marazzi 2590₽/м2",
    "mirror": "Зеркало в прихожей WB арт. 129109108 7431₽/шт.",
    "tv": "Тв тумба OZON\nАрт. 1639148968 15 147₽",
    "bundle1": "🌱Диваны, стулья, столик, тумба Divan.ru 242 440₽",
    "bundle2": "Диван, журнальный столик, тумба от divan.ru - 80.996₽",
    "bundle3": "🌱Кухня, шкафы в прихожей, шкаф в ванной Mebel.in 560 000₽",
    "bundle4": "Диван, кровать, прикроватные тумбочки, журнальный столик, вешалка divan.ru - 109.475 ₽",
    "chairs": "Стулья OZON Арт. 1851786582 10 964₽/шт.",
    "sofa2": "Диван Divan.ru Спейс-1 Коралловый 85 491₽",
    "lamp1": "Бра над диваном OZON Арт. 958601723 3087₽",
    "bed": "Кровать трансформер с диваном Guter mebel 120 100₽",
    "lamp2": "Настольная лампа OZON Арт. 2796002119 1198₽",
    "lamp3": "люстра над столом Алиэкспресс 34 459₽",
    "lamp4": "Люстра в гостиной OZON Арт. 2902627596 15 812₽",
    "shelves": "Полки в ванной OZON Арт. 1016863987 1290₽",
    "vinyl": "Кварцвинил + подложка Alpine floor 68.000 руб.\nПотолки 7 небо",
    "laminate": "Телевизор, стиральная машина и кондиционер на 100.000₽. Также заменили ламинат в спальне.",
    "handles": "Ручки на кухне OZON Арт. 1925710161 834₽/шт.",
    "none": None,
    "blank": "  \n ",
    "post": "Артикулы проекта\nЖК Люблинский парк\n\nКухня фасады Дуб каселла натуральный+ Капучино гринвуд Mebel.in\n270 000₽\n\nФартук Сантехника онлайн\nАрт. 621512 2590₽/м2\n\nСтол OZON\nАрт. 1550292417 14 157₽\n\nДиван Divan.ru\nСлипсон Вельвет Зеленый 64 990₽\n\n🌱Диваны, стулья, столик, тумба Divan.ru 242 440₽\n\nЦвет стен G482",
}


@pytest.fixture(scope="module")
def facts(spark):
    names = list(TEXTS)
    posts = spark.createDataFrame([(i, "2026-05-02T11:19:01", TEXTS[n], "all_text", None) for i, n in enumerate(names)], "message_id long, date string, text string, source_scope string, first_photo_path string")
    rows = X.with_ids(X.deduplicate_facts(X.extract_facts(posts))).collect()
    assert sorted(r.id for r in rows) == list(range(1, len(rows) + 1))
    return lambda name, category=None: [r for r in rows if names[r.message_id] == name and category in (None, r.category)]


def test_wall_colors(facts):
    own = facts("wall", "wall_colors")
    assert {"G482", "30YY 56/060", "RAL 7047"} <= {f.color_code for f in own}
    assert {f.item_type for f in own if f.color_code == "30YY 56/060"} == {"wall_color_accent"}
    assert {f.brand_normalized for f in own} == {"Tikkurila"} and {f.confidence for f in own} == {"high"}


def test_sofas(facts):
    (f,) = facts("sofa", "sofas")
    assert (f.item_type, f.vendor_normalized, f.model, f.material, f.color, f.price_value) == ("sofa", "Divan.ru", "Слипсон", "Вельвет", "Зеленый", 64990)
    assert not facts("coffee", "sofas")
    assert facts("sofa2", "sofas")[0].model.startswith("Спейс-1")
    assert all(f.needs_review for n in ("lamp1", "bed") for f in facts(n, "sofas"))


def test_tables_and_chairs(facts):
    (f,) = facts("coffee", "tables")
    assert (f.item_type, f.model) == ("coffee_table", "Лимм Древесный")
    assert all(f.needs_review for n in ("lamp2", "lamp3") for f in facts(n, "tables"))
    (f,) = facts("chairs", "chairs")
    assert (f.item_type, f.item_name, f.article_id, f.price_unit) == ("chair", None, "1851786582", "шт")


def test_kitchens(facts):
    (f,) = facts("facade", "kitchens")
    assert (f.item_type, f.vendor_normalized, f.finish, f.price_value) == ("kitchen_facades", "Mebel.in", "Дуб каселла натуральный+ Капучино гринвуд", 270000)
    (f,) = facts("facade2", "kitchens")
    assert (f.finish, f.confidence, f.needs_review) == ("Дуб каселла+Капучино", "high", False)
    assert all(f.needs_review for f in facts("handles", "kitchens"))


def test_flooring(facts):
    assert not facts("splash", "flooring")
    assert facts("floor", "flooring")[0].item_type == "flooring_tile"
    for name, room in (("bathfloor", "bathroom"), ("laminate", "bedroom")):
        (f,) = facts(name, "flooring")
        assert f.needs_review and f.room_context == room
    (f,) = facts("vinyl", "flooring")
    assert "Alpine floor" in f.material and "Потолки" not in f.material


def test_hallway_and_living_room(facts):
    (f,) = facts("mirror", "hallway")
    assert (f.item_type, f.vendor_normalized, f.article_id) == ("mirror", "Wildberries", "129109108")
    (f,) = facts("tv", "living_room_furniture")
    assert (f.item_type, f.vendor_normalized, f.article_id) == ("tv_unit", "OZON", "1639148968")
    assert all(f.needs_review for f in facts("lamp4", "living_room_furniture"))
    (f,) = facts("shelves", "living_room_furniture")
    assert f.needs_review and f.room_context == "bathroom"


def test_bundles(facts):
    for name in ("bundle1", "bundle2", "bundle3", "bundle4"):
        own = facts(name)
        assert any(f.item_type == "bundle_purchase" and f.needs_review for f in own)
        assert all(f.needs_review for f in own)


def test_whole_post(facts):
    own = facts("post")
    assert len(own) >= 5 and {f.project_name for f in own} == {"ЖК Люблинский парк"}
    assert {"kitchen_facades", "backsplash", "table", "sofa", "bundle_purchase", "wall_color"} <= {f.item_type for f in own}
    assert not [f for f in own if f.item_type == "bundle_purchase" and not f.needs_review]


def test_nothing_in_nothing(facts):
    assert not facts("none") and not facts("blank")


def test_scopes(spark):
    posts = spark.createDataFrame([(1, "2024", "Артикулы проекта", None), (2, "2024", "Кухня фасады", None), (3, "2024", "погода", None), (4, "2024", None, None)], "message_id long, date string, text string, first_photo_path string").withColumn("photo_count", F.lit(0))
    ids = lambda scope, **k: [r.message_id for r in X.source_posts(posts, scope, **k).orderBy("message_id").collect()]
    assert ids("all_text") == [1, 2, 3] and ids("project_articles") == [1] and ids("candidates") == [2] and ids("all_text", limit=2) == [1, 2]


def test_each_distinct_block_is_parsed_once(spark, capsys):
    """Posts share their blocks: frequent ones, rare ones and one that a post holds twice."""
    price = lambda i: f"Стул Loft {5000 + i} ₽"
    posts = spark.range(2500).selectExpr("id AS message_id", "'2026' AS date", "concat_ws('\n\n', 'Комод Malm 7 990₽', concat('Стул Loft ', 5000 + id div 2, ' ₽'), 'Комод Malm  7 990₽') AS text", "'all_text' AS source_scope", "CAST(NULL AS string) AS first_photo_path")
    found = X.extract_facts(posts)
    found.explain()
    assert "HashAggregate(keys=[block" in capsys.readouterr().out
    rows = found.collect()
    assert sorted((r.message_id, r.item_type, r.evidence_quote, int(r.price_value)) for r in rows) == sorted(x for i in range(2500) for x in ((i, "chest", "Комод Malm 7 990₽", 7990), (i, "chair", price(i // 2), 5000 + i // 2)))
    assert all(a.ord < b.ord for a in rows for b in rows[:50] if a.message_id == b.message_id and a.item_type == "chest" and b.item_type == "chair")


def test_stems_rule_out_only_what_cannot_match(spark):
    from oreloom.functions import text as T

    assert T.stems(r"стол(?:ы|а)?|кварц[\s-]?винил|wb|леруа(?!\s*мерлен)|ab?c|(?:x|y)z") == ("стол", "кварц", "wb", "леруа", "a", "")
    words = ["DİVAN", "dıvan", "DIVAN", "ОБУВНИЦА", "wıldberrieſ", "диваны", "иванов"]
    row = spark.createDataFrame([(w,) for w in words], "w string")
    forms = r"divan|обувниц(?:а|ы)?|wildberries|диван(?:ы)?"
    got = row.select("w", T.has_word(F.col("w"), forms, T.folded(F.col("w"))).alias("fast"), T.has(F.col("w"), T.word_pattern(forms)).alias("plain")).collect()
    assert all(r.fast == r.plain for r in got) and [r.plain for r in got] == [True] * 6 + [False]
