from pyspark.sql import functions as F

from oreloom import rules
from oreloom.functions import parse as P
from oreloom.functions import text as T
from oreloom.operators import candidates as C


def values(spark, texts, column):
    return [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", column.alias("v")).orderBy("i").select("v").collect()]


def test_prices(spark):
    got = values(spark, ["270 000₽", "270 000 руб.", "14 157₽", "6200 руб./шт.", "2590₽/м2", "7 431₽/шт.", "12 054 руб./пара", "80.996₽", "270 000₽", "350 растений", "цена 900 р за пару стульев", "нет цены", None, ""], P.price(F.col("t")))
    assert [None if v is None else (v.value, v.unit) for v in got] == [(270000, None), (270000, None), (14157, None), (6200, "шт"), (2590, "м2"), (7431, "шт"), (12054, "пара"), (80996, None), (270000, None), None, (900, "пара"), None, None, None]


def test_articles(spark):
    got = values(spark, ["OZON Арт. 1550292417", "WB Арт. 498029528", "ЯМ Арт. 102727930434", "Код: 549902", "Арт.1179015456", "Сантехника онлайн Арт. 621512", "артикул 9110581", "промокод HOUSE5 -2%", "Артикулы проекта"], P.article(F.col("t")))
    assert [None if v is None else (v.article_id, v.vendor_normalized, v.marketplace) for v in got] == [
        ("1550292417", "OZON", "OZON"), ("498029528", "Wildberries", "Wildberries"), ("102727930434", "Yandex Market", "Yandex Market"), ("549902", None, None),
        ("1179015456", None, None), ("621512", "Сантехника Онлайн", None), ("9110581", None, None), None, None,
    ]


def test_vendor_names(spark):
    raw = ["Divan.ru", "Диван ру", "official_divan.ru", "Mebel in", "мебель инн", "Озон", "ВБ", "Яндекс маркет", "Лемана Про", "Леруа Мерлен", "Сантехника онлайн", "veresk_mebel", "Хофф", " @Чужой дом ", ""]
    assert values(spark, raw, P.normalize_vendor(F.col("t"))) == ["Divan.ru", "Divan.ru", "Divan.ru", "Mebel.in", "Mebel.in", "OZON", "Wildberries", "Yandex Market", "Лемана Про", "Леруа Мерлен", "Сантехника Онлайн", "VERESK", "HOFF", "Чужой дом", None]


def test_earliest_vendor(spark):
    got = values(spark, ["стол OZON или WB", "WB, потом OZON", "ничего"], P.vendor(F.col("t")))
    assert [v and v.normalized for v in got] == ["OZON", "Wildberries", None]


def test_project_names(spark):
    texts = ["Артикулы проекта ЖК Люблинский парк Кухня фасады Дуб", "Артикулы проекта\nЖК Кольская 8\n\nСтол OZON", "Артикулы проекта Матвеевский парк\n\nДиван Divan.ru", "ЖК Второй Нагатинский\n\nПокупки:", "ЖК Астра Марин, Санкт-Петербург\n\nПокупки:", "Просто текст", None]
    assert values(spark, texts, P.project_name(F.col("t"))) == ["ЖК Люблинский парк", "ЖК Кольская 8", "Матвеевский парк", "ЖК Второй Нагатинский", "ЖК Астра Марин, Санкт-Петербург", None, None]


def test_color_codes_and_brand(spark):
    text = "Tikkurila Symphony RAL 7047 и G482, 30YY 56/060, NCS S 5030-Y60R"
    assert values(spark, [text], P.color_codes(F.col("t"))) == [["RAL 7047", "G482", "30YY 56/060", "NCS S 5030-Y60R"]]
    assert values(spark, [text, "v33 белая"], P.brand(F.col("t"))["normalized"]) == ["Tikkurila", "V33"]


def test_text_functions(spark):
    assert values(spark, ["  a b \n c ", None], T.compact(F.col("t"))) == ["a b c", None]
    assert values(spark, ["Ёлка  НА Полу"], T.match_form(F.col("t"))) == ["елка на полу"]
    assert values(spark, ["abcdefghij", "abc"], T.truncate(F.col("t"), 6)) == ["abc...", "abc"]
    assert values(spark, ["x " * 400 + "ламинат" + " y" * 400], T.excerpt(F.col("t"), ["ламинат"], width=50))[0].startswith("...x")
    assert "ламинат" in values(spark, ["x " * 400 + "ламинат" + " y" * 400], T.excerpt(F.col("t"), ["ламинат"], width=50))[0]
    assert values(spark, ["1", "12", "22", "25", "111"], T.plural(F.col("t").cast("int"), "строка", "строки", "строк")) == ["строка", "строк", "строки", "строк", "строк"]
    assert values(spark, ["900", "2048", "5242880"], T.format_bytes(F.col("t").cast("long"))) == ["900 B", "2.0 KB", "5.0 MB"]


def test_model_material_color(spark):
    got = values(spark, ["Слипсон Вельвет Зеленый", "Лимм серый", "Один два три", None], P.model_material_color(F.col("t")))
    assert [v and tuple(v) for v in got] == [("Слипсон", "Вельвет", "Зеленый"), ("Лимм", None, "серый"), ("Один два три", None, None), None]


def scores(spark, category, *texts, photos=0):
    own = tuple(c for c in rules.CATEGORIES if c.name == category)
    df = spark.createDataFrame(list(enumerate(texts)), "message_id int, text string").withColumn("date", F.lit("2024"))
    return {r.message_id: r for r in C.score_posts(df, own, photos=F.lit(photos)).collect()}


def test_categories(spark):
    assert not scores(spark, "flooring", "полка над диваном", "полотенце на крючке", "полезные советы", "пол", "")
    assert min(r.score for r in scores(spark, "flooring", "плитка на пол", "напольное покрытие", "кварцвинил").values()) >= 3
    kitchen = scores(spark, "kitchens", "Кухня фасады Дуб Каселла")[0]
    assert kitchen["rank"] == 2 and "дуб каселла" in kitchen.strong
    assert {r["rank"] for r in scores(spark, "wall_colors", "Цвет стен RAL 7047", "Tikkurila Symphony G482").values()} == {2}
    sofa = scores(spark, "sofas", "Divan.ru Слипсон Velvet Emerald")[0]
    assert sofa["rank"] == 2 and {"divan.ru", "velvet emerald"} <= set(sofa.strong)
    assert scores(spark, "hallway", "Шкаф распашной", photos=1)[0]["rank"] == 0
    assert scores(spark, "tables", "Кухня и столешница")[0]["rank"] == 0


def test_article_terms(spark):
    df = spark.createDataFrame([(1, "2024", "Артикулы проекта"), (2, "2024", "Купить все артикулы"), (3, "2024", "ничего"), (4, None, "Промокод HOUSE внутри"), (5, None, None)], "message_id int, date string, text string")
    assert {r.message_id: r.article_terms for r in C.article_posts(df, owner="HOUSE").collect()} == {1: ["Артикулы проекта"], 2: ["Купить все артикулы"], 4: ["промокод HOUSE"]}


def test_formats(spark):
    df = spark.createDataFrame([(64990.0, None, "шт", "2024-01-02T10:00", '{"b": 1, "a": [2]}'), (None, "RUB", None, None, "{")], "v double, c string, u string, d string, j string")
    got = df.select(T.format_price(F.col("v"), F.col("c"), F.col("u")), T.format_day(F.col("d")), T.canonical_json(F.col("j")), T.post_url("home", F.lit(5))).collect()
    assert [tuple(r) for r in got] == [("64 990 ₽/шт", "2024-01-02", '{"a":[2],"b":1}', "https://t.me/home/5"), (None, None, None, "https://t.me/home/5")]
