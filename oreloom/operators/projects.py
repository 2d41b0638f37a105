"""Projects: facts of several messages grouped under the post their links lead to, scored and classified.

A project's key is always the id of its post; equal names never merge projects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_optional, compact, contains_any, first_match, has, let, lines, match_form, ordered_distinct, quoted, strip

# Words of palettes and of phrases that say nothing of one.
NOISE_EXACT = ("задача", "арт", "артикул", "кухня", "на кухне", "в кухне", "рабочее", "панель", "алюмика")
NOISE_PHRASES = ("функциональность", "максимальное количество мест хранения", "заказчики на полном доверии", "и панель мы тоже сделали", "практически как на заказ", "обратите внимание", "задача:", "на кухне из акрила")
PALETTE = ("дуб", "каселла", "орех", "карини", "гикори", "чарльстон", "капучино", "латте", "кашемир", "меренга", "нубук", "сапфир", "эбони", "зелен", "олив", "графит", "мдф", "premium white", "премиум вайт", "бел", "светл", "пластик", "доминикана", "форст", "камень", "мрамор", "grandex", "laparet", "сантехника онлайн", "лемана", "rusplitka", "фартук", "столешниц", "плитк")
FACADE = ("фасад", "мдф", "дуб", "орех", "гикори", "каселла", "карини", "чарльстон")
WOOD = ("дуб", "каселла", "орех", "гикори", "мадейра", "карини", "чарльстон", "дерево", "древес", "wood", "oak", "walnut", "hickory")
LIGHT_WOOD = ("дуб", "каселла", "карини", "мадейра", "светл")
NEUTRAL = ("капучино", "кашемир", "латте", "меренга", "бел", "молоч", "тальк", "беж", "сер", "софт", "нубук", "greige", "грейдж")
ACCENT = ("зелен", "олив", "сапфир", "эбони", "терракот", "бургунди", "син", "голуб", "бирюз", "темн", "холодный серый", "безмолвная пустыня", "сатин", "кастелло", "графит", "антрацит", "черн")
DARK = ("зелен", "олив", "сапфир", "эбони", "терракот", "бургунди", "син", "голуб", "бирюз", "темн", "графит", "антрацит")
LIGHT = ("бел", "светл", "меренг", "premium white", "премиум вайт", "кашемир", "тальк", "молоч")
VENDORS = ("mebel.in", "мебел", "леруа", "лемана", "сантехника онлайн", "rusplitka", "laparet", "grandex")
PLAIN_WORDS = ("арт", "артикул", "кухня", "фартук", "столешница")
CITIES = ("Санкт-Петербург", "Москва", "Казань", "Сочи")
DIRECT_TYPES = ("kitchen_facades", "countertop", "backsplash")
HIGH, MEDIUM = 8, 5
NEIGHBOURS, ALBUM_CHARS, MAX_PHOTOS = 8, 180, 12
#: Palettes in the order of ties.
PALETTES = ("wood_neutral", "wood_nature_accent", "light_facade_stone_accent")


def channel_link(channel: str, base: str = r"https?://t\.me/") -> str:
    """A pattern of links to posts of a channel; group 1 is the post's id."""
    return rf"(?i){base}(?:s/)?{quoted(channel)}/(\d+)(?:\?single)?"


def link_context(text: Column, context: Column) -> Column:
    """A link that speaks of a project, not of tariffs, codes or discounts."""
    said = lambda t: contains_any(t, ("проект",)) & ~(contains_any(t, ("тариф", "промокод", "скидк")) & ~contains_any(t, ("артикул",)))
    return let(match_form(F.concat_ws(" ", text, context)), said)


def around(text: Column, needle: Column, width: int = 80) -> Column:
    """What stands around the first place of needle."""
    return let(F.position(needle, F.coalesce(text, F.lit(""))), lambda at: F.when(at > 0, F.substring(text, F.greatest(F.lit(1), at - width), F.length(needle) + 2 * width)).otherwise(F.lit("")))


def resolve_posts(messages: DataFrame, channel: str) -> DataFrame:
    """(message_id, project_id): the post that a message's first project link leads to, else the message itself.

    Links are the message's entities (JSON) in order, then links in its text that no entity has.
    """
    p = channel_link(channel)
    entity = F.from_json(F.coalesce("text_entities_json", F.lit("[]")), "array<struct<text:string,href:string>>")
    own = messages.select("message_id", "text_plain", F.coalesce(entity, F.array().cast("array<struct<text:string,href:string>>")).alias("e"))
    linked = F.filter(F.transform("e", lambda x, i: F.struct(i.alias("i"), first_match(x["href"], p, 1).try_cast("bigint").alias("id"), compact(F.coalesce(x["text"], F.lit(""))).alias("text"))), lambda x: x["id"].isNotNull())
    typed = F.transform(F.regexp_extract_all(F.coalesce("text_plain", F.lit("")), F.lit(f"({p})"), F.lit(1)), lambda x, i: F.struct((i + 1_000_000).alias("i"), first_match(x, p, 1).try_cast("bigint").alias("id"), x.alias("text")))
    own = own.withColumns({"linked": linked, "typed": typed})
    every = F.concat("linked", F.filter("typed", lambda t: ~F.exists("linked", lambda x: x["id"] == t["id"])))
    found = own.select("message_id", "text_plain", F.explode(every).alias("x")).where(link_context(F.col("x.text"), around(F.col("text_plain"), F.col("x.text"))))
    first = found.groupBy("message_id").agg(F.min_by("x.id", "x.i").alias("project_id"))
    return messages.select("message_id").distinct().join(first, "message_id", "left").withColumn("project_id", F.coalesce("project_id", "message_id"))


def clean_value(c: Column) -> Column:
    own = compact(F.regexp_replace(c, r"^[\s\"'«».,:;—–-]+|[\s\"'«».,:;—–-]+$", ""))
    return F.when(F.length(own) > 120, strip(F.regexp_replace(own, r"[.!?]\s+[\s\S]*$", ""), " .,:;—–-")).otherwise(own)


def noise(c: Column) -> Column:
    """A phrase that says nothing of a palette; also null and blank."""

    def of(text):
        low = match_form(text)
        pair = F.contains(text, F.lit("+")) | F.contains(low, F.lit(" и "))
        long = (F.length(text) > 90) & ~(pair & contains_any(low, PALETTE) & contains_any(low, ("фасад", "мдф", "дуб", "орех", "гикори", "каселла", "карини")))
        talk = has(low, r"(?U)\b(сдать|аренд|продать|хранени[ея]|доверии|пожелани[ея])\b") & ~(contains_any(low, PALETTE) & pair)
        return (text == "") | low.isin(*NOISE_EXACT) | F.startswith(low, F.lit("задача")) | contains_any(low, NOISE_PHRASES) | long | talk

    return F.coalesce(let(clean_value(c), of), F.lit(True))


def clean_palette(c: Column) -> Column:
    of = lambda text: ~noise(text) & (F.length(text) >= 2) & (contains_any(match_form(text), PALETTE) | has(text, r"\b\d{3,5}\b"))
    return F.coalesce(let(clean_value(c), of), F.lit(False))


def strong_facade(c: Column) -> Column:
    def of(text):
        low = match_form(text)
        white = contains_any(low, ("premium white", "премиум вайт"))
        pair = has(text, "[+;,]") | F.contains(low, F.lit(" и "))
        return ~noise(text) & (white | (contains_any(low, FACADE) & contains_any(low, WOOD + NEUTRAL + ACCENT + LIGHT) & (pair | contains_any(low, ("мдф", "нубук")))))

    return F.coalesce(let(clean_value(c), of), F.lit(False))


def useful_value(c: Column) -> Column:
    return F.coalesce(F.length(compact(c)).between(2, 220) & ~match_form(c).isin(*PLAIN_WORDS), F.lit(False))


def facade_parts(c: Column) -> Column:
    parts = F.filter(F.split(c, r"(?iU)\s*(?:\+|,|;|/|\band\b|\bи\b)\s*"), lambda x: useful_value(x) & clean_palette(x))
    return ordered_distinct(F.transform(parts, clean_value), match_form)


def primary_value(fields: tuple[str, ...] = ("finish", "material", "model", "color_code", "color", "brand_normalized", "brand_raw", "item_name")) -> Column:
    """The first field of a fact that holds a clean palette value."""
    return F.coalesce(*(let(clean_value(F.col(f)), lambda v: F.when(useful_value(v) & clean_palette(v), v)) for f in fields))


def object_name(text: Column, date: Column, post: Column) -> Column:
    """Struct (name, source) of the object a post shows: a housing complex, a street, else the post itself."""
    named = lambda x: strip(F.regexp_replace(compact(F.concat(F.lit("ЖК "), F.regexp_extract(x, r"(?iU)\bЖК\.?\s+(.+)", 1))), r"\s*[|•].*$", ""), " .,:;-")

    def of(ls):
        jk = F.get(F.filter(F.transform(F.filter(F.slice(ls, 1, 20), lambda x: has(x, r"(?iU)\bЖК\.?\s+.+")), named), lambda x: x != ""), F.lit(0))
        street = F.get(F.filter(F.slice(ls, 1, 25), lambda x: has(x, r"(?iU)\b(ул\.|улица|проспект|пр-т|бульвар|шоссе|переулок|наб\.|набережная)(?![\p{L}])")), F.lit(0))
        day = F.coalesce(F.nullif(F.split_part(date, F.lit("T"), F.lit(1)), F.lit("")), F.lit("без даты"))
        whole = F.concat(F.lit("Пост от "), day, F.lit(", message_id="), post.cast("string"))
        return F.struct(F.coalesce(jk, strip(compact(street), " .,:;-"), whole).alias("name"), F.when(jk.isNotNull(), "complex").when(street.isNotNull(), "street").otherwise("fallback_post_id").alias("source"))

    return let(meaningful_lines(text), of)


def meaningful_lines(text: Column) -> Column:
    return F.filter(F.transform(lines(F.coalesce(text, F.lit(""))), compact), lambda x: x != "")


def city(text: Column) -> Column:
    def of(ls):
        first = F.get(F.filter(F.transform(F.slice(ls, 1, 20), lambda x: F.coalesce(*(F.when(F.contains(F.lower(x), F.lit(c.lower())), F.lit(c)) for c in CITIES))), lambda x: x.isNotNull()), F.lit(0))
        return first

    return let(meaningful_lines(text), of)


def area_type(text: Column) -> Column:
    kind, size = r"(?U)\b(студия|евро\s*-?\s*\d|[1234]\s*-?\s*комнат)", r"(?U)\b\d+(?:[,.]\d+)?\s*(?:м2|м²|кв\.?\s*м|кв\.)"
    return let(meaningful_lines(text), lambda ls: F.get(F.filter(F.slice(ls, 1, 15), lambda x: has(match_form(x), kind) & has(match_form(x), size)), F.lit(0)))


def designer(text: Column, default: str) -> Column:
    """Struct (name, source): the designers or home stagers credited in the first 30 lines, else the default."""
    p = r"(?iU)\b(Дизайнеры?|Хоумстейджеры?)\s*[:—–-]?\s+(.+)"

    def credit(x):
        role = F.initcap(F.regexp_extract(x, p, 1))
        names = strip(F.regexp_replace(F.regexp_extract(x, p, 2), r"(?iU)(\s+(?:Задача|Бюджет|Смета|Кухня|Гостиная|Спальня)\b|[.!?])[\s\S]*$", ""), " .,:;—–-")
        return F.when(has(x, p) & (names != "") & (F.length(names) <= 80), F.concat_ws(" ", role, compact(names)))

    def of(ls):
        found = F.array_join(ordered_distinct(F.transform(F.slice(ls, 1, 30), credit), match_form), "; ")
        return F.when(found != "", F.struct(found.alias("name"), F.lit("credited_in_post").alias("source"))).otherwise(F.struct(F.lit(default).alias("name"), F.lit("default").alias("source")))

    return let(meaningful_lines(text), of)


def neighbour_photos(projects: DataFrame, messages: DataFrame, photos: DataFrame) -> DataFrame:
    """(project_id, photo_paths): up to MAX_PHOTOS distinct paths of the post, its sources and album neighbours.

    Neighbours are the next NEIGHBOURS ids of the same day that have photos and at most ALBUM_CHARS of text. The
    interval becomes an equi-join on exploded ids.
    """
    own = projects.select("project_id", "source_ids", F.col("date").alias("p_date"))
    direct = own.select("project_id", F.explode(F.concat(F.array(F.struct(F.lit(0).alias("k"), F.col("project_id").alias("id"))), F.transform(F.filter("source_ids", lambda x: x != F.col("project_id")), lambda x: F.struct(F.lit(1).alias("k"), x.alias("id"))))).alias("m")).select("project_id", "m.k", F.col("m.id").alias("message_id"))
    near = own.select("project_id", "p_date", F.explode(F.sequence(F.col("project_id") + 1, F.col("project_id") + NEIGHBOURS)).alias("message_id")).join(messages.select("message_id", "date", "text_plain"), "message_id")
    near = near.where((F.length(compact(F.coalesce("text_plain", F.lit("")))) <= ALBUM_CHARS) & (F.coalesce(F.left("p_date", F.lit(10)), F.lit("")).isin("") | (F.left("p_date", F.lit(10)) == F.left(F.coalesce("date", F.lit("")), F.lit(10)))))
    every = direct.union(near.select("project_id", F.lit(2).alias("k"), "message_id")).join(photos.select("message_id", "photo_no", "path"), "message_id")
    once = every.groupBy("project_id", "path").agg(F.min(F.struct("k", "message_id", "photo_no")).alias("o"))
    return once.groupBy("project_id").agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("o", "path"))), lambda x: x["path"]), 1, MAX_PHOTOS).alias("photo_paths"))


def _texts(values: Column, limit: int | None = None) -> Column:
    """Distinct values of an array of (order, value) structs, joined by semicolons; null if there is none."""
    own = F.filter(F.transform(F.array_sort(values), lambda x: x["v"]), lambda v: v.isNotNull())
    own = ordered_distinct(F.slice(own, 1, limit) if limit else own, match_form)
    return F.nullif(F.array_join(own, "; "), F.lit(""))


def build_projects(kitchen: DataFrame, context: DataFrame, messages: DataFrame, photos: DataFrame, channel: str, default_designer: str = "") -> DataFrame:
    """One row per project from kitchen facts and context facts (wall colours, flooring), with ids, dates and lists in
    the order of (message, fact)."""
    resolved = resolve_posts(messages, channel)
    own = kitchen.join(resolved, "message_id", "left").withColumn("project_id", F.coalesce("project_id", "message_id")).withColumn("v", primary_value())
    order = F.struct("message_id", "id")
    of_type = lambda t: F.filter(F.collect_list(F.when(F.col("item_type") == t, F.struct(order.alias("o"), F.col("v").alias("v")))), lambda x: x.isNotNull())
    vendor = F.coalesce("vendor_normalized", "vendor_raw", "marketplace")
    price = F.when(F.col("price_value").isNotNull(), F.concat(F.col("item_type"), F.lit(": "), F.regexp_replace(F.col("price_value").cast("string"), r"\.0+$", ""), F.lit(" "), F.coalesce("price_currency", F.lit("₽")), F.when(F.col("price_unit").isNotNull(), F.concat(F.lit("/"), F.col("price_unit"))).otherwise("")))
    listed = lambda v, o=order: F.transform(F.array_sort(F.filter(F.collect_list(F.struct(o.alias("o"), v.alias("v"))), lambda x: x["v"].isNotNull())), lambda x: x["v"])
    quote = F.when(F.length(compact(F.col("evidence_quote"))) >= 3, compact(F.col("evidence_quote")))
    grouped = own.groupBy("project_id").agg(
        F.array_sort(F.collect_set("message_id")).alias("source_ids"), F.array_sort(F.collect_set("item_type")).alias("item_types"), F.min_by("date", order).alias("fact_date"),
        *(of_type(t).alias(f"_{t}") for t in DIRECT_TYPES), listed(clean_optional(vendor, " ")).alias("_vendors"), listed(price).alias("_prices"), listed(quote, F.struct((~F.col("item_type").isin(*DIRECT_TYPES)).alias("k"), order.alias("o"))).alias("_quotes"),
    )
    grouped = grouped.withColumns({"facade": _texts(F.col("_kitchen_facades")), "countertop": _texts(F.col("_countertop")), "backsplash": _texts(F.col("_backsplash")), "vendors": ordered_distinct(F.col("_vendors"), match_form), "prices": ordered_distinct(F.col("_prices"), match_form), "quotes": F.slice(ordered_distinct(F.col("_quotes"), match_form), 1, 6)})
    # text and context: the post's own text, else its sources' together
    post = messages.select(F.col("message_id").alias("project_id"), F.col("text_plain").alias("post_text"), F.col("date").alias("post_date"))
    ids = grouped.select("project_id", F.explode(F.array_union("source_ids", F.array("project_id"))).alias("message_id"))
    sources = ids.join(grouped.select("project_id", "source_ids"), "project_id").where(F.array_contains("source_ids", F.col("message_id"))).join(messages.select("message_id", "text_plain"), "message_id").groupBy("project_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("message_id", "text_plain"))), lambda x: x["text_plain"]), "\n").alias("source_text"))
    around_ = ids.join(context.withColumn("v", primary_value()), "message_id").groupBy("project_id").agg(*(F.filter(F.collect_list(F.when(F.col("category") == c, F.struct(order.alias("o"), F.col("v").alias("v")))), lambda x: x.isNotNull()).alias(f"_{c}") for c in ("wall_colors", "flooring")))
    out = grouped.join(post, "project_id", "left").join(sources, "project_id", "left").join(around_, "project_id", "left")
    out = out.withColumns({"text": F.coalesce(F.nullif("post_text", F.lit("")), "source_text", F.lit("")), "date": F.coalesce("post_date", "fact_date"), "wall_color": _texts(F.col("_wall_colors"), 5), "flooring": _texts(F.col("_flooring"), 5)})
    out = out.withColumns({"object": object_name(F.col("text"), F.col("date"), F.col("project_id")), "city": city(F.col("text")), "area_type": area_type(F.col("text")), "designer": designer(F.col("text"), default_designer), "facade_parts": facade_parts(F.col("facade"))})
    out = out.join(neighbour_photos(out.select("project_id", "source_ids", "date"), messages, photos), "project_id", "left").withColumn("photo_paths", F.coalesce("photo_paths", F.array().cast("array<string>")))
    keep = ("project_id", "source_ids", "date", "object", "area_type", "city", "designer", "facade", "facade_parts", "countertop", "backsplash", "wall_color", "flooring", "vendors", "prices", "quotes", "item_types", "photo_paths")
    return out.select(*keep)


def palette_summary() -> Column:
    part = lambda label, c: F.when(clean_palette(F.col(c)), F.concat(F.lit(f"{label}: "), clean_value(F.col(c))))
    return F.concat_ws("; ", part("фасады", "facade"), part("столешница", "countertop"), part("фартук", "backsplash"), part("стены", "wall_color"), part("пол", "flooring"))


def score_quality(projects: DataFrame) -> DataFrame:
    """Adds has_clean_facade, has_countertop, has_backsplash, has_photo, quality_score, quality_reasons and quality_tier."""
    own = projects.withColumns({"summary_clean": palette_summary(), "has_clean_facade": F.col("facade").isNotNull() & strong_facade(F.col("facade")), "has_countertop": clean_palette(F.col("countertop")), "has_backsplash": clean_palette(F.col("backsplash")), "has_photo": F.size("photo_paths") > 0})
    only = lambda *t: (F.size("item_types") > 0) & (F.size(F.array_except("item_types", F.array(*map(F.lit, t)))) == 0)
    vendor = F.exists("vendors", lambda v: contains_any(match_form(v), VENDORS))
    fallback = F.col("object.source") == "fallback_post_id"
    bare = F.lit(False)
    for c in ("facade", "countertop", "backsplash"):
        bare = bare | F.coalesce(match_form(F.col(c)).isin("задача", "алюмика", "арт"), F.lit(False))
    rules = (
        ("clean_facade", F.col("has_clean_facade"), 4), ("countertop", F.col("has_countertop"), 2), ("backsplash", F.col("has_backsplash"), 2), ("wall_color", F.col("wall_color").isNotNull(), 1), ("flooring", F.col("flooring").isNotNull(), 1),
        ("object", ~fallback, 1), ("synthetic_object", fallback, -2), ("designer", F.col("designer.source") == "credited_in_post", 1), ("photo", F.col("has_photo"), 2), ("no_photo", ~F.col("has_photo"), -2), ("kitchen_vendor", vendor, 1),
        ("bundle_only", only("bundle_purchase"), -4), ("only_other_or_accessory", only("kitchen_other", "kitchen_accessory"), -3), ("no_clean_facade", ~F.col("has_clean_facade"), -3),
        ("noisy_palette_summary", (F.col("summary_clean") != "") & noise(F.col("summary_clean")), -5), ("long_or_task_quote", F.exists(F.slice("quotes", 1, 2), lambda q: (F.length(q) > 350) | noise(q)), -2), ("non_palette_token", bare, -2),
    )
    own = own.withColumn("_points", F.filter(F.array(*(F.when(test, F.struct(F.lit(name).alias("name"), F.lit(points).alias("points"))) for name, test, points in rules)), lambda x: x.isNotNull()))
    own = own.withColumns({"quality_score": F.aggregate("_points", F.lit(0), lambda a, x: a + x["points"]), "quality_reasons": F.transform("_points", lambda x: x["name"])}).drop("_points")
    tier = F.when((F.col("quality_score") >= HIGH) & F.col("has_clean_facade"), "high").when((F.col("quality_score") >= MEDIUM) & (F.col("has_clean_facade") | (F.col("has_countertop") & F.col("has_backsplash"))), "medium").otherwise("low")
    return own.withColumn("quality_tier", tier)


def argmax_label(scores: list[tuple[str, Column]]) -> Column:
    """Struct (label, score, others) of the best scored label; equal scores in the order given; null scores do not count."""
    own = F.filter(F.array(*(F.when(s.isNotNull(), F.struct((-s).alias("s"), F.lit(k).alias("k"), F.lit(n).alias("label"))) for k, (n, s) in enumerate(scores))), lambda x: x.isNotNull())
    best = lambda ranked: F.when(F.size(ranked) > 0, F.struct(F.get(ranked, F.lit(0))["label"].alias("label"), (-F.get(ranked, F.lit(0))["s"]).alias("score"), F.transform(F.slice(ranked, 2, F.greatest(F.lit(1), F.size(ranked))), lambda x: x["label"]).alias("others")))
    return let(F.array_sort(own), best)


def classify_palettes(projects: DataFrame) -> DataFrame:
    """Adds palette (label), other_palettes and palette_score; a project that fits no palette has a null label."""
    join = lambda *c: match_form(F.concat_ws(" ", *c))
    own = projects.withColumns({"_facade": join(F.array_join("facade_parts", " "), F.col("facade")), "_all": join("facade", "countertop", "backsplash", F.array_join("quotes", " "))})
    clean = F.col("has_clean_facade")
    wood, neutral, accent = clean & contains_any(F.col("_facade"), WOOD), contains_any(F.col("_facade"), NEUTRAL), clean & contains_any(F.col("_facade"), ACCENT)
    light = contains_any(F.col("_facade"), LIGHT) | contains_any(F.col("_all"), LIGHT)
    surface = F.col("countertop").isNotNull() | F.col("backsplash").isNotNull()
    plus = lambda test: F.when(test, 1).otherwise(0)
    scores = [
        ("wood_neutral", F.when(wood & neutral, 4 + plus(contains_any(F.col("_facade"), LIGHT_WOOD)))),
        ("wood_nature_accent", F.when(wood & accent, 5 + plus(contains_any(F.col("_facade"), DARK)))),
        ("light_facade_stone_accent", F.when(light & surface, 4 + plus(~wood))),
    ]
    out = own.withColumn("_best", argmax_label(scores))
    return out.withColumns({"palette": F.col("_best.label"), "palette_score": F.col("_best.score"), "other_palettes": F.coalesce("_best.others", F.array().cast("array<string>"))}).drop("_facade", "_all", "_best")


def quota_fill(df: DataFrame, group: str, tier: str, order: list[Column], k: int, least: int = 3) -> DataFrame:
    """Adds ``selected``: of each group the first k rows of tier high; fewer than ``least`` of them are filled up to k
    from tier medium. Rows without a group are not selected."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(group, tier).orderBy(*order))
    high = F.least(F.lit(k), F.count_if(F.col(tier) == "high").over(Window.partitionBy(group)))
    own = df.withColumns({"_place": place, "_high": high})
    wanted = F.when(F.col(tier) == "high", F.col("_place") <= k).when(F.col(tier) == "medium", (F.col("_high") < least) & (F.col("_place") <= k - F.col("_high"))).otherwise(F.lit(False))
    return own.withColumn("selected", F.col(group).isNotNull() & wanted).drop("_place", "_high")


def select_examples(projects: DataFrame, k: int = 6) -> DataFrame:
    """Adds selected and exclusion_reason (null for the selected)."""
    rank = F.when(F.col("quality_tier") == "high", 2).when(F.col("quality_tier") == "medium", 1).otherwise(0)
    order = [F.desc("quality_score"), rank.desc(), (F.col("designer.source") == "credited_in_post").desc(), (F.col("object.source") != "fallback_post_id").desc(), F.desc("has_photo"), F.coalesce("date", F.lit("")).desc(), F.desc("project_id")]
    own = quota_fill(projects, "palette", "quality_tier", order, k)
    bundle = (F.size("item_types") > 0) & (F.size(F.array_except("item_types", F.array(F.lit("bundle_purchase")))) == 0)
    low = F.when(bundle, "bundle_only").when(~F.col("has_photo"), "no_photo").when(~F.col("has_clean_facade") & ~(F.col("has_countertop") & F.col("has_backsplash")), "no_clean_facade").when((F.col("summary_clean") != "") & noise(F.col("summary_clean")), "noisy_palette_summary").otherwise("weak_evidence")
    reason = F.when(F.col("selected"), None).when(F.col("quality_tier") == "low", low).when(F.col("palette").isNull(), "not_classified_by_palette_rules").otherwise("not_needed_after_quality_cutoff_or_duplicate")
    return own.withColumn("exclusion_reason", reason)


def palette_report(kitchen: DataFrame, context: DataFrame, messages: DataFrame, photos: DataFrame, channel: str, default_designer: str = "", k: int = 6) -> DataFrame:
    """Projects built, scored, classified and selected, by selection, palette and quality."""
    own = select_examples(classify_palettes(score_quality(build_projects(kitchen, context, messages, photos, channel, default_designer))), k)
    return own.orderBy(F.desc("selected"), F.asc_nulls_last("palette"), F.desc("quality_score"), F.coalesce("date", F.lit("")).desc(), F.desc("project_id"))
