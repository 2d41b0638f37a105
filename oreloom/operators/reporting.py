"""Tables behind the reports: which values are fit to show, and their histograms by section."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import compact, confidence_rank, contains_any, has, let, strip
from . import ranking

# Values that say nothing, fragments of essays, phrases of rooms, what a value must not be alone.
BAD_VALUES = ("арт", "арт.", "артикул", "art", "art.", "на пол", "на полу", "в кабинете", "в гостиной", "в гостинной", "на кухне", "в прихожей", "в прихожую", "в ванной", "в ванную", "в спальне", "в спальню", "в детской", "в детскую", "для ключей", "рабочее", "рабочий", "кухонный", "кухонные", "кухонная", "2шт", "2 шт", "1шт", "1 шт", "позиции из цитат")
ESSAY = ("задача:", "практически, как на заказ", "обратите внимание", "выбрав нужную", "сразу кажется", "который обойдется", "который обойдётся", "модель и ткань", "обязательно раскладной")
ROOM_PHRASES = ("в прихожей", "в прихожую", "в кабинете", "в гостиной", "в гостинной", "на кухне", "в ванной", "в ванную", "в спальне", "в спальню", "в детской", "в детскую", "для ключей", "на пол", "на полу")
WALL_CODE = r"(?iU)^(?:G\s*\d{3}|RAL\s*\d{3,4}|NCS\s*[A-Z0-9\s/\-]+|\d{2}\s*[A-Z]{2}\s*\d{2}/\d{3})$"
ARTICLE_ONLY = r"(?iU)^(?:арт\.?\s*[\d\-/\s]+|\d[\d\s\-_/]*)$"
PRICE_ONLY = r"(?iU)^[\d\s.,]+\s*(?:руб\.?|₽|rub)\s*(?:/?\s*(?:шт|м2|м²|м|кг|компл(?:ект)?))?\s*$"


def display_value(value: Column, category: Column, item_type: Column) -> Column:
    """A value that a report may show: wall codes, else 3 to 90 characters (facades of several parts may be longer),
    not a bare word, room phrase, essay, article number or price."""

    def of(text):
        low = F.lower(text)
        refused = low.isin(*BAD_VALUES) | contains_any(low, ESSAY) | contains_any(low, ROOM_PHRASES) | has(text, PRICE_ONLY)
        fits = (F.length(text) >= 3) & ~has(text, ARTICLE_ONLY) & ((F.length(text) <= 90) | ((item_type == "kitchen_facades") & F.contains(text, F.lit(" + "))))
        return (text != "") & ~refused & (has(text, WALL_CODE) | F.coalesce(fits, F.lit(False)))

    return F.coalesce(let(compact(value), of), F.lit(False))


def _cases(c: Column, cases) -> Column:
    """The label of the first case that the lower-cased text has a token of, else the text."""
    text = strip(compact(c), " .,:;")
    out = text
    for label, tokens in reversed(cases):
        out = F.when(contains_any(F.lower(text), tokens), F.lit(label)).otherwise(out)
    return F.nullif(out, F.lit(""))


# Labels of fabrics, sofa colours, flooring.
def sofa_material(c: Column) -> Column:
    return _cases(c, (("букле / Bucle", ("bucle", "букле")), ("велюр / velvet-like labels", ("velvet", "вельвет", "велюр")), ("рогожка", ("рогож",))))


def sofa_color(c: Column) -> Column:
    return _cases(c, (("olive", ("olive", "олив")), ("light", ("light", "светл", "молоч")), ("terra", ("terra", "терра")), ("серый", ("grey", "gray", "сер")), ("зелёный", ("green", "зелен", "зелён", "emerald")), ("бежевый", ("beige", "беж", "крем"))))


def flooring_material(c: Column) -> Column:
    return _cases(c, (("Alpine Floor", ("alpine floor",)), ("SPC / кварцвинил", ("spc", "кварц")), ("плитка / керамогранит", ("плитк", "керамогранит")), ("ламинат", ("ламинат",)), ("паркет / инженерная доска", ("паркет", "инженер"))))


def primary(category: str = "e_category") -> Column:
    """The value of a fact that its section is about."""
    c = F.col(category)
    return (
        F.when(c == "wall_colors", F.coalesce("e_color_code", "e_color"))
        .when(c == "kitchens", F.coalesce("e_finish", "e_model", "e_material", "e_color"))
        .when(c == "sofas", F.coalesce(F.col("e_model"), sofa_material(F.col("e_material")), sofa_color(F.col("e_color"))))
        .when(c == "flooring", flooring_material(F.coalesce("e_material", "e_brand", "e_finish")))
        .otherwise(F.coalesce("e_model", "e_finish", "e_material", "e_color", "e_article_id"))
    )


def display_counts(used: DataFrame, n: int = 15) -> DataFrame:
    """The commonest values of each category that a report may show; ties by value."""
    own = used.withColumn("value", compact(primary())).where(display_value(F.col("value"), F.col("e_category"), F.col("e_item_type")))
    counts = own.groupBy("e_category", "value").agg(F.count("*").alias("n"))
    return ranking.top_k(counts, ["e_category"], [F.desc("n"), F.asc("value")], n)


def suppressed(used: DataFrame) -> DataFrame:
    """By category: facts in use whose value is not shown."""
    return used.where(~display_value(primary(), F.col("e_category"), F.col("e_item_type"))).groupBy("e_category").agg(F.count("*").alias("n"))


def suppliers(used: DataFrame, k: int = 3) -> DataFrame:
    """By vendor: facts, its k commonest categories and item types, two quotes, and its k commonest items: the values a
    report may show, where it has none the item types."""
    own = used.where("e_vendor is not null")
    top = lambda c, name: ranking.top_k(own.groupBy("e_vendor", F.col(c).alias(name)).agg(F.count("*").alias("n")), ["e_vendor"], [F.desc("n"), F.asc(name)], k).groupBy("e_vendor").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", name))), lambda x: x[name]), "; ").alias(name))
    quotes = ranking.top_k(own.select("e_vendor", "id", "evidence_quote"), ["e_vendor"], [F.desc("id")], 2).groupBy("e_vendor").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "evidence_quote"))), lambda x: x["evidence_quote"]).alias("quotes"))
    total = own.groupBy("e_vendor").agg(F.count("*").alias("facts"))
    shown = own.withColumn("value", F.when(display_value(primary(), F.col("e_category"), F.col("e_item_type")), compact(primary()))).where("value is not null")
    values = ranking.top_k(shown.groupBy("e_vendor", "value").agg(F.count("*").alias("n")), ["e_vendor"], [F.desc("n"), F.asc("value")], k).groupBy("e_vendor").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]), "; ").alias("_values"))
    out = _rolled(total, top, quotes).join(values, "e_vendor", "left")
    return out.withColumn("items", F.coalesce("_values", F.nullif("item_types", F.lit("")), "categories")).drop("_values").orderBy(F.desc("facts"), "e_vendor")


def _rolled(total: DataFrame, top, quotes: DataFrame) -> DataFrame:
    return total.join(top("e_category", "categories"), "e_vendor").join(top("e_item_type", "item_types"), "e_vendor").join(quotes, "e_vendor")


def wood_and_neutral(used: DataFrame) -> DataFrame:
    """One row: whether at least two kitchen facts name oak with a neutral tone."""
    text = F.lower(F.concat_ws(" ", "e_finish", "e_material", "e_color", "evidence_quote"))
    hit = F.contains(text, F.lit("дуб")) & contains_any(text, ("капуч", "эбони", "сантьяго", "тальк", "greige", "гринвуд", "мат", "сер", "беж", "молоч"))
    return used.where("e_category = 'kitchens'").agg((F.count_if(hit) >= 2).alias("wood_and_neutral"))


def examples(used: DataFrame, category: str, k: int = 12) -> DataFrame:
    """The best examples of a section: reviewed, confidence, price, vendor, model, article, photo, date; then the smallest id."""
    told = lambda c: F.col(c).isNotNull().desc()
    order = [F.coalesce(F.col("decision").isin("keep", "fix"), F.lit(False)).desc(), F.coalesce(confidence_rank(F.col("confidence")), F.lit(0)).desc(), told("e_price_value"), told("e_vendor"), told("e_model"), told("e_article_id"), told("first_photo_path"), F.coalesce("date", F.lit("")).desc(), F.asc("id")]
    return used.where(F.col("e_category") == category).orderBy(*order).limit(k)


def living_room_keep() -> Column:
    """Living-room facts that are furniture of that room: no hallway pieces, coffee tables, bundles, lighting or decor,
    and something to show."""
    kind, evidence = F.lower("e_item_type"), F.lower(F.coalesce("evidence_quote", F.lit("")))
    other = kind.isin("coffee_table", "hallway_wardrobe", "shoe_cabinet", "hanger", "mirror", "pouf", "entry_group", "living_room_context_match", "bundle_purchase")
    elsewhere = contains_any(evidence, ("в прихожей", "в прихожую", "в ванной", "в ванную", "для ключей", "санузел")) | (kind.isin("shelves", "shelving") & F.contains(evidence, F.lit("ключ")))
    shown = display_value(primary(), F.col("e_category"), kind) | F.coalesce("e_vendor", "e_brand", "e_model", "e_material").isNotNull()
    return F.coalesce(~other, F.lit(True)) & ~elsewhere & ~contains_any(evidence, ("люстра", "бра", "торшер", "постер", "плед")) & shown


def hallway_keep() -> Column:
    return F.coalesce(F.lower("e_item_type") != "bundle_purchase", F.lit(True))


def kept_in_sections(used: DataFrame) -> DataFrame:
    """Facts in use that their section shows: living-room and hallway facts pass their section's filter."""
    c = F.col("e_category")
    return used.where(F.when(c == "living_room_furniture", living_room_keep()).when(c == "hallway", hallway_keep()).otherwise(F.lit(True)))


def category_sections(used: DataFrame, category: str, n: int = 15, k: int = 12) -> dict[str, DataFrame]:
    """The tables of one category: commonest values, vendors, and the best examples."""
    own = kept_in_sections(used.where(F.col("e_category") == category))
    vendors = ranking.histogram(own, F.col("e_vendor"), n)
    return {"Values": display_counts(own, n).orderBy("place").select("place", "value", "n"), "Vendors": vendors, "Examples": examples(own, category, k).select("id", "date", "e_item_type", "e_vendor", primary().alias("value"), "e_price_value", "evidence_quote")}


def reliability(dataset: DataFrame) -> DataFrame:
    """One row: facts in all and in use, reviewed ones, fixes taken over, prices hidden by a review, values not shown."""
    on = F.col("exclusion_reason").isNull()
    shown = display_value(primary(), F.col("e_category"), F.col("e_item_type"))
    n = F.count_if
    return dataset.agg(F.count("*").alias("facts"), n(on).alias("used"), n(on & F.col("reviewed")).alias("used_reviewed"), n(on & (F.col("decision") == "fix")).alias("fixes"), n(on & ~F.coalesce("e_price_reliable", F.lit(True))).alias("hidden_prices"), n(on & ~shown).alias("hidden_values"))


def to_review(dataset: DataFrame) -> DataFrame:
    """Facts that a person has to look at: by category and reason."""
    own = dataset.where(F.col("exclusion_reason").isin("needs_review_without_review", "review_needs_human", "review_unknown_decision", "review_fix_not_coherent"))
    return own.groupBy("category", "exclusion_reason").agg(F.count("*").alias("n")).orderBy("category", F.desc("n"), "exclusion_reason")


def value_sections(used: DataFrame, n: int = 15) -> dict[str, DataFrame]:
    """``n``: values shown of each category."""
    own = kept_in_sections(used)
    return {"Values": display_counts(own, n).orderBy("e_category", "place"), "Wood and neutral": wood_and_neutral(used), "Suppliers": suppliers(used), "Not shown": suppressed(used)}


def fact_summary(facts: DataFrame) -> DataFrame:
    """By category: facts, clean ones, ones to review, and of each confidence."""
    n = lambda c: F.count_if(c)
    review = F.col("needs_review")
    return facts.groupBy("category").agg(F.count("*").alias("facts"), n(~review).alias("clean"), n(review).alias("to_review"), *(n(F.col("confidence") == c).alias(c) for c in ("high", "medium", "low"))).orderBy("category")


def top_values(facts: DataFrame, fields: tuple[str, ...] = ("item_type", "vendor_normalized", "color_code", "finish", "model", "material"), k: int = 15) -> DataFrame:
    """Long table category, field, value, n: the k commonest values of each field; ties by value. One pass unpivots."""
    long = facts.select("category", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields))).alias("x")).select("category", "x.field", "x.value").where("value is not null")
    return ranking.top_k(long.groupBy("category", "field", "value").agg(F.count("*").alias("n")), ["category", "field"], [F.desc("n"), F.asc("value")], k)


def review_signals(facts: DataFrame) -> DataFrame:
    """One row: how many notes speak of each reason for a review; a note may speak of several."""
    text = F.lower(F.coalesce("notes", F.lit("")))
    signals = {"bundle": ("bundle",), "non_target_room": ("non-target",), "suspicious_descriptor": ("suspicious",), "lighting_or_context": ("lighting", "context"), "several_items": ("several unrelated",), "several_prices": ("multiple prices",), "low_confidence": ("low confidence",), "nothing_parsed": ("no vendor",)}
    return facts.where("needs_review").agg(*(F.count_if(contains_any(text, parts)).alias(n) for n, parts in signals.items()))
