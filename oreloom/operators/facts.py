"""Fact extraction: text -> evidence blocks -> facts, as projections and explodes.

Parsing (price, article, vendor, rooms, item heads) happens once for each distinct block, whatever the number of posts
that hold it; the extractors are CASE ladders over the parsed fields. Posts get the facts of their blocks by a join. Other
shuffles are the removal of repeated facts and the total order that gives ids.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import parse as P
from ..functions.text import blank_to_null, clean_optional, compact, confidence_label, confidence_rank, contains_any, folded, has, has_word, holds_stem, let, lines, match_form, sha256, strip, word_count_over, word_pattern

_STARTS = f"(?iU)\\b({rules.LINE_START})\\b"
_GOES_ON = r"(?iU)\b(арт\.?|код|руб|₽|промокод)\b"
_EDGES = " \t-*•"
#: Control characters and white space other than spaces and line ends, and line ends without another beside them.
_UNEVEN = r"[\x00-\x09\x0B-\x1F\x7F-\xA0\u1680\u180E\u2000-\u206F\u3000\uFEFF]|(?<!\n)\n(?!\n)"


def evidence_blocks(text: Column) -> Column:
    """Paragraphs, and inside paragraphs of several lines a window from each item line over up to 3 lines more.

    A window ends before another item line that has no article, code, price or promo word, and behind a line with a
    price or an article number. Blocks are distinct by their compacted text of 3 characters or more.
    """
    paragraphs = F.split(F.regexp_replace(text, r"\r\n?", "\n"), r"(?U)\n\s*\n+")
    own = F.transform(paragraphs, lambda p: F.transform(F.filter(lines(p), lambda x: F.trim(x) != ""), lambda x: strip(x, _EDGES)))

    def step(acc, y):
        stops = has(y, _STARTS) & ~has(y, _GOES_ON)
        found = has(P.price_text(y), P.PRICE) | has(y, P.ARTICLE)
        return F.struct(F.when(~acc["done"] & ~stops, F.concat(acc["text"], F.lit("\n"), y)).otherwise(acc["text"]).alias("text"), (acc["done"] | stops | found).alias("done"))

    def windows(ls):
        window = lambda x, i: F.when(has(x, _STARTS), F.aggregate(F.slice(ls, i + 2, F.lit(3)), F.struct(x.alias("text"), F.lit(False).alias("done")), step, lambda a: a["text"]))
        return F.when(F.size(ls) > 1, F.filter(F.transform(ls, window), lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))

    every = F.flatten(F.transform(own, lambda ls: F.concat(F.array(F.array_join(ls, "\n")), windows(ls))))
    distinct = lambda kept: let(F.transform(kept, compact), lambda keys: F.filter(kept, lambda b, i: F.array_position(keys, F.get(keys, i)) == i + 1))
    # Where each paragraph is a line as it should be, it is a block, its own compacted text and holds no window.
    plain = F.array_distinct(F.filter(F.split(text, "\n"), lambda b: F.length(b) >= 3))
    at_ends = [test(text, F.lit(x)) for x in " *•-" for test in (F.startswith, F.endswith)]
    uneven = contains_any(text, ("  ", *(y for x in " *•-" for y in (f"{x}\n", f"\n{x}")))) | F.coalesce(reduce(or_, at_ends), F.lit(False)) | has(text, _UNEVEN)
    return F.when(~uneven, plain).otherwise(let(F.filter(every, lambda b: F.length(compact(b)) >= 3), distinct))


def bundle_texts(block: Column) -> Column:
    """The lines of a block, and the whole block if it has at most two."""
    own = F.filter(F.transform(F.filter(lines(block), lambda x: F.trim(x) != ""), lambda x: compact(F.regexp_replace(x, r"^[ \t\-*•🌱]+|[ \t\-*•🌱]+$", ""))), lambda x: x != "")
    return let(own, lambda ls: F.when(F.size(ls) <= 2, F.array_union(ls, F.array(compact(block)))).otherwise(ls))


def heads(text: Column, low: Column) -> Column:
    """Item heads of a line in order of their first place: array of struct (at, head, category, times). ``low``: it folded."""
    found = []
    for head, category, forms in rules.BUNDLE_HEADS:
        p = word_pattern(forms)
        found.append(F.when(has_word(text, forms, low), F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(head).alias("head"), F.lit(category).alias("category"), F.regexp_count(text, F.lit(p)).alias("times"))))
    none = F.array().cast("array<struct<at:int,head:string,category:string,times:int>>")
    return F.when(holds_stem(low, "|".join(p for _, _, p in rules.BUNDLE_HEADS)), F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()))).otherwise(none)


def bundle(candidate: Column) -> Column:
    """Struct (quote, heads, category, rooms) of a line that sells several items at once; null otherwise."""
    listed = has(candidate, f"(?iU){rules.BUNDLE_LIST}")
    sold = has(P.price_text(candidate), P.PRICE) | P.has_article(candidate) | P.vendor(candidate).isNotNull()

    def of(x):
        own, names, rooms, low = x["own"], x["names"], x["rooms"], x["low"]
        only = lambda *h: F.size(F.array_except(names, F.array(*map(F.lit, h)))) == 0
        exempt = only("кухня", "фасады") | F.array_contains(names, "фартук") | (F.contains(match_form(candidate), F.lit("столешниц")) & only("кухня", "стол"))
        times = F.aggregate(own, F.lit(0), lambda a, y: a + y["times"])
        many, many_rooms = F.size(names) >= 2, F.size(rooms) >= 2
        tests = lambda t: ((many | (many_rooms & (times >= 2))) & (t["listed"] | t["sold"])) | (many_rooms & t["sold"])
        several = F.when(many | many_rooms, let(F.struct(listed.alias("listed"), sold.alias("sold")), tests)).otherwise(False)
        first = F.get(own, F.lit(0))["category"]
        category = F.when((first == "living_room_furniture") & F.array_contains(rooms, "hallway"), "hallway").otherwise(first)
        return F.when(~exempt & (has_word(candidate, rules.BUNDLE_WORDS, low) | several), F.struct(candidate.alias("quote"), names.alias("heads"), category.alias("category"), rooms.alias("rooms")))

    def with_heads(x):
        own, low = x["own"], x["low"]
        named = F.struct(own.alias("own"), F.transform(own, lambda y: y["head"]).alias("names"), P.rooms(candidate, low).alias("rooms"), low.alias("low"))
        return F.when(F.size(own) > 0, let(named, of))

    return let(let(folded(candidate), lambda low: F.struct(heads(candidate, low).alias("own"), low.alias("low"))), with_heads)


_FIELDS = ("category", "item_type", "item_name", "model", "material", "finish", "color", "room", "method", "hint", "extra", "note", "quote")


def _fact(category: str | Column, item_type: str | Column, method: str, hint: str | Column = "medium", extra: bool | Column = False, note: str | Column | None = None, quote: Column | None = None, **fields: Column) -> Column:
    own = lambda x: x if isinstance(x, Column) else F.lit(x)
    given = {"category": own(category), "item_type": own(item_type), "method": F.lit(f"regex:{method}"), "hint": own(hint), "extra": own(extra), "note": own(note).cast("string"), "quote": own(quote).cast("string")} | fields
    return F.struct(*(given.get(n, F.lit(None).cast("string")).alias(n) for n in _FIELDS))


_SURFACE = "line mentions sofa only as surrounding context"


def _extractors(b: Column, low: Column, fold: Column, text: Column, p: dict[str, Column]) -> list[Column]:
    """A struct or null of each of the seven product extractors. Words, kinds, methods and notes in it are fixed values."""
    none = F.lit(None)
    word = lambda forms: has_word(b, forms, fold)
    sofa_like = lambda pattern: F.contains(fold, F.lit("диван")) & has(b, pattern)
    inside = lambda *parts: contains_any(low, parts)
    with_ = lambda keys, body: let(P.descriptor(text, keys), body)
    priced = F.when(p["price"].isNotNull() | p["article"].isNotNull(), "high").otherwise("medium")
    lit, decor = p["lighting"], p["decor"]

    counter = with_(rules.KEYWORDS["countertop"], lambda v: _fact("kitchens", "countertop", "kitchen_countertop", item_name=v, material=v))
    facade = with_(rules.KEYWORDS["facades"], lambda v: _fact("kitchens", "kitchen_facades", "kitchen_facades", hint=F.when(v.isNotNull(), "high").otherwise("medium"), extra=v.isNull(), note=F.when(v.isNull(), "kitchen facades without parsed finish"), finish=v))
    kitchen = (
        F.when(lit, F.when(inside("кухн"), _fact("kitchens", "kitchen_other", "kitchen_lighting_review", extra=True, note="lighting/decor kitchen context needs review")))
        .when(word(r"ручк(?:а|и|у|ой)|смесител(?:ь|и|я|ем)|мойк(?:а|и|у|ой)") & inside("кухн"), _fact("kitchens", "kitchen_accessory", "kitchen_accessory_review", extra=True, note="kitchen accessory outside current clean summary scope"))
        .when(inside("фартук"), _fact("kitchens", "backsplash", "kitchen_backsplash", hint="high"))
        .when(inside("столешниц"), counter)
        .when(~inside("кухн", "фасад"), none)
        .when(inside("фасад"), facade)
        .when(inside("гарнитур", "на заказ", "мебель", "mebel.in", "кухня") & (p["price"].isNotNull() | p["vendor"].isNotNull()), _fact("kitchens", "kitchen_purchase", "kitchen_purchase", extra=True, note="broad kitchen purchase row needs review unless validated against facades/countertop/backsplash"))
        .otherwise(_fact("kitchens", "kitchen_other", "kitchen_other_review", extra=True, note="broad kitchen context without facade/countertop/backsplash signal"))
    )

    head = word(r"журнальн(?:ый|ого|ому|ым)?\s+столик|обеденн(?:ый|ого|ому|ым)?\s+стол|кухонн(?:ый|ого|ому|ым)?\s+стол|рабоч(?:ий|его|ему|им)?\s+стол|подстолье|столик(?:и|а|ом|е)?|стол(?:ы|а|у)?")
    kind = F.when(inside("журналь"), "coffee_table").when(inside("обеден"), "dining_table").when(inside("кухон"), "kitchen_table").when(inside("рабоч"), "working_table").when(inside("подстоль"), "table_base").otherwise("table")
    named = with_(rules.KEYWORDS["table"], lambda v: _fact("tables", kind, "table", hint=priced, item_name=v, model=v))
    table = (
        F.when(~head, F.when(word("столом|столе") & lit, _fact("tables", "table_context_match", "table_context_review", extra=True, note="lighting/decor line mentions table only as context")))
        .when(lit, _fact("tables", "table_context_match", "table_lighting_review", extra=True, note="lighting/decor line is not a clean table fact"))
        .when(inside("столешниц"), none)
        .otherwise(named)
    )

    beside = r"(?iU)\b(над|за|у|рядом\s+с|возле"
    bed = F.when(inside("диван-кровать", "кровать-диван"), "sofa_bed").when(inside("софа"), "couch").otherwise("sofa")
    sold = F.when(p["price"].isNotNull() | p["vendor"].isNotNull(), "high").otherwise("medium")
    whole = lambda v, m: _fact("sofas", bed, "sofa", hint=sold, extra=word_count_over(v), note=F.when(word_count_over(v), "suspiciously long sofa descriptor"), model=m["model"], material=m["material"], color=m["color"])
    named = with_(rules.KEYWORDS["sofa"], lambda v: let(P.model_material_color(v), lambda m: whole(v, m)))
    around = _fact("sofas", "sofa_context_match", "sofa_context_review", extra=True, note=_SURFACE)
    sofa = (
        F.when(~word(r"диван(?:ы|а)?|софа|диван-кровать|кровать-диван"), F.when(word("диваном|дивана|диване") & (decor | sofa_like(beside + r"|с)\s+диван")), around))
        .when(sofa_like(beside + r")\s+диван"), around)
        .when(sofa_like(r"(?iU)\bкровать\b.{0,40}\bс\s+диван") & ~has(b, r"(?iU)^\s*диван[-\s]?кровать\b"), _fact("sofas", "sofa_context_match", "sofa_bed_context_review", extra=True, note="bed line mentions sofa as part of another item"))
        .otherwise(named)
    )

    kind = F.when(inside("бар"), "bar_chair").when(inside("рабоч", "кресл"), "working_chair").when(inside("обеден", "кухон"), "dining_chair").otherwise("chair")
    seat = lambda k, v, m: _fact("chairs", k, "chair", hint=priced, item_name=v, model=F.coalesce(m["model"], v), material=m["material"], color=m["color"])
    chair = F.when(inside("стул", "кресл"), with_(rules.KEYWORDS["chair"], lambda v, k=kind: let(P.model_material_color(v), lambda m: seat(k, v, m))))

    floor = inside("плитка на полу", "плитка на пол", "плитка для пола", "на полу керамогранит", "керамогранит на полу", "напольное покрытие", "покрытие пола", "кварцвинил", "кварц винил", "spc", "ламинат", "паркет")
    tiled = has(low, r"(?U)(плитк|керамогранит).{0,60}(на\s+полу|на\s+пол|для\s+пола)") | has(low, r"(?U)(на\s+полу|на\s+пол|для\s+пола).{0,60}(плитк|керамогранит)")
    floor = floor | (inside("плитк", "керамогранит") & tiled)
    other = p["non_target"]
    elsewhere = F.size(other) > 0
    kind = F.when(inside("кварцвинил", "кварц винил"), "flooring_quartz_vinyl").when(inside("spc", "ламинат"), "flooring_laminate").when(inside("паркет"), "flooring_parquet").when(inside("плитк", "керамогранит"), "flooring_tile").when(inside("напольн"), "flooring_material").otherwise("flooring_unclear")
    note = F.when(elsewhere, F.concat(F.lit("flooring row has non-target room context: "), F.array_join(other, ", ")))
    laid = lambda k, n, v: _fact("flooring", k, "flooring", hint=F.when(elsewhere, "medium").otherwise("high"), extra=elsewhere, note=n, item_name=v, material=v, room=F.get(other, F.lit(0)))
    flooring = F.when(~inside("фартук") & floor & (p["price"].isNotNull() | p["article"].isNotNull() | p["vendor"].isNotNull()), with_(rules.KEYWORDS["flooring"], lambda v, k=kind: laid(k, note, v)))

    kind = F.when(inside("обувниц"), "shoe_cabinet").when(inside("шкаф"), "hallway_wardrobe").when(inside("консол"), "console").when(inside("пуф", "банкетк"), "pouf").when(inside("зеркал"), "mirror").when(inside("вешал"), "hanger").otherwise("entry_group")
    hallway = F.when(inside("прихож", "коридор", "обувниц", "входная группа", "вешал"), with_(rules.KEYWORDS["hallway"], lambda v, k=kind: _fact("hallway", k, "hallway", hint=priced, item_name=v, model=v, room=F.lit("hallway"))))

    kind = F.when(inside("тв тумб", "тв-тумб", "тумба под тв", "телевизор"), "tv_unit").when(inside("комод"), "chest").when(inside("стеллаж"), "shelving").when(inside("полк"), "shelves").when(inside("консол"), "console").when(inside("шкаф"), "cabinet").when(inside("журнальн"), "coffee_table").otherwise("cabinet")
    living = (
        F.when(~inside("тв тумб", "тв-тумб", "тумба под тв", "телевизор", "комод", "стеллаж", "полк", "консол", "шкаф", "журнальн"), F.when(inside("гостин") & decor, _fact("living_room_furniture", "living_room_context_match", "living_room_context_review", extra=True, note="lighting/decor line mentions living room only as context")))
        .when(decor & ~inside("полк", "стеллаж", "комод", "тумб", "шкаф", "консол"), _fact("living_room_furniture", "living_room_context_match", "living_room_decor_review", extra=True, note="lighting/decor line is not a clean living-room furniture fact"))
        .otherwise(with_(rules.KEYWORDS["living_room"], lambda v, k=kind: _fact("living_room_furniture", k, "living_room_furniture", hint=priced, item_name=v, model=v, room=F.when(inside("гостин"), "living_room"))))
    )
    return [kitchen, table, sofa, chair, flooring, hallway, living]


def confidence_of(hint: Column, extra: Column, details: Column, sold: Column) -> Column:
    """Rank before review notes, from the hint, the number of details and whether vendor, article or price was parsed."""
    out = F.when((details >= 3) & (hint != "low"), 2).when((details <= 1) & (hint == "high"), 1).otherwise(confidence_rank(hint))
    out = F.when(~sold, F.when(hint == "high", 1).otherwise(0)).otherwise(out)
    return F.when(extra & (hint == "medium"), 1).otherwise(out)


def parsed_blocks(posts: DataFrame, owner: str = "") -> DataFrame:
    """One row for each evidence block of posts (message_id, date, text, source_scope, first_photo_path)."""
    own = posts.withColumns({"project_name": clean_optional(P.project_name(F.col("text"))), "source_text_hash": sha256(F.col("text")), "first_photo_path": clean_optional(F.col("first_photo_path"))})
    return own.select("*", F.posexplode(evidence_blocks(F.col("text"))).alias("block_no", "block")).drop("text")


def _parsed(quote: Column, low: Column) -> dict[str, Column]:
    return {"price": P.price(quote), "article": P.article(quote, low), "vendor": P.vendor(quote), "promo_code": P.promo_code(quote, low), "prices": P.price_count(quote), "non_target": P.non_target_rooms(quote, low)}


#: A block that is more than one in so many of all is a frequent one; there are fewer than that.
FREQUENT = 1000


def extract_facts(posts: DataFrame, owner: str = "") -> DataFrame:
    """Facts of posts (message_id, date, text, source_scope, first_photo_path), not yet deduplicated, with ``ord``.

    Every block gives its wall colours; a bundle gives one reviewable fact and nothing else, any other block one fact
    of each extractor that applies. A null or blank text gives none. Each distinct block is parsed once. Facts of frequent
    blocks are broadcast to the posts; other blocks meet theirs by their hash and text, so that no task has many of one.
    """
    rows = parsed_blocks(posts.where(blank_to_null(F.col("text")).isNotNull()), owner)
    # The text depends on the count, so that no filter on it goes below the shuffle, which all branches share.
    distinct = rows.groupBy("block").agg(F.count("*").alias("_copies")).select(F.when(F.col("_copies") > 0, F.col("block")).alias("block"), "_copies")
    spark = posts.sparkSession
    # Parsing takes far longer than moving the distinct blocks: over all cores, however small they are.
    distinct = distinct.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "block")
    total = distinct.agg(F.sum("_copies")).scalar()
    frequent, other = distinct.where(F.col("_copies") * FREQUENT > total), distinct.where(F.col("_copies") * FREQUENT <= total)
    hashed = lambda df: df.withColumn("_hash", F.xxhash64("block"))
    rest = hashed(rows.join(F.broadcast(frequent.select("block")), "block", "left_anti"))
    out = rows.join(F.broadcast(_block_facts(frequent, owner)), "block").unionByName(rest.join(hashed(_block_facts(other, owner)), ["_hash", "block"]).drop("_hash"))
    return out.select("message_id", "date", "source_scope", "project_name", *_BLOCK_FIELDS, "source_text_hash", "first_photo_path", F.struct("block_no", "kind", "n").alias("ord"))


def _block_facts(blocks: DataFrame, owner: str) -> DataFrame:
    """Facts of distinct blocks: block, kind (0 for wall colours), n and the fields that hang on the block alone."""
    b, low, fold = F.col("block"), F.col("low"), F.col("fold")
    blocks = blocks.select("block", match_form(b).alias("low"), folded(b).alias("fold"))
    parsed = _parsed(b, fold) | {"lighting": P.lighting(b, fold), "decor": P.lighting_or_decor(b, fold), "clean": P.descriptor_text(b, owner)}
    own = blocks.withColumns({f"p_{k}": v for k, v in parsed.items()})
    own = own.withColumn("bundle", F.get(F.filter(F.transform(bundle_texts(b), bundle), lambda x: x.isNotNull()), F.lit(0)))
    p = {k: F.col(f"p_{k}") for k in ("price", "article", "vendor", "non_target", "lighting", "decor")}
    note = F.concat(F.lit("bundle purchase: detected item heads "), F.array_join("bundle.heads", ", "), F.when(F.size("bundle.rooms") > 0, F.concat(F.lit("; room contexts "), F.array_join("bundle.rooms", ", "))).otherwise(""))
    names = F.array_join("bundle.heads", ", ")
    as_bundle = _fact(F.col("bundle.category"), "bundle_purchase", "bundle_purchase", extra=True, note=note, item_name=names, room=F.nullif(F.array_join("bundle.rooms", ","), F.lit("")), quote=F.col("bundle.quote"))
    kind = "array<struct<" + ",".join(f"{n}:{'boolean' if n == 'extra' else 'string'}" for n in _FIELDS) + ">>"
    products = F.when(F.col("bundle").isNotNull(), F.array(as_bundle)).otherwise(F.filter(F.array(*_extractors(b, low, fold, F.col("p_clean"), p)), lambda x: x.isNotNull())).cast(kind)
    found = own.select("*", F.posexplode(products).alias("n", "f")).withColumn("quoted", F.coalesce("f.quote", "block"))
    again = _parsed(F.col("quoted"), folded(F.col("quoted")))
    found = found.withColumns({f"q_{k}": F.when(F.col("f.quote").isNull(), F.col(f"p_{k}")).otherwise(v) for k, v in again.items()})
    return _assemble(found, owner).unionByName(_wall_colors(blocks, owner))


_BLOCK_FIELDS = (
    "category", "item_type", "item_name", "vendor_raw", "vendor_normalized", "brand_raw", "brand_normalized", "model", "material", "finish", "color", "color_code", "article_id", "marketplace",
    "price_value", "price_currency", "price_unit", "promo_code", "room_context", "evidence_quote", "extraction_method", "confidence", "needs_review", "notes",
)


def _assemble(found: DataFrame, owner: str) -> DataFrame:
    f, q = (lambda n: F.col(f"f.{n}")), (lambda n: F.col(f"q_{n}"))
    vendor_raw = F.coalesce(q("vendor.raw"), q("article.vendor_raw"))
    vendor_name = F.coalesce(q("vendor.normalized"), q("article.vendor_normalized"))
    sold = vendor_name.isNotNull() | q("article").isNotNull() | q("price").isNotNull()
    details = sum((F.when(x.isNotNull() & (x.cast("string") != "0"), 1).otherwise(0) for x in (vendor_name, q("article.article_id"), q("price.value"), f("item_name"), f("model"), f("material"), f("finish"), f("color"))), F.lit(0))
    found = found.withColumns({"_vendor_raw": vendor_raw, "_vendor": vendor_name, "_sold": sold, "_details": details, "_quote": P.evidence_quote(F.col("quoted"), owner)})
    vendor_raw, vendor_name, sold, quote = F.col("_vendor_raw"), F.col("_vendor"), F.col("_sold"), F.col("_quote")
    found = found.withColumn("_rank", confidence_of(f("hint"), f("extra"), F.col("_details"), sold))
    rank = F.col("_rank")
    other = q("non_target")
    foreign = (F.size(other) > 0) & f("category").isin(*rules.NON_TARGET_CATEGORIES)
    cut = F.lit(False)
    for n in ("item_name", "model", "material", "finish", "color"):
        cut = cut | P.cut_word(f(n))
    notes = F.array(
        f("note"),
        F.when(rank == 0, "low confidence deterministic match"),
        F.when(~sold, "no vendor, article id, or price parsed"),
        F.when(q("prices") > 1, "multiple prices in quote; price attribution ambiguous"),
        F.when(word_count_over(f("item_name")) | word_count_over(f("model")), "suspiciously long descriptor"),
        F.when(cut, "suspicious descriptor fragment"),
        F.when(foreign, F.concat(F.lit("non-target room context: "), F.array_join(other, ", "))),
        F.when(P.item_triggers(quote) > 2, "quote may contain several unrelated items"),
    )
    out = found.withColumn("_notes", F.filter(notes, lambda x: x.isNotNull()))
    noted = F.size("_notes") > 0
    final = F.when((F.col("_rank") == 2) & (f("extra") | noted), 1).otherwise(F.col("_rank"))
    c = clean_optional
    return out.select(
        "block", F.lit(1).alias("kind"), "n", f("category").alias("category"), f("item_type").alias("item_type"), c(f("item_name")).alias("item_name"),
        c(vendor_raw).alias("vendor_raw"), c(vendor_name).alias("vendor_normalized"), F.lit(None).cast("string").alias("brand_raw"), F.lit(None).cast("string").alias("brand_normalized"),
        c(f("model")).alias("model"), c(f("material")).alias("material"), c(f("finish")).alias("finish"), c(f("color")).alias("color"), F.lit(None).cast("string").alias("color_code"),
        c(q("article.article_id")).alias("article_id"), q("article.marketplace").alias("marketplace"), q("price.value").cast("decimal(12,2)").alias("price_value"), q("price.currency").alias("price_currency"), q("price.unit").alias("price_unit"), q("promo_code").alias("promo_code"),
        c(F.coalesce(f("room"), F.get(other, F.lit(0)))).alias("room_context"), F.col("_quote").alias("evidence_quote"), f("method").alias("extraction_method"), confidence_label(final).alias("confidence"), (f("extra") | noted | (final == 0)).alias("needs_review"),
        c(F.array_join("_notes", "; ")).alias("notes"),
    )


def _wall_colors(blocks: DataFrame, owner: str) -> DataFrame:
    low, none = F.col("low"), F.lit(None).cast("string")
    own = blocks.where(contains_any(low, ("цвет стен", "стены цвет", "краска", "tikkurila", "dulux", "v33", "ral"))).withColumn("p_brand", P.brand(F.col("block")))
    own = own.select("*", F.posexplode(P.color_codes(F.col("block"))).alias("n", "code"))
    quote = P.quote_of(F.col("block"), F.col("code"), owner)
    sure = F.contains(low, F.lit("цвет стен")) | F.col("p_brand").isNotNull() | F.startswith("code", F.lit("RAL"))
    accent = F.contains(match_form(quote), F.lit("акцент"))
    c = clean_optional
    return own.select(
        "block", F.lit(0).alias("kind"), "n", F.lit("wall_colors").alias("category"), F.when(accent, "wall_color_accent").otherwise("wall_color").alias("item_type"), none.alias("item_name"),
        none.alias("vendor_raw"), none.alias("vendor_normalized"), F.col("p_brand.raw").alias("brand_raw"), F.col("p_brand.normalized").alias("brand_normalized"), none.alias("model"), none.alias("material"), F.when(F.contains(low, F.lit("symphony")), "Symphony").alias("finish"), none.alias("color"), c(F.col("code")).alias("color_code"),
        none.alias("article_id"), none.alias("marketplace"), F.lit(None).cast("decimal(12,2)").alias("price_value"), none.alias("price_currency"), none.alias("price_unit"), none.alias("promo_code"), none.alias("room_context"), quote.alias("evidence_quote"), F.lit("regex:wall_color_code").alias("extraction_method"),
        F.when(sure, "high").otherwise("medium").alias("confidence"), (~sure).alias("needs_review"), none.alias("notes"),
    )


FACT_KEY = ("message_id", "category", "item_type", "evidence_quote", "article_id", "color_code")


def deduplicate_facts(facts: DataFrame, key=FACT_KEY, order: str = "ord") -> DataFrame:
    """One fact for each key: the first of the highest confidence."""
    w = Window.partitionBy(*key).orderBy(confidence_rank(F.col("confidence")).desc(), F.col(order).asc())
    return facts.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sorted_facts(facts: DataFrame) -> DataFrame:
    """Total order of facts: confidence, clean first, date, message, category, item type, all descending; then ord."""
    return facts.orderBy(confidence_rank(F.col("confidence")).desc(), F.col("needs_review").asc(), F.coalesce("date", F.lit("")).desc(), F.desc("message_id"), F.desc("category"), F.desc("item_type"), F.asc("ord"))


def with_ids(facts: DataFrame) -> DataFrame:
    """Facts with ``id``, their place in the total order. Sorting is distributed; ids come from the sizes of the sorted
    partitions before, so no task sees more than its own part."""
    from .ranking import numbered

    return numbered(facts, [confidence_rank(F.col("confidence")).desc(), F.col("needs_review").asc(), F.coalesce("date", F.lit("")).desc(), F.desc("message_id"), F.desc("category"), F.desc("item_type"), F.asc("ord")], "id")


def source_posts(posts: DataFrame, scope: str = "all_text", min_article_score: int = 2, limit: int | None = None, owner: str = "") -> DataFrame:
    """Posts of a scope: all_text, project_articles (by article score) or candidates (any category at high); a limit
    takes the first by id."""
    from .candidates import article_terms, score_posts

    own = posts.where(blank_to_null(F.col("text")).isNotNull())
    if scope == "project_articles":
        own = own.where(F.size(article_terms(match_form(F.col("text")), owner)) * 2 >= F.greatest(F.lit(min_article_score), F.lit(1)))
    elif scope == "candidates":
        hits = score_posts(own, photos=F.col("photo_count"), owner=owner).where("rank = 2").select("message_id").distinct()
        own = own.join(hits, "message_id", "left_semi")
    elif scope != "all_text":
        raise ValueError(f"unknown scope {scope!r}")
    own = own.withColumn("source_scope", F.lit(scope))
    return own.orderBy("message_id").limit(limit) if limit is not None else own
