"""Parsers for prices, article numbers, vendors, promo codes, project names and colour codes, as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules
from ..rules import WORD
from .text import compact, contains_any, first_match, folded, has, has_word, holds_stem, let, lines, match_form, quoted, strip, truncate, word_pattern

# Amounts with space or dot between thousands, rouble tokens with a boundary behind them, units.
PRICE = r"(?iU)(?<![\w])(\d{1,3}(?:[ .]\d{3})+|\d{3,})\s*(рублей|рубля|руб\.?|₽|р\.?)(?![\p{L}\p{N}])(?:\s*/\s*(шт\.?|м2|м²|пара|уп\.?))?"
ARTICLE = rf"(?iU)(?:(ozon|озон|wb|вб|wildberries|яндекс[.\s-]*маркет|ям|сантехника\s+онлайн)\s*)?\b(?:артикул(?![\p{{L}}])|арт(?![\p{{L}}])\.?|код(?:\s+товара)?\s*:?(?![\p{{L}}]))\s*[.:]?\s*([{WORD}_-]{{3,}})"
#: Letters that no article number goes without.
ARTICLE_STEMS = ("арт", "код")
PROMO = rf"(?iU)\bпромокод\s+([{WORD}_-]+)"
PROMO_LINE = r"(?iU)\bпромо(?:код)?\b"
#: Text of JVM regular expressions needs plain spaces for the thousands of a price.
_HARD_SPACES = "[   ]"


def price_text(c: Column) -> Column:
    return F.regexp_replace(c, _HARD_SPACES, " ")


def price(c: Column) -> Column:
    """Struct (value, currency, unit, raw) of the first price; null without one."""

    def found(text):
        value = F.regexp_replace(F.regexp_extract(text, PRICE, 1), "[ .]", "").try_cast("bigint")
        unit = F.nullif(F.replace(strip(F.lower(F.regexp_extract(text, PRICE, 3)), " ."), F.lit("²"), F.lit("2")), F.lit(""))
        tail = F.left(F.regexp_replace(text, f"^[\\s\\S]*?(?:{PRICE})", ""), F.lit(20))
        pair = F.when(has(tail, r"(?iU)\bза\s+пару\b"), F.lit("пара"))
        return F.when(has(text, PRICE), F.struct(value.alias("value"), F.lit("RUB").alias("currency"), F.coalesce(unit, pair).alias("unit"), compact(F.regexp_extract(text, PRICE, 0)).alias("raw")))

    return let(price_text(c), found)


def price_count(c: Column) -> Column:
    return F.regexp_count(price_text(c), F.lit(PRICE))


def _vendor_pattern(aliases: tuple[str, ...]) -> str:
    return f"(?iU)(?<![\\w.])(?:{'|'.join(aliases)})(?![\\w.])"


def vendor(c: Column, vendors=rules.VENDORS) -> Column:
    """Struct (raw, normalized) of the vendor that is named first; null without one."""

    def found(x):
        text, low = x["text"], x["low"]
        own = [F.when(holds_stem(low, "|".join(aliases)) & has(text, p), F.struct(F.regexp_instr(text, F.lit(p)).alias("at"), F.lit(k).alias("k"), F.lit(name).alias("normalized"), F.regexp_extract(text, p, 0).alias("raw"))) for k, (name, aliases) in enumerate(vendors) for p in [_vendor_pattern(aliases)]]
        # letters that an alias begins with, or else none is there
        return F.when(holds_stem(low, "|".join(a for _, aliases in vendors for a in aliases)), F.array_min(F.filter(F.array(*own), lambda x: x.isNotNull())))

    both = lambda text: F.struct(text.alias("text"), folded(text).alias("low"))
    named = lambda first: F.when(first.isNotNull(), F.struct(compact(first["raw"]).alias("raw"), first["normalized"].alias("normalized")))
    return let(let(let(F.translate(c, "ёЁ", "еЕ"), both), found), named)


def normalize_vendor(c: Column, vendors=rules.VENDORS) -> Column:
    """A vendor's name: an alias that is the whole value, else one inside it, else the value cleaned."""

    def named(cleaned):
        def of(form):
            whole = [F.when(has(form, f"(?iU)^(?:{'|'.join(a)})$"), F.lit(n)) for n, a in vendors]
            inside = [F.when(has(form, _vendor_pattern(a)), F.lit(n)) for n, a in vendors]
            return F.coalesce(*whole, *inside)

        return F.coalesce(let(match_form(cleaned), of), cleaned)

    return let(F.nullif(compact(strip(c, " @")), F.lit("")), named)


def has_article(c: Column, low: Column | None = None) -> Column:
    """Whether an article number is given; ``low``: c folded."""
    return contains_any(folded(c) if low is None else low, ARTICLE_STEMS) & has(c, ARTICLE)


def article(c: Column, low: Column | None = None) -> Column:
    """Struct (article_id, raw, vendor_raw, vendor_normalized, marketplace) of the first article number."""

    def found(raw_vendor):
        own = F.struct(raw_vendor.alias("raw"), F.when(raw_vendor.isNotNull(), normalize_vendor(raw_vendor)).alias("normalized"))
        return let(F.when(raw_vendor.isNotNull(), own).otherwise(vendor(c)), parts)

    def parts(v):
        marketplace = F.when(v["normalized"].isin(*rules.MARKETPLACES), v["normalized"])
        return F.struct(F.regexp_extract(c, ARTICLE, 2).alias("article_id"), compact(F.regexp_extract(c, ARTICLE, 0)).alias("raw"), compact(v["raw"]).alias("vendor_raw"), v["normalized"].alias("vendor_normalized"), marketplace.alias("marketplace"))

    return F.when(has_article(c, low), let(first_match(c, ARTICLE, 1), found))


def promo_code(c: Column, low: Column | None = None) -> Column:
    return F.when(F.contains(folded(c) if low is None else low, F.lit("промокод")), first_match(c, PROMO, 1))


def promo_line(owner: str = "") -> str:
    """A pattern of lines that advertise; ``owner``: a name that marks them as well."""
    return PROMO_LINE + (f"|{quoted(owner.lower())}" if owner else "")


def without_promo_lines(c: Column, owner: str = "") -> Column:
    return F.array_join(F.filter(lines(c), lambda x: ~has(x, promo_line(owner))), "\n")


_NAME_END = r"(?iU)\b(кухня|фартук|стол|диван|цвет\s+стен|покупки|арт\.|wb|ozon)\b[\s\S]*$"


def trim_project_name(c: Column) -> Column:
    """A project's name cut at the first item; null for numbered lines, items and names under 3 characters."""

    def checked(own):
        item = has(own, f"(?iU)\\b({rules.ITEM_START})\\b") & ~F.startswith(F.lower(own), F.lit("жк "))
        name = F.when(F.length(own) > 90, F.regexp_replace(F.left(own, F.lit(90)), r"[ \-:;,.]+$", "")).otherwise(own)
        return F.when((F.length(own) >= 3) & ~has(own, r"^\d+[.)]?\s") & ~item, name)

    return let(strip(F.regexp_replace(compact(strip(c, " -:;,.")), _NAME_END, ""), " -:;,."), checked)


def project_name(c: Column) -> Column:
    """From the first 8 lines that are not blank: behind the heading of a project's articles or on the line after it,
    else a housing complex by name."""

    def of(own):
        def named(x, i):
            rest = strip(F.regexp_replace(x, r"(?iU)^.*?артикулы\s+проекта", ""), " :-")
            after = F.coalesce(trim_project_name(F.nullif(rest, F.lit(""))), trim_project_name(F.get(own, i + 1)))
            return F.when(F.contains(match_form(x), F.lit("артикулы проекта")), after)

        head = F.slice(own, 1, 8)
        heading = F.get(F.filter(F.transform(head, named), lambda x: x.isNotNull()), F.lit(0))
        complex_name = first_match(F.array_join(head, "\n"), rf"(?iU)\bЖК\s+[{WORD} .,-]{{3,80}}", 0)
        return F.coalesce(heading, trim_project_name(complex_name))

    return let(F.filter(F.transform(lines(c), compact), lambda x: x != ""), of)


def color_codes(c: Column) -> Column:
    """Colour codes in capitals, pattern by pattern, each once."""
    found = [F.transform(F.regexp_extract_all(c, F.lit(f"(?iU)({p})"), F.lit(1)), lambda x: compact(F.upper(x))) for p in rules.COLOR_CODES]
    return F.when(has(c, "[0-9]{2}"), F.array_distinct(F.concat(*found))).otherwise(F.array().cast("array<string>"))


def brand(c: Column) -> Column:
    """Struct (raw, normalized) of the first paint brand."""
    raw = first_match(c, rf"(?iU)\b({'|'.join(rules.BRANDS)})\b", 1)
    return F.when(raw.isNotNull(), F.struct(raw.alias("raw"), F.initcap(F.lower(raw)).alias("normalized")))


def item_triggers(c: Column) -> Column:
    """How many item words stand alone."""
    return F.regexp_count(c, F.lit(f"(?iU)\\b({rules.ITEM_START})\\b"))


def rooms(c: Column, low: Column | None = None) -> Column:
    """Rooms that are named, in order; ``low``: c folded."""
    if low is None:
        return let(folded(c), lambda own: rooms(c, own))
    own = F.filter(F.array(*(F.when(has_word(c, p, low), F.lit(n)) for n, p in rules.ROOMS)), lambda x: x.isNotNull())
    return F.when(holds_stem(low, "|".join(p for _, p in rules.ROOMS)), own).otherwise(F.array().cast("array<string>"))


def non_target_rooms(c: Column, low: Column | None = None) -> Column:
    return F.filter(rooms(c, low), lambda x: x.isin(*rules.NON_TARGET_ROOMS))


def lighting(c: Column, low: Column | None = None) -> Column:
    return has_word(c, rules.LIGHTING, folded(c) if low is None else low)


def lighting_or_decor(c: Column, low: Column | None = None) -> Column:
    low = folded(c) if low is None else low
    return lighting(c, low) | has_word(c, rules.DECOR, low)


def remove_parsed(c: Column) -> Column:
    """Prices, article numbers and promo codes become spaces; lines stay lines."""
    replaced = lambda x, p: F.regexp_replace(x, p, " ")
    others = lambda x: F.when(contains_any(folded(x), ARTICLE_STEMS), reduce(replaced, (ARTICLE, PROMO), x)).otherwise(x)
    own = let(replaced(price_text(c), PRICE), others)
    return F.array_join(F.transform(lines(own), compact), "\n")


def _keyword(k: str) -> str:
    return r"\s+".join(quoted(p) for p in k.split()).replace("\\-", r"[-\s]?")


def descriptor_text(c: Column, owner: str = "") -> Column:
    """A block without what the parsers read: promo lines, prices, article numbers and the vendor."""
    without = lambda own, v: F.when(v.isNotNull(), F.regexp_replace(own, F.concat(F.lit("(?iU)\\Q"), F.coalesce(v["raw"], F.lit("")), F.lit("\\E")), F.lit(" "))).otherwise(own)
    return let(remove_parsed(without_promo_lines(c, owner)), lambda own: let(vendor(own), lambda v: without(own, v)))


def descriptor(text: Column, keywords: tuple[str, ...]) -> Column:
    """What descriptor_text() says of an item behind the first of its keywords, on one line; null if nothing or a cut
    word is left. Of several keywords that begin at one place, the one given first counts."""
    any_keyword = word_pattern("|".join(_keyword(k) for k in keywords))

    def behind(own):
        return F.when(has(own, any_keyword), F.regexp_replace(own, f"^[\\s\\S]*?{any_keyword}", "")).otherwise(own)

    def line(own):
        segments = F.filter(F.transform(lines(own), lambda x: strip(x, " -:;,.+")), lambda x: x != "")
        first = F.regexp_replace(F.coalesce(F.get(segments, F.lit(0)), F.lit("")), r"^\s*\d+[.)]\s*", "")
        return compact(strip(F.regexp_replace(first, word_pattern("ozon|wb|вб|ям"), " "), " -:;,.+"))

    return let(line(let(text, behind)), lambda own: F.when(~cut_word(own), F.nullif(own, F.lit(""))))


def cut_word(c: Column) -> Column:
    """Begins like the rest of a cut word."""
    return has(match_form(c), f"^(?:{'|'.join(rules.CUT_WORDS)})")


def model_material_color(c: Column) -> Column:
    """Struct (model, material, color) of a descriptor, split at the first material, else at the first colour."""

    def places(tokens):
        at = lambda forms, words: F.array_min(F.filter(F.transform(forms, lambda x, i: F.when(x.isin(*words), i)), lambda i: i.isNotNull()))
        return let(F.transform(tokens, match_form), lambda forms: F.struct(tokens.alias("t"), at(forms, rules.MATERIALS).alias("m"), at(forms, rules.COLORS).alias("k"), F.size(tokens).alias("n")))

    def split(x):
        t, m, k, n = (x[f] for f in "tmkn")
        join = lambda a, length: F.nullif(F.array_join(F.slice(t, a, length), " "), F.lit(""))
        none = F.lit(None).cast("string")
        by_material = F.struct(join(F.lit(1), m).alias("model"), F.get(t, m).alias("material"), join(m + 2, F.lit(2)).alias("color"))
        by_color = F.struct(join(F.lit(1), k).alias("model"), none.alias("material"), join(k + 1, n).alias("color"))
        whole = F.struct(F.when(n <= 5, F.array_join(t, " ")).otherwise(c).alias("model"), none.alias("material"), none.alias("color"))
        return F.when(n > 0, F.when(m.isNotNull(), by_material).when(k.isNotNull(), by_color).otherwise(whole))

    return let(let(F.regexp_extract_all(c, F.lit(f"([{WORD}.-]+)"), F.lit(1)), places), split)


def evidence_quote(c: Column, owner: str = "") -> Column:
    return let(compact(without_promo_lines(c, owner)), lambda own: truncate(own, 260))


def quote_of(c: Column, token: Column, owner: str = "") -> Column:
    """The line that holds the token, else the evidence quote."""
    own = F.get(F.filter(lines(c), lambda x: F.contains(match_form(x), match_form(token))), F.lit(0))
    return F.coalesce(compact(own), evidence_quote(c, owner))
