"""Text functions as Columns. A null text stays null unless stated otherwise."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import WORD

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def quoted(text: str) -> str:
    """text as a Java pattern that matches itself."""
    return _SPECIAL.sub(r"\\\1", text)


def compact(c: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def match_form(c: Column) -> Column:
    """Lower-cased, ё as е, compacted: the form that terms are looked up in."""
    return compact(F.translate(F.lower(c), "ё", "е"))


def match_form_of(text: str) -> str:
    return " ".join(text.casefold().replace("ё", "е").split())


def truncate(c: Column, n: int, mark: str = "...") -> Column:
    """At most n characters; a longer text ends in ``mark``."""
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.regexp_replace(F.left(c, F.lit(n - len(mark))), r"(?U)\s+$", ""), F.lit(mark)))


def preview(c: Column, n: int = 120) -> Column:
    return truncate(compact(c), n)


def keyword_pattern(keyword: str) -> str:
    """A pattern for a term in match form: whole words, white space or hyphens between its parts."""
    body = r"[\s-]+".join(quoted(p) for p in match_form_of(keyword).split(" "))
    return f"(?<![{WORD}]){body}(?![{WORD}])"


def word_pattern(alternatives: str) -> str:
    """Any of the alternatives as a whole word, in any case."""
    return f"(?iU)(?<![{WORD}])(?:{alternatives})(?![{WORD}])"


def folded(c: Column) -> Column:
    """Letters alike that a pattern in any case takes for alike. What such a pattern asks for as letters stands in it."""
    return F.lower(F.translate(F.upper(c), "İ", "I"))


def stems(alternatives: str) -> tuple[str, ...]:
    """The letters that each alternative of a pattern begins with, lower-cased; empty where one begins otherwise."""
    parts, depth, begin, i = [], 0, 0, 0
    while i < len(alternatives):
        x = alternatives[i]
        depth += (x in "([") - (x in ")]")
        if x == "|" and not depth:
            parts.append(alternatives[begin:i])
            begin = i + 1
        i += 2 if x == "\\" else 1
    found = []
    for part in [*parts, alternatives[begin:]]:
        own = re.match(r"[\w -]*", part)[0]
        found.append((own[:-1] if part[len(own) :][:1] in ("?", "*", "{") else own).lower())
    return tuple(found)


def holds_stem(low: Column, alternatives: str) -> Column:
    """Whether a folded text holds the beginning of an alternative: without it none matches, and looking costs less than
    the pattern."""
    own = stems(alternatives)
    return contains_any(low, dict.fromkeys(own)) if all(own) else low.isNotNull()


def has_word(c: Column, alternatives: str, low: Column) -> Column:
    """Whether an alternative stands in c as a whole word, in any case; ``low``: c folded."""
    return holds_stem(low, alternatives) & has(c, word_pattern(alternatives))


def matched_names(c: Column, named: Iterable[tuple[str, str]], terms: Iterable[str] = ()) -> Column:
    """Names of the patterns found in c, in the order given. ``terms``: names that are themselves what c, in match form, must
    hold the first part of; looking for it costs less than the pattern."""
    plain = set(terms)
    test = lambda n, p: F.contains(c, F.lit(match_form_of(n).split(" ")[0])) & c.rlike(f"(?iU){p}") if n in plain else c.rlike(f"(?iU){p}")
    own = [F.when(test(n, p), F.lit(n)) for n, p in named]
    return F.filter(F.array(*own), lambda x: x.isNotNull()) if own else F.array().cast("array<string>")


def ordered_distinct(values: Column, key=lambda x: x) -> Column:
    """The first of each group of values with the same key, in order; nulls and blanks go."""

    def among(kept):
        return let(F.transform(kept, key), lambda keys: F.filter(kept, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1))

    return let(F.filter(values, lambda x: x.isNotNull() & (F.trim(x) != "")), among)


def excerpt(c: Column, terms: Sequence[str] = (), patterns: Sequence[str] = (), matched: Column | None = None, width: int = 500) -> Column:
    """width characters around the first match of a term or pattern; the text's beginning if nothing matches.

    ``matched``: an array of names; only terms and patterns named there are looked up.
    """

    def places(form):
        among = lambda name, at: at if matched is None else F.when(F.array_contains(matched, name), at)
        own = [among(t, F.locate(match_form_of(t), form)) for t in terms] + [among(p, F.when(form.rlike(f"(?iU){p}"), F.regexp_instr(form, F.lit(f"(?iU){p}"))).otherwise(F.lit(0))) for p in patterns]
        return F.array_min(F.filter(F.array(F.lit(None).cast("int"), *own), lambda x: x > 0)) - 1

    def window(at):
        text, first = at["text"], at["first"]
        end = F.least(F.length(text), F.greatest(F.lit(0), first - width // 2) + width)
        return let(F.struct(text.alias("text"), end.alias("end"), F.greatest(F.lit(0), end - width).alias("begin")), cut)

    def cut(w):
        return F.concat(F.when(w["begin"] > 0, F.lit("...")).otherwise(F.lit("")), F.trim(F.substring(w["text"], w["begin"] + 1, w["end"] - w["begin"])), F.when(w["end"] < F.length(w["text"]), F.lit("...")).otherwise(F.lit("")))

    def whole(text):
        return let(F.struct(text.alias("text"), let(match_form(text), places).alias("first")), lambda at: F.when(at["first"].isNull(), truncate(at["text"], width)).otherwise(window(at)))

    return let(compact(c), whole)


def lines(c: Column) -> Column:
    """Lines of a text, whatever their ends."""
    # A pattern of one letter is split at without the pattern being compiled for each text.
    return F.when(has(c, r"[\r\x0B\f\x85\u2028\u2029]"), F.split(c, r"\r\n|\r|\n|\u000B|\u000C|\u0085| | ")).otherwise(F.split(c, "\n"))


def strip(c: Column, chars: str) -> Column:
    """Without these characters at the ends."""
    own = "[" + "".join(quoted(x) if x not in "\t" else r"\t" for x in chars) + "]"
    return F.regexp_replace(c, f"^{own}+|{own}+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def clean_optional(c: Column, chars: str = " -:;,.") -> Column:
    """Compacted, without punctuation at the ends; null if nothing is left."""
    return F.nullif(compact(strip(c, chars)), F.lit(""))


def word_count_over(c: Column, n: int = 8) -> Column:
    """More than n words."""
    return F.coalesce(F.regexp_count(c, F.lit(f"[{WORD}]+")) > n, F.lit(False))


def contains_any(c: Column, parts: Iterable[str]) -> Column:
    own = [F.contains(c, F.lit(p)) for p in parts]
    out = F.lit(False)
    for x in own:
        out = out | x
    return F.coalesce(out, F.lit(False))


def has(c: Column, pattern: str) -> Column:
    """True or false, never null."""
    return F.coalesce(c.rlike(pattern), F.lit(False))


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """The group of the first match; null without a match or if the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def first_of(c: Column, cases: Iterable[tuple[str, str]]) -> Column:
    """The name of the first (name, pattern) found; null if none is."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(list(cases)):
        out = F.when(has(c, pattern), F.lit(name)).otherwise(out)
    return out


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """Russian noun form for a number."""
    tens, units = F.pmod(n, F.lit(100)), F.pmod(n, F.lit(10))
    return F.when(tens.between(11, 14), many).when(units == 1, one).when(units.between(2, 4), few).otherwise(many)


def markdown_cell(c: Column) -> Column:
    """Pipes escaped, line ends as spaces; null as empty."""
    return F.coalesce(F.regexp_replace(F.replace(c, F.lit("|"), F.lit("\\|")), r"[\r\n]+", " "), F.lit(""))


def format_bytes(n: Column) -> Column:
    """B, KB, MB, GB or TB with one decimal above bytes."""
    out = F.format_string("%.1f TB", n / float(1 << 40))
    for unit, shift in (("GB", 30), ("MB", 20), ("KB", 10)):
        out = F.when(n < F.lit(1 << (shift + 10)), F.format_string(f"%.1f {unit}", n / float(1 << shift))).otherwise(out)
    return F.when(n < 1024, F.format_string("%d B", n)).otherwise(out)


def labelled(c: Column, labels: dict[str, str]) -> Column:
    """The label of a value, or the value itself."""
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in labels.items() for x in kv)), c), c)


def confidence_rank(c: Column) -> Column:
    return F.when(c == "high", 2).when(c == "medium", 1).when(c == "low", 0)


def confidence_label(rank: Column) -> Column:
    return F.when(rank >= 2, "high").when(rank == 1, "medium").when(rank == 0, "low")


def int_or_null(c: Column) -> Column:
    """A whole number from a number or a text of digits; anything else is null."""
    return c.try_cast("bigint")


def meaningful(c: Column) -> Column:
    """Not null, an empty string, array or object (in JSON form)."""
    return F.coalesce(~F.trim(c).isin("", "[]", "{}", '""', "null"), F.lit(False))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def format_price(value: Column, currency: Column, unit: Column) -> Column:
    """``64 990 ₽/шт``; null without a value."""
    whole = F.replace(F.format_number(value.cast("decimal(18,0)"), 0), F.lit(","), F.lit(" "))
    sign = F.when(F.coalesce(currency, F.lit("RUB")) == "RUB", F.lit("₽")).otherwise(currency)
    return F.when(value.isNotNull(), F.concat(whole, F.lit(" "), sign, F.when(unit.isNotNull(), F.concat(F.lit("/"), unit)).otherwise("")))


def format_day(date: Column) -> Column:
    """The day of an ISO date text."""
    return F.nullif(F.split_part(date, F.lit("T"), F.lit(1)), F.lit(""))


def post_url(channel: str, message_id: Column) -> Column:
    return F.concat(F.lit(f"https://t.me/{channel}/"), message_id.cast("string"))


def canonical_json(c: Column) -> Column:
    """JSON text with sorted keys and no spaces; null if it is not JSON."""
    return F.to_json(F.try_parse_json(c))
