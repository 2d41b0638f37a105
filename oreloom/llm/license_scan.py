"""License scans by conditional compression.

Lines that speak of licensing, and what lies between such lines, are candidate blocks. A block is compressed alone and
with each license template as a zstandard raw-content dictionary; the templates that save the largest share of its
size, and all others whose words can be there close together, are compared with the block word for word, and the best one
whose wording is there is confirmed with its differences counted. Its words are cut out and the rest of the block is
matched again until nothing is confirmed, so a block has all licenses that it states. A notice whose name is joined to a confirmed one by
``or`` or ``and`` shares the words before that one (``the MIT License or the Apache License, Version 2.0``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io

#: Lines without a licensing word that a block may run over; templates compared word for word wherever their words are; wording that must be there.
GAP, RANKED, COVER = 3, 3, 0.8

#: License id, name of the wording, wording. The published notices.
TEMPLATES = (
    ("MIT", "notice", "Released under the MIT License."),
    ("MIT", "notice", "Licensed under the MIT License."),
    ("MIT", "text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0", "notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "text", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("CC-BY-NC-4.0", "notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "notice", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "notice", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-2-Clause", "text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("ISC", "text", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)
_TRIGGER = regex.compile(r"licen[cs]|copyright|permission|redistribut|warrant|creative commons|public domain", regex.IGNORECASE)
_WORDS = regex.compile(r"[\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*")
_SENTENCE = regex.compile(r"(?<=[.!?:])\s+(?=\p{Lu}|\()")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(text)]


def blocks(text: str) -> list[str]:
    """Runs of sentences from one licensing word to another at most GAP sentences away, of the whole text."""
    if not _TRIGGER.search(text):
        return []
    parts = [s for line in text.split("\n") for s in _SENTENCE.split(line) if s.strip()]
    out, first, last = [], None, 0
    for i, s in enumerate(parts):
        if _TRIGGER.search(s):
            if first is not None and i - last > GAP + 1:
                out.append(" ".join(parts[first : last + 1]))
                first = None
            first, last = i if first is None else first, i
    if first is not None:
        out.append(" ".join(parts[first : last + 1]))
    return out


@lru_cache(maxsize=2)
def _prepared(templates: tuple) -> tuple:
    quiet = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    how = zstandard.ZstdCompressionParameters.from_level(3, min_match=3, strategy=zstandard.STRATEGY_GREEDY, **quiet)
    out = []
    for lic, kind, text in templates:
        own = words(text)
        data = f" {' '.join(own)} ".encode()
        out.append((lic, kind, own, zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(data.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT))))
    return out, zstandard.ZstdCompressor(compression_params=how)


#: What a notice has before and after its name, and what may join two names.
_AROUND, _JOINS = {"released", "licensed", "license", "under", "the", "a", "this", "work", "is"}, {"or", "and", "the", "a", "either", "both", "of", "license", "licenses"}


def _pairs(block: list[str], template: list[str]) -> list:
    return [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]


def _differ(pairs: list, template: list[str]) -> tuple[float, int]:
    if not pairs:
        return 0.0, len(template)
    same = sum(m.size for m in pairs)
    inside = pairs[-1].a + pairs[-1].size - pairs[0].a
    return same / len(template), (inside - same) + (len(template) - same)


def differences(block: list[str], template: list[str]) -> tuple[float, int]:
    """(share of the template's words that the block has in order, words added, dropped or changed between the first and last of them)"""
    return _differ(_pairs(block, template), template)


def _best(own: list[str], templates: tuple, near: bool) -> tuple | None:
    """(place in templates, saved, differences, matched runs of words) of the best confirmed template; ``near``: its words
    must be within twice its length, as they must for templates that are not among the best compressed."""
    data = f" {' '.join(own)} ".encode()
    prepared, plain = _prepared(templates)
    alone = len(plain.compress(data))
    ranked = sorted(((alone - len(c.compress(data))) / alone, -k) for k, (_, _, _, c) in enumerate(prepared))[::-1]
    have = Counter(own)

    def confirmed(some: list, near: bool) -> list:
        found = []
        for saved, k in some:
            text = prepared[-k][2]
            if (have & Counter(text)).total() < COVER * len(text):
                continue
            pairs = _pairs(own, text)
            cover, differ = _differ(pairs, text)
            if cover >= COVER and (not near or pairs[-1].a + pairs[-1].size - pairs[0].a <= 2 * len(text)):
                found.append((-cover, differ, -len(text), k, saved, pairs))
        return found

    first = [r for r in ranked[:RANKED] if r[0] > 0]
    found = confirmed(first, near) + confirmed(ranked[len(first) :], True)
    if not found:
        return None
    _, differ, _, k, saved, pairs = min(found, key=lambda f: f[:4])
    return -k, saved, differ, pairs


def _one_place(pairs: list, reach: int) -> list:
    """The runs around the longest one, none further than reach words from the next: far words may be another statement's."""
    k = max(range(len(pairs)), key=lambda i: pairs[i].size)
    first = last = k
    while first > 0 and pairs[first].a - (pairs[first - 1].a + pairs[first - 1].size) <= reach:
        first -= 1
    while last + 1 < len(pairs) and pairs[last + 1].a - (pairs[last].a + pairs[last].size) <= reach:
        last += 1
    return pairs[first : last + 1]


def _joined(own: list[str], free: set[int], spans: list, templates: tuple) -> tuple | None:
    """(place in templates, missing words, places) of a notice whose name is joined to a confirmed match."""
    known = {lic for lic, _, _ in spans}
    for k, (lic, kind, text, _) in enumerate(_prepared(templates)[0]):
        if lic in known or kind != "notice":
            continue
        core = [w for w in text if w not in _AROUND or w == "license"]
        while core and core[-1] == "license":
            core.pop()
        for _, first, last in spans:
            for step, at in ((1, last + 1), (-1, first - 1)):
                between = []
                while 0 <= at < len(own) and own[at] in _JOINS and at in free:
                    between.append(own[at])
                    at += step
                at = at if step == 1 else at - len(core) + 1
                places = list(range(at, at + len(core)))
                if core and at >= 0 and {"or", "and"} & set(between) and own[at : at + len(core)] == core and free.issuperset(places):
                    return k, len(text) - len(core), places
    return None


def matches(block: str, templates: tuple = TEMPLATES) -> list[tuple[str, str, float, int]]:
    """(license, kind, share of the size saved, differing words) of every confirmed template, best first."""
    own = words(block)
    left = list(range(len(own)))
    prepared = _prepared(templates)[0]
    out, spans, covered = [], [], {}
    while left:
        rest = [own[i] for i in left]
        best = _best(rest, templates, bool(out))
        if best is None:
            break
        k, saved, differ, pairs = best
        lic, kind, text, _ = prepared[k]
        if differ:
            runs = [[p for m in _one_place(pairs, len(text)) for p in range(m.a, m.a + m.size)]]
        else:  # every repetition of an exact wording at once
            runs, i = [], 0
            while i <= len(rest) - len(text):
                same = rest[i] == text[0] and rest[i : i + len(text)] == text
                if same:
                    runs.append(range(i, i + len(text)))
                i += len(text) if same else 1
        for run in runs:
            first, last = left[run[0]], left[run[-1]]
            # a notice and the text of its license around or beside it are one statement
            if not any(other == lic and any(at[max(0, first - (how != kind)) : last + 1 + (how != kind)]) for (other, how), at in covered.items()):
                out.append((lic, kind, saved, differ))
            spans.append((lic, first, last))
            covered.setdefault((lic, kind), bytearray(len(own)))[first : last + 1] = b"\1" * (last + 1 - first)
        taken = {p for run in runs for p in run}
        left = [i for p, i in enumerate(left) if p not in taken]
    free = set(left)
    while spans and (more := _joined(own, free, spans, templates)):
        k, missing, places = more
        out.append((prepared[k][0], prepared[k][1], 0.0, missing))
        spans.append((prepared[k][0], places[0], places[-1]))
        free -= set(places)
    return out


def match(block: str, templates: tuple = TEMPLATES) -> tuple[str, str, float, int] | None:
    """The first of matches()."""
    return next(iter(matches(block, templates)), None)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per row of docs: id_col, n_blocks (candidate blocks), licenses (distinct, sorted, comma-joined), n_exact
    (matches of a template's exact wording), matches (array of license, kind, saved, differences, block).

    A null or empty text has no block. Blocks without a confirmed template count in n_blocks only.
    """
    kind = pa.list_(pa.struct([("license", pa.string()), ("kind", pa.string()), ("saved", pa.float64()), ("differences", pa.int32()), ("block", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many, names, exact, rows = [], [], [], []
            for t in batch.column(1):
                own = blocks(t.as_py() or "")
                found = [(m, b) for b in own for m in matches(b, templates)]
                many.append(len(own))
                names.append(",".join(sorted({m[0] for m, _ in found})))
                exact.append(sum(m[3] == 0 for m, _ in found))
                rows.append([{"license": m[0], "kind": m[1], "saved": round(m[2], 6), "differences": m[3], "block": b} for m, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(many, pa.int64()), pa.array(names, pa.string()), pa.array(exact, pa.int64()), pa.array(rows, kind)], names=[id_col, "n_blocks", "licenses", "n_exact", "matches"])

    own = docs.select(F.col(id_col), F.col(text))
    return own.transform(_io.arrow(run, _io.schema_with(own.select(id_col), "n_blocks bigint", "licenses string", "n_exact bigint", "matches array<struct<license:string,kind:string,saved:double,differences:int,block:string>>")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(_io.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_blocks", "licenses", "n_exact", F.size("matches").cast("long").alias("n_matches"))
