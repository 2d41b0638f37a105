"""Operators on documents against plain versions: near-duplicates, decontamination, language ID, mixing, token counts, licenses."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from oreloom.llm import decontaminate, language_id, license_scan, mixing, near_duplicates, token_counts, token_files

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def plain_groups(rows, k, percent):
    """Connected components by all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed, n=60):
    r = random.Random(seed)
    words = [f"w{i}é" for i in range(400)]
    base = [[r.choice(words) for _ in range(r.randrange(5, 120))] for _ in range(12)]
    rows = []
    for i in range(n):
        own = list(r.choice(base))
        for _ in range(r.randrange(0, 6)):
            own[r.randrange(len(own))] = r.choice(words)
        rows.append((i, r.choice([" ", "\n"]).join(own)))
    return [*rows, (900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "x " * 3000), (907, "x " * 2990)]


@pytest.mark.parametrize(("k", "percent", "block"), [(3, 85, 256), (5, 80, 256), (3, 85, 4)])
def test_near_duplicates(make_docs, monkeypatch, k, percent, block):
    monkeypatch.setattr(near_duplicates, "LIST", block)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    rows = corpus(k)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(make_docs(rows), shingle=k, percent=percent).collect()}
    assert got == plain_groups(rows, k, percent)


def test_near_duplicates_edges(make_docs):
    docs = make_docs([(1, "a b c d"), (1, "a b c d"), (2, "A B c d"), (None, "a b c d"), (3, "other words here now")])
    rows = near_duplicates.near_duplicates(docs, shingle=3, percent=85).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in rows) == [("1", 1, True), ("1", 1, True), ("2", 1, False), ("3", 3, True), ("None", None, True)]
    kept = near_duplicates.deduplicate(docs, shingle=3, percent=85)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "None"]
    assert near_duplicates.near_duplicates(make_docs([])).count() == 0


def plain_contamination(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    runs = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            runs[tuple(w[s : s + n])].add(str(i))
    out = {}
    for d, t in docs:
        w, hit, own = words(t), set(), set()
        for n in {len(r) for r in runs}:
            for s in range(len(w) - n + 1):
                if found := runs.get(tuple(w[s : s + n])):
                    hit.update(range(s, s + n))
                    own |= found
        out[d] = (len(w), len(hit), len(own), sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 24, 200])
def test_contamination(spark, make_docs, block_bytes):
    r = random.Random(5)
    words = [f"t{i}" for i in range(60)] + ["é", "ß9"]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 3, 9, 10, 11, 25, 40])))) for i in range(12)] + [(50, None), (51, ""), (52, "the the the the the the the the the the the")]
    docs = []
    for i in range(40):
        own = [r.choice(words) for _ in range(r.randrange(0, 80))]
        for _ in range(r.randrange(0, 3)):
            at = r.randrange(len(own) + 1)
            item = (r.choice(items)[1] or "").split()
            own[at:at] = item[r.randrange(0, 3) :]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(own).title()))
    docs += [(100, None), (101, ""), (102, "the " * 300)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.contamination(make_docs(docs), bench, block_bytes=block_bytes).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == plain_contamination(docs, items)
    clean = decontaminate.decontaminate(make_docs(docs), bench, block_bytes=block_bytes)
    assert clean.columns == make_docs(docs).columns
    assert {r.doc_id for r in clean.collect()} == {d for d, v in plain_contamination(docs, items).items() if not v[4]}
    assert decontaminate.contamination(make_docs([]), bench).count() == 0 and decontaminate.decontaminate(make_docs(docs), bench.limit(0)).count() == len(docs)


def test_language_id(spark, make_docs):
    docs = language_id.folds(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    model = language_id.sample(docs.where("not held_out"))
    assert set(model) == {"en", "de", "fr", "es"} and max(map(len, model.values())) <= language_id.SAMPLE_BYTES
    rows = language_id.identify(docs, model).select("doc_id", "held_out", "lang", "lang_pred", "score", "text").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97
    odd = language_id.identify(make_docs([(1, None), (2, ""), (3, "123 !?"), (4, "THE " * 9000)]), model)
    assert {r.doc_id: r.lang_pred for r in odd.collect()} == {1: "und", 2: "und", 3: "und", 4: "en"}
    assert language_id.sample(docs.limit(0)) == {} and language_id.classify("the", ()) == ("und", 0.0)


def test_mixing(make_docs):
    rows = [(i, "word " * (60 + i % 7), ["en", "de", None][i % 3], f"s{i % 4}") for i in range(400)] + [(1000, None), (1001, "", "fr", None)]
    docs = make_docs(rows)
    targets = {"source": {"s0": 0.7, "s1": 0.1, "s2": 0.1, "s3": 0.1}, "lang": None, "topic": None}
    out = mixing.with_probability(docs, targets=targets, rounds=6, rate=0.2)
    got = out.collect()
    assert len(got) == len(rows) and all(r._probability == 0 and not r._kept for r in got if r.doc_id >= 1000)
    share = lambda s: sum(r._probability * r._tokens for r in got if r._source == s) / sum(r._probability * r._tokens for r in got)
    assert abs(share("s0") - 0.7) < 0.01 and abs(share("s1") - 0.1) < 0.01
    kept = mixing.mix(docs, targets=targets, rounds=6, rate=0.2)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r._kept}
    assert mixing.mix(make_docs([])).count() == 0


def test_mixing_within_tokens(make_docs):
    """Raked multipliers beyond 1 / rate: the targets that can be met are met, the others are taken whole and named."""
    rows = [(i, "word " * 100, "es" if i % 25 == 0 else "en", "rare" if i % 10 == 0 else "s", "x") for i in range(500)] + [(1000 + i, "word " * 20, "en", "s") for i in range(3)]
    targets = {"source": {"s": 0.7, "rare": 0.3}, "lang": {"en": 0.93, "es": 0.07}, "topic": {"prose": 0.9, "note": 0.1}}
    out = mixing.with_probability(make_docs(rows), targets=targets, rate=0.3, rounds=30)
    got = out.collect()
    want, every = sum(r._probability * r._tokens for r in got), sum(r._tokens for r in got)
    assert abs(want / every - 0.3) < 1e-6 and max(r._probability for r in got) <= 1
    assert all(abs(r._probability - 1) < 1e-6 for r in got if r._topic == "note")
    told = {(r.dimension, r.value): r for r in mixing.achieved(out, targets, rate=0.3).collect()}
    assert {k for k, r in told.items() if not r.feasible} == {("topic", "note")}
    assert all(abs(r.expected - r.target) < 1e-4 for (d, _), r in told.items() if d != "topic")


def test_token_counts(spark, make_docs):
    own = token_counts.counter(token_counts.default_tokenizer())
    full = lambda t: len(own.tokenizer.encode(t, add_special_tokens=False))
    r = random.Random(7)
    parts = [" ", "  ", "\n", "a", "b", "'", "s", "'re", "1", "!", "é", "The", "<|endoftext|>"]
    for _ in range(400):
        tree = token_counts.TokenTree("".join(r.choice(parts) for _ in range(r.randrange(0, 400))), own)
        for _ in range(5):
            a = r.randrange(-2, len(tree.text) + 3)
            tree.edit(a, a + r.choice([0, 1, 5, 60]), "".join(r.choice(parts) for _ in range(r.choice([0, 1, 9]))))
            assert tree.total == full(tree.text) and sum(x for c in tree.chunks for x, _ in c) == len(tree.text)
    long = "some plain words of a text. " * 800
    docs = make_docs([(1, None), (2, ""), (3, long)]).withColumn("edits", token_counts.revision(F.col("text")))
    rows = {x.doc_id: x for x in token_counts.recount(docs, token_counts.default_tokenizer()).collect()}
    assert rows[3].n_tokens == full(long) and rows[3].reencoded_chars < 400 and rows[2].n_tokens == 0 and rows[1].tokens_after == rows[2].tokens_after > 0
    edits = spark.createDataFrame([(3, 2, 0, 4, "last"), (3, 1, 0, 0, "first ")], "doc_id long, seq int, start int, end int, text string")
    scripted = token_counts.recount(token_counts.attach_edits(docs, edits), token_counts.default_tokenizer())
    assert {x.doc_id: x.tokens_after for x in scripted.collect()}[3] == full("lastt " + long)


@pytest.mark.parametrize(("chunk", "full"), [(64, 128), (2, 4)])
def test_token_trees(monkeypatch, chunk, full):
    """Pre-tokens found at once are those of the pattern; edited trees are those of the edited texts, sums of ranges too."""
    monkeypatch.setattr(token_counts, "CHUNK", chunk)
    monkeypatch.setattr(token_counts, "FULL", full)
    own = token_counts.counter(token_counts.default_tokenizer())
    r = random.Random(11)
    parts = [" ", "  ", "\n", "a", "'", "s", "'re", "'l", "l", "'v", "e", "1", "!", "é", "The", "\u00a0", "\t", "٣", "漢", "🙂", "\u0301", "\x1c", "\x85"]
    make = lambda most: "".join(r.choice(parts) for _ in range(r.randrange(most)))
    for _ in range(250):
        texts = [make(60) for _ in range(4)]
        raw = [t.encode() for t in texts]
        lengths, counts, of = own.leaves(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        for t, a, b in zip(texts, of[:-1], of[1:], strict=True):
            assert lengths[a:b].tolist() == [len(x) for x in own.scan.findall(t)]
            assert counts[a:b].sum() == len(own.tokenizer.encode(t, add_special_tokens=False))
    for _ in range(100):
        tree = token_counts.TokenTree(make(200), own)
        for _ in range(6):
            a = r.randrange(-2, tree.length + 3)
            tree.edit(a, a + r.choice([0, 0, 1, 5, 60, 1000]), make(r.choice([1, 2, 9, 120])))
            text = tree.text
            leaves = [x for c in tree.chunks for x in c]
            assert tree.length == len(text) and tree.leaves == len(leaves) and [x for x, _ in leaves] == [len(x) for x in own.scan.findall(text)]
            x, y = sorted((r.randrange(len(text) + 2), r.randrange(len(text) + 2)))
            begins = [sum(n for n, _ in leaves[:k]) for k in range(len(leaves))]
            assert tree.count_between(x, y) == sum(c for b, (_, c) in zip(begins, leaves, strict=True) if x <= b < y)


def test_token_counts_edges(make_docs):
    file = token_counts.default_tokenizer()
    docs = make_docs([(1, "a b"), (1, "a b"), (None, "c")]).withColumn("edits", F.expr("array(cast(null as struct<start:int,end:int,text:string>), named_struct('start', null, 'end', null, 'text', 'x '))")).withColumn("n_tokens", F.lit("mine"))
    rows = sorted((str(r.doc_id), r.n_tokens, r.n_edits, r.tokens_after, r.chars_after) for r in token_counts.recount(docs, file).collect())
    assert rows == [("1", 2, 2, 3, 5), ("1", 2, 2, 3, 5), ("None", 1, 2, 2, 3)]
    assert token_counts.recount(docs.limit(0), file).count() == 0
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(token_files.default_tokenizer())


def test_licenses(make_docs):
    mit = license_scan.TEMPLATES[2][2]
    docs = make_docs([(1, "prose\nReleased under the MIT License. more"), (2, "Intro line\n" + mit.replace("substantial", "important").replace(". ", ".\n")), (3, None), (4, ""), (5, "a worthless license of nothing"), (6, "Licensed under CC BY-NC 4.0. " + "x " * 20000 + "Licensed under the Apache License, Version 2.0.")])
    rows = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert (rows[1].licenses, rows[1].n_exact) == ("MIT", 1)
    assert rows[2].licenses == "MIT" and rows[2].n_exact == 0 and 1 <= rows[2].matches[0].differences <= 4
    assert (rows[3].n_blocks, rows[4].n_blocks, rows[5].licenses, rows[5].n_blocks) == (0, 0, "", 1)
    assert rows[6].licenses == "Apache-2.0,CC-BY-NC-4.0"


def test_several_licenses_in_a_block(make_docs):
    mit, apache, gpl = (license_scan.TEMPLATES[k][2] for k in (2, 4, 6))
    texts = [
        "Licensed under CC BY-NC 4.0. " + "x " * 20000 + "Licensed under the Apache License, Version 2.0.",
        "Released under the MIT License. One plain sentence. Licensed under CC BY-NC 4.0.",
        "Licensed under the MIT License or the Apache License, Version 2.0.",
        "Licensed under either of the Apache License, Version 2.0 or MIT license at your option.",
        f"Notices\n{mit}\n{apache}\n{gpl}\nLicensed under CC BY 4.0.\nThis work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Released under the MIT License. " * 3,
        apache.replace("obtain", "get"),
        "Licensed under the MIT License. This is version 2.0 of it, licensed as before.",
    ]
    rows = {r.doc_id: r for r in license_scan.scan(make_docs(list(enumerate(texts)))).collect()}
    want = ["Apache-2.0,CC-BY-NC-4.0", "CC-BY-NC-4.0,MIT", "Apache-2.0,MIT", "Apache-2.0,MIT", "Apache-2.0,CC-BY-4.0,CC-BY-SA-4.0,GPL-3.0,MIT", "MIT", "Apache-2.0", "MIT"]
    assert [rows[k].licenses for k in range(len(texts))] == want
    assert [(rows[k].n_blocks, len(rows[k].matches)) for k in range(len(texts))] == [(1, 2), (1, 2), (1, 2), (1, 2), (1, 5), (1, 3), (1, 1), (1, 1)]
    assert rows[0].n_exact == rows[1].n_exact == 2 and rows[4].n_exact == 5 and rows[5].n_exact == 3
