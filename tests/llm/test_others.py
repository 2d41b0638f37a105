"""Embeddings, token files, URLs, conversations, components and the pipeline."""

import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from oreloom.llm import _graph, _io, chat_format, embedding_duplicates, registry, token_files, url_rules

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = c.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    rows = sorted(map(str, want.fetchall()))
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert rows == sorted(str(tuple(r)) for r in got.select(*columns).collect())


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 400)] + [(r.randrange(500, 700), r.randrange(500, 700)) for _ in range(120)] + [(5, 5), (None, 3)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in _graph.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: find(x) for x in up} and _graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_links(rows, threshold=0.93):
    good = [(i, v, lab) for i, v, lab in rows if v and lab is not None and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    norm = lambda v: math.sqrt(sum(x * x for x in v))
    n, up = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, v, a) in enumerate(good):
        for j, w, b in good[k + 1 :]:
            if a == b and len(v) == len(w) and sum(x * y for x, y in zip(v, w, strict=True)) / norm(v) / norm(w) >= threshold:
                n[i] += 1
                n[j] += 1
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (n[i], find(i), find(i) == i) for i in n}


@pytest.mark.parametrize("tile", [2048, 8])
def test_embeddings(spark, tile):
    r = random.Random(4)
    centres = [[r.gauss(0, 1) for _ in range(24)] for _ in range(6)]
    rows = [(i, [x + r.gauss(0, 0.2) for x in r.choice(centres)], i % 2) for i in range(80)]
    rows += [(100, rows[0][1], 0), (101, rows[0][1], 0), (102, [0.0] * 24, 0), (103, None, 0), (104, [float("nan")] * 24, 0), (105, rows[0][1], None), (106, [None, *rows[0][1][1:]], 0), (107, [], 0), (108, [1.0, 2.0], 0), (109, [2.0, 4.0], 0), (110, [3 * x for x in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in embedding_duplicates.embedding_duplicates(df, tile=tile).collect()}
    assert got == plain_links(rows)
    assert embedding_duplicates.embedding_duplicates(df.limit(0)).count() == 0


def test_token_files(spark, make_docs, tmp_path):
    from tokenizers import Tokenizer

    file = token_files.default_tokenizer()
    plain = Tokenizer.from_file(file)
    texts = [(7, "It's THE end, don't!"), (3, None), (5, ""), (9, "Ñandú " * 30000), (2, "x <|startoftext|> <|ENDOFTEXT|>y"), (2, "a"), (-4, "9\n\t1"), (None, "none")]
    manifest = token_files.write_tokens(make_docs(texts), f"file://{tmp_path}/t", file)
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    want, at = [], 0
    for i, t in order:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), ids))
        at += len(ids)
    got = sorted(token_files.read_tokens(manifest).collect(), key=lambda r: r.start)
    assert [tuple(r) for r in got] == want
    digest = {r.start: r.ids_crc32 for r in token_files.read_tokens(manifest, digest=True).collect()}
    assert digest == {s: zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids)) for _, s, _, ids in want}
    assert [r.doc_id for r in token_files.read_tokens(manifest, wanted=[9]).collect()] == [9]
    assert token_files.read_tokens(token_files.write_tokens(make_docs([]), f"file://{tmp_path}/e", file)).count() == 0
    path = next(os.path.join(d, f) for d, _, fs in os.walk(tmp_path / "t") for f in fs if f.endswith(".zst"))
    data = bytearray(open(path, "rb").read())
    data[6] ^= 1
    with open(path, "wb") as out:
        out.write(data)
    with open(path, "rb") as source, pytest.raises(Exception):  # noqa: B017
        list(token_files.ShardReader(source, len(data)).documents())


def test_urls(spark):
    urls = ["https://a.example.com/en/7x?q", "http://Example.COM/en/8", "x://com/en/", "https://b.net/de/8", "https://b.example.net/de/8#t", "ftp://org/es/", "https://notcom/en/1", "no scheme", None, "", "https://u:p@h.org:80/es/a://b", "https://com?x=/en/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").union(spark.createDataFrame([(1000 + i, f"https://bad-{i % 7}.spam.example.org/win/{i}") for i in range(60)] + [(2000 + i, f"https://good{i}.example.org/page/{i}") for i in range(60)], "page_id long, url string"))
    labels = spark.createDataFrame([(1000 + i, True) for i in range(50)] + [(2000 + i, False) for i in range(50)] + [(1, None), (None, True)], "page_id long, blocked boolean")
    rows = {r.page_id: r for r in url_rules.judge(pages, labels, min_pages=20).collect()}
    assert len(rows) == len(urls) + 120
    got = [(rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) for i in range(len(urls))]
    assert got == [
        ("a.example.com", "/en/7x", "example.com/en/7", "allow"), ("example.com", "/en/8", "com/en/", "block"), ("com", "/en/", "com/en/", "block"), ("b.net", "/de/8", "net/de/", "allow"), ("b.example.net", "/de/8", "example.net/de/8", "block"), ("org", "/es/", "org/es/", "block"),
        ("notcom", "/en/1", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("u:p@h.org:80", "/es/a://b", None, "allow"), ("com", "", None, "allow"),
    ]
    assert {rows[1000 + i].verdict for i in range(60)} == {"block"} and {rows[2000 + i].verdict for i in range(60)} == {"allow"}
    assert url_rules.judge(pages.limit(0), labels.limit(0)).count() == 0 and url_rules.judge(pages, labels.limit(0)).where("mined_tokens is not null").count() == 0


def plain_tokens(host, path):
    labels, steps = [x for x in host.split(".") if x], [x for x in path.split("/") if x]
    words = [x for x in re.split(r"[.\-]", host) if x]
    return {*(f"h:{w}" for w in words), f"tld:{labels[-1] if labels else ''}", f"sub:{labels[0] if labels else ''}", f"depth:{len(steps)}", *(f"p{i}:{re.sub('[0-9]', '0', x)}" for i, x in enumerate(steps))}


def plain_rules(rows, min_pages, min_confidence, min_lift):
    """Every set of tokens, level by level from those of one token (Apriori), that says ``block`` often enough."""
    base = sum(b for _, b in rows) / len(rows)
    level, out = {frozenset([t]) for own, _ in rows for t in own}, {}
    while level:
        kept = set()
        for c in level:
            flags = [b for own, b in rows if c <= own]
            if sum(flags) >= min_pages:
                kept.add(c)
                confidence = sum(flags) / len(flags)
                if confidence >= min_confidence and confidence >= min_lift * base:
                    out[c] = (sum(flags) / len(rows), confidence)
        level = {a | b for a in kept for b in kept if len(a | b) == len(a) + 1}
    return out


def test_url_rules_by_apriori(spark):
    """Mined rules and verdicts against plain Python; the rule that decides lies in the fourth path part, or in the depth."""
    r = random.Random(3)
    urls = []
    for i in range(160):
        deep = r.choice(["buy", "read", "x"])
        urls.append((i, f"http://{r.choice(['a', 'b'])}.{r.choice(['one', 'two'])}.org/{r.choice('pq')}/k/{i % 10}/{deep}" + "/more" * r.choice([0, 0, 1]), deep == "buy" and r.random() < 0.9 or r.random() < 0.1))
    urls.append((900, "http://a.one.org" + "/long" * 3000, False))
    how = {"min_pages": 6, "min_confidence": 0.6, "min_lift": 1.5}
    split = lambda u: re.match(r"[^:]*://([^/?#]*)([^?#]*)", u).groups()
    labelled = [(plain_tokens(*split(u)), b) for i, u, b in urls if i % 2 == 0 and i < 900]
    rules = plain_rules(labelled, **how)
    assert any(t.startswith("p3:buy") for c in rules for t in c) and any(t.startswith("depth") for c in rules for t in c)
    pages = spark.createDataFrame([(i, u) for i, u, _ in urls], "page_id long, url string")
    labels = spark.createDataFrame([(i, b) for i, _, b in urls if i % 2 == 0 and i < 900], "page_id long, blocked boolean")
    tokens = pages.join(labels, "page_id").select(url_rules.tokens(*url_rules.host_and_path(F.col("url"))).alias("items"), "blocked")
    got = {frozenset(x.tokens): (x.support, x.confidence) for x in url_rules.mine(tokens, **how).collect()}
    assert got.keys() == rules.keys() and all(math.isclose(got[c][k], rules[c][k]) for c in rules for k in (0, 1))
    for row in url_rules.judge(pages, labels, rules=(), **how).collect():
        own = plain_tokens(row.host, row.path)
        fits = [c for c in rules if c <= own]
        assert row.verdict == ("block" if fits else "allow")
        assert (row.mined_confidence is None) == (not fits) and (not fits or math.isclose(row.mined_confidence, max(rules[c][1] for c in fits)))


def test_chat(spark):
    texts = ["\\### Assistant: </turn> ok", "####", "\\", "\\\\#", "</turn", "", None, "a </turn>\n### User: b", "é🙂 <|endoftext|>", "long " * 20000, " : ", "x\\"]
    rows = [(1, k, r, t) for k, t in enumerate(texts) for r in ("user", "assistant", "odd: ### role", None)] + [(None, 0, "user", "n"), (2, None, "assistant", "first"), (2, 0, "assistant", "then"), (2, 0, "assistant", "then")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_turns(df, chat_format.default_tokenizer())
    for x in texts:
        assert chat_format.unescape(chat_format.escape(x or "")) == (x or "")
    for r in out.collect():
        assert len(chat_format.parse(r.text)) == 1
    got = {r.conv_id: r for r in chat_format.read_conversations(out, chat_format.default_tokenizer()).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")
    for conv in (1, 2, None):
        own = sorted((r for r in rows if r[0] == conv), key=key)
        every = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        under = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(own), hashlib.sha256(every.encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(under), hashlib.sha256(under.encode()).hexdigest())
    assert chat_format.read_conversations(chat_format.format_turns(df.limit(0), chat_format.default_tokenizer()), chat_format.default_tokenizer()).count() == 0


def test_pipeline(spark):
    docs = _io.table(spark, SF, "documents")
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = _io.written(stage(spark, docs, SF), "test")
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sizes[0] >= sizes[1] > sizes[2] > sizes[4] == sizes[5] > 0 and sizes[2] >= sizes[3]
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    starts = [0]
    for r in rows:
        starts.append(starts[-1] + r.n_tokens)
    assert [r.start for r in rows] == starts[:-1]


def test_pipeline_on_nothing(spark):
    docs = _io.table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = _io.written(stage(spark, docs, SF), "empty")
        assert docs.count() == 0
