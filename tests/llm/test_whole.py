"""Operators and the pipeline against plain versions of the whole job, and columns that must pass unchanged."""

import glob
import math
import zlib

import numpy as np
import pytest
import test_documents as plain
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from oreloom.llm import _io, _pieces, decontaminate, language_id, license_scan, mixing, near_duplicates, token_files

SF = "/root/testdata/sf0.001"
ROWS = [(i, f"the words of text {i} " + "and many more words of the house by the river " * (i % 5 + 1), "en", f"s{i % 3}") for i in range(60)] + [(70, None), (71, ""), (72, "123 456"), (None, "the house is by the river and the wood")]


@pytest.fixture(scope="module")
def model(spark):
    return language_id.sample(spark.read.parquet(f"{SF}/documents.parquet"))


def test_columns_pass_unchanged(spark, make_docs, unchanged, model):
    docs = make_docs(ROWS)
    bench = spark.createDataFrame([(1, "the words of text 7 and many more words of the house")], "item_id long, text string")
    assert len(unchanged(language_id.accepted(docs, model), docs, ["lang"])) == 61
    assert 0 < len(unchanged(near_duplicates.deduplicate(docs), docs)) <= len(ROWS)
    assert len(unchanged(decontaminate.decontaminate(docs, bench), docs)) == len(ROWS) - 1
    drawn = unchanged(mixing.mix(docs), docs)
    assert 0 < len(drawn) < len(ROWS)
    same = mixing.with_probability(docs).where("_kept")
    assert same.count() == len(drawn) and len(set(same.columns)) == len(same.columns)
    assert len(set(language_id.identify(docs, model).columns)) == len(docs.columns)
    assert dict(decontaminate.find_spans(docs, bench).dtypes)["_words"] == "bigint"


def test_index_is_small():
    """The index of a benchmark block is about three times its text, whatever the items repeat."""
    r = np.random.default_rng(1)
    items = [(str(i), " ".join(f"w{x}" for x in r.integers(0, 50_000, 400))) for i in range(400)] + [("same", "the " * 5000), ("short", "a b c")]
    index = decontaminate.Index(items)
    text = sum(len(t) for _, t in items)
    size = len(index.text) + index.prints.nbytes + sum(x.hashes.nbytes + x.places.nbytes for x in index.runs.values())
    assert size < 3.2 * text and len(index.text) <= text + len(items)


def test_language_by_every_dictionary(spark, make_docs, model):
    """Texts of every length, against sizes with each whole dictionary, block by block."""
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    texts = [t[:n] for t in (r.text for r in docs[:40]) for n in (20, 100, 511, 513, 100_000)]
    how = zstandard.ZstdCompressionParameters.from_level(6, min_match=3, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
    rows = language_id.identify(make_docs([(i, t) for i, t in enumerate(texts)]), model).collect()
    order = list(model)
    for row in rows:
        own = language_id.normalise(texts[row.doc_id])
        if not own:
            assert row.lang_pred == "und"
            continue
        sizes = []
        for lang, data in model.items():
            c = zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            sizes.append((sum(len(c.compress(own[k : k + language_id.BLOCK])) for k in range(0, len(own), language_id.BLOCK)), order.index(lang), lang))
        sizes.sort()
        assert row.lang_pred == sizes[0][2] and row.score == 1 - sizes[0][0] / sizes[1][0]


def test_language_edges(spark, make_docs):
    one = language_id.sample(make_docs([(1, "some words", "xx"), (2, "some words", "xx"), (3, "other", None)]))
    assert one == {"xx": b" some words "} and language_id.classify("anything", tuple(one.items())) == ("xx", 1.0)
    tie = {"aa": b" some words here ", "bb": b" some words here "}
    assert language_id.classify("some words", tuple(tie.items()))[0] == "aa"
    assert language_id.identify(make_docs([]), tie).count() == 0


def test_licenses_by_every_template(spark):
    """Licenses of each block against a scan that compares all templates word for word, without compression."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("text rlike '(?i)licen[cs]|copyright'").select("text").collect()]
    blocks = [b for t in texts for b in license_scan.blocks(t)]
    own = [(lic, license_scan.words(t)) for lic, _, t in license_scan.TEMPLATES]
    assert blocks

    def every(words):
        """Licenses with exact wordings in the block, each cut out, the longest first."""
        out, left = set(), words
        for lic, t in sorted(own, key=lambda x: -len(x[1])):
            i = 0
            while i <= len(left) - len(t):
                if left[i : i + len(t)] == t:
                    out.add(lic)
                    left = left[:i] + ["\0"] + left[i + len(t) :]
                i += 1
        return out

    stated = 0
    for b in blocks:
        exact = {m[0] for m in license_scan.matches(b) if m[3] == 0}
        assert exact == every(license_scan.words(b))
        stated += bool(exact)
    assert stated


def test_licenses_of_odd_tables(make_docs):
    long = " ".join(["Released under the MIT License. " + "word " * 400] * 40)
    out = license_scan.scan(make_docs([(1, long), (1, long), (2, "\n".join([t for _, _, t in license_scan.TEMPLATES] * 2)), (None, "no such word")]))
    rows = sorted(((str(r.doc_id), r.n_blocks, r.licenses, r.n_exact) for r in out.collect()))
    assert rows[0] == rows[1] and rows[0][2] == "MIT" and rows[0][3] == 40
    assert rows[2][2] == ",".join(sorted({lic for lic, _, _ in license_scan.TEMPLATES})) and rows[3] == ("None", 0, "", 0)
    assert license_scan.scan(make_docs([])).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_files_of_any_tokenizer(spark, make_docs, name, tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    texts = ["Hello World, Foo", "It's  THE\n\nend, don't! ", "x <|endoftext|> y <|STARTOFTEXT|>", "Ñandú 東京 12345 🙂", "", None]
    files = [public_tokenizers.path(name)]
    told = json.loads(open(files[0], encoding="utf-8").read())
    told["normalizer"] = {"type": "Lowercase"}  # no kind known here
    files.append(str(tmp_path / "odd.json"))
    with open(files[1], "w", encoding="utf-8") as f:
        json.dump(told, f)
    assert _pieces.kind_of(Tokenizer.from_file(files[1])) is _pieces.TextEncoder and _pieces.kind_of(Tokenizer.from_file(files[0])) is not _pieces.TextEncoder
    for file in files:
        own = Tokenizer.from_file(file)
        manifest = token_files.write_tokens(make_docs(list(enumerate(texts))), f"file://{tmp_path}/{len(file)}", file)
        got = {r.doc_id: r.ids for r in token_files.read_tokens(manifest).collect()}
        assert got == {i: [*own.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def plain_rates(docs, rate=mixing.RATE, rounds=mixing.ROUNDS):
    """Probability of each cell: raking within tokens in plain Python."""
    cells = {}
    for key, n in docs:
        if n:
            cells[key] = cells.get(key, 0.0) + n
    every, values = sum(cells.values()), [sorted({k[d] for k in cells}) for d in range(3)]
    own = lambda d, v, w: sum(w[k] for k in w if k[d] == v)
    shares = [None, mixing.LANG_SHARES, None]
    wish = [{v: own(d, v, cells) ** mixing.ALPHA if shares[d] is None else shares[d].get(v, 0.0) for v in values[d]} for d in range(3)]
    cells = {k: n for k, n in cells.items() if all(wish[d][k[d]] > 0 for d in range(3))}
    asked = min(rate * every, sum(cells.values()))
    goal = []
    for d in range(3):
        room = {v: own(d, v, cells) for v in {k[d] for k in cells}}
        lo, hi = 0.0, 1e18
        for _ in range(400):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if sum(min(room[v], mid * wish[d][v]) for v in room) < asked else (lo, mid)
        goal.append({v: min(room[v], hi * wish[d][v]) for v in room})
    want = {k: n * rate for k, n in cells.items()}
    for _ in range(rounds):
        for d in range(3):
            for v, g in goal[d].items():
                mine = [k for k in cells if k[d] == v]
                whole = sum(cells[k] for k in mine if want[k] >= cells[k])
                free = sum(want[k] for k in mine if want[k] < cells[k])
                by = (g - whole) / free if free > 0 and whole + free < g else g / (whole + free)
                for k in mine:
                    want[k] = min(want[k] * by, cells[k] * 1e12)
    return {k: min(want[k], n) / n for k, n in cells.items()}


def test_pipeline_against_plain_stages(spark):
    """Every stage on what the one before kept, and the rows of run(), by plain Python on the whole small tables."""
    from tokenizers import Tokenizer

    docs = _io.table(spark, SF, "documents")
    stage = [f for _, f in corpus_pipeline.STAGES]
    rows = docs.collect()
    model = tuple(language_id.sample(language_id.folds(docs).where("not held_out")).items())
    told = {r.doc_id: language_id.classify(r.text, model) for r in rows}
    rows = [(r.doc_id, r.text, told[r.doc_id][0], r.source) for r in rows if told[r.doc_id][0] != "und" and told[r.doc_id][1] >= language_id.MARGIN]
    one = _io.written(stage[0](spark, docs, SF), "test")
    assert sorted((r.doc_id, r.text, r.lang, r.source) for r in one.collect()) == sorted(rows)
    groups = plain.plain_groups([(i, t) for i, t, _, _ in rows], 5, 80)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    two = _io.written(stage[1](spark, one, SF), "test")
    assert sorted(r.doc_id for r in two.collect()) == sorted(r[0] for r in rows)
    items = [(r.item_id, r.text) for r in _io.table(spark, SF, "benchmark").collect()]
    dirty = plain.plain_contamination([(i, t) for i, t, _, _ in rows], items)
    rows = [r for r in rows if not dirty[r[0]][4]]
    three = _io.written(stage[2](spark, two, SF), "test")
    assert sorted(r.doc_id for r in three.collect()) == sorted(r[0] for r in rows)

    def keyed(t):
        n = len(t.split(" ")) if t else 0
        kind = "table" if " | " in t else "note" if n < 50 else "lines" if t.count("\n") * 40 >= n else "prose"
        return kind, n

    cells = [((s or "", lang, keyed(t)[0]), keyed(t)[1]) for _, t, lang, s in rows]
    rate = plain_rates(cells)
    draws = {r.doc_id: r.u for r in three.select("doc_id", mixing.draw(F.col("doc_id")).alias("u")).collect()}
    rows = [r for r, (k, n) in zip(rows, cells, strict=True) if n and draws[r[0]] < rate.get(k, 0.0)]
    four = _io.written(stage[3](spark, three, SF), "test")
    assert sorted(r.doc_id for r in four.collect()) == sorted(r[0] for r in rows)
    own, want, at = Tokenizer.from_file(token_files.default_tokenizer()), [], 0
    for i, t, _, _ in sorted(rows):
        ids = [*own.encode(t, add_special_tokens=False).ids, 1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


def test_intermediate_tables_go(spark):
    """After a run only what its result reads is left in the shared folder."""
    folder = _io.shared_dir(spark).removeprefix("file://") + "/oreloom/*/*"
    before = set(glob.glob(folder))
    out = near_duplicates.near_duplicates(_io.table(spark, SF, "documents"))
    assert out.count() and len(set(glob.glob(folder)) - before) == 1
    from oreloom.llm import embedding_duplicates

    before = set(glob.glob(folder))
    assert embedding_duplicates.op2_embedding_duplicates(spark, SF).count() and len(set(glob.glob(folder)) - before) == 1
    before = set(glob.glob(folder))
    assert corpus_pipeline.run(spark, SF).count() and {p.split("/")[-1].split("-")[0] for p in set(glob.glob(folder)) - before} == {"result", "tokens"}


def test_shared_folder_of_a_cluster(monkeypatch, spark):
    """Without the setting, a session that is not local has no shared folder."""

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://h:7077", "getConf": lambda self: Conf()})()

    with pytest.raises(RuntimeError, match="checkpoint"):
        _io.shared_dir(Session())
    assert math.isclose(_io.parts_for(spark, 1e9, 1e6), 1000)
