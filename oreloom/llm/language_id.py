"""Language identification by compression.

The letters of a text, lower-cased and with everything else squeezed to single spaces, are compressed with one
zstandard raw-content dictionary for each language; the language whose dictionary gives the smallest output wins. Texts
are compressed in blocks of ``BLOCK`` bytes, so a long text is judged by its dictionaries and not by its own
repetitions, and all of it counts. Texts of every length are judged alike, by the whole dictionaries.

``score`` is 1 - smallest / second smallest output, from 0 to 1. Texts without a letter are ``und``; ``reject`` also
gives up those whose score is below a margin.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _io

#: Bounds of the fit: bytes of normalised text for each language (all of them make its dictionary), characters taken from
#: one document, labelled documents fetched for each language, and languages (the commonest).
SAMPLE_BYTES, PIECE, SAMPLE_DOCS, LANGUAGES = 1 << 18, 1000, 2000, 256
BLOCK = 8192
MARGIN = 0.004
UNKNOWN = "und"

_OTHER = regex.compile(r"[^\p{L}]+")


def normalise(text: str | None) -> bytes:
    """Lower-cased letters with single spaces around and between the runs; empty if there is no letter."""
    own = _OTHER.sub(" ", (text or "").lower()).strip()
    return f" {own} ".encode() if own else b""


def sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Normalised text of at most SAMPLE_BYTES for each language, from labelled docs in an order by hash.

    The fetch is bounded: about SAMPLE_DOCS different documents for each of the LANGUAGES commonest languages, PIECE
    characters from each.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.length(text) > 0)).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not counts:
        return {}
    share = F.element_at(F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * SAMPLE_DOCS / n)))), F.col("lang"))
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    picked = rows.withColumn("draw", draw).where(F.col("draw") < share * (1 << 30))
    got: dict[str, list] = {k: [] for k in counts}
    for r in picked.select("lang", "draw", F.substring("text", 1, PIECE).alias("piece")).distinct().toLocalIterator():
        got[r.lang].append((r.draw, r.piece))
    out = {}
    for k in sorted(got, key=lambda k: (-counts[k], k)):
        own = b"".join(normalise(piece) for _, piece in sorted(got[k]))[:SAMPLE_BYTES]
        if own:
            out[k] = own
    return out


@lru_cache(maxsize=1)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    how = zstandard.ZstdCompressionParameters.from_level(6, min_match=3, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
    out = []
    for lang, data in model:
        own = zstandard.ZstdCompressionDict(data.rjust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(compression_params=how)
        out.append((lang, zstandard.ZstdCompressor(compression_params=how, dict_data=own)))
    return out


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float]:
    """(language, score) of one text; ties go to the language that comes first in the model (the commonest one)."""
    own = normalise(text)
    if not own or not model:
        return UNKNOWN, 0.0
    parts = [own[i : i + BLOCK] for i in range(0, len(own), BLOCK)]
    sizes = sorted((sum(len(c.compress(p)) for p in parts), rank, lang) for rank, (lang, c) in enumerate(_compressors(model)))
    return sizes[0][2], (1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0)


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """docs with lang_pred (a language of the model, or ``und`` for a null text, one without a letter or an empty model),
    score (0 to 1) and rejected (``und``, or a score below margin). Columns of these names in docs are replaced; accepted()
    returns docs as it is. Repeated rows are judged alike, ties go to the commonest language, and an empty table gives an
    empty one."""
    names = ["lang_pred", "score", "rejected"]
    own = docs.select(*(docs[f"`{c}`"] for c in docs.columns if c.lower() not in names))
    return _judged(_io.packed(own), model, text, margin).select("row.*", *names)


def accepted(docs: DataFrame, model: dict[str, bytes], text: str = "text", lang: str = "lang", margin: float = MARGIN) -> DataFrame:
    """The rows of docs that are not rejected, with their own columns; ``lang`` becomes the predicted language."""
    out = _judged(_io.packed(docs), model, text, margin).where("not rejected")
    return out.select(*(F.col("lang_pred").alias(c) if c == lang else F.col(f"row.`{c}`") for c in docs.columns))


def _judged(packed: DataFrame, model: dict[str, bytes], text: str, margin: float) -> DataFrame:
    """Columns row, lang_pred, score, rejected of a table of rows."""
    sent = packed.sparkSession.sparkContext.broadcast(tuple(model.items()))  # at most SAMPLE_BYTES for each of at most LANGUAGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [classify(t.as_py(), sent.value) for t in pc.struct_field(batch.column(0), text)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())], names=["row", "lang_pred", "score"])

    out = packed.transform(_io.arrow(run, _io.schema_with(packed, "lang_pred string", "score double")))
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("score") < margin))


def folds(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs with held_out: crc32 of the id as text, modulo 4, is 2 (null id: false). A column of that name is replaced."""
    return docs.withColumn("held_out", F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False)))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = folds(_io.table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    model = sample(docs.where("not held_out"))
    return identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")
