"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, token files.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Each
result is written as Parquet in the shared folder and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreloom.llm import _io, decontaminate, language_id, mixing, near_duplicates, token_files


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; ``lang`` becomes the predicted language. Learns from the training folds."""
    model = language_id.sample(language_id.folds(docs).where("not held_out"))
    return language_id.accepted(docs, model)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8."""
    return near_duplicates.deduplicate(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a run of a benchmark item go."""
    return decontaminate.decontaminate(docs, _io.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the target weights of source, language and topic."""
    return mixing.mix(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document in frames with a seek table; the rows are read back from the files."""
    return token_files.written_and_read(spark, docs)


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
    ("token files", write_token_files),
]

#: Compression, tokenizer files and signatures have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _io.table(spark, sf_dir, "documents")
    with _io.steps(spark):
        for k, (_, stage) in enumerate(STAGES[:-1]):
            before, docs = docs, _io.written(stage(spark, docs, sf_dir), f"stage{k}")
            if k:
                _io.remove(before)
        return _io.result(STAGES[-1][1](spark, docs, sf_dir))
