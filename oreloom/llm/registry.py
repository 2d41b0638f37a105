"""The queries of the corpus operators, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat_format, decontaminate, embedding_duplicates, language_id, license_scan, mixing, near_duplicates, token_counts, token_files, url_rules


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_embedding_duplicates": embedding_duplicates.op2_embedding_duplicates,
        "op3_token_files": token_files.op3_token_files,
        "op4_url_rules": url_rules.op4_url_rules,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_license_scan": license_scan.op6_license_scan,
        "op7_mix_sources": mixing.op7_mix_sources,
        "op8_chat_format": chat_format.op8_chat_format,
        "op9_near_duplicates": near_duplicates.op9_near_duplicates,
        "op10_language_id": language_id.op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": decontaminate.ORACLE,
        "op2_embedding_duplicates": embedding_duplicates.ORACLE,
        "op7_mix_sources": mixing.ORACLE,
        "op8_chat_format": chat_format.ORACLE,
        "op9_near_duplicates": near_duplicates.ORACLE,
    }
