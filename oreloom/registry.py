"""The queries of the archive-mining operators, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import operator_queries  # noqa: F401  its queries register themselves
from .plans.queries import QUERIES, SQL

FLAGSHIP = "rule_score_topk"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
