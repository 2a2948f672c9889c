"""Registered queries: name -> function (spark, sf_dir), and the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans.views import VIEWS, view_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def with_views(sql: str) -> str:
    """SQL that starts with its own WITH list or SELECT, after the views that it names."""
    used = [view_sql(v) for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    recursive = "RECURSIVE " if "WITH RECURSIVE" in sql else ""
    body = re.sub(r"^\s*WITH (RECURSIVE )?", "", sql)
    own = re.match(r"\s*WITH", sql)
    return f"WITH {recursive}{', '.join(used)}{', ' if used and own else ' '}{body}" if used else sql


def query(name: str, sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            SQL[name] = with_views(sql)
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["e1_genotype_patient"](spark, sf_dir)


def load() -> None:
    from .plans import q_intervals, q_pileups, q_sources, q_variants  # noqa: F401, I001
    from .plans import q_cohort, q_files  # noqa: F401  (their SQL builds on the others')
