"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import markup as op
from paperlake.session import spread, table


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "results")
    return op.marked_up(spread(results, "result_id"), op.fit_model(results))


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "results")
    return op.cleaned(spread(results, "result_id"), op.fit_model(results))


QUERIES = {"p7_found": p7_found, "p7_clean": p7_clean}
ORACLES: dict[str, str] = {}
