"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import encoding as op
from paperlake.session import spread, table


def p2_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, entries = table(spark, sf_dir, "results"), table(spark, sf_dir, "entries")
    return op.garbled_texts(op.texts_of(spread(results, "result_id"), spread(entries, "entry_seq")), op.dictionaries(results))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p2_restored(spark, sf_dir).select("tab", "row_id", "file_name")


QUERIES = {"p2_found": p2_found, "p2_restored": p2_restored}
ORACLES: dict[str, str] = {}
