"""Queries of problem 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import sentences as op
from paperlake.session import spread, table


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sentence_units(spread(table(spark, sf_dir, "documents"), "doc_id"), with_text=False).select("doc_id", "sent_start")


def p10_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.sentence_units(spread(table(spark, sf_dir, "documents"), "doc_id"))


QUERIES = {"p10_found": p10_found, "p10_sentences": p10_sentences}
ORACLES: dict[str, str] = {}
