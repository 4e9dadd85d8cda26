"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import language as op
from paperlake.session import spread, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "results")
    return op.relabelled(spread(results, "result_id"), op.train(op.labelled_sentences(results)))


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "results")
    return op.language_segments(spread(results, "result_id"), op.train(op.labelled_sentences(results)))


QUERIES = {"p5_found": p5_found, "p5_segments": p5_segments}
ORACLES: dict[str, str] = {}
