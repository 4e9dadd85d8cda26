"""Queries of problem 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import mixing as op
from paperlake.session import spread, table


def _planned(spark: SparkSession, sf_dir: str, temperature: str | None = None) -> tuple:
    sizes = op.sized(spread(table(spark, sf_dir, "documents"), "doc_id"), spark.conf.get("spark.paperlake.tokenizer", op.TOKENIZER))
    chosen = op.plan(sizes, op.read_targets(table(spark, sf_dir, "mix_targets")), temperature=temperature)
    return op.mix(sizes, chosen), chosen


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _planned(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, chosen = _planned(spark, sf_dir)
    return op.shares(spark, mixed, chosen)


def p9_tempered_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, chosen = _planned(spark, sf_dir, "entropy")
    return op.shares(spark, mixed, chosen)


def p9_repeat_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest exponent at which no source passes its limit."""
    mixed, chosen = _planned(spark, sf_dir, "repeats")
    return op.shares(spark, mixed, chosen)


def p9_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every source that has documents keeps its limit of repetitions and its budget, and misses it by less than
    its longest document."""
    sizes = op.sized(spread(table(spark, sf_dir, "documents"), "doc_id"), spark.conf.get("spark.paperlake.tokenizer", op.TOKENIZER))
    chosen = op.plan(sizes, op.read_targets(table(spark, sf_dir, "mix_targets")))
    longest = sizes.groupBy("source").agg(F.max("n_tokens").alias("longest"))
    found = op.shares(spark, op.mix(sizes, chosen), chosen).join(longest, "source")
    return found.select("source", (F.col("most_uses") <= F.col("max_repeats")).alias("in_limit"), (F.col("mix_tokens") <= F.col("budget_tokens")).alias("in_budget"), (F.col("budget_tokens") - F.col("mix_tokens") < F.col("longest")).alias("used_up"))


def p9_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.groupBy(op.normalized_source(F.col("source")).alias("source")).agg(F.count("*").alias("n_documents"))


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares, "p9_tempered_shares": p9_tempered_shares, "p9_repeat_shares": p9_repeat_shares, "p9_limits": p9_limits, "p9_sources": p9_sources}
ORACLES = {
    "p9_limits": r"""
SELECT DISTINCT regexp_replace(lower(trim(t.source)), '[\s_-]+', '_', 'g') AS source, true AS in_limit, true AS in_budget, true AS used_up
FROM mix_targets t JOIN documents d ON regexp_replace(lower(trim(t.source)), '[\s_-]+', '_', 'g') = regexp_replace(lower(trim(d.source)), '[\s_-]+', '_', 'g')
""",
    "p9_sources": r"""
SELECT nullif(regexp_replace(lower(trim(source)), '[\s_-]+', '_', 'g'), '') AS source, count(*) AS n_documents FROM documents GROUP BY 1
""",
}
