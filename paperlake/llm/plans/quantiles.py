"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import quantiles as op
from paperlake.session import materialize, table

METRICS = ["total_time_us", "peak_memory_bytes"]
POINTS = [0.25, 0.5, 0.9, 0.99]


def _groups() -> dict:
    return {"status": F.col("status"), "outer_tar": F.col("outer_tar"), "day": F.to_date("started_at")}


def p4_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.percentiles(op.summarize(table(spark, sf_dir, "attempts"), _groups(), METRICS), POINTS)


def p4_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored day summaries merged into weeks, without touching the rows again."""
    days = materialize(op.summarize(table(spark, sf_dir, "attempts"), {"day": F.to_date("started_at")}, METRICS, op.EPSILON / 2), "day-summaries")
    return op.percentiles(op.combine(days, "week", F.date_trunc("week", F.to_date("key")).cast("date").cast("string"), op.EPSILON), POINTS)


def p4_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.percentiles(op.summarize(table(spark, sf_dir, "results"), {"status": F.col("status"), "day": F.to_date("written_at")}, METRICS), POINTS)


def p4_rank_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every percentile held against the exact ranks of all rows: whether it lies within the promised error."""
    attempts = table(spark, sf_dir, "attempts")
    groups = {"status": F.col("status"), "day": F.to_date("started_at")}
    answers = op.percentiles(op.summarize(attempts, groups, METRICS), POINTS)
    long = attempts.select(
        F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in groups.items()])).alias("g"), *METRICS
    ).select("g.*", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS])).alias("v"))
    values = long.select("kind", "key", "v.metric", "v.value").where((F.col("value") >= 0) & (F.col("value") < op.MAX_LONG))
    joined = values.join(answers, ["kind", "key", "metric"])
    names = ["p25", "p50", "p90", "p99"]
    counted = joined.groupBy("kind", "key", "metric").agg(
        F.count("*").alias("n_exact"),
        F.max("n").alias("n_answer"),
        *[F.count_if(F.col("value") < F.col(p)).alias(f"lt_{p}") for p in names],
        *[F.count_if(F.col("value") <= F.col(p)).alias(f"le_{p}") for p in names],
    )
    fine = F.col("n_exact") == F.col("n_answer")
    for p, q in zip(names, POINTS, strict=True):
        rank, slack = F.ceil(F.col("n_exact") * q), F.ceil(F.col("n_exact") * op.EPSILON) + 1
        fine = fine & (F.col(f"lt_{p}") + 1 <= rank + slack) & (F.col(f"le_{p}") >= rank - slack)
    return counted.select("kind", "key", "metric", F.col("n_exact").alias("n"), fine.alias("within"))


QUERIES = {"p4_percentiles": p4_percentiles, "p4_weekly": p4_weekly, "p4_results": p4_results, "p4_rank_check": p4_rank_check}
ORACLES = {
    "p4_rank_check": """
WITH v AS (
  SELECT 'status' AS kind, status AS key, 'total_time_us' AS metric, total_time_us AS value FROM attempts
  UNION ALL SELECT 'status', status, 'peak_memory_bytes', peak_memory_bytes FROM attempts
  UNION ALL SELECT 'day', strftime(started_at, '%Y-%m-%d'), 'total_time_us', total_time_us FROM attempts
  UNION ALL SELECT 'day', strftime(started_at, '%Y-%m-%d'), 'peak_memory_bytes', peak_memory_bytes FROM attempts
)
SELECT kind, key, metric, count(*) AS n, true AS within FROM v WHERE value >= 0 AND value < 9223372036854775807 GROUP BY kind, key, metric
""",
}
