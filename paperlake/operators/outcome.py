"""Outcomes of a run: classification, counters with samples, and the metrics of every tar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.operators.text import CRASH
from paperlake.schema import OUTCOMES

SAMPLES = 5


def outcome(status: Column, message: Column) -> Column:
    """Status and message of a row to its outcome; an error is a crash if its thread died, else a panic."""
    return (
        F.when(status.isin("ok", "timeout", "skipped", "empty", "archive_error"), status)
        .when((status == "error") & message.contains(CRASH), "crash")
        .otherwise("panic")
    )


def with_outcome(results: DataFrame, unwritten: DataFrame | None = None) -> DataFrame:
    """Adds ``outcome``. With ``unwritten`` (arxiv_id, outer_tar, outcome) only these three columns, its rows included."""
    rows = results.withColumn("outcome", outcome(F.col("status"), F.col("error_message")))
    if unwritten is None:
        return rows
    return rows.select("arxiv_id", "outer_tar", "outcome").unionByName(unwritten)


def unwritten_papers(extracted: DataFrame) -> DataFrame:
    """Of extracted papers (with ``unwritten``) those that get no row: (arxiv_id, outer_tar, outcome). Papers done by an
    earlier run are ``skipped_resume``; a defect without id, as of a truncated tar, is an ``archive_error``."""
    return extracted.where("unwritten is not null").select("arxiv_id", "outer_tar", F.col("unwritten").alias("outcome"))


def counts_with_samples(results: DataFrame, by: list[str] | None = None, unwritten: DataFrame | None = None) -> DataFrame:
    """Per outcome (and ``by``) the number of rows and up to five sample ids, the smallest ones.

    The samples come from a ranked window whose limit is pushed below the shuffle, so a hot outcome sends five rows per
    task; counts are a plain partial aggregation.
    """
    keys = [*(by or []), "outcome"]
    rows = with_outcome(results, unwritten)
    total = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("arxiv_id"))
    ids = rows.select(*keys, "arxiv_id").withColumn("rank", rank).where(F.col("rank") <= SAMPLES)
    samples = ids.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "arxiv_id"))), lambda x: x.arxiv_id), ",").alias("samples"))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return total.alias("t").join(samples.alias("s"), same, "left").select(*[f"t.{k}" for k in keys], "n", "samples")


def tar_metrics(results: DataFrame, unwritten: DataFrame | None = None) -> DataFrame:
    """One row per tar and a grand total (null tar with is_total): a counter per outcome and the rows but for i/o errors."""
    rows = with_outcome(results, unwritten)
    counters = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    return rows.rollup("outer_tar").agg(F.grouping("outer_tar").cast("int").alias("is_total"), *counters, F.count_if(F.col("outcome") != "io_error").alias("total"))


def summary_lines(counts: DataFrame) -> DataFrame:
    """Log lines of the counters."""
    return counts.select(F.format_string("%s: %d (%s)", "outcome", "n", F.coalesce("samples", F.lit(""))).alias("line"))
