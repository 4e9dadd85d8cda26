"""The checkpoint ledger, and what is left to do after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.operators.incremental import strip_all
from paperlake.schema import LEDGER
from paperlake.session import fs


def read_ledger(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of ledgers: a name alone closes a tar, a name and an id (parted by a tab) log one paper. Blank lines and
    ledgers that do not exist give nothing."""
    there = [p for p in paths if (found := fs(spark, p))[0].exists(found[1])]
    return parse_lines(spark.read.text(there)) if there else spark.createDataFrame([], LEDGER)


def parse_lines(lines: DataFrame) -> DataFrame:
    parts = F.split("value", "\t", 2)
    name, paper = strip_all(parts[0]), strip_all(F.try_element_at(parts, F.lit(2)))
    return lines.select(name.alias("stem"), paper.alias("arxiv_id")).where("stem <> ''")


def closed_tars(ledger: DataFrame) -> DataFrame:
    """File names of the tars that are done."""
    return ledger.where("arxiv_id is null").select(F.col("stem").alias("source_tar")).distinct()


def open_tars(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    """Papers of tars that no line closes."""
    return papers.join(closed_tars(ledger), "source_tar", "left_anti")


def with_done(papers: DataFrame, ledger: DataFrame, partitions: int | None = None) -> DataFrame:
    """Adds ``done``: whether a line logs the paper. The key (stem, id) is unique on the right and fine enough to spread
    a hot stem. With ``partitions`` papers are spread by it once, and the join finds them in place."""
    stemmed = papers.withColumn("_stem", F.regexp_replace("source_tar", r"\.tar$", ""))
    if partitions:
        stemmed = stemmed.repartition(partitions, "_stem", "arxiv_id")
    logged = ledger.where("arxiv_id is not null").select(F.col("stem").alias("_stem"), "arxiv_id", F.lit(True).alias("_logged")).distinct()
    joined = stemmed.join(logged, ["_stem", "arxiv_id"], "left")
    return joined.select(*papers.columns, F.coalesce("_logged", F.lit(False)).alias("done"))


def pending(papers: DataFrame, ledger: DataFrame) -> DataFrame:
    """What a resumed run has to do."""
    return with_done(open_tars(papers, ledger), ledger).where("not done").drop("done")


__all__ = ["closed_tars", "open_tars", "parse_lines", "pending", "read_ledger", "with_done"]
