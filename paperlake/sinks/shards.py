"""Result sinks: Parquet and JSON Lines shards, text files, metrics, and the ledger that is written after them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.operators.numbering import numbered
from paperlake.session import broadcast_if_small, materialize
from paperlake.sources.archives import locate

ROWS, OCTETS = 10_000, 256_000_000
OVERHEAD = 200


def row_octets() -> Column:
    """Estimated size of a result row."""
    parts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("arxiv_id", "text", "error_message", "stage_timings_us")]
    return (parts[0] + parts[1] + parts[2] + parts[3] + F.lit(OVERHEAD)).cast("bigint")


def stem_of(tar: Column) -> Column:
    return F.coalesce(F.regexp_replace(tar, r"\.tar$", ""), F.lit("results"))


def shard_name(stem: Column, n: Column) -> Column:
    """stem, stem_001, stem_002 ..."""
    return F.when(n == 0, stem).otherwise(F.concat(stem, F.lit("_"), F.lpad(n.cast("string"), 3, "0")))


def assign_shards(results: DataFrame, order: list[str], rows: int = ROWS, papers: int | None = None) -> DataFrame:
    """Sets ``shard_id``: rows of a tar in order, a new shard after ``rows`` rows or ``papers`` papers, whichever comes
    first. Numbering does not put a tar into one task."""
    per = min(rows, papers) if papers else rows
    placed = numbered(results.withColumn("_stem", stem_of(F.col("outer_tar"))), "_stem", order)
    shard = shard_name(F.col("_stem"), F.floor((F.col("row_no") - 1) / per).cast("int"))
    return placed.withColumn("shard_id", shard).drop("row_no", "_stem")


def octet_shards(results: DataFrame, order: list[str], octets: int = OCTETS, rows: int = ROWS) -> DataFrame:
    """Adds ``chunk``: the running size within fixed runs of ``rows`` rows, cut every ``octets``; files written by it
    keep to both limits. (A strictly sequential cut over a whole tar would have to pass through one task.)"""
    placed = numbered(results.withColumn("_stem", stem_of(F.col("outer_tar"))), "_stem", order)
    run = F.floor((F.col("row_no") - 1) / rows)
    before = F.sum(row_octets()).over(Window.partitionBy("_stem", "_run").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)) - row_octets()
    return placed.withColumn("_run", run).withColumn("chunk", F.floor(before / octets).cast("int")).drop("_stem", "_run", "row_no")


def cut_shards(results: DataFrame, order: list[str], rows: int = ROWS, octets: int | None = OCTETS, taken: DataFrame | None = None) -> DataFrame:
    """Sets ``shard_id`` and adds ``stem`` for writing: rows of a stem in order, a new shard once one holds ``rows`` rows
    or ``octets`` estimated octets, names going on after those ``taken`` (stem, next_shard).

    Rows are range-partitioned by stem and order, so a stem of any size is spread; each partition is cut in one pass, and
    the shards that earlier partitions hold of a stem – one number per partition and stem – are the offsets. A stem that
    spans partitions gets one more, shorter shard at each border; no shard passes a limit.
    """
    spark = results.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = results.withColumn("stem", stem_of(F.col("outer_tar"))).withColumn("_octets", row_octets())
    placed = placed.repartitionByRange(partitions, "stem", *order).sortWithinPartitions("stem", *order).withColumn("_part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields) + ", _cut int"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stem, shard, held, size = None, 0, 0, 0
        for b in batches:
            cuts = []
            for s, n in zip(b.column("stem").to_pylist(), b.column("_octets").to_pylist(), strict=True):
                if s != stem:
                    stem, shard, held, size = s, 0, 0, 0
                elif held >= rows or (octets is not None and size >= octets):
                    shard, held, size = shard + 1, 0, 0
                held, size = held + 1, size + n
                cuts.append(shard)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cuts, pa.int32())], names=[*b.schema.names, "_cut"])

    local = materialize(placed.mapInArrow(cut, schema), "cut")
    held = local.groupBy("stem", "_part").agg((F.max("_cut") + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("stem").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = held.withColumn("_before", before).drop("_n")
    if taken is not None:
        offsets = offsets.join(taken, "stem", "left").withColumn("_before", F.col("_before") + F.coalesce("next_shard", F.lit(0))).drop("next_shard")
    joined = local.join(broadcast_if_small(materialize(offsets, "shard-offsets")), ["stem", "_part"])
    shard = (F.col("_before") + F.col("_cut")).cast("int")
    return joined.withColumn("shard_id", shard_name(F.col("stem"), shard)).withColumn("shard", shard).select(*results.columns, "stem", "shard")


def next_shards(sharded: DataFrame) -> DataFrame:
    """(stem, next_shard): one row per stem."""
    return sharded.groupBy("stem").agg((F.max("shard") + 1).alias("next_shard"))


def write_parquet(results: DataFrame, path: str, rows: int = ROWS, mode: str = "errorifexists") -> None:
    """Shards under one folder per stem, zstd, at most ``rows`` rows a file. The committer makes files visible together."""
    (
        results.withColumn("stem", stem_of(F.col("outer_tar"))).write.mode(mode).option("compression", "zstd").option("maxRecordsPerFile", rows)
        .partitionBy("stem").parquet(path)
    )


def write_shards(sharded: DataFrame, path: str, kind: str) -> None:
    """One folder per stem and shard; a shard is written by the task that holds it."""
    if kind == "jsonl":
        json_rows(sharded, "stem", "shard").write.partitionBy("stem", "shard").text(path)
    else:
        sharded.write.option("compression", "zstd").partitionBy("stem", "shard").parquet(path)


def json_rows(results: DataFrame, *beside: str) -> DataFrame:
    """One JSON object per row without null fields; two names differ from the Parquet columns and there is no shard.
    Columns ``beside`` stay outside the object."""
    names = {"error_message": "error", "outer_tar": "source_tar"}
    fields = [F.col(c).alias(names.get(c, c)) for c in results.columns if c not in ("shard_id", *beside)]
    return results.select(F.to_json(F.struct(*fields)).alias("value"), *beside)


def write_jsonl(results: DataFrame, path: str, papers: int | None = None, mode: str = "errorifexists") -> None:
    writer = json_rows(results).write.mode(mode)
    (writer.option("maxRecordsPerFile", papers) if papers else writer).text(path)


def write_texts(results: DataFrame, folder: str, name: Column | None = None) -> int:
    """One ``.txt`` per row with a text, in a folder that all executors share. Returns how many; of equal names the last
    written stays."""
    names = F.translate(F.col("arxiv_id"), "/", "_") if name is None else name

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = locate(folder)
        store.create_dir(place, recursive=True)
        for b in batches:
            for n, text in zip(b["name"], b["text"], strict=True):
                aside = f"{place}/.{n}.{uuid.uuid4().hex}.tmp"
                with store.open_output_stream(aside, compression=None) as out:
                    out.write(text.encode("utf-8"))
                store.move(aside, f"{place}/{n}.txt")
            yield pd.DataFrame({"n": [len(b)]})

    done = results.where("text is not null").select(names.alias("name"), "text").mapInPandas(write, "n bigint")
    return done.agg(F.sum("n")).first()[0] or 0


def write_metrics(metrics: DataFrame, folder: str) -> int:
    """A JSON file per tar, ``<stem>_metrics.json``, and ``total_metrics.json`` for the grand total, written where the
    rows are. Returns how many."""
    columns = metrics.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, place = locate(folder)
        store.create_dir(place, recursive=True)
        for b in batches:
            for r in b.to_dict("records"):
                stem = "total" if r["is_total"] else (r["outer_tar"] or "results").removesuffix(".tar")
                with store.open_output_stream(f"{place}/{stem}_metrics.json", compression=None) as out:
                    out.write(json.dumps({k: r[k] for k in columns}, indent=2).encode())
            yield pd.DataFrame({"n": [len(b)]})

    return metrics.mapInPandas(write, "n bigint").agg(F.sum("n")).first()[0] or 0


def ledger_lines(results: DataFrame, tars: DataFrame) -> DataFrame:
    """Lines of the papers, then those that close their tars (one column ``outer_tar``)."""
    papers = results.select(F.concat_ws("\t", stem_of(F.col("outer_tar")), "arxiv_id").alias("value"))
    return papers.unionByName(tars.where("outer_tar is not null").select(F.col("outer_tar").alias("value")).distinct())


def write_ledger(results: DataFrame, path: str, tars: DataFrame) -> None:
    ledger_lines(results, tars).write.text(path)
