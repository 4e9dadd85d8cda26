"""A whole run: archives in, shards, metrics and ledger out.

python -m paperlake.job -d INPUT -o OUTPUT [--resume] [--metrics] [--output-format parquet|jsonl] [--text-files] ...
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.operators.incremental import PARTS, CommitLog, new_folder
from paperlake.operators.outcome import counts_with_samples, summary_lines, tar_metrics, unwritten_papers
from paperlake.operators.text import MOST_OCTETS, TIMEOUT_S, extract_papers
from paperlake.session import materialize
from paperlake.sinks import shards
from paperlake.sources.archives import read_papers
from paperlake.sources.ledger import closed_tars, read_ledger, with_done

LOG = logging.getLogger("paperlake.job")
#: Rows of a shard without a limit.
ONE_SHARD = 1 << 62
FORMATS = {"parquet": "parquet", "jsonl": "jsonl", "json": "jsonl"}


def output_format(name: str) -> str:
    """Format by name, whatever its case."""
    if (known := FORMATS.get(name.lower())) is None:
        raise ValueError(f"unknown output format {name!r}: use one of {', '.join(FORMATS)}")
    return known


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="paperlake.job")
    p.add_argument("-d", "--input-dir")
    p.add_argument("-f", "--input-file")
    p.add_argument("-o", "--output-dir")
    p.add_argument("-j", "--threads", type=int)
    p.add_argument("--timeout-secs", type=float, default=TIMEOUT_S)
    p.add_argument("--max-tex-bytes", type=int, default=MOST_OCTETS)
    p.add_argument("--max-memory-mb", type=int)
    p.add_argument("--max-inflight", type=int)
    p.add_argument("--text-files", action="store_true")
    p.add_argument("--output-format", type=output_format, default="parquet")
    p.add_argument("--max-shard-rows", type=int, default=shards.ROWS)
    p.add_argument("--max-shard-bytes", type=int, default=shards.OCTETS)
    p.add_argument("--papers-per-shard", type=int)
    p.add_argument("--resume", action="store_true")
    p.add_argument("--metrics", action="store_true")
    return p.parse_args(argv)


def session(o: argparse.Namespace) -> SparkSession:
    """Threads and admission map to cores and to the memory of Python workers."""
    b = SparkSession.builder.appName("paperlake").config("spark.sql.session.timeZone", "UTC")
    if o.threads or o.max_inflight:
        b = b.master(f"local[{min(x for x in (o.threads, o.max_inflight) if x)}]")
    if o.max_memory_mb:
        b = b.config("spark.executor.pyspark.memory", f"{o.max_memory_mb}m")
    return b.getOrCreate()


def commit_log(spark: SparkSession, output_dir: str) -> CommitLog:
    return CommitLog(spark, f"{output_dir}/results")


def read_results(spark: SparkSession, output_dir: str, kind: str = "parquet") -> DataFrame | None:
    """Rows of all committed runs."""
    rows = commit_log(spark, output_dir).read("json" if kind == "jsonl" else kind)
    return rows if rows is None else rows.drop("stem", "shard")


def logged(spark: SparkSession, o: argparse.Namespace, log: CommitLog) -> DataFrame:
    """Ledger lines of committed runs, and those of a plain ``checkpoint.log`` beside them."""
    return read_ledger(spark, f"{o.output_dir}/checkpoint.log", *log.folders("ledger"))


def run(spark: SparkSession, o: argparse.Namespace, before_commit: Callable[[], None] | None = None) -> DataFrame | None:
    """Process a directory; the written rows.

    Archives are read once: every paper passes one extraction, whose rows (the resumed and the lost ones marked) are
    kept; shards, ledger lines, metrics and samples are made from these. Rows, ledger and shard numbers lie in folders
    that only the commit makes visible, so a run that dies before it leaves nothing, and one that ran beside another
    fails at it. Closed tars are never opened. ``before_commit`` is called right before the commit (tests kill there).
    """
    log = commit_log(spark, o.output_dir)
    done = log.commits()
    # papers of a large tar are spread over all tasks before they are extracted
    tasks = spark.sparkContext.defaultParallelism * 4
    if o.resume:
        ledger = logged(spark, o, log)
        # at most one name per tar of the folder, each of which is listed on the driver anyway
        closed = [r[0] for r in closed_tars(ledger).toLocalIterator()]
        papers = with_done(read_papers(spark, o.input_dir, closed), ledger, tasks)
    else:
        papers = read_papers(spark, o.input_dir).repartition(tasks, "source_tar", "arxiv_id", "entry_name")
    LOG.info("extracting %s", o.input_dir)
    extracted = materialize(extract_papers(papers, o.timeout_secs, o.max_tex_bytes, keep_unwritten=True), "extracted")
    results, unwritten = extracted.where("unwritten is null").drop("unwritten"), unwritten_papers(extracted)
    for line in summary_lines(counts_with_samples(results, unwritten=unwritten)).toLocalIterator():
        LOG.warning(line["line"])
    if o.metrics:
        shards.write_metrics(tar_metrics(results, unwritten), f"{o.output_dir}/metrics")
    if o.text_files:
        shards.write_texts(results, o.output_dir)
        return _commit(log, len(done), new_folder(), ["ledger"], results, extracted, before_commit)
    rows = min(x for x in ((o.papers_per_shard or ONE_SHARD,) if o.output_format == "jsonl" else (o.max_shard_rows, o.papers_per_shard)) if x)
    octets = None if o.output_format == "jsonl" else o.max_shard_bytes
    earlier = log.folders("shards")
    taken = spark.read.parquet(*earlier).groupBy("stem").agg(F.max("next_shard").alias("next_shard")) if earlier else None
    sharded = shards.cut_shards(results, ["arxiv_id", "entry_name"], rows, octets, taken)
    folder = new_folder()
    shards.write_shards(sharded, f"{log.root}/data/{folder}", o.output_format)
    shards.next_shards(sharded).write.parquet(f"{log.root}/shards/{folder}")
    _commit(log, len(done), folder, list(PARTS), results, extracted, before_commit)
    return sharded.drop("stem", "shard")


def _commit(log: CommitLog, n: int, folder: str, parts: list[str], results: DataFrame, extracted: DataFrame, before: Callable[[], None] | None) -> None:
    shards.write_ledger(results, f"{log.root}/ledger/{folder}", extracted.select("outer_tar"))
    if before:
        before()
    log.commit({"n": n, "folder": folder, "parts": parts})
    LOG.info("committed run %d", n)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(stream=sys.stderr, level=logging.INFO, format="%(message)s")
    o = options(argv)
    spark = session(o)
    if o.input_file:
        row = extract_papers(read_papers(spark, o.input_file), o.timeout_secs, o.max_tex_bytes).first()
        if row is None or row["text"] is None:
            print(json.dumps({"status": row["status"] if row else "error"}))
        else:
            print(row["text"] if o.text_files else json.dumps({k: v for k, v in row.asDict().items() if v is not None and k != "shard_id"}, ensure_ascii=False))
        return 0
    run(spark, o)
    return 0


if __name__ == "__main__":
    sys.exit(main())
