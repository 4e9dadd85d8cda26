"""Processing only new or changed records.

Two cooperating parts:

* ``pending_papers`` – the selection: which papers have content that no run has logged yet, from the deliveries and the
  checkpoint ledger. The ledger is an append-only sequence of commits; the *latest commit time* that covers a tar or a
  paper is that key's high watermark, and a delivery at or below its watermark is handled.
* ``CommitLog`` / ``run_incremental`` – the execution: each run takes the records in ``(low, high]`` of a monotonic
  sequence column, where ``low`` is the last committed watermark and ``high`` is fixed before any work starts. Output
  and watermark become visible together, by one atomic create of the next commit file. A run that dies leaves only files
  that no commit names; the next run repeats the same lower bound, so nothing is skipped and nothing appears twice.
* ``run_pending`` – both together: the selection is the input of a run, and its ledger lines are part of the commit.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.session import fs, materialize

#: A tar can hold a third of all papers, so the one-row-per-tar side is repeated this often and the papers are spread.
SALTS = 16
#: Output that no commit names is given up after this long without a write.
LEASE_S = 24 * 3600
#: Folders of a commit: results, ledger lines, next shard numbers.
PARTS = ("data", "ledger", "shards")


def strip_all(c: Column) -> Column:
    """Trim every kind of white space, carriage returns included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def parse_ledger(ledger: DataFrame) -> DataFrame:
    """(tar, arxiv_id, recorded_at) of usable lines.

    A line without id closes the tar it names and must end in ``.tar``; a line with an id logs one paper of ``stem``.
    Blank names, null times and ids that are only white space carry no information and are left out.
    """
    name, paper = strip_all(F.col("stem")), strip_all(F.col("arxiv_id"))
    lines = ledger.select(name.alias("name"), paper.alias("arxiv_id"), F.col("recorded_at")).where(
        "name <> '' and recorded_at is not null"
    )
    is_tar = F.col("arxiv_id").isNull() & F.col("name").endswith(".tar")
    is_paper = F.col("arxiv_id").isNotNull() & (F.col("arxiv_id") != "")
    return lines.where(is_tar | is_paper).select(
        F.when(is_tar, F.col("name")).otherwise(F.concat("name", F.lit(".tar"))).alias("source_tar"),
        "arxiv_id",
        "recorded_at",
    )


def content_digest(files: Column) -> Column:
    """32-byte digest of names, contents and order; null equals null only (an absent key, never an empty string)."""
    return F.unhex(F.sha2(F.to_json(F.struct(files.alias("f"))), 256))


def deliveries_with_watermark(entries: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every delivery with ``handled``: whether a commit of its tar or of its paper covers ``received_at``.

    Texts are reduced to a digest before anything is shuffled. Deliveries and paper-level ledger lines meet in one
    aggregation-friendly union instead of a join; the tar-level watermark is joined over a salted key.
    """
    logged = parse_ledger(ledger)
    papers = entries.where("arxiv_id <> 'unknown' and source_tar is not null").select(
        "source_tar",
        "arxiv_id",
        "received_at",
        "entry_seq",
        content_digest(F.col("tex_files")).alias("digest"),
    )
    paper_mark = (
        logged.where("arxiv_id is not null").groupBy("source_tar", "arxiv_id").agg(F.max("recorded_at").alias("paper_mark"))
    )
    tar_mark = (
        logged.where("arxiv_id is null")
        .groupBy("source_tar")
        .agg(F.max("recorded_at").alias("tar_mark"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    return (
        papers.withColumn("salt", F.pmod(F.xxhash64("arxiv_id"), F.lit(SALTS)).cast("int"))
        .join(tar_mark.hint("merge"), ["source_tar", "salt"], "left")
        .drop("salt")
        .join(paper_mark, ["source_tar", "arxiv_id"], "left")
        .withColumn(
            "handled", F.coalesce(F.col("received_at") <= F.greatest("tar_mark", "paper_mark"), F.lit(False))
        )
    )


def pending_papers(entries: DataFrame, ledger: DataFrame, upper: int | None = None) -> DataFrame:
    """Papers to process next: (source_tar, arxiv_id).

    A paper is pending if its newest delivery (by received_at, then entry_seq) is not handled and either no delivery of
    it is handled or the newest handled one has other content. ``upper`` bounds the deliveries by entry_seq; without it
    the current maximum is read once and fixed, so rows arriving during the run belong to the next run.

    Edge cases: null arxiv_id or source_tar and id ``unknown`` are no deliveries; a null received_at is older than any
    time and never handled; equal deliveries (ties in both time and sequence) count once; empty tables give no rows;
    further columns are ignored.
    """
    if upper is None:
        upper = entries.agg(F.max("entry_seq")).first()[0]
    bounded = entries.where(F.col("entry_seq") <= F.lit(upper)) if upper is not None else entries.limit(0)
    d = deliveries_with_watermark(bounded, ledger)
    age = F.struct(F.col("received_at"), F.col("entry_seq"), F.col("digest"))
    per_paper = d.groupBy("source_tar", "arxiv_id").agg(
        F.max(F.struct("received_at", "entry_seq", "digest", "handled")).alias("newest"),
        F.max(F.when(F.col("handled"), age)).alias("newest_handled"),
    )
    changed = F.col("newest_handled").isNull() | (F.col("newest_handled.digest") != F.col("newest.digest"))
    return per_paper.where(~F.col("newest.handled") & changed).select("source_tar", "arxiv_id")


def new_folder() -> str:
    """A name for the output of a run; runs are the partitions of what is read."""
    return f"_run={uuid.uuid4().hex}"


class CommitLog:
    """Committed runs of one job: ``_commits/<n>.json`` names the output folder and the watermark of run ``n``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> list[dict]:
        """All commits in order. One small file a run; their number is the number of runs, not of records."""
        system, path = fs(self.spark, f"{self.root}/_commits")
        if not system.exists(path):
            return []
        names = sorted(s.getPath().getName() for s in system.listStatus(path))
        return [self._read(f"{self.root}/_commits/{n}") for n in names if n.endswith(".json")]

    def _read(self, path: str) -> dict:
        system, p = fs(self.spark, path)
        stream = system.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def watermark(self) -> int | None:
        done = self.commits()
        return done[-1]["high"] if done else None

    def commit(self, record: dict) -> None:
        """Publish run ``record['n']``. The file is written aside and renamed; the rename fails if the name is taken, so
        of two runs that started from the same watermark only one can win."""
        target = f"{self.root}/_commits/{record['n']:012d}.json"
        system, final = fs(self.spark, target)
        system.mkdirs(final.getParent())
        _, aside = fs(self.spark, f"{self.root}/_tmp-{uuid.uuid4().hex}")
        stream = system.create(aside, False)
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        never_over = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never_over[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(system.makeQualified(aside), system.makeQualified(final), never_over)
        except Py4JJavaError as taken:
            system.delete(aside, False)
            raise RuntimeError(f"run {record['n']} was committed by another process") from taken

    def clean(self, lease_s: float = LEASE_S) -> int:
        """Remove output folders that no commit names and that nothing was written to for ``lease_s`` seconds (left by
        runs that died; a run in progress keeps its own). Returns how many."""
        removed, kept = 0, {c["folder"] for c in self.commits()}
        for part in PARTS:
            system, path = fs(self.spark, f"{self.root}/{part}")
            for status in system.listStatus(path) if system.exists(path) else []:
                inside = [s.getModificationTime() for s in system.listStatus(status.getPath())] if status.isDirectory() else []
                idle = time.time() - max([status.getModificationTime(), *inside]) / 1000
                if status.getPath().getName() not in kept and idle >= lease_s:
                    removed += bool(system.delete(status.getPath(), True)) and part == "data"
        return removed

    def folders(self, part: str = "data") -> list[str]:
        """Paths that the commits name, of the results or of what was committed with them."""
        return [f"{self.root}/{part}/{c['folder']}" for c in self.commits() if c["folder"] and part in c.get("parts", PARTS[:1])]

    def read(self, kind: str = "parquet") -> DataFrame | None:
        """Everything committed so far, and nothing else."""
        done = self.folders()
        return self.spark.read.option("basePath", f"{self.root}/data").format(kind).load(done).drop("_run") if done else None


def run_incremental(
    source: DataFrame,
    sequence: str,
    transform: Callable[[DataFrame], DataFrame],
    log: CommitLog,
    high: int | None = None,
) -> dict | None:
    """One run over the records above the last committed watermark.

    ``high`` defaults to the current maximum of ``sequence`` and is fixed before the first record is read. Returns the
    commit, or None if nothing is new. Records with a null sequence have no place in the order and are never taken.
    """
    # lower bound and number of the commit come from one reading: of overlapping runs only the first can commit
    done = log.commits()
    low = done[-1]["high"] if done else None
    top = source.agg(F.max(sequence)).first()[0]
    high = top if high is None else (None if top is None else min(high, top))
    if high is None or (low is not None and high <= low):
        return None
    bounds = F.col(sequence) <= F.lit(high)
    if low is not None:
        bounds &= F.col(sequence) > F.lit(low)
    folder = new_folder()
    transform(source.where(bounds)).write.parquet(f"{log.root}/data/{folder}")
    record = {"n": len(done), "low": low, "high": int(high), "folder": folder}
    log.commit(record)
    return record


def run_pending(
    entries: DataFrame,
    ledger: DataFrame,
    log: CommitLog,
    transform: Callable[[DataFrame], DataFrame] = lambda d: d,
    high: int | None = None,
    before_commit: Callable[[], None] | None = None,
) -> dict | None:
    """One run over the papers whose newest content no run has logged: their newest deliveries go through ``transform``.

    The commit sequence is the number of the run; its upper limit ``high`` (of ``entry_seq``, default: the current
    maximum) is fixed before the first record is read, and what earlier commits logged counts with the given ledger.
    Results, the papers' ledger lines and the watermark become visible by one commit, so a run that dies leaves nothing,
    and of overlapping runs only the first commits. Returns the commit, or None if there is no delivery at all.
    """
    spark, done = entries.sparkSession, log.commits()
    top = entries.agg(F.max("entry_seq")).first()[0]
    high = top if high is None else (None if top is None else min(high, top))
    if high is None:
        return None
    earlier = log.folders("ledger")
    known = ledger.select("stem", "arxiv_id", "recorded_at")
    known = known.unionByName(spark.read.option("basePath", f"{log.root}/ledger").parquet(*earlier).drop("_run")) if earlier else known
    newest = (
        entries.where(F.col("entry_seq") <= F.lit(high)).groupBy("source_tar", "arxiv_id").agg(F.max(F.struct("received_at", "entry_seq")).alias("_newest"))
        .select("source_tar", "arxiv_id", "_newest.received_at", "_newest.entry_seq")
    )
    chosen = materialize(pending_papers(entries, known, high).join(newest, ["source_tar", "arxiv_id"]), "pending")
    folder = new_folder()
    transform(entries.join(chosen.select("entry_seq"), "entry_seq")).write.parquet(f"{log.root}/data/{folder}")
    lines = chosen.select(F.regexp_replace("source_tar", r"\.tar$", "").alias("stem"), "arxiv_id", F.col("received_at").alias("recorded_at"))
    lines.write.parquet(f"{log.root}/ledger/{folder}")
    if before_commit:
        before_commit()
    record = {"n": len(done), "low": done[-1]["high"] if done else None, "high": int(high), "folder": folder, "parts": ["data", "ledger"]}
    log.commit(record)
    return record
