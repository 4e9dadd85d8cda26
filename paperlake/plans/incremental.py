"""Queries of problem 1."""

from __future__ import annotations

from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.operators import incremental as inc
from paperlake.session import scratch, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.pending_papers(table(spark, sf_dir, "entries"), table(spark, sf_dir, "ledger"))


def p1_watermarked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over entries, the second of which dies after writing and is repeated; the committed rows, counted."""
    entries = table(spark, sf_dir, "entries").select("entry_seq", "source_tar", "arxiv_id", "file_type")
    log = inc.CommitLog(spark, scratch(spark, "p1-runs"))
    top = entries.agg(F.max("entry_seq")).first()[0] or 0

    def dies(df: DataFrame) -> DataFrame:
        df.write.parquet(f"{log.root}/data/run-died")
        raise InterruptedError

    inc.run_incremental(entries, "entry_seq", lambda d: d, log, top // 3)
    try:
        inc.run_incremental(entries, "entry_seq", dies, log, top * 2 // 3)
    except InterruptedError:
        log.clean(lease_s=0)
    inc.run_incremental(entries, "entry_seq", lambda d: d, log, top * 2 // 3)
    inc.run_incremental(entries, "entry_seq", lambda d: d, log)
    done = log.read()
    done = done if done is not None else entries.limit(0)
    return done.groupBy("source_tar").agg(
        F.count("*").alias("n_rows"), F.countDistinct("entry_seq").alias("n_entries"), F.max("entry_seq").alias("last_seq")
    )


def p1_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pending papers taken by two runs, the first over two thirds of the deliveries, the second killed before its
    commit and repeated: every committed delivery with the run that has it. A third run finds nothing."""
    entries = table(spark, sf_dir, "entries").select("entry_seq", "source_tar", "arxiv_id", "tex_files", "received_at")
    ledger, log = table(spark, sf_dir, "ledger"), inc.CommitLog(spark, scratch(spark, "p1-pending"))
    top = entries.agg(F.max("entry_seq")).first()[0] or 0
    narrow = lambda d: d.select("entry_seq", "source_tar", "arxiv_id")

    def dies() -> None:
        raise InterruptedError

    inc.run_pending(entries, ledger, log, narrow, top * 2 // 3)
    with suppress(InterruptedError):
        inc.run_pending(entries, ledger, log, narrow, before_commit=dies)
    inc.run_pending(entries, ledger, log, narrow)
    inc.run_pending(entries, ledger, log, narrow)
    done = log.read()
    return done if done is not None else narrow(entries.limit(0))


QUERIES = {"p1_committed_runs": p1_committed_runs, "p1_found": p1_found, "p1_watermarked_runs": p1_watermarked_runs}

_DELIVERIES = r"""
WITH led AS (
  SELECT regexp_replace(stem, '^\s+|\s+$', '', 'g') AS name, regexp_replace(arxiv_id, '^\s+|\s+$', '', 'g') AS pid, recorded_at FROM ledger
), b AS (SELECT max(entry_seq) * 2 // 3 AS cut FROM entries), e AS (
  SELECT entry_seq, source_tar, arxiv_id, received_at, CAST(to_json(tex_files) AS VARCHAR) AS body, entry_seq <= cut AS early,
         EXISTS (SELECT 1 FROM led WHERE led.recorded_at >= e0.received_at AND
                 ((led.pid IS NULL AND led.name = e0.source_tar AND led.name LIKE '%.tar') OR (led.pid = e0.arxiv_id AND led.name || '.tar' = e0.source_tar))) AS handled
  FROM entries e0, b WHERE arxiv_id <> 'unknown'
), n1 AS (SELECT *, row_number() OVER (PARTITION BY source_tar, arxiv_id ORDER BY received_at DESC, entry_seq DESC) AS rn,
  row_number() OVER (PARTITION BY source_tar, arxiv_id, handled ORDER BY received_at DESC, entry_seq DESC) AS rh FROM e WHERE early
), one AS (
  SELECT a.* FROM n1 a LEFT JOIN (SELECT * FROM n1 WHERE handled AND rh = 1) h USING (source_tar, arxiv_id) WHERE a.rn = 1 AND NOT a.handled AND (h.body IS NULL OR h.body <> a.body)
), f AS (
  SELECT e.* REPLACE (e.handled OR coalesce(e.received_at <= one.received_at, false) AS handled) FROM e LEFT JOIN one ON one.source_tar = e.source_tar AND one.arxiv_id = e.arxiv_id
), n2 AS (SELECT *, row_number() OVER (PARTITION BY source_tar, arxiv_id ORDER BY received_at DESC, entry_seq DESC) AS rn,
  row_number() OVER (PARTITION BY source_tar, arxiv_id, handled ORDER BY received_at DESC, entry_seq DESC) AS rh FROM f
), two AS (
  SELECT a.* FROM n2 a LEFT JOIN (SELECT * FROM n2 WHERE handled AND rh = 1) h USING (source_tar, arxiv_id) WHERE a.rn = 1 AND NOT a.handled AND (h.body IS NULL OR h.body <> a.body)
)
SELECT entry_seq, source_tar, arxiv_id FROM one UNION ALL SELECT entry_seq, source_tar, arxiv_id FROM two
"""
ORACLES = {
    "p1_committed_runs": _DELIVERIES,
    "p1_found": r"""
WITH led AS (
  SELECT regexp_replace(stem, '^\s+|\s+$', '', 'g') AS name, regexp_replace(arxiv_id, '^\s+|\s+$', '', 'g') AS pid, recorded_at FROM ledger
), e AS (
  SELECT source_tar, arxiv_id, received_at, entry_seq, CAST(to_json(tex_files) AS VARCHAR) AS body,
         EXISTS (SELECT 1 FROM led WHERE led.recorded_at >= e0.received_at AND
                 ((led.pid IS NULL AND led.name = e0.source_tar AND led.name LIKE '%.tar')
                  OR (led.pid = e0.arxiv_id AND led.name || '.tar' = e0.source_tar))) AS handled
  FROM entries e0 WHERE arxiv_id <> 'unknown'
), r AS (
  SELECT *, row_number() OVER (PARTITION BY source_tar, arxiv_id ORDER BY received_at DESC, entry_seq DESC) AS rn,
         row_number() OVER (PARTITION BY source_tar, arxiv_id, handled ORDER BY received_at DESC, entry_seq DESC) AS rh
  FROM e
)
SELECT a.source_tar, a.arxiv_id FROM r a
LEFT JOIN (SELECT * FROM r WHERE handled AND rh = 1) h ON h.source_tar = a.source_tar AND h.arxiv_id = a.arxiv_id
WHERE a.rn = 1 AND NOT a.handled AND (h.source_tar IS NULL OR h.body IS DISTINCT FROM a.body)
""",
    "p1_watermarked_runs": """
SELECT source_tar, count(*) AS n_rows, count(DISTINCT entry_seq) AS n_entries, max(entry_seq) AS last_seq
FROM entries GROUP BY source_tar
""",
}
