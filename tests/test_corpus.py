"""Sources, outcomes, sinks, ledger, incremental runs, numbering and relational forms on small frames."""

import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from paperlake import job
from paperlake.functions import cite
from paperlake.operators import incremental as inc
from paperlake.operators import outcome, relational, text
from paperlake.operators.numbering import numbered
from paperlake.schema import PAPER
from paperlake.session import scratch
from paperlake.sinks import shards
from paperlake.sources import archives, ledger

DOC = r"\documentclass{a}\begin{document}Paper %s.\end{document}"


def tar_bytes(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, raw in members:
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
    return out.getvalue()


def outer(path, names, bad=None):
    with tarfile.open(path, "w") as tar:
        for n in names:
            raw = gzip.compress((DOC % n).encode())
            info = tarfile.TarInfo(f"{n}.gz")
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
        if bad:
            info = tarfile.TarInfo(bad)
            info.size = 200_000_000
            tar.fileobj.write(info.tobuf())


def test_outer_tars(spark, tmp_path, rows):
    outer(tmp_path / "x.tar", ["2401.00001", "2401.00002"], bad="2401.00003.tex")
    (tmp_path / "ignored.tex").write_text("x")
    done = text.extract_papers(archives.read_papers(spark, str(tmp_path)))
    assert rows(done.select("arxiv_id", "status", "text", "file_type", "outer_tar")) == [
        ("2401.00001", "ok", "Paper 2401.00001.", "tex", "x.tar"),
        ("2401.00002", "ok", "Paper 2401.00002.", "tex", "x.tar"),
        ("2401.00003", "archive_error", None, "tex", "x.tar"),
    ]
    message = done.where("status = 'archive_error'").first()["error_message"]
    assert "100MB limit" in message


def test_single_archives(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress((DOC % "a").encode()))
    (tmp_path / "b.tar.gz").write_bytes(gzip.compress(tar_bytes([("main.tex", (DOC % "b").encode()), ("fig.png", b"x"), ("refs.BBL", b"r")])))
    (tmp_path / "c.tex").write_text(DOC % "c")
    (tmp_path / "d.gz").write_bytes(b"no gzip")
    (tmp_path / "e.gz").write_bytes(gzip.compress(b"%PDF-1.4"))
    got = {r["arxiv_id"]: r for r in text.extract_papers(archives.read_papers(spark, str(tmp_path))).collect()}
    assert {k: (r["status"], r["file_type"], r["num_tex_files"]) for k, r in got.items()} == {
        "a": ("ok", "tex", 1), "b": ("ok", "tex", 2), "c": ("ok", "tex", 1), "d": ("empty", "unknown", 0), "e": ("empty", "pdf", 0),
    }
    assert got["a"]["text_length"] == len("Paper a.") and got["a"]["peak_memory_bytes"] > 1_000_000


@pytest.mark.parametrize(("raw", "kind"), [(b"", "unknown"), (b"%PDF-1", "pdf"), (b"%!PS-Adobe", "postscript"), (b"<!DOCTYPE html>", "html"), (b"<HTML>", "html"), (b"\\doc", "tex")])
def test_sniff(raw, kind):
    assert archives.sniff(raw) == kind


@pytest.mark.parametrize(("raw", "wanted"), [("café".encode(), "café"), (b"\xef\xbb\xbfx", "x"), (b"caf\xe9", "café"), (b"\x81\x80", "\x81€"), (b"\xff\xfea\x00\xe9\x00", "aé")])
def test_decode(raw, wanted):
    assert archives.decode(raw) == wanted


def test_ids():
    assert archives.paper_id("hep-ph/0001001.gz") == "0001001" and archives.paper_id("a/b.tar.gz.tar.gz") == "b" and archives.paper_id("x.pdf.tex") == "x"


def test_extraction_edge_cases(spark):
    rows = [
        ("t.tar", "1.gz", "1", "tex", [("a.tex", None)], None), ("t.tar", "2.gz", "2", "tex", None, None), ("t.tar", "3.pdf", "3", None, None, "broken"),
        ("t.tar", "u", "unknown", None, None, "bad header"), (None, None, None, None, None, None), ("t.tar", "4.gz", "4", "tex", [("a.tex", "x" * 50)], None), ("t.tar", "5.gz", "5", "tex", [("a.tex", "hi")], None),
    ]
    done = text.extract_papers(spark.createDataFrame(rows, PAPER), most_octets=20)
    assert {r["arxiv_id"]: r["status"] for r in done.collect()} == {"1": "empty", "2": "empty", "3": "archive_error", "4": "skipped", "5": "ok"}
    assert text.extract_papers(spark.createDataFrame([], PAPER)).count() == 0


def test_outcomes(spark, rows):
    data = [("a", "ok", None), ("b", "timeout", None), ("c", "error", "extraction thread crashed"), ("d", "error", "x"), ("e", "error", None), ("f", None, None)] + [(f"t{i}", "timeout", None) for i in range(9)]
    df = spark.createDataFrame(data, "arxiv_id string, status string, error_message string")
    counted = {r["outcome"]: (r["n"], r["samples"]) for r in outcome.counts_with_samples(df).collect()}
    assert counted["timeout"] == (10, "b,t0,t1,t2,t3") and counted["crash"] == (1, "c") and counted["panic"][0] == 3
    total = outcome.tar_metrics(df.withColumn("outer_tar", F.lit("x"))).where("is_total = 1").first()
    assert (total["total"], total["timeout"], total["ok"]) == (15, 10, 1)


def test_shards(spark, rows):
    df = spark.createDataFrame([(i, "s.tar" if i < 7 else None) for i in range(9)], "id int, outer_tar string")
    named = rows(shards.assign_shards(df, ["id"], papers=3).select("id", "shard_id"))
    assert [n for _, n in named] == ["s"] * 3 + ["s_001"] * 3 + ["s_002"] + ["results"] * 2


def test_text_files_and_json(spark, tmp_path):
    df = spark.createDataFrame([("a/1", "one", None, "t.tar", "x"), ("b", None, "bad", None, "x")], "arxiv_id string, text string, error_message string, outer_tar string, shard_id string")
    assert shards.write_texts(df, str(tmp_path / "txt")) == 1
    assert (tmp_path / "txt" / "a_1.txt").read_text() == "one" and not list((tmp_path / "txt").glob(".*.tmp"))
    lines = [json.loads(r[0]) for r in shards.json_rows(df).collect()]
    assert lines == [{"arxiv_id": "a/1", "text": "one", "source_tar": "t.tar"}, {"arxiv_id": "b", "error": "bad"}]


def test_ledger(spark, rows):
    lines = spark.createDataFrame([("a.tar",), ("b\t1",), ("",), ("  ",), ("b\t2\r",), (" c \t 3 ",)], "value string")
    led = ledger.parse_lines(lines)
    assert rows(led) == [("a.tar", None), ("b", "1"), ("b", "2"), ("c", "3")]
    papers = spark.createDataFrame([("a.tar", "9"), ("b.tar", "1"), ("b.tar", "3"), ("c.tar", "3")], "source_tar string, arxiv_id string")
    assert rows(ledger.pending(papers, led)) == [("b.tar", "3")]


ENTRY = "entry_seq bigint, source_tar string, arxiv_id string, received_at timestamp, tex_files array<struct<name string, content string>>, extra string"
LEDGER = "stem string, arxiv_id string, recorded_at timestamp, run_id int"


def at(day):
    from datetime import datetime

    return datetime(2025, 1, day)


def test_pending_papers(spark, rows):
    f = [("m.tex", "x")]
    entries = spark.createDataFrame(
        [
            (1, "a.tar", "1", at(1), f, ""), (2, "a.tar", "1", at(3), [("m.tex", "y")], ""),  # handled once, then changed
            (3, "a.tar", "2", at(1), f, ""), (4, "a.tar", "2", at(3), f, ""),  # delivered again unchanged
            (5, "b.tar", "1", at(1), f, ""),  # closed with its tar
            (6, "b.tar", "2", at(5), f, ""),  # late for its tar
            (7, "c.tar", "1", at(1), [("m.tex", None)], ""), (8, "c.tar", "1", at(2), [("m.tex", "")], ""),  # null is not empty
            (9, "c.tar", "unknown", at(1), f, ""), (10, "d.tar", "1", None, f, ""), (11, "c.tar", None, at(1), f, ""),
        ],
        ENTRY,
    )
    lines = spark.createDataFrame(
        [("a", "1", at(2), 1), (" a ", "2\r", at(2), None), ("b.tar", None, at(2), 1), ("b", None, at(9), 1), ("c", "1", at(1), 1), ("", None, at(9), 1), ("zz.tar", None, at(9), 1), (None, None, None, None)], LEDGER
    )
    assert rows(inc.pending_papers(entries, lines)) == [("a.tar", "1"), ("b.tar", "2"), ("c.tar", "1"), ("d.tar", "1")]
    assert rows(inc.pending_papers(entries, lines.limit(0), upper=4)) == [("a.tar", "1"), ("a.tar", "2")]
    assert inc.pending_papers(entries.limit(0), lines).count() == 0


def test_runs_survive_a_crash(spark, rows):
    source = spark.range(1, 101).withColumnRenamed("id", "seq")
    log = inc.CommitLog(spark, scratch(spark, "runs"))
    inc.run_incremental(source, "seq", lambda d: d, log, high=40)

    def dies(d):
        d.write.parquet(f"{log.root}/data/half-written")
        raise OSError("lost")

    with pytest.raises(OSError):
        inc.run_incremental(source, "seq", dies, log, high=70)
    assert log.watermark() == 40 and log.clean(0) == 1
    inc.run_incremental(source, "seq", lambda d: d, log)
    assert inc.run_incremental(source, "seq", lambda d: d, log) is None
    assert sorted(r[0] for r in log.read().collect()) == list(range(1, 101))
    with pytest.raises(RuntimeError):
        log.commit({"n": 1, "low": 0, "high": 1, "folder": "x"})


def test_of_overlapping_runs_one_commits(spark):
    source = spark.range(1, 101).withColumnRenamed("id", "seq")
    log = inc.CommitLog(spark, scratch(spark, "runs"))
    inc.run_incremental(source, "seq", lambda d: d, log, high=40)

    def stalls(d):
        inc.run_incremental(source, "seq", lambda x: x, log, high=90)
        return d

    with pytest.raises(RuntimeError):
        inc.run_incremental(source, "seq", stalls, log, high=70)
    assert log.watermark() == 90 and [c["n"] for c in log.commits()] == [0, 1] and log.clean(0) == 1
    inc.run_incremental(source, "seq", lambda d: d, log)
    assert sorted(r[0] for r in log.read().collect()) == list(range(1, 101))


def test_numbering_is_the_same_for_any_partitioning(spark, rows):
    df = spark.createDataFrame([("hot" if i % 3 else None, i) for i in range(200)], "g string, i int")
    want = sorted(((g, i, n) for g in ("hot", None) for n, i in enumerate([i for i in range(200) if ("hot" if i % 3 else None) == g], 1)), key=repr)
    for parts in (1, 7):
        assert rows(numbered(df.repartition(parts), "g", ["i"]).select("g", "i", "row_no")) == want
    assert numbered(df.limit(0), "g", ["i"]).count() == 0


def test_relational_forms_agree(spark, rows):
    source = r"\label{fig:a}\label{x}\label{fig:b}\label{fig:a}\label{y}"
    docs = spark.createDataFrame([("d", source)], "doc string, t string")
    labels = relational.occurrences(docs, "doc", "t", r"\\label\{([^}]*)\}").withColumnRenamed("value", "label")
    got = {r["label"]: str(r["number"]) for r in relational.label_numbers(labels).collect()}
    assert got == cite.label_numbers(source)
    from paperlake.functions.layout import section_number

    levels, counts = [1, 2, 2, 3, 1, 3, 0, 2], [0, 0, 0, 0]
    want = [section_number(counts, x) for x in levels]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(levels)], "doc string, pos int, level int")
    assert [r["number"] for r in relational.section_numbers(df).orderBy("pos").collect()] == want


def test_job_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    outer(tmp_path / "in" / "a.tar", ["1", "2"])
    o = job.options(["-d", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--resume", "--metrics"])
    assert job.run(spark, o).count() == 2
    outer(tmp_path / "in" / "b.tar", ["3"])
    assert [r["arxiv_id"] for r in job.run(spark, o).collect()] == ["3"]
    assert job.output_format("JSON") == "jsonl"
    with pytest.raises(ValueError):
        job.output_format("xml")


def test_metrics_count_papers_without_a_row(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "out").mkdir()
    outer(tmp_path / "in" / "a.tar", ["1", "2", "3"])
    outer(tmp_path / "in" / "b.tar", ["4"], bad="5.tex")
    (tmp_path / "out" / "checkpoint.log").mkdir()
    (tmp_path / "out" / "checkpoint.log" / "part-0.txt").write_text("a\t1\na\t2\n")
    o = job.options(["-d", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--resume", "--metrics"])
    assert sorted(r["arxiv_id"] for r in job.run(spark, o).where("status = 'ok'").collect()) == ["3", "4"]
    got = {r["outer_tar"]: r for r in spark.read.option("multiLine", True).json(str(tmp_path / "out" / "metrics")).collect()}
    assert got["a.tar"]["skipped_resume"] == 2 and got["a.tar"]["ok"] == 1
    # the entry above the limit, and the tar that ends in it
    assert got["b.tar"]["archive_error"] == 2 and got[None]["total"] == 6


def test_job_survives_a_kill(spark, tmp_path):
    """A run that dies before its commit leaves nothing visible; the next one brings every paper once and goes on with
    the shard numbers."""
    (tmp_path / "in").mkdir()
    outer(tmp_path / "in" / "a.tar", ["1", "2", "3"])
    for kind in ("parquet", "jsonl"):
        out = str(tmp_path / kind)
        o = job.options(["-d", str(tmp_path / "in"), "-o", out, "--resume", "--output-format", kind, "--papers-per-shard", "2"])

        def die():
            raise KeyboardInterrupt

        with pytest.raises(KeyboardInterrupt):
            job.run(spark, o, before_commit=die)
        assert job.read_results(spark, out, kind) is None and job.logged(spark, o, job.commit_log(spark, out)).count() == 0
        job.run(spark, o)
        job.run(spark, o)
        assert sorted(r["arxiv_id"] for r in job.read_results(spark, out, kind).collect()) == ["1", "2", "3"]
        assert job.commit_log(spark, out).clean(0) == 1
    assert {r["shard_id"] for r in job.read_results(spark, str(tmp_path / "parquet")).collect()} <= {"a", "a_001", "a_002"}


def test_two_jobs_at_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    outer(tmp_path / "in" / "a.tar", ["1"])
    o = job.options(["-d", str(tmp_path / "in"), "-o", str(tmp_path / "out"), "--resume"])
    with pytest.raises(RuntimeError):
        job.run(spark, o, before_commit=lambda: job.run(spark, o))
    assert job.read_results(spark, str(tmp_path / "out")).count() == 1


def test_shards_keep_their_limits(spark):
    rows = [(f"{i:03d}", "t.tar", "x" * (10 * i)) for i in range(60)] + [("z", None, None)]
    df = spark.createDataFrame(rows, "arxiv_id string, outer_tar string, text string").selectExpr("*", "null as error_message", "null as stage_timings_us", "'' as shard_id")
    taken = spark.createDataFrame([("t", 7)], "stem string, next_shard int")
    cut = shards.cut_shards(df, ["arxiv_id"], rows=8, octets=2000, taken=taken)
    by = {}
    for r in cut.orderBy("arxiv_id").collect():
        by.setdefault((r["stem"], r["shard"], r["shard_id"]), []).append(r)
    assert all(len(v) <= 8 and sum(200 + len(r["arxiv_id"]) + len(r["text"] or "") for r in v[:-1]) < 2000 for v in by.values())
    numbers = sorted(k[1] for k in by if k[0] == "t")
    assert numbers == list(range(7, 7 + len(numbers))) and ("results", 0, "results") in by and sum(map(len, by.values())) == 61
    assert shards.cut_shards(df.limit(0), ["arxiv_id"]).count() == 0


def test_one_scan_and_closed_tars(spark, tmp_path):
    for n in "ab":
        outer(tmp_path / f"{n}.tar", [n])
    open_only = archives.read_papers(spark, str(tmp_path), ["a.tar", "zz.tar"])
    assert [r["arxiv_id"] for r in open_only.collect()] == ["b"] and open_only.rdd.getNumPartitions() == 1
    plan = text.extract_papers(open_only.repartition(4, "arxiv_id"), keep_unwritten=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert [r["arxiv_id"] for r in archives.collect_papers(str(tmp_path / "a.tar"))] == ["a"]


def test_deadline_and_death(monkeypatch):
    import os
    import re
    import time

    files = [{"name": "m.tex", "content": "x"}, None]
    monkeypatch.setattr(text, "extract", lambda *_: re.match("(a+)+$", "a" * 40 + "b"))
    began = time.monotonic()
    assert text._extract_row(files, 0.3)[0] == "timeout" and time.monotonic() - began < 5
    monkeypatch.setattr(text, "extract", lambda *_: os._exit(9))
    assert text._isolated(files, 5.0)[:3] == ("error", text.CRASH, 1)
    monkeypatch.undo()
    assert text._isolated([{"name": "m.tex", "content": "text"}], 5.0)[:4] == ("ok", None, 1, "text")


def test_pending_runs_commit_once(spark):
    """Selection, output and ledger lines in one commit: a killed run leaves nothing, a repeated one takes everything, a
    revised paper comes again, a second run finds nothing."""
    from datetime import datetime

    at = lambda h: datetime(2024, 1, 1, h)
    files = lambda t: [("m.tex", t)]
    rows = [(1, "a.tar", "1", files("x"), at(1)), (2, "a.tar", "2", files("x"), at(1)), (3, "a.tar", "1", files("y"), at(3)), (4, "a.tar", "unknown", None, at(1)), (5, "a.tar", "3", None, None)]
    entries = spark.createDataFrame(rows, "entry_seq bigint, source_tar string, arxiv_id string, tex_files array<struct<name:string,content:string>>, received_at timestamp")
    ledger = spark.createDataFrame([], "stem string, arxiv_id string, recorded_at timestamp, run_id int")
    log = inc.CommitLog(spark, scratch(spark, "pending-runs"))
    narrow = lambda d: d.select("entry_seq")

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        inc.run_pending(entries, ledger, log, narrow, 2, die)
    assert log.read() is None
    assert inc.run_pending(entries, ledger, log, narrow, 2)["high"] == 2
    with pytest.raises(RuntimeError):
        inc.run_pending(entries, ledger, log, narrow, 4, lambda: inc.run_pending(entries, ledger, log, narrow, 4))
    inc.run_pending(entries, ledger, log, narrow, 4)
    assert sorted(r[0] for r in log.read().collect()) == [1, 2, 3]
    assert inc.run_pending(entries.limit(0), ledger, log, narrow) is None


def test_operators_in_one_pass(spark, tmp_path):
    """All operators take one Python worker a task, and give the octets that each gives by itself."""
    from paperlake.plans.corpus import ent_stages

    sources = [r"\newcommand{\x}{é}\section{A} \x % c", "", None, r"\documentclass{a}\begin{document}\'e $\alpha\leq 1$ \cite{k}\end{document}"]
    files = [(1, [(str(i), s) for i, s in enumerate(sources)]), (2, []), (3, None), (4, [None, ("a", "ü" * 10_000)])]
    spark.createDataFrame(files, "entry_seq bigint, tex_files array<struct<name:string,content:string>>").write.parquet(str(tmp_path / "entries.parquet"))
    found = ent_stages(spark, str(tmp_path))
    of = lambda s: tuple(None if s is None else len(fn(s).encode()) for fn in text.OPERATORS.values())
    wanted = [(1, i, *of(s)) for i, s in enumerate(sources)] + [(4, 0, *of(None)), (4, 1, *of("ü" * 10_000))]
    assert found.columns == ["entry_seq", "pos", *text.OPERATORS] and {t for _, t in found.dtypes[1:]} == {"int"}
    assert sorted(map(tuple, found.collect())) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1


def test_closure_of_repeated_and_circular_includes(spark):
    """Rows follow the files, not the ways to them (3 ** 20 in paper 1); 20 steps at most (papers 2 and 3)."""
    names = lambda n: [f"{i:02}.tex" for i in range(n)]
    chain = lambda p, n, back: [(p, a, b) for a, b in zip(names(n), names(n)[1:] + back, strict=False)]
    repeated = [(1, "a.tex", "b.tex"), (1, "b.tex", "a.tex")] * 3 + [(1, "b.tex", "lost.tex"), (1, "apart.tex", "x.tex")]
    odd = [(None, "a.tex", "b.tex"), (4, None, "b.tex"), (5, "a.tex", "a.tex"), (6, "a.tex", "b.tex")]
    edges = spark.createDataFrame([*repeated, *chain(2, 25, []), *chain(3, 20, ["00.tex"]), *odd], "paper bigint, file string, target string")
    roots = spark.createDataFrame([(1, "a.tex"), (1, "a.tex"), (2, "00.tex"), (3, "00.tex"), (None, "a.tex"), (4, None), (5, "a.tex"), (7, "a.tex")], "paper bigint, file string")
    found = [tuple(r) for r in relational.include_closure(edges, roots, 20).collect()]
    wanted = [(1, f) for f in ("a.tex", "b.tex", "lost.tex")] + [(2, f) for f in names(21)[1:]] + [(3, f) for f in names(20)] + [(5, "a.tex")]
    assert sorted(found) == sorted(wanted)


def test_inc_closure_of_repeated_includes(spark, tmp_path):
    from paperlake.plans.corpus import inc_closure

    files = [("a.tex", r"\begin{document}" + r"\input{b}" * 3), ("b.tex", r"\include{./a.tex}" * 3), ("c.tex", None), (None, r"\input{c}")]
    spark.createDataFrame([(1, files), (2, None), (3, [])], "entry_seq bigint, tex_files array<struct<name:string,content:string>>").write.parquet(str(tmp_path / "entries.parquet"))
    assert sorted(map(tuple, inc_closure(spark, str(tmp_path)).collect())) == [(1, "a.tex"), (1, "b.tex")]
