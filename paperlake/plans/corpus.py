"""Queries of sources, include resolution, outcomes, sinks, the ledger, relational numbering and streaming."""

from __future__ import annotations

import gzip
import io
import tarfile
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperlake import job
from paperlake.functions import columns, includes
from paperlake.operators import outcome, relational, text
from paperlake.operators.numbering import numbered
from paperlake.session import scratch, spread, table
from paperlake.sinks import shards
from paperlake.sources import ledger
from paperlake.sources.archives import locate, read_papers
from paperlake.streaming.ingest import ingest, late_counts, stream_papers

STAGED = "array<struct<name:string,content:string>>"


def papers_of_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "entries").select("source_tar", "entry_name", "arxiv_id", "file_type", "tex_files", "error")


def multi_file(nations: DataFrame) -> DataFrame:
    """A paper of several files per nation: a template, a part, the main file, a bibliography and a stray file."""
    f = lambda name, content: f"named_struct('name', '{name}', 'content', {content})"
    files = ", ".join(
        [
            f("sample_x.tex", r"concat(r'\documentclass{x}', n_name)"),
            f("sec/part.tex", "concat('part of ', n_name)"),
            f("main.tex", r"concat(r'\documentclass{a}\begin{document}', n_nationkey, r' \input{sec/part} \input{none} \bibliography{refs} \input{sec/part}\end{document}')"),
            f("refs.bbl", "'BIB'"),
            f("zz.tex", "'stray'"),
        ]
    )
    return nations.select(F.col("n_nationkey").cast("bigint").alias("id"), F.expr(f"array({files})").alias("tex_files"))


def _roots(files: list) -> str:
    given = [includes.TexFile(f["name"], f["content"]) for f in files]
    return "|".join(f"{f.name}={f.content}" for f in includes.ordered_roots(given))


def inc_root_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = F.udf(_roots, "string", useArrow=True)
    return multi_file(table(spark, sf_dir, "nation")).select("id", roots("tex_files").alias("txt"))


def inc_main_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_file(table(spark, sf_dir, "nation")).select("id", columns.main_file(F.col("tex_files")).cast("int").alias("place"))


def inc_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = multi_file(table(spark, sf_dir, "nation")).select("id", F.posexplode("tex_files").alias("pos", "f"))
    return files.select("id", "pos", columns.is_template(F.col("f.name"), F.col("f.content")).alias("template"))


def ent_main_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "entries").where(F.size("tex_files") > 0)
    return e.select("entry_seq", columns.main_file(F.col("tex_files")).cast("int").alias("place"))


def ent_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "entries").select("entry_seq", F.posexplode("tex_files").alias("pos", "f"))
    return files.select("entry_seq", "pos", columns.is_template(F.col("f.name"), F.col("f.content")).alias("template"))


def ent_root_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots of every delivered paper, includes inlined."""
    roots = F.udf(_roots, "string", useArrow=True)
    e = table(spark, sf_dir, "entries").where("tex_files is not null")
    return spread(e.select("entry_seq", "tex_files"), "entry_seq").select("entry_seq", roots("tex_files").alias("txt"))


def ent_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every operator by itself on every delivered file, whole: the octets that come out."""
    files = spread(table(spark, sf_dir, "entries").select("entry_seq", "tex_files"), "entry_seq").select("entry_seq", F.posexplode("tex_files").alias("pos", "f"))
    return text.operator_octets(files.select("entry_seq", "pos", F.col("f.content").alias("content")), "content")


def ent_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result rows of all delivered papers without their texts."""
    rows = text.extract_papers(spread(papers_of_entries(spark, sf_dir), "source_tar", "arxiv_id"))
    return rows.select("arxiv_id", "outer_tar", "entry_name", "file_type", "status", "num_tex_files", "error_message")


def inc_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "entries").select(F.col("entry_seq").alias("paper"), F.explode("tex_files").alias("f")).select("paper", F.col("f.name").alias("file"), F.col("f.content").alias("content"))
    edges = relational.include_edges(files)
    roots = files.where(F.col("content").contains("\\begin{document}")).select("paper", "file")
    return relational.include_closure(edges, roots, 20)


def src_entry_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "entries")
    first = F.try_element_at("tex_files", F.lit(1)).content
    return e.select("entry_seq", columns.file_type(first).alias("sniffed"), columns.type_by_name(F.col("entry_name")).alias("by_name"), columns.paper_id(F.col("entry_name")).alias("paper_id"),
                    columns.output_stem(F.col("source_tar")).alias("stem"), columns.safe_id(F.col("entry_name")).alias("safe"))


def _put(folder: str, name: str, raw: bytes) -> None:
    store, place = locate(folder)
    store.create_dir(place, recursive=True)
    with store.open_output_stream(f"{place}/{name}", compression=None) as out:
        out.write(raw)


def _tar(members: list[tuple[str, bytes]], claims: str | None = None) -> bytes:
    """Octets of a tar; ``claims`` adds a last entry that says it has 200 MB but has none."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, raw in members:
            info = tarfile.TarInfo(name)
            info.size = len(raw)
            tar.addfile(info, io.BytesIO(raw))
        if claims:
            info = tarfile.TarInfo(claims)
            info.size = 200_000_000
            out.write(info.tobuf())
            return out.getvalue()
    return out.getvalue()


def _document(text: str) -> str:
    return f"\\documentclass{{a}}\\begin{{document}}{text}\\end{{document}}"


def _nations(spark: SparkSession, sf_dir: str) -> list:
    """nation is a fixed table of 25 rows."""
    return table(spark, sf_dir, "nation").orderBy("n_nationkey").collect()


def _by_region(nations: list) -> dict[int, list]:
    by: dict[int, list] = {}
    for r in nations:
        by.setdefault(r["n_regionkey"], []).append(r)
    return by


def _write_tars(folder: str, nations: list, claims: str | None = None) -> None:
    """One outer tar per region with a gzipped paper per nation."""
    for region, members in _by_region(nations).items():
        packed = [(f"0101/{r['n_nationkey']:05d}.gz", gzip.compress(_document(r["n_name"]).encode(), mtime=0)) for r in members]
        _put(folder, f"region_{region}.tar", _tar(packed, claims))


def src_tar_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "tars")
    _write_tars(folder, _nations(spark, sf_dir))
    done = text.extract_papers(read_papers(spark, folder))
    return done.select("outer_tar", "arxiv_id", "status", "file_type", "entry_name", "text", F.col("num_tex_files").alias("files"))


def src_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outer tars whose entries are compressed tars of several files, plain sources, PDFs and others, by turns."""
    folder = scratch(spark, "nested")
    for region, members in _by_region(_nations(spark, sf_dir)).items():
        packed = []
        for r in members:
            k, n = r["n_nationkey"], r["n_name"]
            inner = _tar([("main.tex", _document(f"\\input{{sec/a}} of {n} \\bibliography{{lost}}").encode()), ("sec/a.tex", b"Part"), ("fig.png", b"x"), ("refs.bbl", b"BIB")])
            packed.append([(f"{k}.tar.gz", gzip.compress(inner, mtime=0)), (f"{k}.tex", _document(n).encode()), (f"{k}.pdf", b"%PDF-1.4"), (f"{k}.gz", gzip.compress(b"%!PS x", mtime=0)), (f"{k}.txt", b"x")][k % 5])
        _put(folder, f"r{region}.tar", _tar(packed))
    papers = read_papers(spark, folder).withColumn("files", F.array_join("tex_files.name", ","))
    return text.extract_papers(papers).select("arxiv_id", "status", "file_type", "text", "num_tex_files").join(papers.select("arxiv_id", "files"), "arxiv_id")


def src_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder without outer tars: compressed files, compressed and plain tars under a compressed name, sources."""
    folder = scratch(spark, "files")
    for r in _nations(spark, sf_dir):
        k, source = r["n_nationkey"], _document(r["n_name"]).encode()
        inner = _tar([("main.tex", source)])
        name, raw = [(f"{k}.gz", gzip.compress(source, mtime=0)), (f"{k}.tar.gz", gzip.compress(inner, mtime=0)), (f"{k}.tgz", inner), (f"{k}.tex", source), (f"{k}.gz", b"no archive")][k % 5]
        _put(folder, name, raw)
    return text.extract_papers(read_papers(spark, folder)).select("arxiv_id", "status", "file_type", "text", "num_tex_files", "outer_tar")


def src_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as UTF-8 with and without its mark, UTF-16 of both orders, and Windows-1252."""
    folder = scratch(spark, "encodings")
    for r in _nations(spark, sf_dir):
        k, source = r["n_nationkey"], _document(f"{r['n_name']} café – “x”")
        raw = [source.encode(), b"\xef\xbb\xbf" + source.encode(), b"\xff\xfe" + source.encode("utf-16-le"), b"\xfe\xff" + source.encode("utf-16-be"), source.encode("cp1252")][k % 5]
        _put(folder, f"{k}.tex", raw)
    return text.extract_papers(read_papers(spark, folder)).select("arxiv_id", "status", "text")


def src_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every outer tar ends with an entry that claims 200 MB and has none: an error row for the entry, and the defect of
    the tar itself, which has no id and gives no row."""
    folder = scratch(spark, "defects")
    _write_tars(folder, _nations(spark, sf_dir), "0101/huge.pdf")
    done = text.extract_papers(read_papers(spark, folder), keep_unwritten=True)
    return done.groupBy("outer_tar", "status", "file_type", "unwritten").agg(F.count("*").alias("n"), F.max("error_message").alias("message")).withColumn(
        "message", F.when(F.col("unwritten").isNull(), F.col("message"))
    )


def _job(folder: str, out: str, *more: str):
    return job.options(["-d", folder, "-o", out, *more])


class _Killed(Exception):
    pass


def _kill() -> None:
    raise _Killed


def job_kill_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over some tars; one over all of them that dies between writing and committing; the same once more. Every
    paper comes out once, with the shard that holds it."""
    folder, out, nations = scratch(spark, "job-in"), scratch(spark, "job-out"), _nations(spark, sf_dir)
    _write_tars(folder, [r for r in nations if r["n_regionkey"] < 2])
    job.run(spark, _job(folder, out, "--resume"))
    _write_tars(folder, nations)
    with suppress(_Killed):
        job.run(spark, _job(folder, out, "--resume"), before_commit=_kill)
    job.run(spark, _job(folder, out, "--resume"))
    return job.read_results(spark, out).groupBy("outer_tar", "arxiv_id", "text").agg(F.count("*").alias("n"), F.count_if(F.col("shard_id").startswith(F.regexp_replace("outer_tar", ".tar$", ""))).alias("placed"))


def job_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows a shard at most, and another run whose shards hold 600 estimated octets at most before the last row."""
    folder, by_rows, by_octets = (scratch(spark, n) for n in ("job-in", "by-rows", "by-octets"))
    _write_tars(folder, _nations(spark, sf_dir))
    job.run(spark, _job(folder, by_rows, "--max-shard-rows", "2"))
    job.run(spark, _job(folder, by_octets, "--max-shard-bytes", "600"))
    found = [job.read_results(spark, d).groupBy("outer_tar", "shard_id").agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "outer_tar", "n") for kind, d in (("rows", by_rows), ("octets", by_octets))]
    return found[0].unionByName(found[1]).groupBy("kind", "outer_tar").agg(F.sum("n").alias("n_rows"), (F.max("n") <= F.when(F.col("kind") == "rows", 2).otherwise(3)).alias("kept"), (F.count("*") > 1).alias("several"))


def job_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files of a run and its metrics files, read again."""
    folder, out = scratch(spark, "job-in"), scratch(spark, "job-out")
    _write_tars(folder, _nations(spark, sf_dir))
    job.run(spark, _job(folder, out, "--text-files", "--metrics"))
    texts = spark.read.option("wholetext", True).text(f"{out}/*.txt").select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)\.txt$", 1).alias("name"))
    metrics = spark.read.option("multiLine", True).json(f"{out}/metrics/*_metrics.json").select(F.coalesce("outer_tar", F.lit("total")).alias("name"), F.format_string("%d of %d", "ok", "total").alias("value"))
    return texts.unionByName(metrics)


def out_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: every delivered paper to its result row."""
    return text.extract_papers(spread(papers_of_entries(spark, sf_dir), "source_tar", "arxiv_id")).drop("stage_timings_us", "total_time_us", "peak_memory_bytes")


def out_size_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = papers_of_entries(spark, sf_dir).where("arxiv_id <> 'unknown'")
    octets = columns.source_octets(F.coalesce("tex_files", F.array().cast(STAGED)))
    return papers.groupBy("source_tar").agg(F.count_if(octets > 2000).alias("too_large"), F.count("*").alias("n"))


def out_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.counts_with_samples(table(spark, sf_dir, "results").select("status", "error_message", "arxiv_id"))


def out_tar_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome.tar_metrics(table(spark, sf_dir, "results").select("outer_tar", "status", "error_message"))


def led_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger written as lines and read again."""
    lines = table(spark, sf_dir, "ledger").select(F.concat_ws("\t", "stem", "arxiv_id").alias("value"))
    return ledger.parse_lines(lines).groupBy("stem", "arxiv_id").agg(F.count("*").alias("n"))


def led_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = papers_of_entries(spark, sf_dir).select("source_tar", "arxiv_id").where("arxiv_id <> 'unknown'").distinct()
    lines = table(spark, sf_dir, "ledger").select(F.concat_ws("\t", "stem", "arxiv_id").alias("value"))
    return ledger.pending(papers, ledger.parse_lines(lines))


def led_resume_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    papers = papers_of_entries(spark, sf_dir).select("source_tar", "arxiv_id").where("arxiv_id <> 'unknown'").distinct()
    lines = table(spark, sf_dir, "ledger").select(F.concat_ws("\t", "stem", "arxiv_id").alias("value"))
    return ledger.with_done(papers, ledger.parse_lines(lines)).groupBy("source_tar").agg(F.count_if("done").alias("skipped"), F.count("*").alias("n"))


def snk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "results").select("result_id", "outer_tar")
    return shards.assign_shards(rows, ["result_id"], rows=50, papers=20).select("result_id", "shard_id")


def snk_octets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "results").select("result_id", "outer_tar", "arxiv_id", "text", "error_message", "stage_timings_us")
    return shards.octet_shards(rows, ["result_id"], octets=20_000, rows=100).groupBy("outer_tar").agg(F.max("chunk").alias("chunks"), F.sum(shards.row_octets()).alias("octets"))


def snk_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result rows as JSON lines, written and read again."""
    path = scratch(spark, "jsonl")
    shards.write_jsonl(table(spark, sf_dir, "results").select("result_id", "arxiv_id", "status", "error_message", "outer_tar", "text", "shard_id"), path, 100)
    return spark.read.schema("result_id bigint, arxiv_id string, status string, error string, source_tar string, text string").json(path)


def snk_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "parquet")
    shards.write_parquet(table(spark, sf_dir, "results").select("result_id", "outer_tar", "status", "text"), path, 100)
    return spark.read.parquet(path).select("result_id", "outer_tar", "status", "text")


def num_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag", ["l_orderkey", "l_linenumber"]).withColumn("row_no", F.col("row_no").cast("bigint"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their place in the order (line numbers alone repeat)."""
    by = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return table(spark, sf_dir, "lineitem").withColumn("pos", F.row_number().over(by))


def rel_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sections of a customer's paper: the return flag gives the level."""
    level = F.when(F.col("l_returnflag") == "N", 1).when(F.col("l_returnflag") == "R", 2).otherwise(3)
    rows = _items(spark, sf_dir).select(F.col("l_orderkey").alias("doc"), "pos", level.alias("level"))
    return relational.section_numbers(rows)


def rel_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _items(spark, sf_dir).select(
        F.col("l_orderkey").alias("doc"), "pos", F.concat("l_linestatus", F.when(F.col("l_returnflag") != "N", F.lit(":")).otherwise(F.lit("")), "l_returnflag").alias("label")
    )
    return relational.label_numbers(rows).withColumn("number", F.col("number").cast("bigint"))


def rel_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("L"), F.col("pos").cast("string"))).when(F.col("l_returnflag") == "A", F.lit("7"))
    items = _items(spark, sf_dir).select(F.col("l_orderkey").alias("doc"), "pos", F.col("l_suppkey").cast("string").alias("key"), label.alias("label"))
    names = relational.citation_names(items)
    uses = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.pmod("o_custkey", F.lit(100)).cast("string").alias("key"))
    return relational.resolved(uses, names, "doc", "key", "key", "shown").select("doc", "key", "shown")


def rel_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _items(spark, sf_dir).select(F.col("l_orderkey").alias("doc"), "pos", F.col("l_linestatus").alias("kind"))
    return relational.float_numbers(rows)


def str_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers put into a folder in two halves and ingested by two runs of the same stream."""
    folder, out, state = (scratch(spark, n) for n in ("in", "out", "state"))
    papers = papers_of_entries(spark, sf_dir)
    half = F.pmod(F.xxhash64("source_tar", "arxiv_id"), F.lit(2))
    for part in (0, 1):
        papers.where(half == part).coalesce(4).write.mode("append").parquet(folder)
        ingest(stream_papers(spark, folder), out, state).awaitTermination()
    return spark.read.parquet(out).groupBy("outer_tar", "status").agg(F.count("*").alias("n"))


def str_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by window; a batch frame takes the same plan."""
    return late_counts(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))).select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


QUERIES = {f.__name__: f for f in (
    out_extract, out_size_guard, out_outcomes, out_tar_metrics, inc_root_order, inc_main_file, inc_template, inc_closure, ent_main_file, ent_template, ent_root_order, ent_stages, ent_status, src_entry_kind, src_tar_scan, src_nested, src_files, src_encodings, src_defects, job_kill_resume, job_limits, job_texts, led_lines, led_pending,
    led_resume_counts, snk_shards, snk_octets, snk_jsonl, snk_parquet, num_rows, rel_sections, rel_labels, rel_citations, rel_floats, str_ingest, str_windows,
)}

TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
LED = f"SELECT {TRIM.format('stem')} AS stem, {TRIM.format('arxiv_id')} AS arxiv_id FROM ledger WHERE {TRIM.format('stem')} <> ''"
STATUS = """
SELECT arxiv_id, source_tar AS outer_tar, entry_name, CASE WHEN error IS NULL THEN file_type WHEN suffix(entry_name, '.pdf') THEN 'pdf' WHEN suffix(entry_name, '.tex') THEN 'tex' ELSE 'unknown' END AS file_type,
  CASE WHEN error IS NOT NULL THEN 'archive_error' WHEN len(list_filter(coalesce(tex_files, []), lambda f: trim(coalesce(f.content, ''), chr(10) || ' ') <> '')) > 0 THEN 'ok' ELSE 'empty' END AS status,
  CASE WHEN error IS NULL THEN CAST(coalesce(len(tex_files), 0) AS INTEGER) END AS num_tex_files, error AS error_message
FROM entries WHERE arxiv_id <> 'unknown'"""
ORACLES = {
    "ent_status": STATUS,
    "str_ingest": f"SELECT outer_tar, status, count(*) AS n FROM ({STATUS}) GROUP BY ALL",
    "ent_main_file": r"""
WITH f AS (SELECT entry_seq, unnest(tex_files) AS f, generate_subscripts(tex_files, 1) - 1 AS place FROM entries),
r AS (SELECT *, contains(f.content, '\documentclass') AS c, contains(f.content, '\begin{document}') AS b FROM f)
SELECT entry_seq, CAST(arg_min(place, CASE WHEN c AND b THEN 0 WHEN c THEN 1000 WHEN b THEN 2000 ELSE 3000 END + place) AS INTEGER) AS place FROM r GROUP BY entry_seq""",
    "ent_template": r"""
WITH f AS (SELECT entry_seq, unnest(tex_files) AS f, CAST(generate_subscripts(tex_files, 1) - 1 AS INTEGER) AS pos FROM entries),
n AS (SELECT *, lower(regexp_extract(f.name, '[^/]*$')) AS base, lower(f.content) AS low FROM f)
SELECT entry_seq, pos, regexp_matches(base, '(_conference|_submission|_style|_format)[.]tex$') OR regexp_matches(regexp_replace(base, '[.]tex$', ''), '^(sample|template|example|instructions)')
  OR contains(f.content, '\ProvidesPackage') OR contains(f.content, '\ProvidesClass')
  OR len(list_filter(['formatting instructions', 'style file', 'do not modify', 'camera ready', 'camera-ready', 'do not change', 'submission template'], lambda p: contains(low, p))) >= 2 AS template FROM n""",
    "inc_closure": r"""
WITH RECURSIVE f AS (SELECT entry_seq AS paper, unnest(tex_files) AS f FROM entries),
x AS (SELECT paper, f.name AS file, unnest(regexp_extract_all(f.content, '\\(?:input|include|subfile|@input)\s*\{([^{}]+)\}', 1)) AS p FROM f),
y AS (SELECT paper, file, regexp_replace(trim(p), '^\./', '') AS p FROM x),
e AS (SELECT DISTINCT paper, file, CASE WHEN suffix(p, '.tex') OR suffix(p, '.bbl') THEN p ELSE p || '.tex' END AS target FROM y),
reach AS (
  SELECT DISTINCT paper, f.name AS file, 0 AS depth FROM f WHERE contains(f.content, '\begin{document}')
  UNION SELECT r.paper, e.target, r.depth + 1 FROM reach r JOIN e ON e.paper = r.paper AND e.file = r.file WHERE r.depth < 20)
SELECT DISTINCT paper, file FROM reach WHERE depth > 0""",
    "rel_sections": """
WITH s AS (SELECT l_orderkey AS doc, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INTEGER) AS pos,
  CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS level FROM lineitem),
a AS (SELECT *, count(*) FILTER (WHERE level < 2) OVER w AS a2, count(*) FILTER (WHERE level < 3) OVER w AS a3 FROM s WINDOW w AS (PARTITION BY doc ORDER BY pos)),
n AS (SELECT *, count(*) FILTER (WHERE level = 1) OVER (PARTITION BY doc ORDER BY pos) AS n1, count(*) FILTER (WHERE level = 2) OVER (PARTITION BY doc, a2 ORDER BY pos) AS n2,
  count(*) FILTER (WHERE level = 3) OVER (PARTITION BY doc, a3 ORDER BY pos) AS n3 FROM a)
SELECT doc, pos, level, CASE WHEN n1 > 0 THEN concat_ws('.', n1, CASE WHEN level >= 2 THEN n2 END, CASE WHEN level >= 3 THEN n3 END)
  WHEN level >= 2 AND n2 > 0 THEN concat_ws('.', n2, CASE WHEN level >= 3 THEN n3 END) ELSE CAST(n3 AS VARCHAR) END AS number FROM n""",
    "inc_root_order": r"""
SELECT CAST(n_nationkey AS BIGINT) AS id, 'main.tex=\documentclass{a}\begin{document}' || n_nationkey || ' \input{sec/part} \input{none} BIB part of ' || n_name || '\end{document}|zz.tex=stray' AS txt FROM nation""",
    "inc_main_file": "SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(0 AS INTEGER) + 2 AS place FROM nation",
    "inc_template": "SELECT CAST(n_nationkey AS BIGINT) AS id, CAST(p AS INTEGER) AS pos, p = 0 AS template FROM nation, range(5) t(p)",
    "src_entry_kind": r"""
SELECT entry_seq,
  CASE WHEN coalesce(tex_files[1].content, '') = '' THEN 'unknown' WHEN starts_with(tex_files[1].content, '%PDF') THEN 'pdf' WHEN starts_with(tex_files[1].content, '%!PS') THEN 'postscript'
    WHEN starts_with(lower(tex_files[1].content), '<html') OR starts_with(lower(tex_files[1].content), '<!doctype') THEN 'html' ELSE 'tex' END AS sniffed,
  CASE WHEN suffix(entry_name, '.pdf') THEN 'pdf' WHEN suffix(entry_name, '.tex') THEN 'tex' ELSE 'unknown' END AS by_name,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(entry_name, '[^/]*$'), '(\.tar\.gz)+$', ''), '(\.tgz)+$', ''), '(\.gz)+$', ''), '(\.tex)+$', ''), '(\.pdf)+$', '') AS paper_id,
  regexp_replace(source_tar, '\.tar$', '') AS stem, replace(entry_name, '/', '_') AS safe
FROM entries""",
    "src_tar_scan": """
SELECT 'region_' || n_regionkey || '.tar' AS outer_tar, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS arxiv_id, 'ok' AS status, 'tex' AS file_type,
  '0101/' || lpad(CAST(n_nationkey AS VARCHAR), 5, '0') || '.gz' AS entry_name, n_name AS text, CAST(1 AS INTEGER) AS files FROM nation""",
    "src_nested": r"""
SELECT n_nationkey || CASE WHEN n_nationkey % 5 = 4 THEN '.txt' ELSE '' END AS arxiv_id, CASE WHEN n_nationkey % 5 < 2 THEN 'ok' ELSE 'empty' END AS status,
  CASE n_nationkey % 5 WHEN 2 THEN 'pdf' WHEN 3 THEN 'postscript' WHEN 4 THEN 'unknown' ELSE 'tex' END AS file_type,
  CASE n_nationkey % 5 WHEN 0 THEN 'Part of ' || n_name || ' BIB' || chr(10) || 'BIB' WHEN 1 THEN n_name END AS text, CAST(CASE n_nationkey % 5 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS num_tex_files,
  CASE n_nationkey % 5 WHEN 0 THEN 'main.tex,sec/a.tex,refs.bbl' WHEN 1 THEN n_nationkey || '.tex' ELSE '' END AS files FROM nation""",
    "src_files": r"""
SELECT CAST(n_nationkey AS VARCHAR) AS arxiv_id, CASE WHEN n_nationkey % 5 < 4 THEN 'ok' ELSE 'empty' END AS status, CASE WHEN n_nationkey % 5 < 4 THEN 'tex' ELSE 'unknown' END AS file_type,
  CASE WHEN n_nationkey % 5 < 4 THEN n_name END AS text, CAST(CASE WHEN n_nationkey % 5 < 4 THEN 1 ELSE 0 END AS INTEGER) AS num_tex_files, CAST(NULL AS VARCHAR) AS outer_tar FROM nation""",
    "src_encodings": "SELECT CAST(n_nationkey AS VARCHAR) AS arxiv_id, 'ok' AS status, n_name || ' café – “x”' AS text FROM nation",
    "src_defects": """
WITH r AS (SELECT 'region_' || n_regionkey || '.tar' AS outer_tar, count(*) AS n FROM nation GROUP BY ALL)
SELECT outer_tar, 'ok' AS status, 'tex' AS file_type, CAST(NULL AS VARCHAR) AS unwritten, n, CAST(NULL AS VARCHAR) AS message FROM r
UNION ALL SELECT outer_tar, 'archive_error', 'pdf', NULL, 1, 'entry 0101/huge.pdf has 200000000 bytes, exceeds 100MB limit' FROM r
UNION ALL SELECT outer_tar, 'archive_error', 'unknown', 'archive_error', 1, NULL FROM r""",
    "job_kill_resume": "SELECT 'region_' || n_regionkey || '.tar' AS outer_tar, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS arxiv_id, n_name AS text, 1 AS n, 1 AS placed FROM nation",
    "job_limits": """
SELECT kind, 'region_' || n_regionkey || '.tar' AS outer_tar, count(*) AS n_rows, true AS kept, true AS several FROM nation, (VALUES ('rows'), ('octets')) k(kind) GROUP BY ALL""",
    "job_texts": """
SELECT n_name AS value, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS name FROM nation
UNION ALL SELECT count(*) || ' of ' || count(*), 'region_' || n_regionkey || '.tar' FROM nation GROUP BY n_regionkey
UNION ALL SELECT count(*) || ' of ' || count(*), 'total' FROM nation""",
    "out_size_guard": """
SELECT source_tar, count(*) FILTER (WHERE list_sum(list_transform(tex_files, lambda f: strlen(f.content))) > 2000) AS too_large, count(*) AS n FROM entries WHERE arxiv_id <> 'unknown' GROUP BY source_tar""",
    "out_outcomes": """
WITH o AS (SELECT *, CASE WHEN status = 'error' THEN CASE WHEN error_message LIKE '%extraction thread crashed%' THEN 'crash' ELSE 'panic' END ELSE status END AS outcome FROM results),
r AS (SELECT outcome, arxiv_id, row_number() OVER (PARTITION BY outcome ORDER BY arxiv_id) AS rn FROM o)
SELECT outcome, (SELECT count(*) FROM o WHERE o.outcome = r.outcome) AS n, string_agg(arxiv_id, ',' ORDER BY rn) AS samples FROM r WHERE rn <= 5 GROUP BY outcome""",
    "out_tar_metrics": """
WITH o AS (SELECT outer_tar, CASE WHEN status = 'error' THEN CASE WHEN error_message LIKE '%extraction thread crashed%' THEN 'crash' ELSE 'panic' END ELSE status END AS outcome FROM results)
SELECT outer_tar, CAST(grouping(outer_tar) AS INTEGER) AS is_total, """
    + ", ".join(f"count(*) FILTER (WHERE outcome = '{o}') AS {o}" for o in ("ok", "empty", "timeout", "skipped", "panic", "crash", "archive_error", "io_error", "skipped_resume"))
    + ", count(*) AS total FROM o GROUP BY ROLLUP (outer_tar)",
    "led_lines": f"SELECT stem, nullif(arxiv_id, '') AS arxiv_id, count(*) AS n FROM ({LED}) GROUP BY ALL".replace("nullif(arxiv_id, '')", "arxiv_id"),
    "led_pending": f"""
WITH led AS ({LED}), p AS (SELECT DISTINCT source_tar, arxiv_id FROM entries WHERE arxiv_id <> 'unknown')
SELECT source_tar, arxiv_id FROM p WHERE NOT EXISTS (SELECT 1 FROM led WHERE led.arxiv_id IS NULL AND led.stem = p.source_tar)
  AND NOT EXISTS (SELECT 1 FROM led WHERE led.arxiv_id = p.arxiv_id AND led.stem || '.tar' = p.source_tar)""",
    "led_resume_counts": f"""
WITH led AS (SELECT DISTINCT * FROM ({LED})), p AS (SELECT DISTINCT source_tar, arxiv_id FROM entries WHERE arxiv_id <> 'unknown')
SELECT source_tar, count(led.stem) AS skipped, count(*) AS n FROM p LEFT JOIN led ON led.arxiv_id = p.arxiv_id AND led.stem || '.tar' = p.source_tar GROUP BY source_tar""",
    "snk_shards": """
WITH r AS (SELECT result_id, coalesce(regexp_replace(outer_tar, '[.]tar$', ''), 'results') AS stem FROM results),
n AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY stem ORDER BY result_id) - 1) / 20) AS INTEGER) AS k FROM r)
SELECT result_id, CASE WHEN k = 0 THEN stem ELSE stem || '_' || lpad(CAST(k AS VARCHAR), 3, '0') END AS shard_id FROM n""",
    "snk_octets": """
WITH r AS (SELECT *, coalesce(outer_tar, 'results') AS s, strlen(arxiv_id) + coalesce(strlen(text), 0) + coalesce(strlen(error_message), 0) + coalesce(strlen(stage_timings_us), 0) + 200 AS b FROM results),
n AS (SELECT *, floor((row_number() OVER (PARTITION BY s ORDER BY result_id) - 1) / 100) AS k FROM r),
c AS (SELECT *, floor((sum(b) OVER (PARTITION BY s, k ORDER BY result_id) - b) / 20000) AS chunk FROM n)
SELECT outer_tar, CAST(max(chunk) AS INTEGER) AS chunks, CAST(sum(b) AS BIGINT) AS octets FROM c GROUP BY outer_tar""",
    "snk_jsonl": "SELECT result_id, arxiv_id, status, error_message AS error, outer_tar AS source_tar, text FROM results",
    "snk_parquet": "SELECT result_id, outer_tar, status, text FROM results",
    "num_rows": "SELECT l_orderkey, l_linenumber, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS row_no FROM lineitem",
    "rel_labels": """
WITH l AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS pos, l_linestatus || CASE WHEN l_returnflag <> 'N' THEN ':' ELSE '' END || l_returnflag AS label FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY doc, CASE WHEN label LIKE '%:%' THEN split_part(label, ':', 1) END ORDER BY pos) AS k FROM l)
SELECT doc, label, arg_min(k, pos) AS number FROM n GROUP BY doc, label""",
    "rel_citations": """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS pos FROM lineitem),
i AS (SELECT l_orderkey AS doc, pos, CAST(l_suppkey AS VARCHAR) AS key, CASE l_returnflag WHEN 'R' THEN 'L' || pos WHEN 'A' THEN '7' END AS label FROM b),
n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY pos) AS k, max(CAST(label LIKE 'L%' AS INTEGER)) OVER (PARTITION BY doc) AS texty FROM i),
m AS (SELECT doc, key, arg_min(CASE WHEN texty = 1 THEN coalesce(label, CAST(k AS VARCHAR)) ELSE CAST(k AS VARCHAR) END, pos) AS shown FROM n GROUP BY doc, key),
u AS (SELECT o_orderkey AS doc, CAST(o_custkey % 100 AS VARCHAR) AS key FROM orders)
SELECT u.doc, u.key, coalesce(m.shown, u.key) AS shown FROM u LEFT JOIN m ON m.doc = u.doc AND m.key = u.key""",
    "rel_floats": "WITH b AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS INTEGER) AS pos FROM lineitem) SELECT l_orderkey AS doc, pos, l_linestatus AS kind, CAST(row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY pos) AS INTEGER) AS number FROM b",
    "str_windows": "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
