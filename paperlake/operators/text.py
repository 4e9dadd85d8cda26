"""TeX operators on string columns, Arrow-batched, and the extraction of whole papers."""

from __future__ import annotations

import gc
import json
import os
import pickle
import resource
import signal
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.functions import blocks, cite, columns, expand, front, glyphs, layout, style, tidy
from paperlake.functions.extract import extract
from paperlake.functions.includes import TexFile

#: Operators by name, each str -> str.
OPERATORS: dict[str, Callable[[str], str]] = {
    "comments": expand.remove_comments,
    "shorthands": expand.normalize_shorthands,
    "macros": lambda s: expand.expand_parametric(expand.expand_macros(s, expand.collect_macros(s)), expand.collect_parametric(s)),
    "structure": lambda s: layout.convert_structure(s, {}),
    "references": lambda s: cite.convert_references(s, {}),
    "formatting": style.convert_formatting,
    "environments": lambda s: blocks.convert_environments(s, expand.collect_theorems(s)),
    "pre_diacritic": tidy.strip_layout,
    "diacritics": glyphs.convert_diacritics,
    "symbols": glyphs.convert_symbols,
    "cleanup": tidy.cleanup,
    "body": lambda s: front.split_document(s)[1],
    "preamble": lambda s: "\n".join(front.split_document(s)[0]),
    "extras": lambda s: "\n".join(front.notes(s)),
}


def apply(fn: Callable[[str], str], column: Column) -> Column:
    """``fn`` on every value of a string column; null stays null."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(fn, na_action="ignore")

    return run(column)


def operator(name: str, column: Column) -> Column:
    return apply(OPERATORS[name], column)


def operator_octets(files: DataFrame, content: str) -> DataFrame:
    """``files`` with a column per operator in place of ``content``: the octets that it makes of the content; null stays
    null. All operators run in one Arrow pass, a file at a time, and only numbers come back."""
    kept = [n for n in files.columns if n != content]
    schema = T.StructType([files.schema[n] for n in kept] + [T.StructField(n, T.IntegerType()) for n in OPERATORS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[int | None]] = {n: [] for n in OPERATORS}
            for value in batch.column(content):
                given = value.as_py()
                for n, fn in OPERATORS.items():
                    found[n].append(None if given is None else len(fn(given).encode()))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [pa.array(v, pa.int32()) for v in found.values()], names=schema.names)

    return files.select(*kept, content).mapInArrow(run, schema)


def latex_to_text(column: Column) -> Column:
    """A single source text as a one-file paper."""
    return apply(lambda s: extract([TexFile("main.tex", s)]).text, column)


#: Defaults of a run.
TIMEOUT_S, MOST_OCTETS, ROWS_PER_BATCH = 45.0, 20_000_000, 64
CRASH = "extraction thread crashed"


def extract_papers(papers: DataFrame, timeout_s: float = TIMEOUT_S, most_octets: int = MOST_OCTETS, shard_id: str = "", keep_unwritten: bool = False) -> DataFrame:
    """Papers (see schema.PAPER) to result rows, in one pass over their source.

    Failed archives with a known id give ``archive_error`` rows, papers above ``most_octets`` of source ``skipped`` ones –
    both are settled by native expressions, and their sources never reach Python. The rest is extracted row by row under
    a deadline: no text is ``empty``, a passed deadline ``timeout``, an exception ``error`` with its message. Null
    contents count as empty, null file lists as no files.

    Papers that an earlier run has done (column ``done``, if there is one) and defects without id give no row; with
    ``keep_unwritten`` they stay, named by the further column ``unwritten`` (``skipped_resume``, ``archive_error``).
    """
    done = F.col("done") if "done" in papers.columns else F.lit(False)
    lost = F.col("arxiv_id").isNull() | (F.col("arxiv_id") == "unknown")
    unwritten = F.when(done, "skipped_resume").when(lost, "archive_error")
    files = F.coalesce("tex_files", F.array().cast("array<struct<name:string,content:string>>"))
    octets, failed = columns.source_octets(files), F.col("error").isNotNull()
    large = ~failed & (octets > most_octets)
    source = papers if keep_unwritten else papers.where(unwritten.isNull())
    settled = source.select(
        "arxiv_id", F.col("source_tar").alias("outer_tar"), "entry_name",
        F.when(failed, columns.type_by_name(F.col("entry_name"))).otherwise(F.col("file_type")).alias("file_type"),
        F.when(failed, "archive_error").when(large, "skipped").alias("status"),
        F.when(failed, F.col("error")).when(large, F.format_string(f"tex content %d bytes exceeds limit {most_octets}", octets)).alias("error_message"),
        F.when(large, F.size(files)).cast("int").alias("num_tex_files"),
        unwritten.alias("unwritten"),
        F.when(~failed & ~large & unwritten.isNull(), files).alias("tex_files"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again = (TaskContext.get() or _First()).attemptNumber() > 0
        extracted = _isolated if again else _extract_row
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                out = {k: part.column(k).to_pylist() for k in ("arxiv_id", "outer_tar", "entry_name", "file_type", "unwritten")}
                given = zip(*(part.column(k).to_pylist() for k in ("status", "error_message", "num_tex_files", "tex_files")), strict=True)
                rows = [(status, message, n, None, None, None, None) if files is None else extracted(files, timeout_s) for status, message, n, files in given]
                for i, k in enumerate(("status", "error_message", "num_tex_files", "text", "stage_timings_us", "total_time_us", "peak_memory_bytes")):
                    out[k] = [r[i] for r in rows]
                yield pa.RecordBatch.from_pydict(out, schema=_ARROW)

    rows = settled.mapInArrow(
        run, "arxiv_id string, outer_tar string, entry_name string, file_type string, unwritten string, status string, error_message string, num_tex_files int, text string, "
        "stage_timings_us string, total_time_us bigint, peak_memory_bytes bigint"
    )
    return rows.select(
        "arxiv_id", "status", "error_message", "num_tex_files", F.octet_length("text").cast("int").alias("text_length"), "text", "stage_timings_us", "total_time_us",
        "peak_memory_bytes", "outer_tar", "file_type", "entry_name", F.lit(shard_id).alias("shard_id"), *(["unwritten"] if keep_unwritten else []),
    )


_ARROW = pa.schema(
    [(n, pa.string()) for n in ("arxiv_id", "outer_tar", "entry_name", "file_type", "unwritten", "status", "error_message")]
    + [("num_tex_files", pa.int32()), ("text", pa.string()), ("stage_timings_us", pa.string()), ("total_time_us", pa.int64()), ("peak_memory_bytes", pa.int64())]
)


class _First:
    """Stands in for the task context outside a task."""

    @staticmethod
    def attemptNumber() -> int:  # noqa: N802 - Spark's name
        return 0


@contextmanager
def _alarm(seconds: float) -> Iterator[None]:
    """Raises TimeoutError in the code below once ``seconds`` have passed, even inside a regular expression; where no
    signals can be had (another thread), only the deadline between stages holds."""
    if threading.current_thread() is not threading.main_thread() or not hasattr(signal, "setitimer") or not 0 < seconds < 1e8:
        yield
        return

    def late(*_: object) -> None:
        raise TimeoutError(f"timed out after {seconds:g}s")

    before = signal.signal(signal.SIGALRM, late)
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def resident_octets() -> int | None:
    """Memory of this worker that is resident now; None where the system does not tell."""
    try:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * resource.getpagesize()
    except (OSError, ValueError, IndexError):
        return None


def _extract_row(files: list[dict], timeout_s: float) -> tuple:
    """(status, message, files, text, timings, microseconds, resident octets) of one paper."""
    given = [TexFile(f["name"] or "", f["content"] or "") for f in files if f is not None]
    try:
        with _alarm(timeout_s):
            found = extract(given, timeout_s)
    except TimeoutError as late:
        return "timeout", str(late), len(given), None, None, None, resident_octets()
    except MemoryError:
        gc.collect()
        return "error", CRASH, len(given), None, None, None, resident_octets()
    except Exception as failure:  # noqa: BLE001 - one paper must not take its partition with it
        return "error", str(failure) or type(failure).__name__, len(given), None, None, None, resident_octets()
    spent = sum(json.loads(found.timings).values())
    return ("ok" if found.text is not None else "empty"), None, len(given), found.text, found.timings, spent, resident_octets()


def _isolated(files: list[dict], timeout_s: float) -> tuple:
    """The same in a process of its own. Used when a task is repeated: if a paper kills its process, only its own row is
    an error, and the task ends."""
    read, write = os.pipe()
    child = os.fork()
    if child == 0:
        try:
            with os.fdopen(write, "wb") as out:
                pickle.dump(_extract_row(files, timeout_s), out)
        finally:
            os._exit(0)
    os.close(write)
    with os.fdopen(read, "rb") as answer:
        raw = answer.read()
    os.waitpid(child, 0)
    try:
        return pickle.loads(raw)
    except (EOFError, pickle.UnpicklingError):
        return "error", CRASH, sum(f is not None for f in files), None, None, None, None
