"""From a paper's source files to its text."""

from __future__ import annotations

import json
import time
from typing import NamedTuple

from paperlake.functions import blocks, cite, expand, front, glyphs, includes, layout, style, tidy
from paperlake.functions.includes import TexFile


class Extraction(NamedTuple):
    text: str | None
    timings: str


def clean_file(content: str, macros: dict, parametric: list, theorems: dict, labels: dict, spent: dict[str, int], deadline: expand.Deadline) -> str | None:
    """One root file through all stages; ``labels`` lives on between the files of a paper."""
    kept, body = front.split_document(content)
    s = "\n".join([*kept, body]) if kept else body
    stages = [
        ("remove_comments", expand.remove_comments),
        ("normalize_shorthands", expand.normalize_shorthands),
        ("expand_macros", lambda t: expand.expand_macros(t, macros, deadline)),
        ("expand_parametric", lambda t: expand.expand_parametric(t, parametric, deadline)),
        ("convert_structure", lambda t: layout.convert_structure(t, labels)),
        ("convert_references", lambda t: cite.convert_references(t, labels)),
        ("convert_formatting", style.convert_formatting),
        ("convert_environments", lambda t: blocks.convert_environments(t, theorems)),
        ("strip_pre_diacritic", tidy.strip_layout),
        ("convert_diacritics", glyphs.convert_diacritics),
        ("convert_symbols", glyphs.convert_symbols),
        ("cleanup", tidy.cleanup),
    ]
    for name, stage in stages:
        if deadline.passed:
            return None
        began = time.perf_counter_ns()
        s = stage(s)
        spent[name] = spent.get(name, 0) + (time.perf_counter_ns() - began) // 1000
    return s if s.strip() else None


def extract(files: list[TexFile], timeout: float | None = None) -> Extraction:
    """Text of a paper, None if it has none, and microseconds by stage as JSON (summed over files)."""
    deadline = expand.Deadline(None if timeout is None else time.monotonic() + timeout)
    macros: dict[str, str] = {}
    parametric: list[expand.Macro] = []
    theorems: dict[str, str] = {}
    for f in files:
        macros |= expand.collect_macros(f.content)
        parametric += expand.collect_parametric(f.content)
        theorems |= expand.collect_theorems(f.content)
    spent: dict[str, int] = {}
    labels: dict[str, str] = {}
    parts = [clean_file(f.content, macros, parametric, theorems, labels, spent, deadline) for f in includes.ordered_roots(files)]
    if deadline.passed:
        raise TimeoutError(f"timed out after {timeout:g}s")
    text = "\n".join(p for p in parts if p)
    return Extraction(text if text.strip() else None, json.dumps(spent, separators=(",", ":")))


def extract_text(files: list[TexFile]) -> str | None:
    return extract(files).text
