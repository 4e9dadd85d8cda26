"""Rules that are regular, as native column expressions: no Python in their plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlake.functions.expand import SHORTHAND_TABLE
from paperlake.functions.includes import TEMPLATE_ENDS, TEMPLATE_PHRASES, TEMPLATE_STARTS
from paperlake.functions.style import SIZES
from paperlake.functions.tidy import KEPT


#: Parts of patterns: an option that may be there, a group without groups in it.
OPTION, FLAT = r"(?:\[[^\]]*\])?", r"\{[^{}]*\}"


def sub(c: Column, pattern: str, to: str = "") -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def remove_comments(c: Column) -> Column:
    return sub(c, r"(?<!\\)((?:\\\\)*)%[^\n]*\n?", "$1")


def normalize_shorthands(c: Column) -> Column:
    return reduce(lambda x, kv: sub(x, rf"\\{kv[0]}(?![A-Za-z])", kv[1].replace("\\", "\\\\")), SHORTHAND_TABLE.items(), c)


def drop_sizes(c: Column) -> Column:
    return sub(c, r"\\(?:" + "|".join(SIZES) + ")(?![A-Za-z])")


def drop_labels(c: Column) -> Column:
    return sub(c, rf"\\label{FLAT}")


def drop_graphics(c: Column) -> Column:
    return sub(c, rf"\\includegraphics\s*{OPTION}\s*{FLAT}")


def drop_orphans(c: Column) -> Column:
    return sub(c, r"\\(?!(?:" + "|".join(sorted(KEPT)) + r")(?![A-Za-z]))[A-Za-z]++\*?+(?![{A-Za-z])", " ")


def drop_stray_backslashes(c: Column) -> Column:
    return sub(c, r"\\(?![A-Za-z\\$])")


def row_ends(c: Column) -> Column:
    return sub(c, rf"\\\\{OPTION}", "\n")


def collapse_whitespace(c: Column) -> Column:
    c = sub(sub(c, r"(?U)[^\S\n]+", " "), "\n{3,}", "\n\n")
    return sub(sub(c, r"(?m)^[ \t]+|[ \t]+$"), r"\A\n+|\n+\z")


def reflow(c: Column) -> Column:
    """Join the lines of a paragraph: a line break goes unless its line or the next one is empty or marked."""
    plain = r"(?<=[^\n])(?<!\$\$)\n(?=[^\n])(?!#|- |\$\$|\*\*)"
    # a break behind a marked line has to stay, so such lines are shielded by a sign that no text holds
    shielded = sub(c, r"(?m)^((?:#|- |\$\$)[^\n]*)\n(?=[^\n])", "$1\n\u0001")
    return F.translate(sub(shielded, plain + r"(?!\x01)", " "), "\u0001", "")


def file_type(content: Column) -> Column:
    """Kind of a decoded entry by its first characters."""
    head = F.lower(F.substring(content, 1, 9))
    return (
        F.when(content.isNull() | (content == ""), "unknown")
        .when(content.startswith("%PDF"), "pdf")
        .when(content.startswith("%!PS"), "postscript")
        .when(head.startswith("<html") | head.startswith("<!doctype"), "html")
        .otherwise("tex")
    )


def type_by_name(name: Column) -> Column:
    return F.when(name.endswith(".pdf"), "pdf").when(name.endswith(".tex"), "tex").otherwise("unknown")


def paper_id(path: Column) -> Column:
    """The last part of a path without its suffixes."""
    c = F.regexp_extract(path, "[^/]*$", 0)
    for suffix in ("tar\\.gz", "tgz", "gz", "tex", "pdf"):
        c = sub(c, rf"(?:\.{suffix})+$")
    return c


def output_stem(path: Column) -> Column:
    return sub(sub(F.regexp_extract(path, "[^/]*$", 0), r"(?<=.)\.[^.]*$"), r"\.tar$")


def safe_id(c: Column) -> Column:
    return F.translate(c, "/", "_")


def include_path(c: Column) -> Column:
    c = sub(F.trim(c), r"^\./")
    return F.when(c.endswith(".tex") | c.endswith(".bbl"), c).otherwise(F.concat(c, F.lit(".tex")))


def main_file(files: Column) -> Column:
    """0-based place of the main file of an array of (name, content)."""
    ranked = F.transform(
        files,
        lambda f, i: F.struct(
            F.when(f.content.contains("\\documentclass") & f.content.contains("\\begin{document}"), 0)
            .when(f.content.contains("\\documentclass"), 1)
            .when(f.content.contains("\\begin{document}"), 2)
            .otherwise(3)
            .alias("rank"),
            i.alias("place"),
        ),
    )
    return F.array_min(ranked).place


def is_template(name: Column, content: Column) -> Column:
    base = F.lower(F.regexp_extract(name, "[^/]*$", 0))
    stem, text = sub(base, r"\.tex$"), F.lower(content)
    any_of = lambda tests: reduce(lambda a, b: a | b, tests)
    phrases = reduce(lambda a, b: a + b, [text.contains(p).cast("int") for p in TEMPLATE_PHRASES])
    return (
        any_of([base.endswith(e) for e in TEMPLATE_ENDS])
        | any_of([stem.startswith(s) for s in TEMPLATE_STARTS])
        | content.contains("\\ProvidesPackage")
        | content.contains("\\ProvidesClass")
        | (phrases >= 2)
    )


def source_octets(files: Column) -> Column:
    return F.aggregate(files, F.lit(0).cast("bigint"), lambda total, f: total + F.coalesce(F.octet_length(f.content), F.lit(0)))
