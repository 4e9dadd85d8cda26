"""Numbering and reference resolution over a whole corpus, in relational form: windows and joins instead of a walk
through each text. Tables are one row per occurrence, ordered by position within a document."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def occurrences(documents: DataFrame, key: str, text: str, pattern: str, group: int = 1) -> DataFrame:
    """(key, pos, value) of all matches of a regular pattern, in order."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    return documents.select(key, F.posexplode(found).alias("pos", "value"))


def section_numbers(sections: DataFrame, doc: str = "doc", pos: str = "pos", level: str = "level") -> DataFrame:
    """Adds ``number`` ("2.1"): each level counts within the nearest section above it; the number begins at the highest
    level that has occurred under the current one."""
    order = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    # sections of each level so far, and how many of them stood before the last section of a higher level; both windows
    # have the same order, so rows are sorted once
    table = sections.withColumns({f"_c{d}": F.count_if(F.col(level) == d).over(order) for d in range(4)})
    table = table.withColumns({f"_n{d}": F.col(f"_c{d}") - F.coalesce(F.max(F.when(F.col(level) < d, F.col(f"_c{d}"))).over(order), F.lit(0)) for d in range(4)})
    parts = [F.struct((F.col(f"_n{d}") > 0).alias("used"), F.lit(d).alias("d"), F.col(f"_n{d}").alias("n")) for d in range(4)]
    upto = F.filter(F.array(*parts), lambda x: x.d <= F.col(level))
    first = F.array_min(F.transform(F.filter(upto, lambda x: x.used), lambda x: x.d))
    shown = F.transform(F.filter(upto, lambda x: x.d >= first), lambda x: x.n.cast("string"))
    return table.withColumn("number", F.array_join(shown, ".")).drop(*[f"_{k}{d}" for k in "cn" for d in range(4)])


def label_numbers(labels: DataFrame, doc: str = "doc", pos: str = "pos", label: str = "label") -> DataFrame:
    """(doc, label, number): numbers count per prefix before a colon; the first place of a label holds, later ones count
    on."""
    prefix = F.when(F.col(label).contains(":"), F.substring_index(label, ":", 1))
    n = F.row_number().over(Window.partitionBy(doc, prefix).orderBy(pos))
    counted = labels.withColumn("_n", n)
    return counted.groupBy(doc, label).agg(F.min_by("_n", pos).alias("number"))


def citation_names(items: DataFrame, doc: str = "doc", pos: str = "pos", key: str = "key", label: str = "label") -> DataFrame:
    """(doc, key, shown): labels if any label of the document is more than a number, else positions."""
    trimmed = F.trim(label)
    texty = F.col(label).isNotNull() & (trimmed != "") & ~trimmed.rlike("^[0-9]+$")
    table = items.withColumn("_n", F.row_number().over(Window.partitionBy(doc).orderBy(pos))).withColumn("_by_label", F.max(texty).over(Window.partitionBy(doc)))
    shown = F.when(F.col("_by_label"), F.coalesce(F.col(label), F.col("_n").cast("string"))).otherwise(F.col("_n").cast("string"))
    return table.groupBy(doc, key).agg(F.min_by(shown, F.col(pos)).alias("shown"))


def resolved(uses: DataFrame, names: DataFrame, doc: str, use_key: str, name_key: str, shown: str) -> DataFrame:
    """Every use of a key with what it shows; an unknown key shows itself."""
    right = names.select(F.col(doc).alias("_doc"), F.col(name_key).alias("_key"), F.col(shown).cast("string").alias("_shown"))
    joined = uses.join(right, (F.col(doc) == F.col("_doc")) & (F.col(use_key) == F.col("_key")), "left")
    return joined.withColumn("shown", F.coalesce("_shown", F.col(use_key))).drop("_doc", "_key", "_shown")


def float_numbers(captions: DataFrame, doc: str = "doc", pos: str = "pos", kind: str = "kind") -> DataFrame:
    return captions.withColumn("number", F.row_number().over(Window.partitionBy(doc, kind).orderBy(pos)))


def _reached(edges: list[dict], roots: list[str], depth: int) -> list[str]:
    """Files at most ``depth`` steps from a root, a layer at a time; every file is followed once."""
    targets: dict[str, list[str]] = {}
    for e in edges:
        targets.setdefault(e["file"], []).append(e["target"])
    found: set[str] = set()
    layer = set(roots)
    for _ in range(depth):
        layer = {t for f in layer for t in targets.get(f, ())} - found
        if not layer:
            break
        found |= layer
    return sorted(found)


def include_closure(edges: DataFrame, roots: DataFrame, depth: int = 20) -> DataFrame:
    """(paper, file): files reachable from each paper's roots over (paper, file, target) edges.

    One shuffle by paper, then each paper is walked by itself: a recursive query keeps a row for every way to a file, so
    its rows (1 000 000 at most in Spark) grow with repeated and circular includes. A task holds the distinct edges of one
    paper, no more than its files have commands. Null papers and files match nothing, as in a join."""
    edge = "struct<file:string,target:string>"
    steps = edges.select("paper", F.struct("file", "target").cast(edge).alias("edge"), F.lit(None).cast("string").alias("root")).where("edge.file is not null")
    starts = roots.select("paper", F.lit(None).cast(edge).alias("edge"), F.col("file").alias("root")).where("root is not null")
    papers = steps.unionByName(starts).where("paper is not null").groupBy("paper").agg(F.collect_set("edge").alias("edges"), F.collect_set("root").alias("roots"))
    walk = F.udf(lambda e, r: _reached(e, r, depth), "array<string>", useArrow=True)
    return papers.where((F.size("edges") > 0) & (F.size("roots") > 0)).select("paper", F.explode(walk("edges", "roots")).alias("file"))


def include_edges(files: DataFrame) -> DataFrame:
    """(paper, file, target) of plain inputs and includes, paths made normal."""
    from paperlake.functions.columns import include_path
    from paperlake.functions.includes import INPUTS

    found = occurrences(files.withColumn("_k", F.struct("paper", "file")), "_k", "content", r"\\(?:" + "|".join(INPUTS) + r")\s*\{([^{}]+)\}")
    return found.select("_k.paper", "_k.file", include_path(F.col("value")).alias("target"))
