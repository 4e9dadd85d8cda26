"""Mixing sources to target weights.

Weights are a tempered distribution: source shares raised to an exponent and normalised. The exponent is bisected to
meet a target entropy or the limit of repetitions. Where every source has a target share of its own, no exponent of the
natural shares can meet all of them; the targets are then the weights (exponent one on the targets) and the limit of
repetitions is met by bisecting a common scale: a source that would exceed its limit gives all it may, and what it
leaves is shared by the others in proportion to their weights. The weights become token budgets, and a budget becomes
whole passes over the source plus one partial pass: the opening of a seeded permutation of its documents. Every pass is a
block with a permutation of its own.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperlake.session import materialize

#: A public byte-level BPE vocabulary (ranks file) and its splitting pattern.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents per bucket of the permutation, on average, as long as there are no more buckets than MOST_BUCKETS: so many
#: are summed up in one place per source, and one per source is sorted.
BUCKET_ROWS, MOST_BUCKETS = 2_000, 1 << 16
#: The table of targets is read to the driver; it lists sources, not documents.
MAX_SOURCES = 10_000


def normalized_source(source: Column) -> Column:
    """Case, spaces around, and the kind of separator do not count; blank is null."""
    s = F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_")
    return F.when(s != "", s)


def token_counts(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """doc_id, source (normalised), n_tokens of the whole text; null and empty texts have 0."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(path) as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(str.split, lines)}
        encoding = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for texts in batches:
            yield pd.Series([len(t) for t in encoding.encode_ordinary_batch(texts.fillna("").tolist(), num_threads=1)])

    return documents.select("doc_id", normalized_source(F.col("source")).alias("source"), count("text").alias("n_tokens"))


def bisect(f: Callable[[float], float], low: float, high: float, steps: int = 200) -> float:
    """The point where increasing ``f`` crosses zero."""
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if f(middle) < 0 else (low, middle)
    return (low + high) / 2


def tempered(shares: dict[str, float], exponent: float) -> dict[str, float]:
    """Shares raised to ``exponent`` and normalised; sources without tokens stay at 0."""
    raised = {s: p**exponent if p > 0 else 0.0 for s, p in shares.items()}
    total = sum(raised.values())
    return {s: x / total if total else 0.0 for s, x in raised.items()}


def entropy(shares: dict[str, float]) -> float:
    return -sum(p * math.log(p) for p in shares.values() if p > 0)


def exponent_for_entropy(shares: dict[str, float], target: float) -> float:
    """The exponent in [0, 16] whose tempered distribution has the target entropy (entropy falls with the exponent)."""
    return bisect(lambda a: target - entropy(tempered(shares, a)), 0.0, 16.0)


def exponent_for_repeats(tokens: dict[str, int], limits: dict[str, float], total: float) -> float:
    """The smallest exponent in [0, 1] at which no source is repeated more than its limit for ``total`` tokens."""
    natural = {s: t / max(1, sum(tokens.values())) for s, t in tokens.items()}

    def fits(a: float) -> float:
        w = tempered(natural, a)
        return min((limits[s] - w[s] * total / t for s, t in tokens.items() if t), default=0.0)

    return 0.0 if fits(0.0) >= 0 else bisect(fits, 0.0, 1.0)


@dataclass
class Budget:
    source: str
    weight: float
    limit: int
    available: int
    tokens: int

    @property
    def passes(self) -> int:
        """Whole passes over the source."""
        return self.tokens // self.available if self.available else 0

    @property
    def rest(self) -> int:
        return self.tokens - self.passes * self.available


def budgets(weights: dict[str, float], limits: dict[str, int], available: dict[str, int], total: int | None = None) -> list[Budget]:
    """Token budgets: weight times a common scale, at most limit times what is there. ``total`` defaults to the tokens
    of the listed sources; if even all limits together give less, the mix is that much smaller."""
    most = {s: available.get(s, 0) * limits[s] for s in weights}
    total = min(sum(available.get(s, 0) for s in weights) if total is None else total, sum(most.values()))
    given = lambda scale: {s: min(w * scale, most[s]) for s, w in weights.items()}
    scale = bisect(lambda x: sum(given(x).values()) - total, 0.0, max([most[s] / w for s, w in weights.items() if w > 0 and most[s]], default=0.0))
    return [Budget(s, weights[s], limits[s], available.get(s, 0), min(most[s], math.floor(x + 0.5))) for s, x in given(scale).items()]


def read_targets(mix_targets: DataFrame) -> list[tuple[str, float, int]]:
    """(source, share, limit) of the target table, whose size is checked. Rows without a source, a positive share or a
    positive limit ask for nothing; of repeated sources shares add up and the largest limit holds."""
    rows = mix_targets.select(normalized_source(F.col("source")).alias("s"), "target_share", "max_repeats").groupBy("s").agg(
        F.sum("target_share").alias("w"), F.max("max_repeats").alias("r")
    ).where("s is not null and w > 0 and r > 0").orderBy("s").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} target sources")
    total = sum(r["w"] for r in rows)
    return [(r["s"], r["w"] / total, r["r"]) for r in rows]


def plan(sizes: DataFrame, targets: list[tuple[str, float, int]], total: int | None = None, temperature: str | None = None) -> list[Budget]:
    """Budgets for the targets; ``temperature`` "entropy" or "repeats" weighs by tempered natural shares instead."""
    names = [s for s, _, _ in targets]
    found = sizes.where(F.col("source").isin(names)).groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()
    available = {r["source"]: int(r["t"]) for r in found}
    limits = {s: r for s, _, r in targets}
    weights = {s: w for s, w, _ in targets}
    if temperature:
        have = {s: available.get(s, 0) for s in names}
        everything = sum(have.values())
        natural = {s: t / max(1, everything) for s, t in have.items()}
        if temperature == "entropy":
            exponent = exponent_for_entropy(natural, entropy({s: w for s, w in weights.items() if have[s]}))
        else:
            exponent = exponent_for_repeats(have, limits, everything if total is None else total)
        weights = tempered(natural, exponent)
    return budgets(weights, limits, available, total)


def mix(sizes: DataFrame, chosen: list[Budget], seed: int = 7) -> DataFrame:
    """One row per use of a document: doc_id, source, n_tokens, block (pass number), place (order within the block).

    The partial pass takes documents in the order of a seeded hash while their running token sum stays within the rest
    of the budget. The sum is taken over hash buckets first, so only the one bucket per source in which the budget ends
    is ever sorted; a source of any size is spread over all tasks.
    """
    spark = sizes.sparkSession
    total_rows = sizes.count()
    buckets = min(MOST_BUCKETS, 1 << max(4, math.ceil(math.log2(max(1, total_rows) / BUCKET_ROWS + 1))))
    rows = [(b.source, b.passes, b.rest) for b in chosen if b.tokens]
    table = F.broadcast(spark.createDataFrame(rows, "source string, passes int, rest bigint"))  # at most MAX_SOURCES rows
    key = F.xxhash64(F.lit(seed), F.col("doc_id"))
    used = sizes.where("n_tokens > 0").join(table, "source").withColumn("key", key).withColumn("bucket", F.pmod("key", F.lit(buckets)))
    sums = used.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"), F.max("rest").alias("rest"))
    upto = F.sum("t").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ends = sums.withColumn("upto", upto).select("source", "bucket", (F.col("rest") - F.col("upto") + F.col("t")).alias("left"), (F.col("upto") <= F.col("rest")).alias("whole"))
    placed = used.join(ends, ["source", "bucket"])
    running = F.sum("n_tokens").over(Window.partitionBy("source", "bucket").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    columns = ["doc_id", "source", "n_tokens", "passes"]
    splits = ~F.col("whole") & (F.col("left") > 0)
    settled = placed.where(~splits).select(*columns, F.col("whole").alias("extra"))
    edge = placed.where(splits).withColumn("running", running).select(*columns, (F.col("running") <= F.col("left")).alias("extra"))
    copies = F.col("passes") + F.col("extra").cast("int")
    uses = settled.unionByName(edge).where(copies > 0).withColumn("block", F.explode(F.sequence(F.lit(1), copies)))
    return uses.select("doc_id", "source", "n_tokens", "block", F.xxhash64(F.lit(seed), F.col("block"), F.col("doc_id")).alias("place"))


def shares(spark, mixed: DataFrame, chosen: list[Budget]) -> DataFrame:
    """Per source: target share, limit, tokens there and used, most uses of one document, share really reached."""
    target = F.broadcast(spark.createDataFrame([(b.source, b.weight, b.limit, b.available, b.tokens) for b in chosen], "source string, target_share double, max_repeats int, available_tokens bigint, budget_tokens bigint"))
    per_doc = mixed.groupBy("source", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("uses"))
    real = per_doc.groupBy("source").agg(F.sum("t").alias("mix_tokens"), F.max("uses").alias("most_uses"), F.count("*").alias("n_documents"))
    whole = real.agg(F.sum("mix_tokens").alias("all_tokens"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return target.join(real, "source", "left").join(F.broadcast(whole)).select(
        "source", "target_share", "max_repeats", "available_tokens", "budget_tokens", zero("mix_tokens").alias("mix_tokens"),
        zero("most_uses").alias("most_uses"), zero("n_documents").alias("n_documents"), (zero("mix_tokens") / F.col("all_tokens")).alias("reached_share"),
    )


def sized(documents: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """Token counts, written once: planning and mixing read them several times."""
    return materialize(token_counts(documents, path), "token-counts")
