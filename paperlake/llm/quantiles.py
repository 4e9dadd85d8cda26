"""Percentiles of very large numeric columns from mergeable rank-interval summaries.

A summary holds a few values with the least and greatest rank each can have. Partitions are summarised where they lie,
pruned to the permitted uncertainty, and merged in a tree of bounded fan-in; ``error`` is the rank error that any
percentile read from the summary can have, recomputed after every step from the intervals themselves. Summaries of days
or partitions are rows that can be stored and merged later.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Permitted rank error of a percentile, as a share of the values.
EPSILON = 0.005
#: Summaries merged by one task for one group and level.
FAN_IN = 64
#: Values of a group buffered before they are folded into its summary.
BUFFER = 50_000
MAX_LONG = 2**63 - 1
#: Rank-interval tuples are longs; a group has at most size(EPSILON) of them.
SUMMARY = "n bigint, n_null bigint, n_sentinel bigint, error bigint, v array<bigint>, lo array<bigint>, hi array<bigint>"


@dataclass
class Summary:
    """Values ``v`` ascending; the rank of v[i] lies in [lo[i], hi[i]]; n values in all."""

    v: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    n: int

    @classmethod
    def exact(cls, values: np.ndarray) -> Summary:
        v = np.sort(values)
        ranks = np.arange(1, len(v) + 1, dtype=np.int64)
        return cls(v, ranks, ranks.copy(), len(v))

    @property
    def error(self) -> int:
        """Any rank can be answered within this many ranks: half the widest gap between neighbours' outer ranks."""
        if self.n == 0:
            return 0
        inner = np.max(self.hi[1:] - self.lo[:-1]) if len(self.v) > 1 else 0
        return int(max((inner + 1) // 2, self.hi[0] - 1, self.n - self.lo[-1]))

    def merge(self, other: Summary) -> Summary:
        if not self.n or not other.n:
            return self if self.n else other
        parts = []
        for a, b, side in ((self, other, "left"), (other, self, "right")):
            i = np.searchsorted(b.v, a.v, side)  # how many of b precede, equal values ordered the same way from both sides
            before = np.where(i > 0, b.lo[np.maximum(i - 1, 0)], 0)
            after = np.where(i < len(b.v), b.hi[np.minimum(i, len(b.v) - 1)] - 1, b.n)
            parts.append((a.v, a.lo + before, a.hi + after, i))
        at_self = np.arange(len(self.v)) + parts[0][3]
        at_other = np.arange(len(other.v)) + parts[1][3]
        size = len(self.v) + len(other.v)
        v, lo, hi = (np.empty(size, dtype=np.int64) for _ in range(3))
        for at, (pv, plo, phi, _) in ((at_self, parts[0]), (at_other, parts[1])):
            v[at], lo[at], hi[at] = pv, plo, phi
        return Summary(v, lo, hi, self.n + other.n)

    def prune(self, tuples: int) -> Summary:
        """Keep at most ``tuples`` + 1 of them, evenly spread over the ranks; adds n / (2 tuples) to the error."""
        if len(self.v) <= tuples + 1:
            return self
        wanted = np.linspace(1, self.n, tuples + 1)
        middle = (self.lo + self.hi) / 2
        i = np.clip(np.searchsorted(middle, wanted), 1, len(middle) - 1)
        i -= wanted - middle[i - 1] < middle[i] - wanted
        keep = np.unique(np.concatenate([[0], i, [len(self.v) - 1]]))
        return Summary(self.v[keep], self.lo[keep], self.hi[keep], self.n)

    def value(self, q: float) -> tuple[int, int] | None:
        """(value, greatest rank error) of percentile ``q`` by nearest rank; None for no values."""
        if not self.n:
            return None
        r = min(self.n, max(1, math.ceil(q * self.n)))
        off = np.maximum(r - self.lo, self.hi - r)
        i = int(np.argmin(off))
        return int(self.v[i]), int(off[i])


#: A partition's own pieces are pruned to so many times the tuples of a leaf. Up to 16 doublings of them add an eighth of
#: what pruning the leaf does.
FINE = 64


def tuples_for(epsilon: float, levels: int) -> int:
    """Tuples to keep so that pruning once at the leaves and once per level stays within ``epsilon``, the pieces of a
    leaf included."""
    return math.ceil((levels + 1.25) / (2 * epsilon)) + 2


def levels_for(partitions: int) -> int:
    return max(1, math.ceil(math.log(max(2, partitions), FAN_IN)))


class _Folder:
    """Collects values of one group; a full buffer becomes a piece, and two pieces of one size become one of the next, so
    that the work grows with the rows times the logarithm of their number."""

    def __init__(self, tuples: int):
        self.tuples, self.parts, self.held = tuples, [], 0
        self.pieces: list[tuple[int, Summary]] = []
        self.nulls = self.sentinels = 0

    def add(self, values: np.ndarray, nulls: int, sentinels: int) -> None:
        self.nulls += nulls
        self.sentinels += sentinels
        if len(values):
            self.parts.append(values)
            self.held += len(values)
        if self.held >= BUFFER:
            self.fold()

    def fold(self) -> None:
        if not self.parts:
            return
        size, piece = 0, Summary.exact(np.concatenate(self.parts)).prune(FINE * self.tuples)
        self.parts, self.held = [], 0
        while self.pieces and self.pieces[-1][0] == size:
            piece = self.pieces.pop()[1].merge(piece).prune(FINE * self.tuples)
            size += 1
        self.pieces.append((size, piece))

    def finish(self) -> Summary:
        self.fold()
        whole = Summary.exact(np.zeros(0, dtype=np.int64))
        for _, piece in reversed(self.pieces):
            whole = piece.merge(whole)
        return whole.prune(self.tuples)


def leaf_summaries(rows: DataFrame, groups: dict[str, Column], metrics: list[str], tuples: int, valid: tuple[int, int]) -> DataFrame:
    """One summary per partition, grouping, key and metric; the rows are read once for all groupings."""
    kinds = list(groups)
    flat = rows.select(*[c.cast("string").alias(f"g{i}") for i, c in enumerate(groups.values())], *[F.col(m).cast("bigint").alias(m) for m in metrics], F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folders: dict[tuple, _Folder] = defaultdict(lambda: _Folder(tuples))
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            columns = []
            for m in metrics:
                c = batch.column(m)
                null = np.asarray(c.is_null())
                columns.append((c.fill_null(0).to_numpy(zero_copy_only=False), null))
            for i, kind in enumerate(kinds):
                coded = batch.column(f"g{i}").dictionary_encode()
                keys = coded.dictionary.to_pylist() + [None]
                code = coded.indices.fill_null(len(keys) - 1).to_numpy(zero_copy_only=False)
                order = np.argsort(code, kind="stable")
                bounds = np.searchsorted(code[order], np.arange(len(keys) + 1))
                for k, key in enumerate(keys):
                    mine = order[bounds[k] : bounds[k + 1]]
                    if not len(mine):
                        continue
                    for m, (values, null) in zip(metrics, columns, strict=True):
                        own, gone = values[mine], null[mine]
                        own = own[~gone]
                        ok = (own >= valid[0]) & (own <= valid[1])
                        folders[kind, key, m].add(own[ok], int(gone.sum()), int((~ok).sum()))
        if folders:
            yield _batch([(kind, key, m, part, f.finish(), f.nulls, f.sentinels) for (kind, key, m), f in folders.items()])

    return flat.mapInArrow(run, f"kind string, key string, metric string, part int, {SUMMARY}")


NAMES = ["kind", "key", "metric", "part", "n", "n_null", "n_sentinel", "error", "v", "lo", "hi"]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int64), pa.int64()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    s = [r[4] for r in rows]
    whole = pa.int64()
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.int32()),
            pa.array([x.n for x in s], whole), pa.array([r[5] for r in rows], whole), pa.array([r[6] for r in rows], whole), pa.array([x.error for x in s], whole),
            _lists([x.v for x in s]), _lists([x.lo for x in s]), _lists([x.hi for x in s]),
        ],
        names=NAMES,
    )


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(kind, key, metric, part, summary, nulls, sentinels) of a batch; lists are slices, nothing is copied by value."""
    plain = [batch.column(n).to_pylist() for n in ("kind", "key", "metric", "part", "n", "n_null", "n_sentinel")]
    lists = []
    for n in ("v", "lo", "hi"):
        c = batch.column(n)
        lists.append((c.offsets.to_numpy(), c.values.to_numpy()))
    for i, (kind, key, metric, part, n, nulls, sentinels) in enumerate(zip(*plain, strict=True)):
        v, lo, hi = (values[offsets[i] : offsets[i + 1]] for offsets, values in lists)
        yield kind, key, metric, part, Summary(v, lo, hi, n), nulls, sentinels


def merged(parts: list[Summary]) -> Summary:
    """All parts as one; parts that still hold every value are put together by one sort."""
    exact = [p.v for p in parts if len(p.v) == p.n]
    rest = [p for p in parts if len(p.v) != p.n]
    total = Summary.exact(np.concatenate(exact) if exact else np.zeros(0, dtype=np.int64))
    for p in rest:
        total = total.merge(p)
    return total


def merge_once(summaries: DataFrame, tuples: int, by: list[str]) -> DataFrame:
    """Merge the summaries that agree in ``by`` (kind, key, metric and, between levels, part). Rows of a group come one
    after the other, so a group is finished as soon as the next begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, counts, done = None, [], [0, 0], []

        def finish() -> None:
            if at is not None:
                done.append((*at, merged(held).prune(tuples), *counts))

        for batch in batches:
            for kind, key, metric, part, summary, nulls, sentinels in _rows(batch):
                if at != (kind, key, metric, part):
                    finish()
                    at, held, counts = (kind, key, metric, part), [], [0, 0]
                held.append(summary)
                counts = [counts[0] + nulls, counts[1] + sentinels]
            if len(done) >= 500:
                yield _batch(done)
                done = []
        finish()
        if done:
            yield _batch(done)

    together = summaries.select(*NAMES).repartition(*by).sortWithinPartitions(*by)
    return together.mapInArrow(run, f"kind string, key string, metric string, part int, {SUMMARY}")


def summarize(rows: DataFrame, groups: dict[str, Column], metrics: list[str], epsilon: float = EPSILON, valid: tuple[int, int] = (0, MAX_LONG - 1)) -> DataFrame:
    """Summaries per grouping, key and metric, with rank error at most ``epsilon`` times their values.

    ``valid`` bounds the measurements; values outside (negative and maximal sentinels) and nulls are counted, not
    ranked. Null keys form a group of their own. Groups without a value have n = 0 and empty arrays.
    """
    partitions = rows.rdd.getNumPartitions()
    levels = levels_for(partitions)
    tuples = tuples_for(epsilon, levels)
    level = leaf_summaries(rows, groups, metrics, tuples, valid)
    for _ in range(levels - 1):
        level = merge_once(level.withColumn("part", (F.col("part") / FAN_IN).cast("int")), tuples, ["kind", "key", "metric", "part"])
    return merge_once(level.withColumn("part", F.lit(0)), tuples, ["kind", "key", "metric"]).drop("part")


def combine(summaries: DataFrame, kind: str, key: Column, epsilon: float = EPSILON) -> DataFrame:
    """Merge stored summaries under new keys, such as days into weeks."""
    # merged intervals add their gaps only where they overlap, so one more pruning is all that is added
    moved = summaries.withColumn("key", key).withColumn("kind", F.lit(kind)).withColumn("part", F.lit(0))
    return merge_once(moved, tuples_for(epsilon, 1), ["kind", "key", "metric"]).drop("part")


def percentiles(summaries: DataFrame, points: list[float]) -> DataFrame:
    """One row per group and metric: counts, the percentiles (null without values) and the greatest rank error."""
    names = [f"p{round(q * 1000) / 10:g}".replace(".", "_") for q in points]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b[["kind", "key", "metric", "n", "n_null", "n_sentinel"]].copy()
            read = [[Summary(*(np.asarray(x, dtype=np.int64) for x in (v, lo, hi)), int(n)).value(q) for q in points] for v, lo, hi, n in zip(b["v"], b["lo"], b["hi"], b["n"], strict=True)]
            for i, name in enumerate(names):
                out[name] = pd.array([r[i][0] if r[i] else None for r in read], dtype="Int64")
            out["rank_error"] = [max((x[1] for x in r if x), default=0) for r in read]
            yield out

    schema = "kind string, key string, metric string, n bigint, n_null bigint, n_sentinel bigint, " + ", ".join(f"{n} bigint" for n in names) + ", rank_error bigint"
    return summaries.mapInPandas(run, schema)
