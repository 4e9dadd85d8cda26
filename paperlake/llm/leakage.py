"""Evaluation passages inside a training corpus.

The corpus is indexed shard by shard: words become numbers, and a suffix array (prefix doubling, finished when no tie can
be broken) sorts all word suffixes of the shard. Every suffix of every item is binary-searched in every shard; verbatim
matches of SEED or more words are the anchors, and the whole alignment of item and document on an anchor's diagonal is
then read out: a passage counts if it covers LEAST words or more, begins and ends on equal words and has at most one
replaced word in ten. A passage of that kind always holds a verbatim run of SEED words, so the search loses no case.

The instruction that the items of a suite open with is settled over all items before any search, so neither the blocks
in which items are searched nor the shards of the corpus change a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlake.session import materialize, scratch

LEAST = 14
ONE_IN = 10
#: 20 words with 2 replaced ones leave runs of 6; every other length leaves at least that.
SEED = 6
#: Octets of item text that are searched at once; larger item sets are taken in blocks over a stored index.
BLOCK_OCTETS = 4_000_000
#: Characters of documents in one suffix array; a longer document has one of its own.
SHARD_CHARS = 16_000_000
#: Anchors that are unfolded at once.
ANCHORS = 2_000_000
#: Words of an opening, at least.
OPENING = 3

WORD = re.compile(r"\d+(?:[.,]\d+)*|[A-Za-zÀ-ɏ]+(?:['’‑-][A-Za-zÀ-ɏ]+)*|[ऀ-ॿ]+|[฀-๿]+|[一-鿿]|[ぁ-ヿ]+|[^\W\d_A-Za-zÀ-ɏऀ-ॿ฀-๿一-鿿ぁ-ヿ]+")
LINE_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐­][ \t]*\r?\n[ \t]*(?=[^\W\d_])")
INSIDE = re.compile(r"['’‑-]")


def words(text: str) -> list[tuple[str, int, int]]:
    """(normal form, start, end) of the words: no case, no punctuation, words cut at a line end joined. Positions refer
    to the text after joining."""
    return [(INSIDE.sub("", m[0]), m.start(), m.end()) for m in WORD.finditer(LINE_HYPHEN.sub("", text).lower())]


def plain_words(text: str) -> list[str]:
    if "\n" in text:
        text = LINE_HYPHEN.sub("", text)
    found = WORD.findall(text.lower())
    return [INSIDE.sub("", w) if ("-" in w or "’" in w or "'" in w or "‑" in w) else w for w in found]


# Items --------------------------------------------------------------------------------------------------------------


def prefix_hashes(text: str | None) -> list[int]:
    """One hash for every opening of a text: of its first word, its first two words and so on."""
    state, out = xxhash.xxh64(), []
    for w in plain_words(text or ""):
        state.update(w + " ")
        out.append(state.intdigest() - (1 << 63))
    return out


def with_openings(eval_items: DataFrame) -> DataFrame:
    """item_id, text, skip: how many words of the item belong to the instruction of its suite.

    The opening of a suite is what nine in ten of those items share that agree with half of the suite or more in their
    first OPENING words. Items without a suite stand in one group if they agree in their first SEED words. An item leaves
    out as much of the opening as it has, so an item that goes on like no other loses nothing of its own.
    """

    @F.pandas_udf("array<bigint>")
    def hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(prefix_hashes)

    rows = eval_items.select("item_id", "suite", "text", F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows.withColumn("h", hashes("text")), "items")
    group = F.coalesce(F.concat(F.lit("s"), "suite"), F.concat(F.lit("h"), F.element_at("h", F.least(F.lit(SEED), F.size("h"))).cast("string")))
    grouped = rows.where(F.size("h") >= OPENING).withColumn("group", group)
    prefixes = grouped.select("row", "group", F.posexplode("h").alias("n", "hash"))
    shared = prefixes.groupBy("group", "n", "hash").agg(F.count("*").alias("n_items"))
    family = shared.where(F.col("n") == OPENING - 1).groupBy("group").agg(F.max("n_items").alias("n_family"), F.sum("n_items").alias("n_group"))
    path = shared.join(family, "group").where("n_family >= 2 and 2 * n_family >= n_group and 10 * n_items >= 9 * n_family").where("group like 's%' or n_family >= 3")
    skips = prefixes.join(path.select("group", "n", "hash"), ["group", "n", "hash"]).groupBy("row").agg((F.max("n") + 1).alias("skip"))
    return rows.join(skips.where(F.col("skip") >= OPENING), "row", "left").select("item_id", "text", F.coalesce("skip", F.lit(0)).alias("skip"))


@dataclass
class Items:
    """Items ready to be searched: their ids and their words without the opening."""

    ids: list[int]
    texts: list[list[str]]


def prepare(rows: list[tuple[int, str | None, int]]) -> Items:
    """(item_id, text, words to leave out) to Items. Null and empty items have no words."""
    return Items([r[0] for r in rows], [plain_words(r[1] or "")[r[2] :] for r in rows])


# Shards of the corpus -----------------------------------------------------------------------------------------------


@dataclass
class Shard:
    """Word numbers of all documents of a shard one after the other, where each document begins (and the end of the
    last), the first positions of the sorted suffixes, and where the stretch ends that a suffix runs to."""

    numbers: dict[str, int]
    ids: np.ndarray
    begins: np.ndarray
    suffixes: np.ndarray
    ends: np.ndarray


def suffix_order(ids: np.ndarray, places: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``places`` sorted by the suffixes that begin there and run to ``ends`` (per place). Prefix doubling; only suffixes
    that still tie with another are sorted again. ``places`` holds every place between one of them and its end."""
    if not len(places):
        return places
    slot = np.full(len(ids) + 1, len(places), dtype=np.int64)
    slot[places] = np.arange(len(places))
    rank = np.append(ids[places].astype(np.int64), 0)
    _, rank[:-1] = np.unique(rank[:-1], return_inverse=True)
    rank[:-1] += 1
    tied, width = np.arange(len(places)), 1
    while len(tied):
        after = places[tied] + width
        following = np.where(after < ends[tied], rank[slot[np.minimum(after, len(ids))]], 0)
        order = np.lexsort((following, rank[tied]))
        own, nxt = rank[tied][order], following[order]
        fresh = np.append(True, own[1:] != own[:-1])
        differs = fresh | np.append(True, nxt[1:] != nxt[:-1])
        if differs.sum() == fresh.sum():
            break
        # within its class a suffix moves up by the number of class members that sort before it
        at = np.arange(len(order))
        class_start = np.maximum.accumulate(np.where(fresh, at, 0))
        block_start = np.maximum.accumulate(np.where(differs, at, 0))
        rank_new = own + block_start - class_start
        if width == 1 and len(tied) == len(places):  # make room: ranks become positions once
            rank_new = block_start + 1
        rank[tied[order]] = rank_new
        again = np.append(differs[1:], True) & differs
        tied, width = tied[order][~again], 2 * width
    return places[np.argsort(rank[:-1], kind="stable")]


def build_shard(texts: list[str | None], numbers: dict[str, int] | None = None) -> Shard:
    """The suffix array over whole texts. Given the ``numbers`` of the words that are searched for, other words end a
    stretch, and stretches shorter than SEED, which no anchor fits into, are left out."""
    own: dict[str, int] = {} if numbers is None else numbers
    if numbers is None:
        parts = [[own.setdefault(w, len(own) + 1) for w in plain_words(t)] if t else [] for t in texts]
    else:
        get = own.get
        parts = [[get(w, 0) for w in plain_words(t)] if t else [] for t in texts]
    begins = np.cumsum([0] + [len(p) for p in parts])
    ids = np.fromiter((i for p in parts for i in p), dtype=np.int32, count=begins[-1])
    n = len(ids)
    cut = np.zeros(n + 1, dtype=bool)
    cut[begins] = True
    cut[:n] |= ids == 0
    cut[1:] |= np.append(ids == 0, False)[:-1]
    bounds = np.flatnonzero(cut)
    lengths = np.diff(np.append(bounds, n)) if n else np.zeros(0, dtype=np.int64)
    bounds = bounds[: len(lengths)]
    good = (lengths >= SEED) & (ids[np.minimum(bounds, max(n - 1, 0))] > 0) if n else np.zeros(0, dtype=bool)
    first, length = bounds[good], lengths[good]
    places = np.repeat(first - np.append(0, np.cumsum(length)[:-1]), length) + np.arange(length.sum())
    ends = np.repeat(first + length, length)
    order = suffix_order(ids, places, ends)
    end_of = np.zeros(n, dtype=np.int64)
    end_of[places] = ends
    keep = end_of[order] - order >= SEED
    return Shard(own, ids, begins, order[keep], end_of[order[keep]])


def longest_passage(equal: np.ndarray) -> tuple[int, int] | None:
    """(start, end) of the longest stretch that begins and ends on an equal word, has LEAST words and no more than one
    different word in ONE_IN; None if there is none. A stretch from a to b is sound if what it owes does not rise:
    owed(b) <= owed(a) for owed(i) = ONE_IN x different words before i, less i."""
    hits = np.flatnonzero(equal)
    if len(hits) < LEAST - LEAST // ONE_IN:
        return None
    owed = ONE_IN * np.concatenate([[0], np.cumsum(~equal)]) - np.arange(len(equal) + 1)
    highest = np.maximum.accumulate(owed[hits])
    begin = hits[np.searchsorted(highest, owed[hits + 1])]  # the first place that owes as much; the last hit at worst
    length = hits + 1 - begin
    k = int(length.argmax())
    return (int(begin[k]), int(hits[k]) + 1) if length[k] >= LEAST else None


def longest_run(equal: np.ndarray) -> int:
    """Equal words in a row, at most."""
    other = np.flatnonzero(np.concatenate([[True], ~equal, [True]]))
    return int(np.diff(other).max()) - 1


def search_shard(shard: Shard, items: Items) -> list[tuple[int, int, int, int, int, int]]:
    """(document number, item number, first word in the document, first word in the item, words, longest verbatim run)
    of the longest passage of every document and item that have one."""
    if not len(shard.suffixes):
        return []
    get = shard.numbers.get
    own = [np.array([get(w, -1) for w in t], dtype=np.int32) for t in items.texts]
    usable = [k for k, t in enumerate(own) if len(t) >= LEAST]
    if not usable:
        return []
    span = np.arange(SEED)
    heads = _packed(shard.ids[shard.suffixes[:, None] + span])
    suffixes = np.concatenate([np.lib.stride_tricks.sliding_window_view(own[k], SEED) for k in usable])
    owner = np.concatenate([np.full(len(own[k]) - SEED + 1, k) for k in usable])
    place = np.concatenate([np.arange(len(own[k]) - SEED + 1) for k in usable])
    known = (suffixes > 0).all(axis=1)
    suffixes, owner, place = _packed(suffixes[known]), owner[known], place[known]
    low, high = np.searchsorted(heads, suffixes, "left"), np.searchsorted(heads, suffixes, "right")
    hit = np.flatnonzero(high > low)
    low, high, owner, place = low[hit], high[hit], owner[hit], place[hit]
    # unfold the ranges a bounded number of anchors at a time; an alignment is (item, corpus place of the item's word 0)
    total = np.cumsum(high - low)
    aligned = np.zeros((0, 3), dtype=np.int64)
    at = 0
    while at < len(low):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + ANCHORS, "right")))
        size = high[at:to] - low[at:to]
        which = np.repeat(np.arange(at, to), size)
        anchors = shard.suffixes[np.repeat(low[at:to] - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())]
        document = np.searchsorted(shard.begins, anchors, "right") - 1
        aligned = np.unique(np.concatenate([aligned, np.stack([document, owner[which], anchors - place[which]], axis=1)]), axis=0)
        at = to
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for n, k, shift in aligned.tolist():
        begin, end = shard.begins[n], shard.begins[n + 1]
        first, last = max(0, int(begin) - shift), min(len(own[k]), int(end) - shift)
        equal = shard.ids[first + shift : last + shift] == own[k][first:last]
        passage = longest_passage(equal)
        if passage and passage[1] - passage[0] > best.get((n, k), (0, 0, 0, 0))[2]:
            best[n, k] = (int(passage[0] + first + shift - begin), passage[0] + first, passage[1] - passage[0], longest_run(equal[passage[0] : passage[1]]))
    return [(n, k, *v) for (n, k), v in best.items()]


def _packed(ids: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them."""
    return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * SEED}").ravel() if len(ids) else np.zeros(0, dtype=f"S{4 * SEED}")


# Operators ----------------------------------------------------------------------------------------------------------

SCHEMA = "doc_id bigint, item_id bigint, doc_word int, item_word int, n_words int, n_verbatim int, passage string"
INDEX = "doc_ids array<bigint>, texts array<string>, words array<string>, ids binary, begins binary, suffixes binary, ends binary"


def _pieces(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Parts of a batch of at most SHARD_CHARS characters."""
    if len(batch):
        part = batch["text"].str.len().cumsum() // SHARD_CHARS
        yield from (rows for _, rows in batch.groupby(part.to_numpy(), sort=False))


def _rows(shard: Shard, items: Items, doc_ids: list[int], texts: list[str]) -> pd.DataFrame:
    rows = []
    for n, k, at, place, length, verbatim in search_shard(shard, items):
        span = words(texts[n])[at : at + length]
        rows.append((doc_ids[n], items.ids[k], at, place, length, verbatim, LINE_HYPHEN.sub("", texts[n])[span[0][1] : span[-1][2]]))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def index_shards(documents: DataFrame) -> DataFrame:
    """One row per shard: its texts, words and suffix array, to be searched any number of times."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _pieces(batch):
                s = build_shard(part["text"].tolist())
                arrays = {name: getattr(s, name).tobytes() for name in ("ids", "begins", "suffixes", "ends")}
                yield pd.DataFrame([{"doc_ids": part["doc_id"].tolist(), "texts": part["text"].tolist(), "words": list(s.numbers), **arrays}])

    return documents.where("text is not null").select("doc_id", "text").mapInPandas(build, INDEX)


def search_index(index: DataFrame, items: Items) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                arrays = [np.frombuffer(getattr(r, n), dtype=t) for n, t in (("ids", np.int32), ("begins", np.int64), ("suffixes", np.int64), ("ends", np.int64))]
                shard = Shard({w: i + 1 for i, w in enumerate(r.words)}, *arrays)
                yield _rows(shard, items, list(r.doc_ids), list(r.texts))

    return index.mapInPandas(run, SCHEMA)


def search_once(documents: DataFrame, items: Items) -> DataFrame:
    """Index and search in one pass: with a single block of items no index has to be kept, and only stretches of words
    that items use are sorted."""
    numbers: dict[str, int] = {}
    for t in items.texts:
        for w in t:
            numbers.setdefault(w, len(numbers) + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _pieces(batch):
                texts = part["text"].tolist()
                yield _rows(build_shard(texts, numbers), items, part["doc_id"].tolist(), texts)

    return documents.where("text is not null").select("doc_id", "text").mapInPandas(run, SCHEMA)


def leaks(documents: DataFrame, eval_items: DataFrame, block_octets: int = BLOCK_OCTETS) -> DataFrame:
    """One row per document and item that it leaks: where the longest passage begins (word numbers in both; of the item
    without its suite's instruction), its words, the longest verbatim run in it, and the passage.

    Whole texts are read; null and empty texts leak nothing; copies are reported each. An item that has fewer than LEAST
    words of its own has no passage of LEAST words and thus no leak. Items come to the driver in blocks of about
    ``block_octets`` of text; with several blocks the index of the corpus is written once and searched for each.
    """
    spark = documents.sparkSession
    items = materialize(with_openings(eval_items), "openings")
    n_blocks = -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_octets)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, n_blocks)))
    one = lambda b: prepare([tuple(r) for r in items.where(block == b).select("item_id", "text", "skip").collect()])
    if n_blocks <= 1:
        return search_once(documents, one(0))
    index, path = materialize(index_shards(documents), "suffix-arrays"), scratch(spark, "leaks")
    for b in range(n_blocks):
        search_index(index, one(b)).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def without_leaks(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents that leak nothing, all columns."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")


def item_report(found: DataFrame) -> DataFrame:
    """Per leaked item: documents, longest passage, longest verbatim run."""
    return found.groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_documents"), F.max("n_words").alias("longest"), F.max("n_verbatim").alias("longest_verbatim"))
