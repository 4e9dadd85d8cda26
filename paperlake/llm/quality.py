"""Per-document text statistics, their exact per-language ranks, and an outlier score that tells prose from the rest.

Statistics are built-in expressions. Equal values of a statistic in a language are counted first, so a value that a third
of all rows share is one row from then on; the (statistic, language, value) counts are range-partitioned and sorted,
partitions are summed, the sums become partition offsets, and offset plus running sum is the exact number of rows below.
Ties share a rank.

The score ranks a row among those rows of its language that hold a sentence end; it selects the rows of ``not_prose``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from unicodedata import category

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake.llm.sampling import CODE_OF
from paperlake.session import materialize

# Common words of the languages, for the share of common words.
COMMON_WORDS = """the of and is that with for not this are was but only to in be a by at on as it we
der die das und ist nicht mit für von auf dass den im bei wir
le la les et est une un que de des dans pour pas du en il nous
el los las y es una no se con por para
il di che non è per della gli
o os e uma não da do um em
что не на и в для это к с по при как"""
#: Only runs of at most five letters, the longest word, are compared with the words.
COMMON = r"(?iU)(?<!\p{L})(?=\p{L}{1,5}+(?!\p{L}))(?:" + "|".join(sorted(set(COMMON_WORDS.split()))) + r")(?!\p{L})|[的了是在のはをに]"
SENTENCE_END = r"\p{L}[\p{M}\p{Cf}]*\p{L}[\p{M}\p{Cf})\]»”\"’*_`]*[.!?…]|[。！？．｡]"
#: A sentence end that nothing continues: not the dot of a file name, an address or an abbreviation inside a phrase.
CLOSED_END = r"\p{L}[\p{M}\p{Cf}]*+\p{L}[\p{M}\p{Cf})\]»”\"’*_`]*+(?:[ \u00a0\u202f]?[!?]|[.…])(?![\p{L}\p{N}_/@,;-]|\s+[\p{Ll}\p{N}])|[。！？．｡]"
LINE_END = r"(?md)[.!?…。！？:;][)\]»”\"’]*[ \t\r]*$"
STATISTICS = ["n_words", "mean_word_len", "symbol_share", "digit_share", "line_end_share", "common_share", "sentence_rate", "distinct_line_share"]


def language_code(label: Column) -> Column:
    """ISO code of a label, ``und`` where it says nothing."""
    head = F.trim(F.split(F.lower(F.trim(label)), "[-_]")[0])
    table = F.create_map(*[F.lit(x) for pair in CODE_OF.items() for x in pair])
    return F.coalesce(F.element_at(table, head), F.lit("und"))


def count_of(pattern: str, text: Column) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def chars_in(pattern: str, text: Column) -> Column:
    """Characters in runs of a class; ``pattern`` matches whole runs, so no list of single characters is built."""
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


_MARK = re.compile("[.!?…。！？．｡]")
_RUN = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")
_WIDE_MARKS, _WIDE_WORDS = set("。！？．｡"), re.compile("[的了是在のはをに]")
_CLOSERS, _GAPS, _BLANKS = set(")]»”\"’*_`"), set(" \u00a0\u202f"), " \t\n\x0b\f\r"
_WORDS = frozenset(COMMON_WORDS.split())


def _bound(text: str, at: int) -> bool:
    """Whether closing signs back from ``at`` and two letters stand there, combining marks and format characters left
    aside."""
    while at >= 0 and (text[at] in _CLOSERS or not text[at].isascii() and category(text[at]) in ("Mn", "Mc", "Me", "Cf")):
        at -= 1
    if at < 1 or not text[at].isalpha():
        return False
    at -= 1
    while at >= 0 and not text[at].isascii() and category(text[at]) in ("Mn", "Mc", "Me", "Cf"):
        at -= 1
    return at >= 0 and text[at].isalpha()


def sentence_counts(text: str) -> tuple[int, int, int]:
    """What SENTENCE_END, CLOSED_END and COMMON count, in one pass: a mark is looked for first and what stands before and
    behind it only then, which costs a tenth of the patterns."""
    ends = closed = 0
    for m in _MARK.finditer(text):
        at = m.start()
        mark = text[at]
        if mark in _WIDE_MARKS:
            ends += 1
            closed += 1
            continue
        is_end = _bound(text, at - 1)
        ends += is_end
        if is_end or mark in "!?" and at and text[at - 1] in _GAPS and _bound(text, at - 2):
            after = text[at + 1 : at + 2]
            if after and (after.isalpha() or after.isnumeric() or after in "_/@,;-"):
                continue
            if after and after in _BLANKS:
                behind = at + 1
                while behind < len(text) and text[behind] in _BLANKS:
                    behind += 1
                if behind < len(text) and category(text[behind]) in ("Ll", "Nd", "Nl", "No"):
                    continue
            closed += 1
    common = len(_WIDE_WORDS.findall(text)) if not text.isascii() else 0
    for run in _RUN.findall(text):
        if len(run) <= 5 or not run.isalpha():
            for word in [run] if run.isalpha() else _LETTERS.findall(run):
                common += word.lower() in _WORDS
    return ends, closed, common


@F.pandas_udf(T.StructType([T.StructField(n, T.LongType()) for n in ("n_sentence_ends", "n_closed", "n_common")]))
def _counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([sentence_counts(t) for t in texts], columns=["n_sentence_ends", "n_closed", "n_common"])


def text_statistics(results: DataFrame, *further: str) -> DataFrame:
    """result_id, lang, text_length (octets of the text, whatever the table says) and the counts and shares of the text;
    before these the ``further`` columns.

    Null text: text_length null and every count 0. Empty and blank texts: counts 0, shares 0.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    base = results.select(
        "result_id",
        *further,
        language_code(F.col("lang_label")).alias("lang"),
        F.octet_length("text").cast("bigint").alias("text_length"),
        F.char_length(t).cast("bigint").alias("n_chars"),
        count_of(r"\p{L}+", t).cast("bigint").alias("n_words"),
        chars_in(r"\p{L}+", t).cast("bigint").alias("n_letters"),
        chars_in(r"[0-9]+", t).cast("bigint").alias("n_digits"),
        chars_in(r"\s+", t).cast("bigint").alias("n_spaces"),
        chars_in(r"[^\x00-\x7f]+", t).cast("bigint").alias("n_high"),
        count_of(r"(?md)^.*\S.*$", t).cast("bigint").alias("n_lines"),
        count_of(LINE_END, t).cast("bigint").alias("n_line_ends"),
        _counted(t).alias("_counted"),
        F.size(F.array_distinct(F.filter(F.split(t, "\n"), lambda x: F.trim(x) != ""))).cast("bigint").alias("n_distinct_lines"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    c = F.col
    base = base.select("*", "_counted.*").drop("_counted")
    return base.withColumns(
        {
            "mean_word_len": share(c("n_letters"), c("n_words")),
            "symbol_share": share(c("n_chars") - c("n_letters") - c("n_spaces"), c("n_chars")),
            "digit_share": share(c("n_digits"), c("n_chars")),
            "line_end_share": share(c("n_line_ends"), c("n_lines")),
            "common_share": share(c("n_common"), c("n_words")),
            "sentence_rate": share(c("n_sentence_ends"), c("n_words")),
            "distinct_line_share": share(c("n_distinct_lines"), c("n_lines")),
        }
    )


def long_form(stats: DataFrame, names: list[str], *columns: str) -> DataFrame:
    """One row per row and statistic: ``columns``, lang, stat, value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in names]))
    return stats.select(*columns, "lang", pairs.alias("x")).select(*columns, "lang", "x.stat", "x.value")


def value_ranks(stats: DataFrame, names: list[str], reference: Column | None = None, partitions: int | None = None) -> DataFrame:
    """stat, lang, value, n_rows, n_here, n_below, n_total for every value that occurs: rows with it, and of the
    ``reference`` rows (default: all) those with it, those below it, and all of the language. Exact.

    Only partition totals – one row per partition, statistic and language – are window-summed in one place.
    """
    partitions = partitions or int(stats.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = stats.withColumn("_ref", F.lit(True) if reference is None else F.coalesce(reference, F.lit(False)))
    counts = long_form(marked, names, "_ref").groupBy("stat", "lang", "value").agg(F.count("*").alias("n_rows"), F.count_if("_ref").alias("n_here"))
    ranged = counts.repartitionByRange(partitions, "stat", "lang", "value").sortWithinPartitions("stat", "lang", "value").withColumn("part", F.spark_partition_id())

    def running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried: dict[tuple, int] = {}
        for b in batches:
            groups = b.groupby(["stat", "lang"], sort=False)["n_here"]
            before = pd.Series([carried.get(k, 0) for k in zip(b["stat"], b["lang"], strict=True)], index=b.index, dtype="int64")
            below = groups.cumsum() - b["n_here"] + before
            for k, total in groups.sum().items():
                carried[k] = carried.get(k, 0) + int(total)
            yield b.assign(n_within=below)

    partial = materialize(ranged.mapInPandas(running, "stat string, lang string, value double, n_rows bigint, n_here bigint, part int, n_within bigint"), "value-ranks")
    totals = partial.groupBy("stat", "lang", "part").agg(F.sum("n_here").alias("n_part"))
    w = Window.partitionBy("stat", "lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("n_part").over(w), F.lit(0))).withColumn(
        "n_total", F.sum("n_part").over(Window.partitionBy("stat", "lang"))
    )
    return partial.join(offsets, ["stat", "lang", "part"]).select(
        "stat", "lang", "value", "n_rows", "n_here", (F.col("n_within") + F.col("offset")).alias("n_below"), "n_total"
    )


def with_ranks(rows: DataFrame, ranks: DataFrame, n_rows: int) -> DataFrame:
    """Long rows with the ranks of their values. Values of more than one row in HOT_ONE_IN (there are at most HOT_ONE_IN
    of them per statistic) are looked up in a broadcast table; the rest have few rows each and are joined by key."""
    keys = ["stat", "lang", "value"]
    ranks = materialize(ranks, "ranks")
    hot = F.col("n_rows") > max(1, n_rows // HOT_ONE_IN)
    found = rows.join(F.broadcast(ranks.where(hot).drop("n_rows")), keys, "left")
    rest = found.where("n_total is null").select(*rows.columns).join(ranks.where(~hot).drop("n_rows"), keys)
    return found.where("n_total is not null").unionByName(rest)


#: A value of more than one row in so many is hot.
HOT_ONE_IN = 1000
#: The statistics that make the score, with the side that speaks against prose (0: both). None of them looks for
#: sentence ends inside a text, which ``not_prose`` checks afterwards.
SCORED = {"common_share": -1, "line_end_share": -1, "distinct_line_share": -1, "symbol_share": 1, "digit_share": 1, "mean_word_len": 0}


def outlier_scores(stats: DataFrame) -> DataFrame:
    """Adds ``n_ref`` and ``score``: the sum of -log(tail) over the SCORED statistics.

    A tail is the share of the reference rows (those of the language with a sentence end, ``n_ref`` of them, plus the row
    itself) that lie at least as far out. Ties count, so a usual value adds nothing; junk does not hide junk, however
    much of a language it is. A language without reference rows has the score 0.
    """
    kept = materialize(stats.withColumn("_row", F.monotonically_increasing_id()), "text-statistics")
    names, n_rows = list(SCORED), kept.count()
    ranked = with_ranks(long_form(kept, names, "_row"), value_ranks(kept, names, F.col("n_sentence_ends") > 0), n_rows)
    low, high = F.col("n_below") + F.col("n_here"), F.col("n_total") - F.col("n_below")
    side = F.element_at(F.create_map(*[F.lit(x) for pair in SCORED.items() for x in pair]), F.col("stat"))
    tail = F.when(side < 0, low).when(side > 0, high).otherwise(F.least(F.col("n_total"), 2 * F.least(low, high)))
    scores = ranked.groupBy("_row").agg(F.max("n_total").alias("n_ref"), F.sum(-F.log((tail + 1) / (F.col("n_total") + 1))).alias("score"))
    return kept.join(scores, "_row").drop("_row")


#: Six independent tails of prose would add up to this in a quarter of its rows.
LEAST_SCORE = 7.4
#: Few reference rows cannot give a high score; there, half of the score they can give is asked for.
LEAST_PART = 0.5
#: Prose closes a sentence every 10 to 40 words.
MOST_CLOSED = 0.01


def outlying() -> Column:
    """Whether the score of a row is that of a list, a table or junk."""
    return F.col("score") >= F.least(F.lit(LEAST_SCORE), F.log(F.col("n_ref") + 1) * (len(SCORED) * LEAST_PART))


def not_prose(results: DataFrame) -> DataFrame:
    """result_id of rows whose text as a whole is a list, a table or junk.

    The score selects the rows; of these, texts that close less than one sentence in a hundred words are no prose. Texts
    made of many characters beyond ASCII without any known mark are garbled prose, not lists. Null and blank texts are
    never cases.
    """
    scored = outlier_scores(text_statistics(results.where(F.col("text").rlike(r"\S"))).select("result_id", "lang", *SCORED, "n_sentence_ends", "n_high", "n_chars", "n_closed", "n_words"))
    unclosed = F.col("n_closed") <= MOST_CLOSED * F.col("n_words")
    return scored.where(outlying() & (F.col("n_high") < 0.15 * F.col("n_chars")) & unclosed).select("result_id")
