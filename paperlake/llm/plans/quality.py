"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.llm import quality as op
from paperlake.session import materialize, spread, table


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.not_prose(spread(table(spark, sf_dir, "results"), "result_id"))


def p6_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ["result_id", "text_length", "n_chars", "n_words", "n_letters", "n_digits", "n_high", "n_sentence_ends"]
    return op.text_statistics(table(spark, sf_dir, "results")).select(*counts, F.round("mean_word_len", 6).alias("mean_word_len"))


def p6_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = op.outlier_scores(op.text_statistics(table(spark, sf_dir, "results").where(F.col("text").rlike(r"\S"))))
    return scored.select("result_id", "lang", *op.STATISTICS, F.round("score", 6).alias("score"))


def p6_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact ranks of all values of all statistics."""
    stats = materialize(op.text_statistics(table(spark, sf_dir, "results")), "text-statistics")
    ranks = op.value_ranks(stats, op.STATISTICS).withColumn("value", F.round("value", 9))
    return ranks.groupBy("stat", "lang", "value").agg(F.sum("n_here").alias("n_here"), F.min("n_below").alias("n_below"), F.max("n_total").alias("n_total"))


CODES = ", ".join(f"('{w}', '{c}')" for w, c in op.CODE_OF.items())
COMMON = ", ".join(f"'{w}'" for w in sorted(set(op.COMMON_WORDS.split())))
QUERIES = {"p6_found": p6_found, "p6_statistics": p6_statistics, "p6_scores": p6_scores, "p6_ranks": p6_ranks}
ORACLES = {
    "p6_statistics": r"""
SELECT result_id, CAST(strlen(text) AS BIGINT) AS text_length, length(coalesce(text, '')) AS n_chars,
  len(regexp_extract_all(coalesce(text, ''), '\p{L}+')) AS n_words,
  len(regexp_extract_all(coalesce(text, ''), '\p{L}')) AS n_letters,
  len(regexp_extract_all(coalesce(text, ''), '[0-9]')) AS n_digits,
  len(regexp_extract_all(coalesce(text, ''), '[^\x00-\x7f]')) AS n_high,
  len(regexp_extract_all(coalesce(text, ''), '\p{L}[\p{M}\p{Cf}]*\p{L}[\p{M}\p{Cf})\]»”"’*_`]*[.!?…]|[。！？．｡]')) AS n_sentence_ends,
  coalesce(round(len(regexp_extract_all(text, '\p{L}')) / nullif(len(regexp_extract_all(text, '\p{L}+')), 0), 6), 0.0) AS mean_word_len
FROM results
""",
    "p6_ranks": f"""
WITH code(word, code) AS (VALUES {CODES}), t AS (
  SELECT coalesce(code, 'und') AS lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '\\p{{L}}+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x) <> '') AS lines
  FROM results LEFT JOIN code ON word = trim(regexp_split_to_array(lower(trim(lang_label)), '[-_]')[1])
), n AS (
  SELECT *, length(t) AS chars, len(w) AS words, len(regexp_extract_all(t, '\\p{{L}}')) AS letters, len(regexp_extract_all(t, '[0-9]')) AS digits, len(regexp_extract_all(t, '[ \\t\\n\\r\\f\\v]')) AS spaces,
    len(regexp_extract_all(t, '(?m)^.*[^ \\t\\n\\r\\f\\v].*$')) AS n_lines, len(regexp_extract_all(t, '(?m)[.!?…。！？:;][)\\]»”"’]*[ \\t\\r]*$')) AS line_ends,
    len(list_filter(w, lambda x: list_contains([{COMMON}], lower(x)))) + len(regexp_extract_all(t, '[的了是在のはをに]')) AS common,
    len(regexp_extract_all(t, '\\p{{L}}[\\p{{M}}\\p{{Cf}}]*\\p{{L}}[\\p{{M}}\\p{{Cf}})\\]»”"’*_`]*[.!?…]|[。！？．｡]')) AS ends, len(list_distinct(lines)) AS distinct_lines FROM t
), v AS (
  SELECT lang, unnest([{{'stat': 'n_words', 'value': words::DOUBLE}}, {{'stat': 'mean_word_len', 'value': coalesce(letters / nullif(words, 0), 0)}},
    {{'stat': 'symbol_share', 'value': coalesce((chars - letters - spaces) / nullif(chars, 0), 0)}}, {{'stat': 'digit_share', 'value': coalesce(digits / nullif(chars, 0), 0)}},
    {{'stat': 'line_end_share', 'value': coalesce(line_ends / nullif(n_lines, 0), 0)}}, {{'stat': 'common_share', 'value': coalesce(common / nullif(words, 0), 0)}},
    {{'stat': 'sentence_rate', 'value': coalesce(ends / nullif(words, 0), 0)}}, {{'stat': 'distinct_line_share', 'value': coalesce(distinct_lines / nullif(n_lines, 0), 0)}}], recursive := true) FROM n
), c AS (SELECT stat, lang, round(value, 9) AS value, count(*) AS n_here FROM v GROUP BY ALL)
SELECT stat, lang, value, n_here, CAST(coalesce(sum(n_here) OVER (PARTITION BY stat, lang ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS n_below,
  CAST(sum(n_here) OVER (PARTITION BY stat, lang) AS BIGINT) AS n_total FROM c
""",
}
