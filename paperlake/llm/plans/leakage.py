"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake.llm import leakage as op
from paperlake.session import materialize, spread, table


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.leaks(spread(table(spark, sf_dir, "documents"), "doc_id"), table(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_leaks(spark, sf_dir).select("doc_id", "item_id")


def p8_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs whose passage holds LEAST words in a row letter for letter, which SQL can state."""
    return p8_leaks(spark, sf_dir).where(f"n_verbatim >= {op.LEAST}").select("doc_id", "item_id")


def p8_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the suite's instruction in every item."""
    return op.with_openings(table(spark, sf_dir, "eval_items")).select("item_id", "skip")


def p8_kept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(p8_found(spark, sf_dir), "leaks")
    return op.without_leaks(table(spark, sf_dir, "documents"), found).select("doc_id", "source", "lang")


def p8_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.item_report(p8_leaks(spark, sf_dir))


WORDS = r"""list_transform(regexp_extract_all(lower(regexp_replace({}, '(\p{{L}})[-‐­][ \t]*\r?\n[ \t]*(\p{{L}})', '\1\2', 'g')),
  '[0-9]+(?:[.,][0-9]+)*|[A-Za-zÀ-ɏ]+(?:[''’‑-][A-Za-zÀ-ɏ]+)*|[ऀ-ॿ]+|[฀-๿]+|[一-鿿]|[ぁ-ヿ]+|[\p{{Greek}}\p{{Cyrillic}}]+'), lambda w: regexp_replace(w, '[''’‑-]', '', 'g'))"""
OPENINGS = f"""
i AS (SELECT item_id, suite, {WORDS.format("text")} AS w FROM eval_items),
p AS (SELECT item_id, suite, unnest(range(1, len(w) + 1)) AS n, w FROM i),
h AS (SELECT item_id, suite, n, array_to_string(list_slice(w, 1, n), ' ') AS prefix FROM p),
s AS (SELECT suite, n, prefix, count(*) AS c FROM h GROUP BY ALL),
fam AS (SELECT suite, max(c) AS family, sum(c) AS everyone FROM s WHERE n = 3 GROUP BY suite),
path AS (SELECT s.* FROM s JOIN fam USING (suite) WHERE family >= 2 AND 2 * family >= everyone AND 10 * c >= 9 * family),
k AS (SELECT i.item_id, i.w, CAST(coalesce(max(path.n) FILTER (WHERE path.n >= 3), 0) AS INTEGER) AS skip FROM i LEFT JOIN h ON h.item_id = i.item_id
  LEFT JOIN path ON path.suite = h.suite AND path.n = h.n AND path.prefix = h.prefix GROUP BY i.item_id, i.w)"""
QUERIES = {"p8_found": p8_found, "p8_leaks": p8_leaks, "p8_verbatim": p8_verbatim, "p8_openings": p8_openings, "p8_kept_documents": p8_kept_documents, "p8_items": p8_items}
ORACLES = {
    "p8_openings": f"WITH {OPENINGS} SELECT item_id, skip FROM k",
    "p8_verbatim": f"""
WITH {OPENINGS},
g AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, a, a + 13), ' ') AS gram FROM (SELECT item_id, list_slice(w, skip + 1, len(w)) AS w, unnest(range(1, len(w) - skip - 12)) AS a FROM k)),
d AS (SELECT doc_id, {WORDS.format("text")} AS w FROM documents WHERE text IS NOT NULL),
dg AS (SELECT doc_id, array_to_string(list_slice(w, a, a + 13), ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 12)) AS a FROM d))
SELECT DISTINCT doc_id, item_id FROM dg JOIN g USING (gram)
""",
}
