"""Helpers of the query catalogue: one TeX operator over markup that is put together from table cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlake.operators.text import apply
from paperlake.session import table


def cells(name: str, key: str, source: str, fn: Callable[[str], str] | str) -> Callable[[SparkSession, str], DataFrame]:
    """Query: (id, txt) of ``fn`` over the SQL expression ``source`` for every row of a table. ``fn`` may also name a
    native column function."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = F.expr(source)
        if isinstance(fn, str):
            from paperlake.functions import columns

            shown = getattr(columns, fn)(text)
        else:
            shown = apply(fn, text)
        return table(spark, sf_dir, name).select(F.col(key).cast("bigint").alias("id"), shown.alias("txt"))

    return query


def expected(name: str, key: str, sql: str) -> str:
    return f"SELECT CAST({key} AS BIGINT) AS id, {sql} AS txt FROM {name}"
