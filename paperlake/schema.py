"""Schemas of papers, results and the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

FILE = T.StructType([T.StructField("name", T.StringType()), T.StructField("content", T.StringType())])
PAPER = T.StructType(
    [
        T.StructField("source_tar", T.StringType()),
        T.StructField("entry_name", T.StringType()),
        T.StructField("arxiv_id", T.StringType()),
        T.StructField("file_type", T.StringType()),
        T.StructField("tex_files", T.ArrayType(FILE)),
        T.StructField("error", T.StringType()),
    ]
)
LEDGER = T.StructType([T.StructField("stem", T.StringType()), T.StructField("arxiv_id", T.StringType())])
OUTCOMES = ("ok", "empty", "timeout", "skipped", "panic", "crash", "archive_error", "io_error", "skipped_resume")
