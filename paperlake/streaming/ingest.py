"""Papers as a stream: new files of a folder are extracted as they come, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paperlake.operators.text import extract_papers
from paperlake.schema import PAPER


def stream_papers(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of papers as they arrive."""
    return spark.readStream.schema(PAPER).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def ingest(papers: DataFrame, output: str, state: str) -> StreamingQuery:
    """Extract everything that is there now. The file log in ``state`` remembers what was read and the sink's own log
    what was written, so a restart neither skips nor repeats a file."""
    results = extract_papers(papers)
    return results.writeStream.format("parquet").option("path", output).option("checkpointLocation", state).trigger(availableNow=True).start()


def late_counts(events: DataFrame, delay: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Events per type and window; events later than ``delay`` are left out once their window has closed."""
    return (
        events.withWatermark("ts", delay).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
    )
