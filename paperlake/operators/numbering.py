"""Row numbers within groups of any size, without putting a group into one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperlake.session import materialize


def numbered(rows: DataFrame, group: str, order: list[str], name: str = "row_no") -> DataFrame:
    """Adds the 1-based number of every row within ``group`` by ``order``.

    Rows are range-partitioned by group and order, so a hot group is spread over many partitions; each partition counts
    its own rows, and the counts – one row per partition and group – give the offsets. ``order`` must tell all rows of
    a group apart for the numbers to be the same on every run. Null groups are numbered as one group.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(partitions, group, *order).sortWithinPartitions(group, *order).withColumn("_part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields) + ", _within bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for b in batches:
            if not b.num_rows:
                continue
            codes = b.column(group).dictionary_encode(null_encoding="encode")
            fresh = np.flatnonzero(np.diff(codes.indices.to_numpy(zero_copy_only=False))) + 1
            starts = np.concatenate([[0], fresh])
            within = np.arange(1, b.num_rows + 1) - np.repeat(starts, np.diff(np.append(starts, b.num_rows)))
            first, end = b.column(group)[0].as_py(), int(fresh[0]) if len(fresh) else b.num_rows
            if seen and first == last:
                within[:end] += seen
            last, seen = b.column(group)[b.num_rows - 1].as_py(), int(within[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(within, pa.int64())], names=[*b.schema.names, "_within"])

    local = materialize(placed.mapInArrow(count, schema), "numbered")
    sums = local.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    joined = local.join(offsets, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return joined.withColumn(name, F.col("_within") + F.col("_before")).drop("_part", "_within", "_g", "_p", "_before")
