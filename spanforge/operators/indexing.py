"""Dense row numbers over a total order without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def dense_index(df: DataFrame, order_cols: Sequence[str], name: str = "idx",
                partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0..n-1 following ``order_cols`` (which must be a total order).

    Two passes, as a distributed ``zipWithIndex``: range-partition and sort, stamp each
    row with its partition and a per-partition counter, write to the shared folder (so both
    passes see the same numbers even after an executor loss), count rows per partition, turn the
    counts into offsets (one row per partition, so the table is bounded by the partition
    count and broadcast) and add.  No step gathers the data into one task.
    """
    spark = df.sparkSession
    n = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_row", F.monotonically_increasing_id()))
    ranged = materialize(ranged, "index")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = ranged.join(F.broadcast(offsets), "_pid")
    out = out.withColumn(name, (F.col("_offset") + F.col("_row") - F.col("_first")).cast("long"))
    return out.drop("_pid", "_row", "_first", "_offset")
