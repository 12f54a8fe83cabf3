"""Global row numbers without a single-partition window (WN-2).

``row_number() over (order by ...)`` with no partition moves every row into
one task. Instead:

1. range-partition on the (total) sort order and sort inside partitions;
2. tag each row with its partition id and its position in the partition
   (``monotonically_increasing_id`` counts rows per partition in order);
3. write parquet into the shared checkpoint folder, so the ids above are fixed
   even if a task is retried or an executor is lost;
4. count rows per partition (one row per partition), turn the counts into
   start offsets, broadcast them, and add.

No step holds more than one partition's rows in one task, and the only
global step works on one row per partition. Give a total order (add
tie-breaking columns) so that equal keys can still be split across ranges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from personalens.session import checkpoint_dir

_POSITION_BITS = 33  # monotonically_increasing_id = partition id << 33 | row position


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number",
                      num_partitions: int | None = None, copies: str | None = None) -> DataFrame:
    """df with each row's number in ``order``; where ``copies`` names a column, a row stands for that
    many equal rows and gets the number of the first of them."""
    spark = df.sparkSession
    cols = df.columns
    # Without a number, adaptive execution sizes the ranges from the shuffled bytes.
    spread = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    path = f"{checkpoint_dir(spark).rstrip('/')}/ranked/{uuid.uuid4().hex}"
    (spread.sortWithinPartitions(*order)
     .withColumn("_rid", F.monotonically_increasing_id())
     .withColumn("_pid", F.shiftright(F.col("_rid"), _POSITION_BITS))
     .withColumn("_pos", F.col("_rid") - F.shiftleft(F.col("_pid"), _POSITION_BITS))
     .write.parquet(path))
    tagged = spark.read.parquet(path)
    if copies:  # a row's place among the copies of its range: the running sum of the rows before it
        inside = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
        tagged = tagged.withColumn("_pos", F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    counts = spark.read.parquet(path).groupBy("_pid").agg((F.sum(copies) if copies else F.count(F.lit(1))).alias("_cnt"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(before), F.lit(0))
                            .alias("_offset"))
    return (tagged.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_offset") + F.col("_pos") + 1).alias(name)))
