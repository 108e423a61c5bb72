"""Numbers in order over a whole table without one task that holds all of it."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from sitefold.plans.shared import materialise


def ranked(df: DataFrame, *order: str, name: str = "id") -> DataFrame:
    """Adds name: 0, 1, ... by the order columns, nulls first. Rows equal in all of them are numbered as they come.

    Rows are cut into ranges, each range is numbered by itself and moved up by the sizes of those before it; only these
    sizes, a number for each shuffle partition, pass through the driver.
    """
    placed = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted(tuple(r) for r in placed.groupBy("_range").agg(F.count(F.lit(1))).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    starts = df.sparkSession.createDataFrame([(k, b) for (k, _), b in zip(sizes, before)], "_range int, _start bigint")
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return placed.join(F.broadcast(starts), "_range").withColumn(name, F.col("_start") + nth - 1).drop("_range", "_start")
