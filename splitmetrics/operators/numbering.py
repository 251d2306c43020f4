"""Numbering the rows of a frame in a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.sources.workspace import stage


def numbered(frame: DataFrame, name: str, *order: str | Column) -> DataFrame:
    """Add ``name``: 1, 2, 3, ... in the given order, without sorting all rows in one task.

    Rows are split into ranges of the order and staged with the number of their range, so
    that the split stays as it is. Each range is then numbered by itself and moved up by
    the sizes of the ranges before it.
    """
    ranges = stage(
        frame.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("_range")
        .agg(F.count("*").alias("_size"))
        .select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranges.withColumn("_place", place)
        .join(offsets, "_range")
        .withColumn(name, F.col("_place") + F.col("_offset"))
        .drop("_range", "_place", "_offset")
    )
