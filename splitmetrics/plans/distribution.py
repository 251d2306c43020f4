"""How traffic is spread over cells, dates and visitor dimensions.

The first four frames are small regroupings of ``traffic`` counts, so one pass over the
visitors serves them all. They describe the tables as they are: the visitor constraint
of an analysis does not apply here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.operators import filters
from splitmetrics.operators.lattice import by_dimension, count_lattice
from splitmetrics.operators.numbering import numbered

# The dimensions reported, the width values are cut to, the label of a
# missing value, and the share a value needs to be checked for evenness.
SHARE_DIMENSIONS = ("is_new", "channel_group", "region", "initial_device_type")
VALUE_WIDTH = 30
MISSING_VALUE = "NA"
MIN_SHARE = 0.01

# Class labels.
HOPPER_CLASSES = {1: "visitor hopper", 2: "session hopper", 3: "subsession hopper"}
NO_HOPPER = "Not a hopper"
EXPOSED, NOT_EXPOSED = "exposed to test", "not exposed to test"


def visitors_by_cell(traffic_counts: DataFrame) -> DataFrame:
    """Non-hoppers per cell, the alternate control included."""
    return (
        traffic_counts.where(F.col("is_hopper") == 0)
        .groupBy("test_sub_name", "control_test")
        .agg(F.sum("visitors").alias("no_visitors"))
    )


def _with_share(classes: DataFrame) -> DataFrame:
    total = F.sum("no_visitors").over(Window.partitionBy())
    return classes.withColumn("rawcent", F.try_divide("no_visitors", total))


def hopper_share(traffic_counts: DataFrame) -> DataFrame:
    """Share of all visitors in each hopper class; non-hoppers count in the total only."""
    label = F.lit(NO_HOPPER)
    for level, name in HOPPER_CLASSES.items():
        label = F.when(F.col("is_hopper") == level, name).otherwise(label)
    classes = traffic_counts.groupBy("is_hopper", label.alias("hopper_class")).agg(
        F.sum("visitors").alias("no_visitors")
    )
    return _with_share(classes).where(F.col("is_hopper") > 0)


def exposure_share(traffic_counts: DataFrame) -> DataFrame:
    label = F.when(F.col("exposed_to_test") == 1, EXPOSED).otherwise(NOT_EXPOSED)
    classes = traffic_counts.groupBy(label.alias("exposed_class")).agg(
        F.sum("visitors").alias("no_visitors")
    )
    return _with_share(classes)


def visitors_by_date(traffic_counts: DataFrame) -> DataFrame:
    """Visitors per cell and touch date, nobody left out."""
    return (
        traffic_counts.groupBy("test_sub_name", "touch_date")
        .agg(F.sum("visitors").alias("no_visitors"))
        .orderBy("test_sub_name", "touch_date")
    )


def dimension_counts(visitors: DataFrame, lattice_counts: DataFrame | None = None) -> DataFrame:
    """Non-hoppers per cell and dimension value, the alternate control left out.

    ``lattice_counts`` is ``count_lattice`` of the same visitors by these dimensions at least, if staged already.
    """
    if lattice_counts is None:
        lattice_counts = count_lattice(visitors, SHARE_DIMENSIONS)
    counted = lattice_counts.where(filters.not_alternate() & (F.col("is_hopper") == 0))
    value = F.substring("dimension", 1, VALUE_WIDTH).alias("value")
    return (
        by_dimension(counted, SHARE_DIMENSIONS, "test_sub_name", "visitors")
        .groupBy("test_sub_name", F.col("cohort").alias("dimension"), value)
        .agg(F.sum("visitors").alias("no_visitor"))
        .withColumn(
            "combined_name",
            F.concat("dimension", F.lit(" : "), F.coalesce("value", F.lit(MISSING_VALUE))),
        )
    )


def _share(no_visitors, traffic_counts: DataFrame):
    cells = visitors_by_cell(traffic_counts).where(filters.not_alternate())
    total = cells.agg(F.sum("no_visitors")).scalar()
    return F.bround(F.try_divide(no_visitors, total), 3)


def dimension_share(counts: DataFrame, traffic_counts: DataFrame) -> DataFrame:
    """Share of each dimension value in the traffic, numbered by dimension and falling share."""
    values = (
        counts.groupBy("combined_name", "value", "dimension")
        .agg(F.sum("no_visitor").alias("no_visitors"))
        .withColumn("cent", _share(F.col("no_visitors"), traffic_counts))
    )
    return numbered(values, "index", "dimension", F.desc("cent"), "combined_name", "value")


def evenness(counts: DataFrame, traffic_counts: DataFrame) -> DataFrame:
    """How each value with enough traffic splits over the cells; an even split is no bias."""
    value_total = F.sum("no_visitor").over(Window.partitionBy("dimension", "value"))
    return (
        counts.withColumn("no_visitors", value_total)
        .withColumn("cent", _share(F.col("no_visitors"), traffic_counts))
        .where(F.col("cent") > MIN_SHARE)
        .withColumn("centeven", F.bround(F.try_divide("no_visitor", "no_visitors"), 4))
        .select(
            "value", "dimension", "test_sub_name", "no_visitor", "combined_name",
            "no_visitors", "cent", "centeven",
        )
        .orderBy("dimension", F.desc("cent"), "test_sub_name")
    )
