"""Order totals per visitor, at three grains.

A visitor total covers all the visitor's orders in the window. A cell total covers those
placed under one test cell, and a touch total those of one cell and touch date. Analyses
that use the finer grains join them to visitors by visitor id alone, so a visitor with
orders under two cells counts once per cell total there, but once in the visitor grain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.functions.nulls import max_strict, sum_strict

CELL_KEYS = (
    "test_id",
    "visitor_id",
    "test_sub_id",
    "control_test",
    "test_name",
    "test_sub_name",
)
TOUCH_KEYS = (*CELL_KEYS, "touch_date")

GRAINS = ("visitor", "cell", "touch")


def _totals():
    return [
        max_strict("order_count").alias("order_count"),
        sum_strict("booking_usd").alias("booking_usd"),
        sum_strict("gm_usd").alias("gm_usd"),
    ]


def touch_totals(orders: DataFrame) -> DataFrame:
    first_order = F.to_date(F.min("order_date")).alias("first_order_date")
    keyed = orders.withColumn("touch_date", F.to_date("touch_date"))
    return keyed.groupBy(*TOUCH_KEYS).agg(*_totals(), first_order)


def order_profile(orders: DataFrame) -> DataFrame:
    """Touch totals that also carry the cell and visitor totals they belong to.

    One row in each group of a grain has its ``is_<grain>_row`` flag set; keeping the
    flagged rows gives exactly that grain. The raw orders are aggregated before anything
    is partitioned by visitor, so a visitor with very many orders is a handful of rows by
    then, and all the windows run on one sort of one shuffle.
    """
    others = [key for key in CELL_KEYS if key != "visitor_id"]
    windows = {
        "visitor": Window.partitionBy("visitor_id").orderBy(*others, "touch_date"),
        "cell": Window.partitionBy("visitor_id", *others).orderBy("touch_date"),
    }
    totals = {}
    for grain, window in windows.items():
        whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        totals |= {
            f"{grain}_order_count": max_strict("order_count", whole),
            f"{grain}_booking_usd": sum_strict("booking_usd", whole),
            f"{grain}_gm_usd": sum_strict("gm_usd", whole),
            f"is_{grain}_row": F.row_number().over(window) == 1,
        }
    return (
        touch_totals(orders)
        .withColumns(totals)
        .withColumnsRenamed(
            {name: f"touch_{name}" for name in ("order_count", "booking_usd", "gm_usd")}
        )
        .withColumn("is_touch_row", F.lit(True))
        .drop(*others, "touch_date")
    )
