"""Row filters on visitors and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.config import ALTERNATE_CONTROL


def within_days(orders: DataFrame, days: int) -> DataFrame:
    return orders.where(F.col("days_from_touch") <= days)


def hopper_at_most(level: int) -> Column:
    return F.col("is_hopper") <= level


def exposure(exposed_only: bool) -> Column:
    return F.col("exposed_to_test") == 1 if exposed_only else F.lit(True)


def not_alternate() -> Column:
    """Drop the alternate control; a missing role is dropped as well."""
    return F.col("control_test") != ALTERNATE_CONTROL


def buyers_only(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("order_count") > 0)
