"""Putting the control's figures next to those of each test cell.

Both forms work on frames that are aggregated already, one row per cell and group, and
shuffle them by group once; the frame is not joined to itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def beside_control(
    arms: DataFrame, groups: Sequence[str], values: Sequence[str], control_id: int
) -> DataFrame:
    """Test rows, with their values as ``t_<value>`` and the control's as ``c_<value>``."""
    is_control = F.col("test_sub_id") == control_id
    found = F.max(F.when(is_control, F.struct(*values))).over(Window.partitionBy(*groups))
    return (
        arms.withColumn("_control", found)
        .where(~is_control)
        .select(
            *groups,
            F.lit(control_id).alias("c_id"),
            F.col("test_sub_id").alias("t_id"),
            *[F.col(f"_control.{value}").alias(f"c_{value}") for value in values],
            *[F.col(value).alias(f"t_{value}") for value in values],
        )
    )


def every_cell_beside_control(
    arms: DataFrame,
    groups: Sequence[str],
    values: Sequence[str],
    cells: DataFrame,
    labels: Sequence[str],
    control_id: int,
) -> DataFrame:
    """As ``beside_control``, but a test cell also gets a row where only the control has one.

    ``cells`` has one row per cell with its ``labels``; the label columns come from there,
    so they are present on both sides of every row. Values of an absent side are null. A
    group holds at most one entry per cell, and so does the cell list.
    """
    listed = cells.select("test_sub_id", *labels)
    directory = listed.agg(F.collect_list(F.struct("test_sub_id", *labels))).scalar()
    by_cell = F.collect_list(F.struct("test_sub_id", F.struct(*values).alias("figures")))
    grouped = arms.groupBy(*groups).agg(by_cell.alias("_arms"))

    paired = (
        grouped.withColumn("_cells", directory)
        .withColumn("_test", F.explode("_cells"))
        .where(F.col("_test.test_sub_id") != control_id)
        .withColumns(
            {
                "_c": F.get(F.filter("_arms", lambda arm: arm["test_sub_id"] == control_id), F.lit(0)),
                "_t": F.get(
                    F.filter("_arms", lambda arm: arm["test_sub_id"] == F.col("_test.test_sub_id")),
                    F.lit(0),
                ),
                "_control": F.get(
                    F.filter("_cells", lambda one: one["test_sub_id"] == control_id), F.lit(0)
                ),
            }
        )
        .where(F.col("_c").isNotNull() | F.col("_t").isNotNull())
    )
    return paired.select(
        *groups,
        F.lit(control_id).alias("c_id"),
        F.col("_test.test_sub_id").alias("t_id"),
        *[F.col(f"_control.{label}").alias(f"c_{label}") for label in labels],
        *[F.col(f"_test.{label}").alias(f"t_{label}") for label in labels],
        *[F.col(f"_c.figures.{value}").alias(f"c_{value}") for value in values],
        *[F.col(f"_t.figures.{value}").alias(f"t_{value}") for value in values],
    )
