"""Conversion over time: by touch date, and cumulated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.functions import significance as sig
from splitmetrics.functions.moments import share_and_variance
from splitmetrics.operators.pairing import beside_control, every_cell_beside_control
from splitmetrics.operators.population import Population

DAILY_COLUMNS = (
    "exp_name", "c_name", "c_id", "t_name", "t_id",
    "c_denominator_count", "c_value", "c_var",
    "t_denominator_count", "t_value", "t_var",
    "z_score", "pvalue", "touch_date", "significant", "per_change",
)


def daily_conversion(population: Population) -> DataFrame:
    """Conversion of each touch date's visitors, per test cell, with a Welch test."""
    counts = population.joined_counts("cell", "touch_date")
    share, variance = share_and_variance("orderers", "visitors")
    arms = counts.selectExpr(
        "touch_date",
        "test_sub_id",
        "valid_visitors as denominator_count",
        "visitors as n",
        f"{share} as value",
        f"{variance} as var",
    )
    paired = every_cell_beside_control(
        arms,
        ("touch_date",),
        ("denominator_count", "n", "value", "var"),
        population.counts(),
        ("test_name", "test_sub_name"),
        population.config.control_id,
    ).fillna(0, ["c_denominator_count", "t_denominator_count"])
    return (
        sig.with_welch(paired)
        .withColumns(
            {
                "exp_name": F.col("c_test_name"),
                "c_name": F.col("c_test_sub_name"),
                "t_name": F.col("t_test_sub_name"),
                "significant": sig.significance_flag("z_score"),
                "per_change": sig.relative_change("t_value", "c_value"),
            }
        )
        .select(*DAILY_COLUMNS)
    )


def date_spine(population: Population) -> DataFrame:
    """Every cell on every day from the first touch to the last first order in the window.

    The last day is taken over all orders, those of ineligible visitors included; touches
    after it are never counted.
    """
    first = population.counts("touch_date").agg(F.min("touch_date")).scalar()
    last = population.last_first_order
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return population.counts().select(
        "test_sub_id", "test_sub_name", F.explode(days).alias("date")
    )


def cumulative_conversion(population: Population) -> DataFrame:
    """Running conversion of each test cell beside the control; z is test minus control."""
    visitors = population.joined_counts("touch", "touch_date").select(
        "test_sub_id", F.col("touch_date").alias("date"), F.col("valid_visitors").alias("visitors")
    )
    buyers = (
        population.ordering("touch")
        .where(F.col("order_count").isNotNull() & (F.col("visitor_id") > 0))
        .groupBy("test_sub_id", F.col("first_order_date").alias("date"))
        .agg(F.count("*").alias("buyers"))
    )
    so_far = (
        Window.partitionBy("test_sub_id")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = (
        date_spine(population)
        .join(visitors, ["test_sub_id", "date"], "left")
        .join(buyers, ["test_sub_id", "date"], "left")
        .fillna(0, ["visitors", "buyers"])
        .withColumns(
            {
                "cum_visitor": F.sum("visitors").over(so_far),
                "cum_buyers": F.sum("buyers").over(so_far),
            }
        )
        .where(F.col("cum_visitor") > 0)
        .withColumn("CR", F.try_divide("cum_buyers", "cum_visitor"))
    )
    paired = beside_control(
        running,
        ("date",),
        ("test_sub_name", "cum_visitor", "cum_buyers", "CR"),
        population.config.control_id,
    ).where(F.col("c_CR").isNotNull())
    return (
        paired.withColumn("sd", sig.unpooled_error("CR", "cum_visitor"))
        .withColumn("zscore", F.expr("try_divide(t_CR - c_CR, sd)"))
        .withColumn("perc_lift", sig.relative_change("t_CR", "c_CR"))
        .withColumn("sensitivity", F.expr(f"try_divide({sig.TWO_TAIL_BOUNDS[95]}D * sd, c_CR)"))
        .withColumn("significant", sig.significance_flag("zscore"))
        .selectExpr(
            "date as dateVariable",
            "c_cum_visitor as cum_visitor_ctrl",
            "c_cum_buyers as cum_buyers_ctrl",
            "c_CR as CR_ctrl",
            "t_test_sub_name as test_sub_name",
            "t_cum_visitor as cum_visitor_test",
            "t_cum_buyers as cum_buyers_test",
            "t_CR as CR_test",
            "perc_lift",
            "sd",
            "sensitivity",
            "zscore",
            "significant",
        )
    )
