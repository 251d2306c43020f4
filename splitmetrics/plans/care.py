"""Customer-care rates per test cell against the control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.config import ExperimentConfig
from splitmetrics.functions import significance as sig
from splitmetrics.functions.moments import count_true
from splitmetrics.operators import filters
from splitmetrics.operators.attribution import contacts_after_touch, touch_period
from splitmetrics.operators.pairing import beside_control
from splitmetrics.sources.workspace import stage

_CELL = ("test_sub_id", "test_sub_name")


def _against_control(
    rates: DataFrame, hits: str, rate: str, extra: tuple[str, ...], config: ExperimentConfig
) -> DataFrame:
    """Pooled two-proportion z (control - test) of ``hits`` out of ``shopper_ct``."""
    rated = rates.withColumn(rate, F.try_divide(hits, "shopper_ct"))
    values = ("test_sub_name", "shopper_ct", hits, *extra, rate)
    return (
        beside_control(rated, (), values, config.control_id)
        .withColumn("combined_var", sig.pooled_share(hits, "shopper_ct"))
        .withColumn("SE", sig.pooled_error("combined_var", "shopper_ct"))
        .withColumn("zvalue", F.expr(f"try_divide(c_{rate} - t_{rate}, SE)"))
        .withColumn("significance", sig.care_label("zvalue", config.z_bound))
        .withColumn("relative_diff", sig.relative_change(f"t_{rate}", f"c_{rate}"))
        .selectExpr(
            "t_test_sub_name as test_sub_name",
            "t_id as test_sub_id",
            *[f"t_{v} as {v}" for v in ("shopper_ct", hits, *extra, rate)],
            *[f"c_{v} as control_{v}" for v in ("shopper_ct", hits, rate)],
            "c_test_sub_name as control_name",
            "combined_var",
            "SE",
            "zvalue",
            "significance",
            "relative_diff",
        )
    )


def credit_rate(
    visitors: DataFrame, orders: DataFrame, credits: DataFrame, config: ExperimentConfig
) -> DataFrame:
    """Share of ordering visitors who got a credit.

    All orders count, whatever their distance from the touch, and exposure plays no part.
    Each side is reduced to distinct visitors before the join, which makes the distinct
    counts plain counts and keeps a visitor with many orders or credits to one row.
    """
    ordering = orders.select(*_CELL, "visitor_id").distinct()
    eligible = visitors.where(
        filters.not_alternate() & filters.hopper_at_most(config.credit_hopper_level)
    )
    credited = credits.select("visitor_id").distinct().withColumn("credited", F.lit(True))
    rates = (
        ordering.join(eligible.select("visitor_id").distinct(), "visitor_id", "left_semi")
        .join(credited, "visitor_id", "left")
        .groupBy(*_CELL)
        .agg(
            F.count("*").alias("shopper_ct"),
            count_true("credited").alias("shopper_ct_credited"),
        )
    )
    return _against_control(rates, "shopper_ct_credited", "credit_rate", (), config)


def _identified(visitors: DataFrame, config: ExperimentConfig) -> DataFrame:
    return visitors.where(
        F.col("shopper_key").isNotNull()
        & filters.not_alternate()
        & filters.hopper_at_most(config.contact_hopper_level)
    )


def _distinct_per_cell(rows: DataFrame, column: str, name: str) -> DataFrame:
    """The number of different values in each cell, nulls not counted.

    Rows become one per cell and value before they are counted, so that no cell is one task's work.
    """
    return rows.select(*_CELL, column).distinct().groupBy(*_CELL).agg(F.count(column).alias(name))


def _contact_rate(identified: DataFrame, contacted: DataFrame, config: ExperimentConfig):
    """``contacted`` has a cell, contacting shopper and contact id per row.

    It is reduced to one row for each of these and staged, so the join behind it is made once; both
    counts then group its rows by their own key.
    """
    shoppers = _distinct_per_cell(identified, "shopper_key", "shopper_ct")
    links = stage(contacted.select(*_CELL, "contact_shopper", "contact_id").distinct(), "contacts")
    rates = shoppers
    for column, name in (("contact_shopper", "shopper_ct_contacted"), ("contact_id", "contact_ct")):
        rates = rates.join(_distinct_per_cell(links, column, name), list(_CELL), "left").fillna(0, name)
    return _against_control(
        rates, "shopper_ct_contacted", "contact_rate", ("contact_ct",), config
    )


def contact_rate(visitors: DataFrame, contacts: DataFrame, config: ExperimentConfig) -> DataFrame:
    """Share of identified shoppers who contacted care, from contacts attributed to visitors."""
    identified = _identified(visitors, config)
    made = contacts.select("visitor_id", F.col("shopper_key").alias("contact_shopper"), "contact_id")
    contacted = identified.select("visitor_id", *_CELL).join(made, "visitor_id")
    return _contact_rate(identified, contacted, config)


def contact_rate_from_raw(
    visitors: DataFrame, raw_contacts: DataFrame, config: ExperimentConfig
) -> DataFrame:
    """The same rate straight from raw contacts.

    Touches are reduced to one per cell, shopper and day before they meet the contacts, so
    a shopper with very many visitors does not multiply with that shopper's contacts.
    """
    identified = _identified(visitors, config)
    touches = identified.select(
        *_CELL, "shopper_key", F.to_date("touch_date").alias("touch_date")
    ).distinct()
    contacted = contacts_after_touch(
        touches, raw_contacts, config.contact_days, touch_period(visitors)
    )
    return _contact_rate(
        identified, contacted.withColumnRenamed("shopper_key", "contact_shopper"), config
    )
