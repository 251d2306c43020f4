"""The summary broken down by visitor dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.functions import significance as sig
from splitmetrics.functions.moments import (
    count_true,
    moments,
    sample_variance,
    share_and_variance,
)
from splitmetrics.operators.caps import capped_ordering
from splitmetrics.operators.lattice import by_dimension
from splitmetrics.operators.pairing import every_cell_beside_control
from splitmetrics.operators.population import Population

# An arm needs more visitors and more orderers than this to be tested.
MIN_VISITORS = 500
MIN_ORDERERS = 30

COLUMNS = (
    "exp_name", "c_name", "c_id", "t_name", "t_id", "cohort", "dimension",
    "c_count", "t_count", "c_ordering_visitor_count", "t_ordering_visitor_count",
    "c_gm", "t_gm", "c_bookings", "t_bookings",
    "pvalue_gm_buyer", "pvalue_bookings_buyer", "pvalue_cr",
    "z_score_gm_buyer", "z_score_bookings_buyer", "z_score_cr",
    "c_cr", "t_cr", "c_bookings_buyer", "t_bookings_buyer", "c_gm_buyer", "t_gm_buyer",
    "bookings_buyer_diff", "gm_buyer_diff", "cr_diff",
)

_KEYS = ("cohort", "dimension", "test_sub_id")


def cohort_arms(population: Population) -> DataFrame:
    """Statistics of each cell within each dimension value; a null value is a value too.

    The caps are set with the alternate control still in. Buyer statistics leave out
    missing money instead of counting it as zero.
    """
    names = tuple(population.config.cohort_dimensions)
    taking_part = population.taking_part
    # Visitors are counted before they are listed once per dimension.
    visitors = (
        by_dimension(
            population.counts_by_dimension, names, "test_sub_id", "visitors", "valid_visitors"
        )
        .groupBy(*_KEYS)
        .agg(F.sum("visitors").alias("visitors"), F.sum("valid_visitors").alias("count"))
    )
    measures = ("test_sub_id", "order_count", "booking_usd", "gm_usd")
    bought = (
        by_dimension(
            capped_ordering(population, include_alternate=True).where(taking_part), names, *measures
        )
        .groupBy(*_KEYS)
        .agg(
            F.count("order_count").alias("orderers"),
            count_true("order_count > 0").alias("ordering_visitor_count"),
            F.sum("gm_usd").alias("gm"),
            F.sum("booking_usd").alias("bookings"),
            *moments("gm_usd", "gm"),
            *moments("booking_usd", "bookings"),
        )
        .withColumnsRenamed({"cohort": "_cohort", "dimension": "_dimension", "test_sub_id": "_cell"})
    )
    same = (
        (F.col("cohort") == F.col("_cohort"))
        & F.col("dimension").eqNullSafe(F.col("_dimension"))
        & (F.col("test_sub_id") == F.col("_cell"))
    )
    share, share_var = share_and_variance("coalesce(orderers, 0)", "visitors")
    return visitors.join(bought, same, "left").selectExpr(
        *_KEYS,
        "visitors",
        "count",
        "coalesce(ordering_visitor_count, 0) as ordering_visitor_count",
        "coalesce(gm, 0) as gm",
        "coalesce(bookings, 0) as bookings",
        f"{share} as share",
        f"{share_var} as share_var",
        *[f"{m}_{part}" for m in ("gm", "bookings") for part in ("n", "mean")],
        *[f"{sample_variance(f'{m}_n', f'{m}_m2')} as {m}_var" for m in ("gm", "bookings")],
    )


def cohort_summary(population: Population) -> DataFrame:
    """Per dimension value and test cell: counts, values per buyer, tests where arms suffice."""
    arms = cohort_arms(population)
    figures = [name for name in arms.columns if name not in _KEYS]
    paired = every_cell_beside_control(
        arms,
        ("cohort", "dimension"),
        figures,
        population.counts(alternate_as_control=True),
        ("test_name", "test_sub_name"),
        population.config.control_id,
    ).fillna(
        0,
        [
            f"{side}_{name}"
            for side in "ct"
            for name in ("count", "ordering_visitor_count", "gm", "bookings")
        ],
    )
    enough = " and ".join(
        f"{side}_count > {MIN_VISITORS} and {side}_ordering_visitor_count > {MIN_ORDERERS}"
        for side in "ct"
    )
    for name, arm in {
        "gm_buyer": ("gm_n", "gm_mean", "gm_var"),
        "bookings_buyer": ("bookings_n", "bookings_mean", "bookings_var"),
        "cr": ("visitors", "share", "share_var"),
    }.items():
        paired = sig.with_welch(
            paired, *arm, z=f"z_score_{name}", p=f"pvalue_{name}", when=enough
        )
    rates = {
        f"{side}_{rate}": F.try_divide(f"{side}_{top}", f"{side}_{bottom}")
        for side in "ct"
        for rate, top, bottom in (
            ("cr", "ordering_visitor_count", "count"),
            ("bookings_buyer", "bookings", "ordering_visitor_count"),
            ("gm_buyer", "gm", "ordering_visitor_count"),
        )
    }
    differences = {
        f"{rate}_diff": F.expr(f"if(c_{rate} = 0, 0D, try_divide(t_{rate} - c_{rate}, c_{rate}))")
        for rate in ("bookings_buyer", "gm_buyer", "cr")
    }
    labels = {
        "exp_name": F.col("c_test_name"),
        "c_name": F.col("c_test_sub_name"),
        "t_name": F.col("t_test_sub_name"),
    }
    return paired.withColumns(rates).withColumns(differences | labels).select(*COLUMNS)
