"""Overall summary: five metrics per test cell against the control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.config import METRICS
from splitmetrics.functions import significance as sig
from splitmetrics.functions.moments import moments, sample_variance, share_and_variance, with_zeros
from splitmetrics.operators.caps import capped_ordering
from splitmetrics.operators.pairing import beside_control
from splitmetrics.operators.population import Population

COLUMNS = (
    "metric", "exp_name", "c_name", "c_id", "t_name", "t_id",
    "c_denominator_count", "c_value", "c_var",
    "t_denominator_count", "t_value", "t_var",
    "z_score", "pvalue", "tail", "tail_type", "sd",
    "low95", "low90", "low80", "relative_diff", "high80", "high90", "high95",
    "significance", "chart_value", "sensitivity",
)


def cell_metrics(population: Population) -> DataFrame:
    """One row per cell and metric: denominator, values counted, mean and sample variance.

    Missing money counts as zero here. Per-visitor metrics take in the visitors without
    orders as that many zeros.
    """
    ordered = "if(order_count is not null, {}, null)"
    bought = (
        capped_ordering(population, include_alternate=False)
        .fillna(0.0, ["booking_usd", "gm_usd"])
        .groupBy("test_sub_id")
        .agg(
            F.count("order_count").alias("found_orderers"),
            *moments(ordered.format("booking_usd"), "buyer_booking"),
            *moments(ordered.format("gm_usd"), "buyer_gm"),
            *moments("booking_usd", "any_booking"),
            *moments("gm_usd", "any_gm"),
        )
    )
    cells = (
        population.counts()
        .join(bought, "test_sub_id", "left")
        .withColumn("orderers", F.expr("coalesce(found_orderers, 0)"))
    )

    def per_buyer(prefix: str) -> tuple[str, str]:
        return f"{prefix}_mean", sample_variance(f"{prefix}_n", f"{prefix}_m2")

    figures = {
        "CR": ("valid_visitors", "visitors", *share_and_variance("orderers", "visitors")),
        "booking_per_buyer": ("orderers", "orderers", *per_buyer("buyer_booking")),
        "gm_per_buyer": ("orderers", "orderers", *per_buyer("buyer_gm")),
        "booking_per_visitor": ("visitors", "visitors", *with_zeros("any_booking", "visitors")),
        "gm_per_visitor": ("visitors", "visitors", *with_zeros("any_gm", "visitors")),
    }
    entries = []
    for metric in METRICS:
        denominator, counted, mean, variance = figures[metric]
        tail = population.config.tail(metric)
        entries.append(
            f"named_struct('metric', '{metric}', 'tail', '{sig.TAIL_LABELS[tail]}',"
            f" 'tail_type', {2 if tail == 0 else 1}, 'denominator_count', {denominator},"
            f" 'n', {counted}, 'value', {mean}, 'var', {variance})"
        )
    return cells.selectExpr(
        "test_sub_id", "test_name", "test_sub_name", f"inline(array({', '.join(entries)}))"
    )


def summary(population: Population) -> DataFrame:
    """Each metric of each test cell: Welch test, confidence ranges, label, sensitivity."""
    values = ("test_name", "test_sub_name", "denominator_count", "n", "value", "var")
    paired = beside_control(
        cell_metrics(population), ("metric", "tail", "tail_type"), values, population.config.control_id
    )
    tested = sig.with_welch(paired).withColumn(
        "sd",
        F.expr(
            "sqrt(try_divide(t_var, t_denominator_count) + try_divide(c_var, c_denominator_count))"
        ),
    )
    limits = {
        f"{name}{level}": sig.confidence_limit("c_value", "t_value", "sd", "tail_type", level, side)
        for name, side in (("low", "-"), ("high", "+"))
        for level in (95, 90, 80)
    }
    derived = tested.withColumns(
        {
            **limits,
            "exp_name": F.col("c_test_name"),
            "c_name": F.col("c_test_sub_name"),
            "t_name": F.col("t_test_sub_name"),
            "relative_diff": sig.relative_change("t_value", "c_value"),
            "significance": sig.tail_label("z_score", "tail"),
            "chart_value": sig.chart_code("z_score", "tail"),
            "sensitivity": F.expr(f"try_divide({sig.bound('tail_type', 95)} * sd, c_value)"),
        }
    )
    # Rates are shown in percent; everything relative was derived before.
    in_percent = {
        value: F.expr(f"if(metric = 'CR', {value} * 100, {value})")
        for value in ("c_value", "t_value")
    }
    return derived.withColumns(in_percent).select(*COLUMNS)
