"""Frames a report is drawn from, derived from the analysis results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.functions.significance import z_bucket

# Chart code of a result that is not significant, label of the control row.
NOT_SIGNIFICANT = 3
CONTROL_LABEL = "control"


def summary_report(summary: DataFrame, only_cell: int | None = None) -> DataFrame:
    """Wider bounds and the sensitivity for results without significance, else neither."""
    rows = summary if only_cell is None else summary.where(F.col("t_id") == only_cell)
    open_result = F.col("chart_value") == NOT_SIGNIFICANT
    return rows.withColumns(
        {
            "sensitivity": F.when(open_result, F.col("sensitivity")),
            "low80": F.when(open_result, F.col("low95")).otherwise(F.col("low80")),
            "high80": F.when(open_result, F.col("high95")).otherwise(F.col("high80")),
        }
    )


def cohort_report(cohorts: DataFrame) -> DataFrame:
    """Dimension values that were tested, with a bucket for each z."""
    return cohorts.where(F.col("pvalue_cr").isNotNull()).withColumns(
        {
            f"{metric}_chart_value": z_bucket(f"z_score_{metric}")
            for metric in ("bookings_buyer", "gm_buyer", "cr")
        }
    )


def care_report(rates: DataFrame, rate: str) -> DataFrame:
    """The control's rate, then each test cell's with its significance."""
    control = rates.select(
        F.col("control_name").alias("test_sub_name"),
        F.col(f"control_{rate}").alias(rate),
        F.lit(CONTROL_LABEL).alias("significance"),
    ).distinct()
    return control.unionByName(rates.select("test_sub_name", rate, "significance"))


def significant_points(points: DataFrame) -> DataFrame:
    """The points of a sweep or series that are marked on its chart."""
    return points.where(F.col("significant") > 0)


def series_report(series: DataFrame, date: str) -> DataFrame:
    """A series with its sensitivity band where it has one; empty unless it spans two dates."""
    band = {}
    if "sensitivity" in series.columns:
        band = {"band_low": -F.col("sensitivity"), "band_high": F.col("sensitivity")}
    extent = series.agg((F.min(date) < F.max(date)).alias("has_span")).scalar()
    return series.withColumns(band).where(extent)
