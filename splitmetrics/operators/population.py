"""The visitors of an analysis and what they ordered.

Most visitors buy nothing, and for them every measure is null or zero. So the visitor
table is only ever counted (a partial aggregation, no row shuffled), while the join to
orders keeps the buyers alone; means and variances over all visitors follow from the
two together. The join result is staged once and serves every analysis of a run.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.config import ALL_DIMENSIONS, ExperimentConfig
from splitmetrics.functions.moments import count_true
from splitmetrics.operators import filters, rollups
from splitmetrics.operators.lattice import CELL_COLUMNS, IN_ANALYSIS, count_lattice
from splitmetrics.sources.tables import with_constraint
from splitmetrics.sources.workspace import stage, stage_bucketed


def traffic(visitors: DataFrame) -> DataFrame:
    """Visitor counts by cell, hopper level, exposure and touch date: a few thousand rows."""
    return (
        visitors.withColumn("touch_date", F.to_date("touch_date"))
        .groupBy(*CELL_COLUMNS, "is_hopper", "exposed_to_test", "touch_date")
        .agg(
            F.count("*").alias("visitors"),
            count_true("visitor_id > 0").alias("valid_visitors"),
        )
    )


class Population:
    """Eligible visitors (hoppers and unexposed visitors removed) and their order totals."""

    def __init__(
        self,
        visitors: DataFrame,
        orders: DataFrame,
        config: ExperimentConfig,
        traffic_counts: DataFrame | None = None,
        lattice_counts: DataFrame | None = None,
        buckets: int | None = None,
    ):
        """``traffic_counts`` is ``traffic`` of the constrained visitors, if staged already.

        ``lattice_counts`` is ``count_lattice`` of all visitors with the constraint and the cohort dimensions at
        least. Where the visitors are bucketed by id, ``buckets`` says how often.
        """
        self.config = config
        self._eligible = filters.hopper_at_most(config.max_hopper_level) & filters.exposure(
            config.exposed_only
        )
        self._kept = with_constraint(visitors, config.visitor_constraint)
        self.visitors = self._kept.where(self._eligible)
        self.orders = filters.within_days(orders, config.days_to_consider)
        self._traffic_counts = traffic_counts
        self._lattice_counts = lattice_counts
        self._buckets = buckets
        #: Filled by ``caps.known_quantiles``.
        self.quantiles: dict | None = None

    @cached_property
    def dimensions(self) -> list[str]:
        wanted = (*ALL_DIMENSIONS, *self.config.cohort_dimensions)
        return [name for name in dict.fromkeys(wanted) if name in self.visitors.columns]

    @cached_property
    def _traffic(self) -> DataFrame:
        if self._traffic_counts is not None:
            return self._traffic_counts
        return traffic(self._kept)

    @property
    def taking_part(self) -> Column:
        """Not an alternate control, unless it is the one compared with."""
        return filters.not_alternate() | (F.col("test_sub_id") == self.config.control_id)

    def counts(self, *keys: str, alternate_as_control: bool = False) -> DataFrame:
        """Visitors by cell and further keys; names are those of the cell.

        The alternate control is left out, unless it may be the control and is.
        """
        chosen = self.taking_part if alternate_as_control else filters.not_alternate()
        eligible = self._traffic.where(self._eligible & chosen)
        return eligible.groupBy("test_sub_id", *keys).agg(
            F.min("test_name").alias("test_name"),
            F.min("test_sub_name").alias("test_sub_name"),
            F.sum("visitors").alias("visitors"),
            F.sum("valid_visitors").alias("valid_visitors"),
        )

    @property
    def counts_by_dimension(self) -> DataFrame:
        """Eligible visitors by cell and all cohort dimensions, with the alternate control only if compared with."""
        counted = self._lattice_counts
        if counted is None:
            counted = count_lattice(self._kept, self.config.cohort_dimensions)
        return counted.where(F.col(IN_ANALYSIS) & self._eligible & self.taking_part)

    @property
    def last_first_order(self) -> Column:
        """The latest first order of any touch, of ineligible visitors as well."""
        return rollups.touch_totals(self.orders).agg(F.max("first_order_date")).scalar()

    @cached_property
    def order_rows(self) -> DataFrame:
        """Order totals of the eligible visitors, with the visitor's attributes, staged.

        The profile has a few rows for a visitor at most and is partitioned by visitor already; it is
        broadcast if it turns out small, so that the visitors are not shuffled. With bucketed visitors it is
        staged in the same buckets, and the join moves neither side whatever their sizes.
        """
        visitor_columns = dict.fromkeys([*CELL_COLUMNS, "touch_date", *self.dimensions])
        eligible = self.visitors.select("visitor_id", *visitor_columns).withColumn(
            "touch_date", F.to_date("touch_date")
        )
        profile = rollups.order_profile(self.orders)
        if self._buckets:
            profile = stage_bucketed(profile, "order_profile", "visitor_id", self._buckets)
        return stage(profile.join(eligible, "visitor_id"), "order_rows")

    def ordering(self, grain: str, include_alternate: bool = False) -> DataFrame:
        """Eligible visitors with orders in the window, one row per total of the grain."""
        if grain not in rollups.GRAINS:
            raise ValueError(f"grain is one of {rollups.GRAINS}")
        chosen = F.col(f"is_{grain}_row")
        if not include_alternate:
            chosen = chosen & filters.not_alternate()
        measures = [
            F.col(f"{grain}_{name}").alias(name) for name in ("order_count", "booking_usd", "gm_usd")
        ]
        return self.order_rows.where(chosen).select(
            "visitor_id",
            *CELL_COLUMNS,
            "touch_date",
            *self.dimensions,
            "is_visitor_row",
            "first_order_date",
            *measures,
        )

    def joined_counts(self, grain: str, *keys: str) -> DataFrame:
        """Rows and orderers of visitors left-joined to the totals of a grain, by cell and keys.

        A visitor with several totals takes several rows, as in the join itself.
        """
        extra = self.ordering(grain).groupBy("test_sub_id", *keys).agg(
            count_true("not is_visitor_row").alias("_extra"),
            count_true("not is_visitor_row and visitor_id > 0").alias("_extra_valid"),
            F.count("order_count").alias("_orderers"),
        )
        return (
            self.counts(*keys)
            .join(extra, ["test_sub_id", *keys], "left")
            .selectExpr(
                "test_sub_id",
                *keys,
                "visitors + coalesce(_extra, 0) as visitors",
                "valid_visitors + coalesce(_extra_valid, 0) as valid_visitors",
                "coalesce(_orderers, 0) as orderers",
            )
        )
