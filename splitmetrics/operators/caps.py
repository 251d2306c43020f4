"""Quantiles of the order totals of visitors, and outlier caps set at them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.operators import filters
from splitmetrics.operators.population import Population
from splitmetrics.operators.quantiles import quantile_values, two_sided_capped, upper_capped

# Upper cut-off levels 0.96 to 0.9875 by 0.0025, then 0.99 to 1 by 0.001;
# the lower level of the margin sweep; low-tail levels 0 to 0.002 by 0.0001.
CUTOFFS = tuple(
    [i / 10_000 for i in range(9_600, 9_876, 25)] + [i / 1_000 for i in range(990, 1_001)]
)
GM_LOW_LEVEL = 0.001
LOW_TAIL = tuple(i / 10_000 for i in range(21))

_MEASURES = ("booking_usd", "gm_usd")
#: Whose totals: all visitors' with or without the alternate control, and the buyers' by cell.
_WITH_ALTERNATE, _WITHOUT_ALTERNATE, _BUYERS = "with_alternate", "without_alternate", "buyers"


def _totals(measure: str) -> dict[str, Column]:
    """The measure of each group of totals, as a column of ``order_rows``; null on other rows."""
    visitor, cell = F.col("is_visitor_row"), F.col("is_cell_row") & (F.col("cell_order_count") > 0)
    return {
        _WITH_ALTERNATE: F.when(visitor, F.col(f"visitor_{measure}")),
        _WITHOUT_ALTERNATE: F.when(visitor & filters.not_alternate(), F.col(f"visitor_{measure}")),
        _BUYERS: F.when(cell & filters.not_alternate(), F.col(f"cell_{measure}")),
    }


def _levels(population: Population) -> dict[tuple[str, str], list[float]]:
    config = population.config
    wanted = {
        (_BUYERS, "booking_usd"): [*CUTOFFS],
        (_BUYERS, "gm_usd"): [*CUTOFFS, GM_LOW_LEVEL, *LOW_TAIL],
    }
    if config.has_cutoffs:
        for group in (_WITH_ALTERNATE, _WITHOUT_ALTERNATE):
            wanted[group, "booking_usd"] = [config.bookings_high]
            wanted[group, "gm_usd"] = [config.gm_low, config.gm_high]
    return wanted


def known_quantiles(population: Population) -> dict[tuple[str, str], dict[float, float] | None]:
    """Every quantile that an analysis of this population asks for, by group, measure and level.

    They all come from one call, made once for a population; None stands for a measure without values.
    """
    if population.quantiles is None:
        wanted = _levels(population)
        columns = {m: _totals(m) for m in _MEASURES}
        rows = population.order_rows.select(
            *[columns[measure][group].alias(f"{group} {measure}") for group, measure in wanted]
        )
        found = quantile_values(rows, {f"{group} {m}": levels for (group, m), levels in wanted.items()})
        population.quantiles = {
            key: values and dict(zip(wanted[key], values, strict=True))
            for key, values in zip(wanted, found.values(), strict=True)
        }
    return population.quantiles


def buyers_quantiles(population: Population, measure: str, levels) -> list[float] | None:
    """Quantiles of the buyers' cell totals at levels of the sweeps."""
    found = known_quantiles(population)[_BUYERS, measure]
    return found and [found[level] for level in levels]


def _caps(population: Population, include_alternate: bool) -> dict[str, list[float] | None]:
    config = population.config
    if not config.has_cutoffs:
        raise ValueError("gm_low, gm_high and bookings_high are needed to cap outliers")
    group = _WITH_ALTERNATE if include_alternate else _WITHOUT_ALTERNATE
    levels = {"booking_usd": [config.bookings_high], "gm_usd": [config.gm_low, config.gm_high]}
    found = {measure: known_quantiles(population)[group, measure] for measure in levels}
    return {m: found[m] and [found[m][level] for level in levels[m]] for m in levels}


def cap_thresholds(population: Population, include_alternate: bool) -> DataFrame:
    """One row: ``booking_usd`` = [upper], ``gm_usd`` = [lower, upper]."""
    caps = _caps(population, include_alternate)
    columns = [
        (F.lit(None) if caps[m] is None else F.array(*map(F.lit, caps[m]))).cast("array<double>").alias(m)
        for m in _MEASURES
    ]
    return population.visitors.sparkSession.range(1).select(*columns)


def capped_ordering(population: Population, include_alternate: bool) -> DataFrame:
    """Visitor-grain order totals with both measures capped at their quantiles.

    Whether the alternate control takes part in setting the caps is up to the analysis.
    The three caps are numbers, so that capping is plain arithmetic on
    constants in the scan of the totals.
    """
    caps = _caps(population, include_alternate)
    capped = {}
    if caps["booking_usd"]:
        capped["booking_usd"] = upper_capped(F.col("booking_usd"), *caps["booking_usd"])
    if caps["gm_usd"]:
        capped["gm_usd"] = two_sided_capped(F.col("gm_usd"), *caps["gm_usd"])
    return population.ordering("visitor", include_alternate).withColumns(capped)
