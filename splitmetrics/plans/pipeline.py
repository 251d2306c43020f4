"""One run of all analyses of an experiment."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession

from splitmetrics import schema
from splitmetrics.config import EMAIL_TEST, SITE_TEST, ExperimentConfig
from splitmetrics.operators.attribution import attribute_credits, attribute_orders
from splitmetrics.operators.lattice import count_lattice
from splitmetrics.operators.population import Population, traffic
from splitmetrics.plans import care, distribution, reports, series, sweep
from splitmetrics.plans.cohort import cohort_summary
from splitmetrics.plans.summary import summary
from splitmetrics.sources.results import append_run_history, cutoff_frame, save_frames
from splitmetrics.sources.tables import RawTableNames, TableNames, read_table, with_constraint
from splitmetrics.sources.workspace import Workspace, stage, stage_bucketed


@dataclass(frozen=True)
class RawEvents:
    """Orders, credits and contacts that still have to be attributed to visitors."""

    orders: DataFrame
    credits: DataFrame
    contacts: DataFrame

    @classmethod
    def load(cls, spark: SparkSession, names: RawTableNames, folder: str | None = None) -> RawEvents:
        """The raw tables of these names, from the catalog or a folder."""
        return cls(*[read_table(spark, getattr(names, f.name), folder) for f in fields(names)])


@dataclass(frozen=True)
class InputTables:
    """Visitors, with attributed orders, credits and contacts or the raw ones to attribute."""

    visitors: DataFrame
    orders: DataFrame | None = None
    credits: DataFrame | None = None
    contacts: DataFrame | None = None
    raw: RawEvents | None = None

    @classmethod
    def load(
        cls,
        spark: SparkSession,
        config: ExperimentConfig,
        names: TableNames | None = None,
        folder: str | None = None,
        raw: RawTableNames | None = None,
    ) -> InputTables:
        """The tables of the experiment's (type, id), from the catalog or a folder.

        With ``raw``, visitors are read by the experiment and the events by these names.
        The visitor constraint is applied where a run applies it, not here.
        """
        names = names or TableNames(config.test_type_id, config.test_id)
        visitors = read_table(spark, names.visitors, folder)
        if raw is not None:
            return cls(visitors, raw=RawEvents.load(spark, raw, folder))
        parts = (names.orders, names.credits, names.contacts)
        return cls(visitors, *[read_table(spark, name, folder) for name in parts])


@dataclass
class RunResult:
    """Result frames by name, report frames by name, and seconds per stage.

    ``skipped`` names the analyses that were left out for want of cut-offs or of their table, and
    ``complete`` says that there are none. ``close`` deletes what the run staged; the frames
    cannot be read any more then.
    """

    frames: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)
    timings: dict[str, float] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    workspace: Workspace | None = None

    @property
    def complete(self) -> bool:
        return not self.skipped

    def close(self) -> None:
        if self.workspace is not None:
            self.workspace.close()

    def __enter__(self) -> RunResult:
        return self

    def __exit__(self, *_) -> None:
        self.close()


class _Stopwatch:
    def __init__(self, timings: dict[str, float]):
        self.timings = timings
        self.begun = self.last = perf_counter()

    def lap(self, stage_name: str) -> None:
        now = perf_counter()
        self.timings[stage_name] = now - self.last
        self.timings["total_time"] = now - self.begun
        self.last = now


def run(
    tables: InputTables,
    config: ExperimentConfig,
    output: str | None = None,
    history: str | None = None,
    buckets: int | None = None,
) -> RunResult:
    """Run every analysis; save results under ``output`` and timings to ``history`` if given.

    Each result frame is staged when its stage is done, so that the timings are those of
    the work, and reports, saving and the caller's reads do not repeat it. Nothing is
    saved in demo mode. Visitors with contradicting labels or repeated ids are refused. What a run
    that fails has staged is deleted.

    With ``buckets`` the visitors are staged once in so many buckets by id, which is one shuffle of them; the joins of
    attribution, order totals and care rates then leave them where they lie.
    """
    result = RunResult(workspace=Workspace(tables.visitors.sparkSession))
    try:
        with result.workspace.active():
            _run(tables, config, output, history, result, buckets)
    except BaseException:
        result.close()
        raise
    return result


def _run(
    tables: InputTables,
    config: ExperimentConfig,
    output: str | None,
    history: str | None,
    result: RunResult,
    buckets: int | None,
) -> None:
    schema.validate(tables.visitors, schema.VISITORS, "visitors")
    schema.check_visitors(tables.visitors)
    clock = _Stopwatch(result.timings)
    if buckets:
        placed = stage_bucketed(tables.visitors, "visitors", "visitor_id", buckets)
        tables = replace(tables, visitors=placed)

    def keep(name: str, frame: DataFrame) -> DataFrame:
        result.frames[name] = stage(frame, name)
        return result.frames[name]

    attribute = config.rerun_attribution and tables.raw is not None
    if attribute:
        schema.validate(tables.raw.orders, schema.RAW_ORDERS, "raw orders")
        schema.validate(tables.raw.credits, schema.RAW_CREDITS, "raw credits")
        schema.validate(tables.raw.contacts, schema.RAW_CONTACTS, "raw contacts")
        orders = stage(
            attribute_orders(tables.visitors, tables.raw.orders, config.days_to_order), "orders"
        )
    elif tables.orders is not None:
        orders = schema.validate(tables.orders, schema.ORDERS, "orders")
        if tables.credits is not None:
            schema.validate(tables.credits, schema.CREDITS, "credits")
        if tables.contacts is not None:
            schema.validate(tables.contacts, schema.CONTACTS, "contacts")
    else:
        raise ValueError("orders are needed, attributed or raw")
    clock.lap("ordersproc")

    all_traffic = stage(traffic(tables.visitors), "traffic")
    constrained = with_constraint(tables.visitors, config.visitor_constraint)
    own_traffic = (
        stage(traffic(constrained), "own_traffic") if config.visitor_constraint else all_traffic
    )
    wanted = dict.fromkeys([*distribution.SHARE_DIMENSIONS, *config.cohort_dimensions])
    known = [name for name in wanted if name in tables.visitors.columns]
    lattice = stage(count_lattice(tables.visitors, known, config.visitor_constraint), "lattice")
    population = Population(tables.visitors, orders, config, own_traffic, lattice, buckets)
    population.order_rows  # noqa: B018 - staged here, used by everything below
    clock.lap("datapull")

    keep("visitors_by_cell", distribution.visitors_by_cell(all_traffic))
    if config.test_type_id == SITE_TEST:
        keep("hopper_share", distribution.hopper_share(all_traffic))
    if config.test_type_id == EMAIL_TEST:
        keep("exposure_share", distribution.exposure_share(all_traffic))
    by_date = keep("visitors_by_date", distribution.visitors_by_date(all_traffic))
    result.reports["visitors_by_date"] = reports.series_report(by_date, "touch_date")
    by_dimension = stage(
        distribution.dimension_counts(tables.visitors, lattice), "dimension_counts"
    )
    keep("dimension_share", distribution.dimension_share(by_dimension, all_traffic))
    keep("evenness", distribution.evenness(by_dimension, all_traffic))
    clock.lap("datadist")

    for name, analysis in (
        ("gm_sweep", sweep.gm_sweep),
        ("gm_low_curve", sweep.gm_low_curve),
        ("booking_sweep", sweep.booking_sweep),
        ("booking_histogram", sweep.booking_histogram),
    ):
        keep(name, analysis(population))
    for name in ("gm_sweep", "booking_sweep"):
        result.reports[name] = reports.significant_points(result.frames[name])
    clock.lap("outlier")
    if not config.has_cutoffs:
        result.skipped += ["summary", "cohort", "credit", "contact", "daily", "cumulative"]
        return
    clock.lap("userentry")

    result.reports["summary"] = reports.summary_report(keep("summary", summary(population)))
    clock.lap("summary")

    result.reports["cohort"] = reports.cohort_report(keep("cohort", cohort_summary(population)))
    clock.lap("cohort")

    _care(tables, orders, config, attribute, keep, result)
    clock.lap("care")

    daily = keep("daily", series.daily_conversion(population))
    result.reports["daily"] = reports.series_report(daily, "touch_date")
    clock.lap("daily")

    cumulative = keep("cumulative", series.cumulative_conversion(population))
    result.reports["cumulative"] = reports.series_report(cumulative, "dateVariable")
    clock.lap("cumulative")

    if not config.demo_mode:
        spark = tables.visitors.sparkSession
        if output:
            cutoffs = {"cutoffs": cutoff_frame(spark, config)}
            save_frames(result.frames | cutoffs, output, config)
        if history:
            append_run_history(spark, history, config, result.timings)


def _care(tables, orders, config, attribute, keep, result) -> None:
    """Credit and contact rates; one whose table is missing is noted as skipped."""
    if attribute:
        credits = attribute_credits(orders, tables.raw.credits, config.drop_reorders)
        contact = care.contact_rate_from_raw(tables.visitors, tables.raw.contacts, config)
    else:
        credits = tables.credits
        contact = (
            None
            if tables.contacts is None
            else care.contact_rate(tables.visitors, tables.contacts, config)
        )
    if credits is not None:
        rates = keep("credit", care.credit_rate(tables.visitors, orders, credits, config))
        result.reports["credit"] = reports.care_report(rates, "credit_rate")
    else:
        result.skipped.append("credit")
    if contact is not None:
        result.reports["contact"] = reports.care_report(keep("contact", contact), "contact_rate")
    else:
        result.skipped.append("contact")
