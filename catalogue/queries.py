"""Every operator and analysis as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from splitmetrics.config import ALL_DIMENSIONS, ExperimentConfig
from splitmetrics.operators import attribution
from splitmetrics.operators.caps import cap_thresholds, capped_ordering
from splitmetrics.operators.population import Population, traffic
from splitmetrics.operators.quantiles import exact_quantiles
from splitmetrics.plans import care, distribution, reports, series, sweep
from splitmetrics.plans.cohort import cohort_summary
from splitmetrics.plans.pipeline import InputTables, run
from splitmetrics.plans.summary import summary
from splitmetrics.sources import results, sample_tables
from splitmetrics.sources.tables import (
    RawTableNames,
    TableNames,
    read_chunks,
    with_constraint,
)
from splitmetrics.sources.workspace import new_path, stage

Query = Callable[[SparkSession, str], DataFrame]

CONFIG = ExperimentConfig(
    test_id=1, test_type_id=1, control_id=100, gm_low=0.001, gm_high=0.99, bookings_high=0.99
)
ONE_TAILED = replace(CONFIG, tails={"booking_per_buyer": -1, "gm_per_buyer": 1})
ALL_COHORTS = replace(
    CONFIG,
    cohort_dimensions=ALL_DIMENSIONS,
)
CHUNKS = 4
CONSTRAINT = "and region = 'EUROPE' and is_new = 1"
EITHER_CONSTRAINT = "AND (region = 'EUROPE' and is_new = 1) or region = 'ASIA'"
QUANTILE_LEVELS = (0.0, 0.001, 0.25, 0.5, 0.9, 0.99, 0.999, 1.0)


# Sums differ between engines in the last bits, and cents divided by small counts often end
# in an exact 5 at the digit that decides rounding. Both sides move such ties up alike.
NUDGE = 1 + 1e-11


def comparable(frame: DataFrame) -> DataFrame:
    """Doubles to six digits, whole numbers as bigint, dates as text: alike in any engine.

    P-values are compared by their logarithms, since the small ones differ in no six digits.
    """
    columns = []
    for field in frame.schema:
        column = F.col(field.name)
        if field.name.startswith("pvalue"):
            column = F.round(F.log10(column), 5) + 0.0
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column * NUDGE, 6)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def _population(spark: SparkSession, folder: str, config: ExperimentConfig = CONFIG) -> Population:
    return Population(
        sample_tables.visitors(spark, folder), sample_tables.orders(spark, folder), config
    )


def _of_population(
    analysis: Callable[[Population], DataFrame], config: ExperimentConfig = CONFIG
) -> Query:
    return lambda spark, folder: analysis(_population(spark, folder, config))


def _of_traffic(frame: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: frame(traffic(sample_tables.visitors(spark, folder)))


def _of_dimensions(frame: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark, folder):
        visitors = sample_tables.visitors(spark, folder)
        return frame(stage(distribution.dimension_counts(visitors), "counts"), traffic(visitors))

    return query


def chunked_import(spark, folder):
    """Imports by key in chunks, each appended to those before, without and with a constraint."""
    visitors = sample_tables.visitors(spark, folder)
    imports = [
        read_chunks(visitors, "visitor_id", CHUNKS, constraint).select(
            F.lit(name).alias("import"), "visitor_id"
        )
        for name, constraint in (("all", None), ("some", EITHER_CONSTRAINT))
    ]
    return (
        imports[0]
        .unionByName(imports[1])
        .groupBy("import", (F.col("visitor_id") % CHUNKS).alias("chunk"))
        .agg(F.count("*").alias("rows"), F.sum("visitor_id").alias("key_sum"))
    )


def constrained_import(spark, folder):
    return (
        with_constraint(sample_tables.visitors(spark, folder), CONSTRAINT)
        .groupBy("test_sub_id")
        .agg(F.count("*").alias("rows"), F.sum("visitor_id").alias("key_sum"))
    )


def save_and_reload(spark, folder):
    """Save two experiments side by side, save one again, and load that one."""
    base = new_path(spark, "results")
    histogram = sweep.booking_histogram(_population(spark, folder))
    other = replace(CONFIG, test_id=2)
    results.save_frames({"booking_histogram": histogram}, base, CONFIG)
    results.save_frames({"booking_histogram": histogram.where("bucket < 10")}, base, other)
    results.save_frames({"booking_histogram": histogram.where("bucket >= 10")}, base, CONFIG)
    return results.load_frame(spark, base, "booking_histogram", CONFIG)


def run_history_append(spark, folder):
    """Which stages a run that stops after the sweeps has timed, and one that does not.

    Timings themselves differ from run to run, so the row says where there are none, and
    that the total covers the stages.
    """
    path = new_path(spark, "history")
    tables = sample_tables.input_tables(spark, folder)
    other = replace(CONFIG, test_id=2, gm_low=None, rerun_attribution=False)
    with run(tables, other) as first:
        results.append_run_history(spark, path, other, first.timings)
    with run(tables, replace(CONFIG, rerun_attribution=False), history=path):
        pass
    history = results.read_run_history(spark, path)
    timed = [stage_name for stage_name in results.STAGES if stage_name != "total_time"]
    spent = sum((F.coalesce(F.col(name), F.lit(0.0)) for name in timed), F.lit(0.0))
    return history.select(
        "test_id",
        "test_type_id",
        *[F.col(name).isNull().alias(f"no_{name}") for name in timed],
        (F.col("total_time") >= spent - 1e-6).alias("total_covers_stages"),
    )


#: What identifies a row of each result frame.
_RUN_KEYS = {
    "visitors_by_cell": "test_sub_name, control_test",
    "hopper_share": "is_hopper",
    "visitors_by_date": "test_sub_name, touch_date",
    "dimension_share": "dimension, coalesce(value, 'NA'), no_visitors",
    "evenness": "dimension, coalesce(value, 'NA'), test_sub_name, no_visitor",
    "gm_sweep": "t_id, int(round(cutoff_perc_max * 10000)), t_denominator_count",
    "gm_low_curve": "int(round(quantile_point * 10000))",
    "booking_sweep": "t_id, int(round(cutoff_perc_max * 10000)), t_visitors_flattened",
    "booking_histogram": "bucket, test_sub_name, no_of_ordering_visitors",
    "summary": "metric, t_id, t_denominator_count",
    "cohort": "cohort, coalesce(dimension, 'NA'), t_id, t_count, t_ordering_visitor_count",
    "credit": "test_sub_id",
    "contact": "test_sub_id, shopper_ct, contact_ct",
    "daily": "touch_date, t_id, t_denominator_count",
    "cumulative": "dateVariable, test_sub_name, cum_visitor_test, cum_buyers_test",
}


def _frame_digests(frames: dict[str, DataFrame]) -> DataFrame:
    """For each frame its number of rows and a digest of their keys and counts, in order."""
    digests = []
    for name, keys in _RUN_KEYS.items():
        key = F.expr(f"concat_ws('|', {keys})")
        joined = F.array_join(F.array_sort(F.collect_list(key)), ",")
        digests.append(
            frames[name].agg(
                F.lit(name).alias("frame"), F.count("*").alias("rows"), F.md5(joined).alias("keys")
            )
        )
    return reduce(DataFrame.unionByName, digests)


def full_run_row_counts(spark, folder):
    return _frame_digests(run(sample_tables.input_tables(spark, folder), CONFIG).frames)


def run_by_name(spark, folder):
    """Save the sample tables under the names of the experiment, load them by (type, id), and run."""
    tables, base = sample_tables.input_tables(spark, folder), new_path(spark, "named_tables")
    names = TableNames(CONFIG.test_type_id, CONFIG.test_id)
    tables.visitors.write.parquet(f"{base}/{names.visitors}")
    for event, name in asdict(RawTableNames()).items():
        getattr(tables.raw, event).write.parquet(f"{base}/{name}")
    loaded = InputTables.load(spark, CONFIG, folder=base, raw=RawTableNames())
    return _frame_digests(run(loaded, CONFIG).frames)


def order_attribution(spark, folder):
    return attribution.attribute_orders(
        sample_tables.visitors(spark, folder),
        sample_tables.raw_orders(spark, folder),
        CONFIG.days_to_order,
    )


def credit_attribution(spark, folder):
    return attribution.attribute_credits(
        sample_tables.orders(spark, folder),
        sample_tables.raw_credits(spark, folder),
        drop_reorders=True,
    )


def contact_attribution(spark, folder):
    return attribution.attribute_contacts(
        sample_tables.visitors(spark, folder),
        sample_tables.raw_contacts(spark, folder),
        CONFIG.contact_days,
    )


def contact_links(spark, folder):
    """Touch classes with their visitors and contacts, without a row for each pair."""
    links = attribution.link_contacts(
        sample_tables.visitors(spark, folder),
        sample_tables.raw_contacts(spark, folder),
        CONFIG.contact_days,
    )
    return links.classes


def population(population: Population) -> DataFrame:
    """Visitors and orderers of each cell and touch date, at the visitor grain."""
    return population.joined_counts("visitor", "touch_date")


_TOTALS = ("order_count", "booking_usd", "gm_usd")


def visitor_order_rollup(population: Population) -> DataFrame:
    return population.ordering("visitor").select("visitor_id", "test_sub_id", *_TOTALS)


def buyer_rollup(population: Population) -> DataFrame:
    return population.ordering("cell").select("visitor_id", "test_sub_id", *_TOTALS)


def first_order_rollup(population: Population) -> DataFrame:
    return population.ordering("touch").select(
        "visitor_id", "test_sub_id", "first_order_date", *_TOTALS
    )


def cap_values(population: Population) -> DataFrame:
    caps = cap_thresholds(population, include_alternate=False)
    return caps.select(
        F.col("booking_usd")[0].alias("booking_high"),
        F.col("gm_usd")[0].alias("gm_low"),
        F.col("gm_usd")[1].alias("gm_high"),
    )


def capped_values(population: Population) -> DataFrame:
    capped = capped_ordering(population, include_alternate=False)
    return capped.select("visitor_id", "booking_usd", "gm_usd")


def quantiles_by_rank(spark, folder):
    """Quantiles over all line items."""
    prices = sample_tables._table(spark, folder, "lineitem").select("l_extendedprice")
    found = exact_quantiles(prices, {"l_extendedprice": QUANTILE_LEVELS})
    levels = F.array(*[F.lit(level) for level in QUANTILE_LEVELS])
    return found.select(
        F.inline(
            F.transform(
                "l_extendedprice",
                lambda price, i: F.struct(
                    F.get(levels, i).alias("level"), price.alias("price")
                ),
            )
        )
    )


_SUMMARY_KEYS = ("metric", "t_id")
_SUMMARY_TEST = (
    "exp_name", "c_name", "c_id", "t_name",
    "c_denominator_count", "c_value", "c_var",
    "t_denominator_count", "t_value", "t_var", "z_score", "pvalue",
)


def summary_metrics(population: Population) -> DataFrame:
    return summary(population).select(*_SUMMARY_KEYS, *_SUMMARY_TEST)


def summary_significance(population: Population) -> DataFrame:
    return summary(population).drop(*_SUMMARY_TEST)


def credit_rate(spark, folder):
    return care.credit_rate(
        sample_tables.visitors(spark, folder),
        sample_tables.orders(spark, folder),
        sample_tables.credits(spark, folder),
        CONFIG,
    )


def contact_rate(spark, folder):
    return care.contact_rate(
        sample_tables.visitors(spark, folder), sample_tables.contacts(spark, folder), CONFIG
    )


def contact_rate_from_raw(spark, folder):
    return care.contact_rate_from_raw(
        sample_tables.visitors(spark, folder), sample_tables.raw_contacts(spark, folder), CONFIG
    )


def care_report(spark, folder):
    credit = reports.care_report(credit_rate(spark, folder), "credit_rate")
    contact = reports.care_report(contact_rate(spark, folder), "contact_rate")
    return credit.select(
        F.lit("credit").alias("report"), "test_sub_name", F.col("credit_rate").alias("rate"), "significance"
    ).unionByName(
        contact.select(
            F.lit("contact").alias("report"), "test_sub_name", F.col("contact_rate").alias("rate"), "significance"
        )
    )


def series_points(population: Population) -> DataFrame:
    """Marked points of both series, and the band of the cumulative one."""
    daily = reports.series_report(series.daily_conversion(population), "touch_date")
    cumulative = reports.series_report(series.cumulative_conversion(population), "dateVariable")
    none = F.lit(None).cast("double")
    return (
        reports.significant_points(daily)
        .select(
            F.lit("daily").alias("series"),
            F.col("touch_date").alias("date"),
            F.col("t_name").alias("test_sub_name"),
            F.col("per_change").alias("change"),
            none.alias("band_low"),
            none.alias("band_high"),
        )
        .unionByName(
            reports.significant_points(cumulative).select(
                F.lit("cumulative").alias("series"),
                F.col("dateVariable").alias("date"),
                "test_sub_name",
                F.col("perc_lift").alias("change"),
                "band_low",
                "band_high",
            )
        )
    )


def sweep_points(population: Population) -> DataFrame:
    both = sweep.gm_sweep(population).unionByName(sweep.booking_sweep(population))
    return reports.significant_points(both).select(
        "metric", "t_id", "cutoff_perc_max", "per_change"
    )


_QUERIES: dict[str, Query] = {
    "chunked_import": chunked_import,
    "constrained_import": constrained_import,
    "save_and_reload": save_and_reload,
    "run_history_append": run_history_append,
    "order_attribution": order_attribution,
    "credit_attribution": credit_attribution,
    "contact_attribution": contact_attribution,
    "contact_links": contact_links,
    "visitor_order_rollup": _of_population(visitor_order_rollup),
    "buyer_rollup": _of_population(buyer_rollup),
    "first_order_rollup": _of_population(first_order_rollup),
    "population": _of_population(population),
    "cap_thresholds": _of_population(cap_values),
    "capped_values": _of_population(capped_values),
    "quantiles_by_rank": quantiles_by_rank,
    "gm_low_curve": _of_population(sweep.gm_low_curve),
    "summary_metrics": _of_population(summary_metrics),
    "summary_significance": _of_population(summary_significance, ONE_TAILED),
    "cohort_metrics": _of_population(cohort_summary, ALL_COHORTS),
    "booking_sweep": _of_population(sweep.booking_sweep),
    "booking_histogram": _of_population(sweep.booking_histogram),
    "gm_sweep": _of_population(sweep.gm_sweep),
    "credit_rate": credit_rate,
    "contact_rate": contact_rate,
    "contact_rate_from_raw": contact_rate_from_raw,
    "daily_conversion": _of_population(series.daily_conversion),
    "cumulative_conversion": _of_population(series.cumulative_conversion),
    "visitors_by_cell": _of_traffic(distribution.visitors_by_cell),
    "hopper_share": _of_traffic(distribution.hopper_share),
    "exposure_share": _of_traffic(distribution.exposure_share),
    "visitors_by_date": _of_traffic(distribution.visitors_by_date),
    "dimension_share": _of_dimensions(distribution.dimension_share),
    "evenness": _of_dimensions(distribution.evenness),
    "full_run_row_counts": full_run_row_counts,
    "run_by_name": run_by_name,
    "summary_report": _of_population(lambda p: reports.summary_report(summary(p), 101)),
    "traffic_report": _of_traffic(
        lambda t: reports.series_report(distribution.visitors_by_date(t), "touch_date")
    ),
    "cohort_report": _of_population(lambda p: reports.cohort_report(cohort_summary(p)), ALL_COHORTS),
    "care_report": care_report,
    "series_points": _of_population(series_points),
    "sweep_points": _of_population(sweep_points),
}


def queries() -> dict[str, Query]:
    def wrapped(query: Query) -> Query:
        return lambda spark, folder: comparable(query(spark, folder))

    return {name: wrapped(query) for name, query in _QUERIES.items()}
