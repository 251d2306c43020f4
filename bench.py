"""Time the headline analyses; prints one JSON line.

The experiment tables are derived from the sample tables and written once, since an
analysis starts from tables that exist; that time is reported as ``inputs``. Each query is
run once to warm up and then timed as the median of BENCH_REPEATS runs. The stages of one
full run, from raw events to all result frames, are listed as well.
"""

from __future__ import annotations

import json
import os
from dataclasses import fields
from statistics import median
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession

from catalogue.queries import ALL_COHORTS, CONFIG
from splitmetrics.operators import attribution
from splitmetrics.operators.population import Population, traffic
from splitmetrics.plans import care, distribution, series, sweep
from splitmetrics.plans.cohort import cohort_summary
from splitmetrics.plans.pipeline import InputTables, RawEvents, run
from splitmetrics.plans.summary import summary
from splitmetrics.sources import sample_tables
from splitmetrics.sources.workspace import stage

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("splitmetrics-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # Recording the Python call site of every expression costs more than small plans do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def staged_inputs(spark: SparkSession) -> InputTables:
    derived = sample_tables.input_tables(spark, FOLDER)
    raw = {f.name: stage(getattr(derived.raw, f.name), f.name) for f in fields(RawEvents)}
    names = ("visitors", "orders", "credits", "contacts")
    return InputTables(
        **{name: stage(getattr(derived, name), name) for name in names}, raw=RawEvents(**raw)
    )


def headline(tables: InputTables) -> dict[str, callable]:
    visitors, raw = tables.visitors, tables.raw

    def of_population(analysis, config=CONFIG):
        return lambda: analysis(Population(visitors, tables.orders, config))

    def of_dimensions(frame):
        return lambda: frame(
            stage(distribution.dimension_counts(visitors), "counts"), traffic(visitors)
        )

    return {
        "order_attribution": lambda: attribution.attribute_orders(visitors, raw.orders, 7),
        "credit_attribution": lambda: attribution.attribute_credits(
            tables.orders, raw.credits, True
        ),
        "contact_attribution": lambda: attribution.attribute_contacts(visitors, raw.contacts, 7),
        "summary_metrics": of_population(summary),
        "cohort_metrics": of_population(cohort_summary, ALL_COHORTS),
        "booking_sweep": of_population(sweep.booking_sweep),
        "booking_histogram": of_population(sweep.booking_histogram),
        "gm_sweep": of_population(sweep.gm_sweep),
        "gm_low_curve": of_population(sweep.gm_low_curve),
        "credit_rate": lambda: care.credit_rate(visitors, tables.orders, tables.credits, CONFIG),
        "contact_rate": lambda: care.contact_rate(visitors, tables.contacts, CONFIG),
        "contact_rate_from_raw": lambda: care.contact_rate_from_raw(
            visitors, raw.contacts, CONFIG
        ),
        "daily_conversion": of_population(series.daily_conversion),
        "cumulative_conversion": of_population(series.cumulative_conversion),
        "visitors_by_cell": lambda: distribution.visitors_by_cell(traffic(visitors)),
        "hopper_share": lambda: distribution.hopper_share(traffic(visitors)),
        "exposure_share": lambda: distribution.exposure_share(traffic(visitors)),
        "visitors_by_date": lambda: distribution.visitors_by_date(traffic(visitors)),
        "dimension_share": of_dimensions(distribution.dimension_share),
        "evenness": of_dimensions(distribution.evenness),
    }


def _seconds(query) -> float:
    begun = perf_counter()
    frame: DataFrame = query()
    frame.write.format("noop").mode("overwrite").save()
    return perf_counter() - begun


def main() -> None:
    spark = session()
    begun = perf_counter()
    tables = staged_inputs(spark)
    inputs = perf_counter() - begun
    times = {}
    for name, query in headline(tables).items():
        _seconds(query)
        times[name] = round(median(_seconds(query) for _ in range(REPEATS)), 3)
    full_run = run(tables, CONFIG)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
                "inputs": round(inputs, 3),
                "full_run_stages": {k: round(v, 3) for k, v in full_run.timings.items()},
                "cpus": int(CPUS),
                "repeats": REPEATS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
