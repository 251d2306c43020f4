import os
from dataclasses import replace

import pytest
from frames import config, contacts, credits, order, orders, rows_by, visitor, visitors

from catalogue.queries import comparable
from splitmetrics import InputTables, Population, RawEvents, run
from splitmetrics.plans.cohort import cohort_summary
from splitmetrics.plans.summary import summary
from splitmetrics.schema import RAW_CREDITS, RAW_ORDERS
from splitmetrics.sources import results
from splitmetrics.sources.tables import TableNames

DISTRIBUTION = {"visitors_by_cell", "visitors_by_date", "dimension_share", "evenness"}
SWEEPS = {"gm_sweep", "gm_low_curve", "booking_sweep", "booking_histogram"}
ANALYSES = {"summary", "cohort", "credit", "contact", "daily", "cumulative"}


def tables(spark, **changes):
    people = [visitor(i, 100 + i % 2, touch=i % 4, region="EU" if i % 3 else "US") for i in range(1, 41)]
    bought = [v for v in people if v["visitor_id"] % 5 < 2]
    placed = [
        order(v["visitor_id"], 10.0 + v["visitor_id"], 3, v["test_sub_id"], v["touch_date"].day - 1, 2)
        for v in bought
    ]
    given = {
        "visitors": visitors(spark, people),
        "orders": orders(spark, placed),
        "credits": credits(spark, [o["visitor_id"] for o in placed[::3]]),
        "contacts": contacts(spark, [(i, i, 100 + i) for i in range(1, 41, 4)]),
    }
    return InputTables(**(given | changes))


def test_full_run(spark, tmp_path):
    settings = config(test_type_id=1, cohort_dimensions=("region",))
    output, history = str(tmp_path / "out"), str(tmp_path / "history")
    result = run(tables(spark), settings, output, history)
    assert result.complete
    assert set(result.frames) == DISTRIBUTION | SWEEPS | ANALYSES | {"hopper_share"}
    assert set(result.reports) == {"visitors_by_date", "gm_sweep", "booking_sweep", *ANALYSES}
    assert result.reports["visitors_by_date"].count() == result.frames["visitors_by_date"].count() > 0
    assert set(result.timings) == set(results.STAGES)
    assert result.reports["credit"].where("significance = 'control'").count() == 1
    saved = results.load_frame(spark, output, "summary", settings)
    own = summary(Population(tables(spark).visitors, tables(spark).orders, settings))
    assert rows_by(saved, "metric") == rows_by(own, "metric")
    cutoffs = results.load_frame(spark, output, "cutoffs", settings).first()
    assert tuple(cutoffs) == (0.0, 1.0, 1.0)
    assert results.read_run_history(spark, history).count() == 1


def test_run_without_cutoffs_stops_after_the_sweeps(spark, tmp_path):
    result = run(tables(spark), config(test_type_id=2, gm_high=None), str(tmp_path / "out"))
    assert not result.complete
    assert set(result.frames) == DISTRIBUTION | SWEEPS | {"exposure_share"}
    assert not (tmp_path / "out").exists()


def test_demo_mode_saves_nothing(spark, tmp_path):
    settings = config(test_type_id=3, demo_mode=True, cohort_dimensions=("region",))
    output = tmp_path / "out"
    result = run(
        tables(spark, credits=None, contacts=None), settings, str(output), str(output / "history")
    )
    assert result.skipped == ["credit", "contact"] and not result.complete
    assert not output.exists()
    assert set(result.frames) == DISTRIBUTION | SWEEPS | ANALYSES - {"credit", "contact"}


def test_constraint_applies_to_the_analyses_but_not_to_the_distribution(spark):
    settings = config(visitor_constraint="region = 'EU'", cohort_dimensions=("region",))
    result = run(tables(spark), settings)
    cells = rows_by(result.frames["visitors_by_cell"], "test_sub_name")
    assert sum(r["no_visitors"] for r in cells.values()) == 40
    rate = rows_by(result.frames["summary"], "metric")["CR"]
    assert rate["c_denominator_count"] + rate["t_denominator_count"] == 27
    assert {r.dimension for r in result.frames["cohort"].collect()} == {"EU"}


def test_run_from_raw_events_equals_run_from_attributed_tables(spark):
    given = tables(spark)
    raw = RawEvents(
        orders=given.orders.selectExpr(
            "visitor_id", "visitor_id as order_id", "order_date", "booking_usd", "gm_usd"
        ).to(RAW_ORDERS),
        credits=given.credits.selectExpr("visitor_id", "false as is_reorder").to(RAW_CREDITS),
        contacts=given.contacts.join(given.visitors.select("visitor_id", "touch_date"), "visitor_id")
        .selectExpr("shopper_key", "contact_id", "cast(touch_date as timestamp_ntz) as contact_ts"),
    )
    settings = config(cohort_dimensions=("region",))
    attributed = run(given, settings)
    from_raw = run(replace(given, orders=None, credits=None, contacts=None, raw=raw), settings)
    assert set(attributed.frames) == set(from_raw.frames)
    for name in ANALYSES | SWEEPS:
        one, other = comparable(attributed.frames[name]), comparable(from_raw.frames[name])
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name


def test_contradicting_visitors_are_refused(spark):
    people = [visitor(1), visitor(2, 101), visitor(3, 101, test_sub_name="other")]
    with pytest.raises(ValueError, match=r"more than one name or role: \[101\]"):
        run(tables(spark, visitors=visitors(spark, people)), config())
    with pytest.raises(ValueError, match="more than one row"):
        run(tables(spark, visitors=visitors(spark, [visitor(1), visitor(1)])), config())
    with pytest.raises(ValueError, match="credits: visitor_id is missing"):
        run(tables(spark, credits=spark.range(3)), config())


def test_tables_are_loaded_by_type_and_id(spark, tmp_path):
    settings = config(test_id=7, test_type_id=3, cohort_dimensions=("region",))
    given, names = tables(spark), TableNames(3, 7)
    for part in ("visitors", "orders", "credits", "contacts"):
        getattr(given, part).write.parquet(f"{tmp_path}/{getattr(names, part)}")
    loaded = InputTables.load(spark, settings, folder=str(tmp_path))
    with run(loaded, settings) as by_name, run(given, settings) as direct:
        assert by_name.complete and set(by_name.frames) == set(direct.frames)
        one, other = by_name.frames["summary"], direct.frames["summary"]
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


def test_what_a_run_staged_goes_when_it_is_closed(spark, tmp_path):
    result = run(tables(spark), config(cohort_dimensions=("region",)))
    files = [f.removeprefix("file://") for f in result.frames["summary"].inputFiles()]
    assert files and all(os.path.exists(f) for f in files)
    folder = result.workspace.folder
    result.close()
    assert not os.path.exists(folder)


def test_one_analysis_needs_few_jobs_before_its_action(spark, tmp_path):
    given = tables(spark)
    for part in ("visitors", "orders"):
        getattr(given, part).write.parquet(f"{tmp_path}/{part}")
    visitor_table, order_table = (spark.read.parquet(f"{tmp_path}/{p}") for p in ("visitors", "orders"))
    spark.sparkContext.setJobGroup("one analysis", "")
    summary(Population(visitor_table, order_table, config()))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("one analysis")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 13


def test_orders_are_needed(spark):
    with pytest.raises(ValueError, match="orders are needed"):
        run(tables(spark, orders=None), config())


def test_a_run_with_bucketed_visitors_has_the_same_results(spark):
    settings = config(cohort_dimensions=("region",))
    with run(tables(spark), settings) as plain, run(tables(spark), settings, buckets=3) as placed:
        assert plain.frames.keys() == placed.frames.keys()
        for name, frame in plain.frames.items():
            rows = [comparable(f).collect() for f in (frame, placed.frames[name])]
            assert sorted(map(str, rows[0])) == sorted(map(str, rows[1])), name


def test_a_run_that_fails_leaves_nothing_behind(spark, monkeypatch):
    from splitmetrics.plans import pipeline

    made = []
    workspace = pipeline.Workspace
    monkeypatch.setattr(pipeline, "Workspace", lambda s: made.append(workspace(s)) or made[-1])
    monkeypatch.setattr(pipeline, "summary", lambda population: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(tables(spark), config(cohort_dimensions=("region",)), buckets=3)
    assert made[0].tables and not os.path.exists(made[0].folder)
    assert not any(spark.catalog.tableExists(name) for name in made[0].tables)


def test_the_constraint_chooses_within_the_lattice(spark):
    settings = config(cohort_dimensions=("is_new",), visitor_constraint="AND region = 'EU'")
    with run(tables(spark), settings) as result:
        alone = cohort_summary(Population(tables(spark).visitors, tables(spark).orders, settings))
        assert sorted(map(str, result.frames["cohort"].collect())) == sorted(map(str, alone.collect()))
        assert result.frames["cohort"].first()["c_count"] < 20
