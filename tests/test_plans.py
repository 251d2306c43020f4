"""Properties of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from catalogue.queries import CONFIG
from splitmetrics.operators import rollups
from splitmetrics.operators.attribution import (
    attribute_contacts,
    attribute_orders,
    contacts_after_touch,
)
from splitmetrics.operators.population import Population, traffic
from splitmetrics.plans import distribution
from splitmetrics.plans.cohort import cohort_arms
from splitmetrics.sources import sample_tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def population(spark):
    return Population(
        sample_tables.visitors(spark, FOLDER), sample_tables.orders(spark, FOLDER), CONFIG
    )


@pytest.mark.parametrize(
    "name",
    [
        "order_attribution",
        "contact_attribution",
        "contact_rate_from_raw",
        "credit_rate",
        "summary_metrics",
        "cohort_metrics",
        "booking_sweep",
        "daily_conversion",
        "cumulative_conversion",
        "evenness",
    ],
)
def test_no_query_pairs_rows_without_a_key(spark, name):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_profile_sorts_once_for_all_its_windows(spark):
    schema = sample_tables.orders(spark, FOLDER).schema
    plan = plan_of(rollups.order_profile(spark.createDataFrame([], schema).repartition(2)))
    assert plan.count("Window [") == 2
    assert plan.count("Sort [") == 1


def test_orders_are_aggregated_before_they_are_shuffled(spark):
    plan = plan_of(rollups.order_profile(sample_tables.orders(spark, FOLDER)))
    assert "partial_sum" in plan and "partial_max" in plan


def test_counting_visitors_shuffles_no_visitor_rows(spark, tmp_path):
    sample_tables.visitors(spark, FOLDER).write.parquet(f"{tmp_path}/v")
    plan = plan_of(traffic(spark.read.parquet(f"{tmp_path}/v")))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
    assert "region" not in plan and "shopper_key" not in plan


def test_cohort_arms_read_only_what_they_use(spark, population):
    plan = plan_of(cohort_arms(population))
    scans = [line for line in plan.splitlines() if "FileScan" in line and "order_rows" in line]
    assert scans and all("touch_booking_usd" not in s and "cell_gm_usd" not in s for s in scans)
    assert all("EqualTo(is_visitor_row,true)" in s for s in scans)


def test_visitors_are_counted_before_they_are_listed_by_dimension(spark, population):
    visitors = sample_tables.visitors(spark, FOLDER)
    for frame in (cohort_arms(population), distribution.dimension_counts(visitors)):
        lines = plan_of(frame).splitlines()
        first = next(k for k, line in enumerate(lines) if "Generate inline" in line and "visitors" in line)
        assert any("partial_count(1)" in line for line in lines[first:])


def test_raw_events_are_pruned_by_the_period_of_the_test(spark, tmp_path):
    people = sample_tables.visitors(spark, FOLDER)
    sample_tables.raw_orders(spark, FOLDER).write.parquet(f"{tmp_path}/orders")
    sample_tables.raw_contacts(spark, FOLDER).write.parquet(f"{tmp_path}/contacts")
    raw_orders, raw_contacts = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("orders", "contacts"))
    for frame, column in (
        (attribute_orders(people, raw_orders, 7), "order_date"),
        (attribute_contacts(people, raw_contacts, 7), "contact_ts"),
    ):
        scans = [line for line in plan_of(frame).splitlines() if "PushedFilters" in line and column in line]
        assert scans
        for scan in scans:
            assert f"GreaterThanOrEqual({column},2024-01-01" in scan
            assert f"LessThan({column},2024" in scan


def test_results_do_not_depend_on_the_number_of_partitions(spark):
    query = registry.queries()["summary_metrics"]
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    found = []
    try:
        for partitions in ("1", "13"):
            spark.conf.set(setting, partitions)
            found.append(sorted(map(str, query(spark, FOLDER).collect())))
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1]


@pytest.fixture
def eager_skew_handling(spark):
    """Settings under which small test tables count as big and skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_visitor_with_a_third_of_all_orders_is_split(spark, eager_skew_handling):
    numbers = spark.range(0, 60_000, 1, 8)
    raw = numbers.selectExpr(
        "if(id % 3 = 0, 5L, id % 5000) as visitor_id",
        "id as order_id",
        "date'2024-01-02' as order_date",
        "rand(1) as booking_usd",
        "rand(2) as gm_usd",
    )
    people = spark.range(5000).selectExpr(
        "id as visitor_id",
        "1 as test_id",
        "'E' as test_name",
        "cast(100 + id % 2 as int) as test_sub_id",
        "'cell' as test_sub_name",
        "'T' as control_test",
        "date'2024-01-01' as touch_date",
    )
    attributed = attribute_orders(people, raw, 7)
    rows = attributed.collect()
    assert len(rows) == 60_000
    assert {r.order_count for r in rows if r.visitor_id == 5} == {20_008}
    assert "SortMergeJoin(skew=true)" in plan_of(attributed)


def test_a_shopper_with_a_third_of_all_rows_is_split(spark, eager_skew_handling):
    touches = spark.range(0, 30_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 7L, id) as shopper_key",
        "xxhash64(id) as visitor_id",
        "date_add(date'2024-01-01', cast(id % 2 as int)) as touch_date",
    )
    contacts = spark.range(30).selectExpr(
        "if(id % 3 = 0, 7L, id) as shopper_key",
        "id as contact_id",
        "timestamp_ntz'2024-01-02 10:00:00' as contact_ts",
    )
    found = contacts_after_touch(touches, contacts, 7)
    assert found.where("shopper_key = 7").count() == 10_001 * 11
    per_contact = found.groupBy("contact_id").agg(F.max("visitor_id"))
    per_contact.collect()
    assert "skew=true" in plan_of(per_contact)


def test_one_quantile_call_for_all_analyses_of_a_population(spark, monkeypatch):
    from splitmetrics.operators import caps
    from splitmetrics.plans import sweep
    from splitmetrics.plans.cohort import cohort_summary
    from splitmetrics.plans.summary import summary

    calls = []
    direct = caps.quantile_values
    monkeypatch.setattr(caps, "quantile_values", lambda *a: calls.append(a) or direct(*a))
    own = Population(sample_tables.visitors(spark, FOLDER), sample_tables.orders(spark, FOLDER), CONFIG)
    for analysis in (sweep.gm_sweep, sweep.gm_low_curve, sweep.booking_sweep, summary, cohort_summary):
        analysis(own).count()
    assert len(calls) == 1


def test_cohorts_and_shares_need_no_visitors_beside_the_lattice(spark, tmp_path):
    from splitmetrics.operators.lattice import count_lattice
    from splitmetrics.sources.workspace import stage

    sample_tables.visitors(spark, FOLDER).write.parquet(f"{tmp_path}/every_visitor")
    people = spark.read.parquet(f"{tmp_path}/every_visitor")
    dimensions = dict.fromkeys([*distribution.SHARE_DIMENSIONS, *CONFIG.cohort_dimensions])
    lattice = stage(count_lattice(people, dimensions), "lattice")
    own = Population(people, sample_tables.orders(spark, FOLDER), CONFIG, lattice_counts=lattice)
    direct = Population(people, sample_tables.orders(spark, FOLDER), CONFIG)
    for through, alone in (
        (cohort_arms(own), cohort_arms(direct)),
        (distribution.dimension_counts(people, lattice), distribution.dimension_counts(people)),
    ):
        reads = [any("every_visitor" in file for file in f.inputFiles()) for f in (through, alone)]
        assert reads == [False, True]
        assert sorted(map(str, through.collect())) == sorted(map(str, alone.collect()))


def test_bucketed_visitors_meet_their_orders_without_a_shuffle(spark, eager_skew_handling):
    from splitmetrics.sources.workspace import Workspace, stage_bucketed

    work = Workspace(spark)
    with work.active():
        people = stage_bucketed(sample_tables.visitors(spark, FOLDER), "visitors", "visitor_id", 5)
        profile = stage_bucketed(
            rollups.order_profile(sample_tables.orders(spark, FOLDER)), "profile", "visitor_id", 5
        )
        joined = profile.join(people.where("is_hopper = 0"), "visitor_id")
        rows = joined.count()
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and rows > 0
        buckets = Population(people, sample_tables.orders(spark, FOLDER), CONFIG, buckets=5)
        plain = Population(
            sample_tables.visitors(spark, FOLDER), sample_tables.orders(spark, FOLDER), CONFIG
        )
        columns = sorted(plain.order_rows.columns)
        found = [sorted(map(str, p.order_rows.select(*columns).collect())) for p in (buckets, plain)]
        assert found[0] == found[1]
    names = list(work.tables)
    work.close()
    assert len(names) == 3 and not any(spark.catalog.tableExists(name) for name in names)


@pytest.mark.parametrize("name", ["contact_rate", "contact_rate_from_raw"])
def test_contact_rates_expand_no_rows(spark, name):
    plan = plan_of(registry.queries()[name](spark, FOLDER))
    assert "Expand" not in plan
