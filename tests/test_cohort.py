import random
from statistics import mean

import pytest
from frames import config, order, orders, rows_by, visitor, visitors, welch_z

from splitmetrics.functions.significance import z_bucket
from splitmetrics.operators.population import Population
from splitmetrics.plans import cohort
from splitmetrics.plans.cohort import COLUMNS, cohort_summary


@pytest.fixture
def low_bars(monkeypatch):
    monkeypatch.setattr(cohort, "MIN_VISITORS", 5)
    monkeypatch.setattr(cohort, "MIN_ORDERERS", 2)


def made_up():
    numbers = random.Random(11)
    people, placed = [], []
    for cell in (100, 101):
        for _ in range(40):
            i = len(people) + 1
            region = numbers.choice(["EU", "US", None])
            people.append(visitor(i, cell, region=region, is_new=i % 2))
            if numbers.random() < 0.6:
                booking = numbers.uniform(10, 90)
                gm = None if numbers.random() < 0.1 else booking / 3
                placed.append(order(i, booking, gm, cell))
    return people, placed


def test_equals_row_by_row_results(spark, low_bars):
    people, placed = made_up()
    settings = config(cohort_dimensions=("region", "is_new"))
    found = cohort_summary(Population(visitors(spark, people), orders(spark, placed), settings))
    assert tuple(found.columns) == COLUMNS and len(COLUMNS) == 30
    rows = rows_by(found, "cohort", "dimension")
    assert set(rows) == {("region", r) for r in ("EU", "US", None)} | {("is_new", "0"), ("is_new", "1")}
    bought = {o["visitor_id"]: o for o in placed}
    for (name, value), row in rows.items():
        arms = {}
        for cell, side in ((100, "c"), (101, "t")):
            ids = [
                v["visitor_id"]
                for v in people
                if v["test_sub_id"] == cell
                and (None if v[name] is None else str(v[name])) == value
            ]
            own = [bought[i] for i in ids if i in bought]
            gm = [o["gm_usd"] for o in own if o["gm_usd"] is not None]
            arms[side] = (
                [float(i in bought) for i in ids],
                [o["booking_usd"] for o in own],
                gm,
            )
            assert row[f"{side}_count"] == len(ids)
            assert row[f"{side}_ordering_visitor_count"] == len(own)
            assert row[f"{side}_gm"] == pytest.approx(sum(gm))
            assert row[f"{side}_cr"] == pytest.approx(len(own) / len(ids))
            assert row[f"{side}_gm_buyer"] == pytest.approx(sum(gm) / len(own))
        for i, metric in enumerate(("cr", "bookings_buyer", "gm_buyer")):
            assert row[f"z_score_{metric}"] == pytest.approx(welch_z(arms["c"][i], arms["t"][i]))
            assert 0 < row[f"pvalue_{metric}"] < 1
        lift = mean(arms["t"][0]) / mean(arms["c"][0]) - 1
        assert row["cr_diff"] == pytest.approx(lift)


def test_values_of_one_arm_only(spark):
    people = [
        visitor(1, 100, region="only control"),
        visitor(2, 101, region="only test"),
        visitor(3, 100, region="both"),
        visitor(4, 101, region="both"),
        visitor(5, 102, region="third"),
    ]
    placed = [order(3, 10, 1), order(4, 20, 2, cell=101)]
    settings = config(cohort_dimensions=("region",))
    rows = rows_by(
        cohort_summary(Population(visitors(spark, people), orders(spark, placed), settings)),
        "dimension",
        "t_id",
    )
    assert set(rows) == {
        ("only control", 101),
        ("only control", 102),
        ("only test", 101),
        ("both", 101),
        ("both", 102),
        ("third", 102),
    }
    lone = rows["only control", 101]
    assert (lone["c_count"], lone["t_count"], lone["t_gm"], lone["t_cr"]) == (1, 0, 0.0, None)
    assert (lone["c_name"], lone["t_name"], lone["cr_diff"]) == ("cell_100", "cell_101", 0.0)
    other = rows["only test", 101]
    assert (other["c_count"], other["c_cr"], other["c_name"]) == (0, None, "cell_100")
    assert rows["both", 101]["bookings_buyer_diff"] == pytest.approx(1.0)


@pytest.mark.parametrize(("visitors_bar", "orderers_bar", "tested"), [(3, 1, True), (4, 1, False), (3, 2, False)])
def test_both_arms_must_be_large_enough(spark, monkeypatch, visitors_bar, orderers_bar, tested):
    monkeypatch.setattr(cohort, "MIN_VISITORS", visitors_bar)
    monkeypatch.setattr(cohort, "MIN_ORDERERS", orderers_bar)
    people = [visitor(i, 100) for i in range(1, 9)] + [visitor(i, 101) for i in range(11, 15)]
    placed = [order(i, 10.0 + i, 1.0 + i) for i in range(1, 6)]
    placed += [order(i, 12.0 + i, 2.0 + i, cell=101) for i in (11, 12)]
    settings = config(cohort_dimensions=("region",))
    row = cohort_summary(
        Population(visitors(spark, people), orders(spark, placed), settings)
    ).first()
    for metric in ("cr", "gm_buyer", "bookings_buyer"):
        assert (row[f"z_score_{metric}"] is not None) is tested
        assert (row[f"pvalue_{metric}"] is not None) is tested


def test_caps_are_set_with_the_alternate_control_in(spark):
    people = [visitor(1), visitor(2, 101), visitor(3, 103, role="AC")]
    placed = [order(1, 10, 1), order(2, 100, 1, cell=101), order(3, 1000, 1, cell=103)]
    settings = config(cohort_dimensions=("region",), bookings_high=0.5)
    rows = rows_by(
        cohort_summary(Population(visitors(spark, people), orders(spark, placed), settings)), "t_id"
    )
    assert set(rows) == {101}
    assert (rows[101]["c_bookings"], rows[101]["t_bookings"]) == (10.0, 100.0)


@pytest.mark.parametrize(
    ("z", "bucket"),
    [(-1.96, 1), (-1.65, 2), (-1.64, 3), (0.0, 3), (1.64, 4), (1.96, 5), (None, None)],
)
def test_z_buckets(spark, z, bucket):
    assert spark.createDataFrame([(z,)], "z double").select(z_bucket("z")).first()[0] == bucket


def test_a_control_marked_as_alternate_keeps_its_labels(spark):
    people = [visitor(i, 100 + i % 2, role="AC" if i % 2 == 0 else None) for i in range(1, 21)]
    people += [visitor(30 + i, 102, role="AC") for i in range(4)]
    settings = config(cohort_dimensions=("region",))
    found = cohort_summary(Population(visitors(spark, people), orders(spark, [order(1, 5)]), settings))
    (row,) = found.collect()
    assert (row.exp_name, row.c_name, row.t_name) == ("EXP", "cell_100", "cell_101")
    assert (row.c_count, row.t_count) == (10, 10)
