import pytest
from frames import day, rows_by, visitor, visitors
from pyspark.sql import functions as F

from splitmetrics.operators.numbering import numbered
from splitmetrics.operators.population import traffic
from splitmetrics.plans import distribution


def made_up():
    people = [visitor(i, 100 + i % 3, region=["EU", "US", None][i % 4 % 3]) for i in range(60)]
    people += [visitor(100 + i, 101, is_hopper=i % 3 + 1) for i in range(7)]
    people += [visitor(200, 103, role="AC"), visitor(201, 101, touch=3, exposed_to_test=0)]
    return people


def test_traffic_frames(spark):
    counts = traffic(visitors(spark, made_up()))
    cells = rows_by(distribution.visitors_by_cell(counts), "test_sub_name", "control_test")
    assert {k: v["no_visitors"] for k, v in cells.items()} == {
        ("cell_100", "C"): 20,
        ("cell_101", "T"): 21,
        ("cell_102", "T"): 20,
        ("cell_103", "AC"): 1,
    }
    hoppers = rows_by(distribution.hopper_share(counts), "is_hopper")
    assert {k: (v["hopper_class"], v["no_visitors"]) for k, v in hoppers.items()} == {
        1: ("visitor hopper", 3),
        2: ("session hopper", 2),
        3: ("subsession hopper", 2),
    }
    assert hoppers[1]["rawcent"] == pytest.approx(3 / 69)
    exposure = rows_by(distribution.exposure_share(counts), "exposed_class")
    assert exposure["not exposed to test"]["rawcent"] == pytest.approx(1 / 69)
    assert sum(r["rawcent"] for r in exposure.values()) == pytest.approx(1)
    dates = rows_by(distribution.visitors_by_date(counts), "test_sub_name", "touch_date")
    assert dates["cell_101", day(0)]["no_visitors"] == 27
    assert dates["cell_101", day(3)]["no_visitors"] == 1


def test_shares_of_dimension_values(spark):
    table = visitors(spark, made_up())
    counts = distribution.dimension_counts(table)
    found = distribution.dimension_share(counts, traffic(table)).orderBy("index").collect()
    assert [r["index"] for r in found] == list(range(1, len(found) + 1))
    assert [r["dimension"] for r in found] == sorted(r["dimension"] for r in found)
    by_name = {r["combined_name"]: r for r in found}
    missing = by_name["region : NA"]
    assert missing["value"] is None and missing["no_visitors"] == 15
    assert missing["cent"] == pytest.approx(round(15 / 61, 3))
    for name in distribution.SHARE_DIMENSIONS:
        shares = [r["cent"] for r in found if r["dimension"] == name]
        assert shares == sorted(shares, reverse=True)
        assert sum(r["no_visitors"] for r in found if r["dimension"] == name) == 61


def test_ties_in_share_are_numbered_by_name(spark):
    table = visitors(spark, [visitor(1, region="b"), visitor(2, region="a"), visitor(3, region="c")])
    counts = distribution.dimension_counts(table)
    rows = distribution.dimension_share(counts, traffic(table)).where("dimension = 'region'").orderBy("index").collect()
    assert [r["value"] for r in rows] == ["a", "b", "c"]


def test_long_values_are_cut_and_counted_together(spark):
    long = "x" * 30
    table = visitors(spark, [visitor(1, region=long + "1"), visitor(2, region=long + "2")])
    rows = rows_by(distribution.dimension_counts(table).where("dimension = 'region'"), "value")
    assert rows[long]["no_visitor"] == 2


def test_exact_ties_round_to_even(spark):
    table = visitors(spark, [visitor(i, region="a" if i < 1 else "b") for i in range(16)])
    counts = distribution.dimension_counts(table)
    shares = rows_by(
        distribution.dimension_share(counts, traffic(table)).where("dimension = 'region'"), "value"
    )
    assert (shares["a"]["cent"], shares["b"]["cent"]) == (0.062, 0.938)


def test_evenness(spark):
    people = made_up() + [visitor(i, 100) for i in range(1000, 1400)]
    people.append(visitor(5000, 101, region="rare"))
    table = visitors(spark, people)
    counts = distribution.dimension_counts(table)
    found = distribution.evenness(counts, traffic(table)).collect()
    assert not [r for r in found if r["value"] == "rare"]
    totals = {}
    for r in found:
        assert r["centeven"] == pytest.approx(r["no_visitor"] / r["no_visitors"], abs=5e-5)
        key = (r["dimension"], r["value"])
        totals[key] = totals.get(key, 0) + r["no_visitor"]
    for r in found:
        assert totals[r["dimension"], r["value"]] == r["no_visitors"]
    assert ("region", None) in totals


def test_numbering_does_not_depend_on_how_rows_are_split(spark):
    frame = spark.range(1000).selectExpr("id % 7 as a", "id")
    rows = numbered(frame.repartition(5), "n", F.desc("a"), "id").orderBy("n").collect()
    expected = sorted(((i % 7, i) for i in range(1000)), key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.id) for r in rows] == expected
    assert [r.n for r in rows] == list(range(1, 1001))
    assert numbered(frame.where("id < 0"), "n", "id").count() == 0
