import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitmetrics.operators import quantiles
from splitmetrics.operators.quantiles import exact_quantiles

LEVELS = [0.0, 0.001, 0.0375, 0.25, 0.5, 0.9625, 0.9675, 0.99, 0.999, 1.0]


def samples():
    numbers = random.Random(7)
    return {
        "spread": [numbers.gauss(50, 30) for _ in range(3000)],
        "a_third_alike": [9.99] * 1000 + [numbers.uniform(0, 100) for _ in range(2000)],
        "all_alike": [24.95] * 1007,
        "few_values": [float(numbers.randrange(4)) for _ in range(500)],
        "single": [3.5],
        "negative": [-float(i) for i in range(257)],
    }


@pytest.fixture(params=["1", "61"])
def spread(request, spark):
    """However many ranges the values are sorted into, the numbers are the same."""
    settings = {
        "spark.sql.shuffle.partitions": request.param,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def percentile(frame, column, levels):
    return frame.agg(F.percentile(column, levels)).first()[0]


@pytest.mark.parametrize("name", list(samples()))
def test_equals_percentile_and_linear_interpolation(spark, spread, name):
    values = samples()[name]
    frame = spark.createDataFrame([(v,) for v in [*values, None, None]], "x double")
    found = exact_quantiles(frame, {"x": LEVELS}).first()["x"]
    assert found == percentile(frame, "x", LEVELS)
    assert found == pytest.approx(list(np.quantile(values, LEVELS)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("size", [1_000, 1_007, 7_321, 60_000])
def test_ties_at_any_size(spark, size):
    frame = spark.range(size).selectExpr("floor(rand(3) * 40) / 100.0D + 24.95D as x")
    kept = spark.createDataFrame(frame.toPandas())
    assert exact_quantiles(kept, {"x": LEVELS}).first()["x"] == percentile(kept, "x", LEVELS)


def test_nan_is_no_value(spark):
    rows = [(float(i),) for i in range(101)] + [(float("nan"),)] * 50 + [(None,)]
    frame = spark.createDataFrame(rows, "x double")
    assert exact_quantiles(frame, {"x": [0.5, 1.0]}).first()["x"] == [50.0, 100.0]


def test_no_values_give_null(spark, spread):
    frame = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert exact_quantiles(frame, {"x": [0.5]}).first()["x"] is None


def test_several_columns(spark, spread):
    frame = spark.createDataFrame([(float(i), float(i * i)) for i in range(800)], "a double, b double")
    found = exact_quantiles(frame, {"a": [0.5], "b": [0.1, 0.9]}).first()
    assert found["a"] == [399.5]
    assert found["b"] == percentile(frame, "b", [0.1, 0.9])


class Jobs:
    """Counts the jobs of a piece of work by its job group."""

    def __init__(self, spark, name):
        self.context, self.name = spark.sparkContext, name

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.name))
        self.context.setLocalProperty("spark.jobGroup.id", None)


def test_two_passes_and_few_values_shuffled(spark):
    frame = spark.range(200_000).selectExpr("rand(5) as x", "round(rand(6) * 100, 2) as y")
    levels = {"x": [0.001, 0.5, 0.99], "y": [0.25, 1.0]}
    with Jobs(spark, "quantiles") as jobs:
        found = quantiles.quantile_values(frame, levels)
    # Two aggregations; a job is counted for each side of their shuffles.
    assert jobs.count <= 4
    assert found == {name: percentile(frame, name, points) for name, points in levels.items()}
    sketch = quantiles._sketch(frame, levels)["x"]
    assert sketch[0] == 200_000
    brackets = quantiles._brackets(levels["x"], sketch[1], 5e-4)
    inside = frame.where(quantiles._slot(F.col("x"), brackets) % 2 == 1).count()
    assert 3 <= inside <= 3 * 200_000 * 2 * 7e-4


def test_a_sketch_that_is_off_changes_nothing(spark, monkeypatch):
    """Brackets that miss their ranks are widened until they hold them."""
    values = [float(k * k) for k in range(5000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    monkeypatch.setattr(quantiles, "_REACHES", (1e-9, 1e-4, 1.0))
    monkeypatch.setattr(quantiles, "_RANKS", 0)
    monkeypatch.setattr(quantiles, "_ACCURACY", 20)
    assert quantiles.quantile_values(frame, {"x": LEVELS})["x"] == percentile(frame, "x", LEVELS)


def test_infinite_and_signed_zero(spark):
    values = [float("inf"), float("-inf"), 0.0, -0.0, 1.0]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert quantiles.quantile_values(frame, {"x": [0.0, 0.25, 0.5, 0.75, 1.0]})["x"] == [float("-inf"), 0.0, 0.0, 1.0, float("inf")]
