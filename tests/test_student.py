import numpy as np
import pytest

from splitmetrics.functions.student import t_pvalue

# (t, df, p) from numerical integration and closed forms.
GOLDEN = [
    (0.5, 3.2, 0.6494501780132),
    (1.96, 50.7, 0.0555032690373),
    (-2.3, 1234.5, 0.0216143955491),
    (4.0, 8.1, 0.0038510760181),
    (0.01, 20000.0, 0.9920213871107),
    (2.0, 1e6, 0.0455005338),
]


def p_values(spark, pairs):
    frame = spark.createDataFrame([(i, *pair) for i, pair in enumerate(pairs)], "i int, t double, df double")
    rows = frame.select("i", t_pvalue("t", "df").alias("p")).orderBy("i").collect()
    return [row.p for row in rows]


def test_golden_values(spark):
    found = p_values(spark, [(t, df) for t, df, _ in GOLDEN])
    assert found == pytest.approx([p for _, _, p in GOLDEN], abs=1e-10)


def test_far_tail_keeps_relative_accuracy(spark):
    assert p_values(spark, [(12.0, 30.0)])[0] == pytest.approx(5.580185415199e-13, rel=1e-9)


@pytest.mark.parametrize("df", [1.2e5, 1e9, 1e12])
def test_far_tail_with_many_degrees_of_freedom(spark, df):
    """The tail itself by Simpson's rule, on a scale on which it falls slowly."""
    ts = [3.6, 5.0, 8.0, 12.0, 20.0, 30.0]
    expected = []
    for t in ts:
        u = np.linspace(0, 40 / t, 200_001)
        weights = np.ones(len(u))
        weights[1:-1:2], weights[2:-1:2] = 4, 2
        density = np.exp(-(df + 1) / 2 * np.log1p((t + u) ** 2 / df))
        area = 40 / t / 200_000 / 3 * np.sum(weights * density)
        scale = (1 - 1 / (4 * df)) / np.sqrt(2 * np.pi)  # of the density, for large df
        expected.append(2 * scale * area)
    assert p_values(spark, [(t, df) for t in ts]) == pytest.approx(expected, rel=1e-8)


def test_missing_and_zero(spark):
    assert p_values(spark, [(None, 5.0), (1.0, None), (0.0, 5.0), (1.0, 0.0)]) == [None, None, 1.0, None]


def test_one_and_two_degrees_of_freedom_have_closed_forms(spark):
    ts = [0.05, 0.7, 1.0, 1.7, 1.75, 3.0, 40.0]
    cauchy = [1 - 2 * np.arctan(t) / np.pi for t in ts]
    second = [1 - t / np.sqrt(2 + t * t) for t in ts]
    assert p_values(spark, [(t, 1.0) for t in ts]) == pytest.approx(cauchy, rel=1e-10)
    assert p_values(spark, [(t, 2.0) for t in ts]) == pytest.approx(second, rel=1e-9)


@pytest.mark.parametrize("df", [5.5, 399.0, 99_000.0, 101_000.0, 1e8, 1e10, 1e12])
def test_against_integration_for_many_t(spark, df):
    """Simpson's rule over the density, scaled by its own integral, so without gamma functions."""

    def integral(upper, steps=20_000):
        u = np.linspace(0.0, upper, steps + 1)
        density = np.exp(-(df + 1) / 2 * np.log1p(u * u / df))
        weights = np.ones(steps + 1)
        weights[1:-1:2], weights[2:-1:2] = 4, 2
        return upper / steps / 3 * np.sum(weights * density)

    ts = [0.001, 0.3, 1.0, 1.5, 1.7, 1.73, 1.74, 1.8, 1.96, 2.5, 3.5, 5.0, 6.5, 7.05, 7.1, 8.0]
    whole = integral(10_000.0, 4_000_000) if df < 100 else integral(20.0)
    expected = [1 - integral(t) / whole for t in ts]
    assert p_values(spark, [(t, df) for t in ts]) == pytest.approx(expected, abs=1e-9)
