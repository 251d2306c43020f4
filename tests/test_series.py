import pytest
from frames import config, day, order, orders, rows_by, visitor, visitors, welch_z

from splitmetrics.functions.significance import significance_flag
from splitmetrics.operators.population import Population
from splitmetrics.plans.reports import series_report
from splitmetrics.plans.series import DAILY_COLUMNS, cumulative_conversion, daily_conversion


def population(spark, people, placed, **changes):
    return Population(visitors(spark, people), orders(spark, placed), config(**changes))


def two_days():
    people, placed = [], []
    for cell, bought in ((100, (2, 3)), (101, (1, 4))):
        for touch in (0, 1):
            for i in range(6):
                people.append(visitor(len(people) + 1, cell, touch=touch))
                if i < bought[touch]:
                    placed.append(order(len(people), 10, 1, cell, touch=touch, after=touch))
    return people, placed


def test_daily_equals_row_by_row_results(spark):
    found = daily_conversion(population(spark, *two_days()))
    assert tuple(found.columns) == DAILY_COLUMNS and len(DAILY_COLUMNS) == 16
    rows = rows_by(found, "touch_date")
    for touch, c, t in ((0, 2, 1), (1, 3, 4)):
        row = rows[day(touch)]
        control, test = [1.0] * c + [0.0] * (6 - c), [1.0] * t + [0.0] * (6 - t)
        assert (row["c_denominator_count"], row["t_denominator_count"]) == (6, 6)
        assert (row["c_value"], row["t_value"]) == (pytest.approx(c / 6), pytest.approx(t / 6))
        assert row["z_score"] == pytest.approx(welch_z(control, test))
        assert row["per_change"] == pytest.approx(t / c - 1)
        assert row["significant"] == 0


def test_daily_rows_where_one_arm_is_missing(spark):
    people = [visitor(1), visitor(2), visitor(3, 101), visitor(4, 100, touch=5), visitor(5, 101, touch=6)]
    rows = rows_by(daily_conversion(population(spark, people, [order(1, 10, 1)])), "touch_date")
    assert set(rows) == {day(0), day(5), day(6)}
    assert (rows[day(5)]["c_denominator_count"], rows[day(5)]["t_denominator_count"]) == (1, 0)
    assert rows[day(6)]["c_name"] == "cell_100" and rows[day(6)]["c_value"] is None
    assert all(row["z_score"] is None for row in rows.values())


def test_daily_counts_a_visitor_once_per_cell_ordered_under(spark):
    people = [visitor(1), visitor(2), visitor(3, 101), visitor(4, 101)]
    placed = [order(1, 10, 1), order(1, 10, 1, touch=1), order(1, 10, 1, cell=101)]
    row = daily_conversion(population(spark, people, placed)).first()
    assert (row.c_denominator_count, row.c_value) == (3, pytest.approx(2 / 3))


def test_cumulative_walkthrough(spark):
    """A day without visitors, a cell starting on day 2, a touch after the last first order."""
    people = [
        visitor(1),
        visitor(2),
        visitor(3, 101, touch=2),
        visitor(4, 101, touch=2),
        visitor(5, 100, touch=2),
        visitor(6, 100, touch=9),
    ]
    placed = [
        order(1, 10, 1, after=1),
        order(1, 10, 1, after=3),
        order(3, 10, 1, cell=101, touch=2, after=1),
        order(5, 10, 1, touch=2, after=2),
    ]
    found = cumulative_conversion(population(spark, people, placed))
    assert len(found.columns) == 13
    rows = rows_by(found, "dateVariable")
    series = {
        d: (r["cum_visitor_ctrl"], r["cum_buyers_ctrl"], r["cum_visitor_test"], r["cum_buyers_test"])
        for d, r in rows.items()
    }
    assert series == {day(2): (3, 1, 2, 0), day(3): (3, 1, 2, 1), day(4): (3, 2, 2, 1)}
    last = rows[day(4)]
    sd = (0.5 * 0.5 / 2 + (2 / 3) * (1 / 3) / 3) ** 0.5
    assert last["sd"] == pytest.approx(sd)
    assert last["zscore"] == pytest.approx((0.5 - 2 / 3) / sd)
    assert last["perc_lift"] == pytest.approx(0.5 / (2 / 3) - 1)
    assert last["sensitivity"] == pytest.approx(1.96 * sd / (2 / 3))


def test_cumulative_range_ends_with_the_orders_of_ineligible_visitors_too(spark):
    people = [visitor(1), visitor(2, 101), visitor(3, 101, is_hopper=1)]
    placed = [order(1, 10, 1, after=0), order(3, 10, 1, cell=101, after=2)]
    rows = rows_by(cumulative_conversion(population(spark, people, placed)), "dateVariable")
    assert set(rows) == {day(0), day(1), day(2)}
    assert rows[day(2)]["cum_buyers_test"] == 0


def test_cumulative_counts_a_visitor_once_per_touch_ordered_under(spark):
    people = [visitor(1), visitor(2, 101)]
    placed = [order(1, 10, 1), order(1, 10, 1, touch=1), order(2, 5, 1, cell=101)]
    rows = rows_by(cumulative_conversion(population(spark, people, placed)), "dateVariable")
    assert rows[day(2)]["cum_visitor_ctrl"] == 2 and rows[day(2)]["cum_buyers_ctrl"] == 2


def test_cumulative_without_orders_or_with_orders_before_the_first_touch(spark):
    people = [visitor(1, touch=5), visitor(2, 101, touch=5)]
    assert cumulative_conversion(population(spark, people, [])).count() == 0
    early = [order(1, 10, 1, touch=0, after=0)]
    assert cumulative_conversion(population(spark, people, early)).count() == 0


def test_last_cumulative_row_holds_the_totals(spark):
    rows = rows_by(cumulative_conversion(population(spark, *two_days())), "dateVariable")
    last = rows[max(rows)]
    assert (last["cum_visitor_ctrl"], last["cum_buyers_ctrl"]) == (12, 5)
    assert (last["cum_visitor_test"], last["cum_buyers_test"]) == (12, 5)


def test_flag_is_strict(spark):
    frame = spark.createDataFrame([(1.96,), (1.9601,), (-1.97,), (None,)], "z double")
    assert [r[0] for r in frame.select(significance_flag("z")).collect()] == [0, 1, 1, None]


def test_series_report_needs_two_dates(spark):
    people = [visitor(1), visitor(2, 101)]
    assert series_report(daily_conversion(population(spark, people, [])), "touch_date").count() == 0
    report = series_report(cumulative_conversion(population(spark, *two_days())), "dateVariable")
    row = report.first()
    assert row.band_high == row.sensitivity == -row.band_low
