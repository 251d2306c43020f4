from datetime import datetime, timedelta
from math import sqrt

import pytest
from frames import DAY, config, contacts, credits, order, orders, rows_by, visitor, visitors
from pyspark.sql import functions as F

from splitmetrics.functions.significance import care_label
from splitmetrics.operators.attribution import (
    attribute_contacts,
    attribute_credits,
    attribute_orders,
)
from splitmetrics.plans.care import contact_rate, contact_rate_from_raw, credit_rate
from splitmetrics.plans.reports import care_report
from splitmetrics.schema import RAW_CONTACTS, RAW_CREDITS, RAW_ORDERS


def moment(days, hours=12):
    return datetime(DAY.year, DAY.month, DAY.day) + timedelta(days=days, hours=hours)


def test_credit_rate(spark):
    people = [visitor(i, 100 if i <= 4 else 101) for i in range(1, 10)]
    people += [visitor(20, 103, role="AC"), visitor(21, 101, is_hopper=1), visitor(22, 101, is_hopper=2)]
    placed = [order(i, 10, 1, cell=100 if i <= 4 else 101, after=20) for i in range(1, 10)]
    placed += [order(1, 10, 1), order(20, 10, 1, 103), order(21, 10, 1, 101), order(22, 10, 1, 101)]
    given = credits(spark, [1, 1, 5, 6, 20, 22, 999])
    found = credit_rate(visitors(spark, people), orders(spark, placed), given, config())
    assert len(found.columns) == 14
    row = rows_by(found, "test_sub_id")[101]
    assert (row["shopper_ct"], row["shopper_ct_credited"], row["credit_rate"]) == (6, 2, pytest.approx(1 / 3))
    assert (row["control_shopper_ct"], row["control_shopper_ct_credited"]) == (4, 1)
    assert row["control_name"] == "cell_100" and row["combined_var"] == pytest.approx(0.3)
    error = sqrt(0.3 * 0.7 / 6 + 0.3 * 0.7 / 4)
    assert row["SE"] == pytest.approx(error)
    assert row["zvalue"] == pytest.approx((0.25 - 1 / 3) / error)
    assert row["relative_diff"] == pytest.approx((1 / 3 - 0.25) / 0.25)
    assert row["significance"] == "No significant change"
    stricter = credit_rate(
        visitors(spark, people), orders(spark, placed), given, config(credit_hopper_level=0)
    )
    assert stricter.first().shopper_ct == 5


def test_contact_rate(spark):
    people = [visitor(i, 100, shopper_key=i) for i in (1, 2)]
    people += [visitor(3, 101, shopper_key=7), visitor(4, 101, shopper_key=7), visitor(5, 101, shopper_key=8)]
    people += [visitor(6, 101, shopper_key=None), visitor(7, 101, is_hopper=1), visitor(8, 103, role="AC")]
    made = contacts(spark, [(1, 1, 50), (3, 7, 60), (4, 7, 60), (4, 7, 61), (6, 9, 62), (7, 7, 63)])
    row = contact_rate(visitors(spark, people), made, config()).first()
    assert (row.shopper_ct, row.shopper_ct_contacted, row.contact_ct) == (2, 1, 2)
    assert (row.control_shopper_ct, row.control_shopper_ct_contacted) == (2, 1)
    assert row.zvalue == pytest.approx(0.0)
    assert len(row) == 15


def test_no_contacts_at_all(spark):
    people = [visitor(1), visitor(2, 101)]
    row = contact_rate(visitors(spark, people), contacts(spark, []), config()).first()
    assert (row.contact_rate, row.contact_ct, row.zvalue, row.significance) == (0.0, 0, None, None)


@pytest.mark.parametrize(
    ("z", "label"),
    [
        (1.96, "significant decrease"),
        (1.95, "No significant change"),
        (-1.96, "significant increase"),
        (None, None),
    ],
)
def test_care_labels(spark, z, label):
    frame = spark.createDataFrame([(z,)], "z double")
    assert frame.select(care_label("z", 1.96)).first()[0] == label


def test_care_report_has_the_control_row_once(spark):
    people = [visitor(1), visitor(2, 101), visitor(3, 102)]
    placed = [order(1, 1, 1), order(2, 1, 1, 101), order(3, 1, 1, 102)]
    rates = credit_rate(visitors(spark, people), orders(spark, placed), credits(spark, [2]), config())
    report = rows_by(care_report(rates, "credit_rate"), "test_sub_name")
    assert report["cell_100"] == {
        "test_sub_name": "cell_100",
        "credit_rate": 0.0,
        "significance": "control",
    }
    assert report["cell_101"]["credit_rate"] == 1.0 and len(report) == 3


def test_order_attribution(spark):
    people = [visitor(1, touch=2), visitor(2, 101, touch=2), visitor(3, touch=2)]
    raw = spark.createDataFrame(
        [
            (1, 1, moment(2).date(), 10.0, 1.0),
            (1, 2, moment(9).date(), 20.0, 2.0),
            (1, 3, moment(9).date(), 25.0, None),
            (1, 4, moment(10).date(), 30.0, 3.0),
            (1, 5, moment(1).date(), 40.0, 4.0),
            (2, 6, moment(5).date(), 50.0, 5.0),
            (9, 7, moment(5).date(), 60.0, 6.0),
        ],
        RAW_ORDERS,
    )
    found = rows_by(attribute_orders(visitors(spark, people), raw, 7), "order_id")
    assert {i: (r["days_from_touch"], r["order_count"]) for i, r in found.items()} == {
        1: (0, 3),
        2: (7, 3),
        3: (7, 3),
        6: (3, 1),
    }
    assert found[6]["test_sub_name"] == "cell_101" and found[3]["gm_usd"] is None


def test_credit_attribution(spark):
    placed = orders(spark, [order(1, 1, 1), order(1, 2, 2), order(2, 1, 1)])
    raw = spark.createDataFrame([(1, False), (1, True), (2, True), (5, False)], RAW_CREDITS)

    def given(drop):
        return {r.visitor_id: r.credits for r in attribute_credits(placed, raw, drop).collect()}

    assert given(False) == {1: 2, 2: 1}
    assert given(True) == {1: 1}


@pytest.mark.parametrize("days", [0, 1, 7])
def test_contact_attribution_equals_trying_all_pairs(spark, days):
    people = [visitor(i, touch=i % 23, shopper_key=i % 5 or None) for i in range(1, 80)]
    made = [(i % 5, i, moment(i % 31, hours=i % 24)) for i in range(60)]
    raw = spark.createDataFrame(made, RAW_CONTACTS)
    found = attribute_contacts(visitors(spark, people), raw, days)
    expected = sorted(
        (v["visitor_id"], v["shopper_key"], contact)
        for v in people
        for shopper, contact, at in made
        if v["shopper_key"] == shopper and 0 <= (at.date() - v["touch_date"]).days <= days
    )
    assert sorted(tuple(r) for r in found.collect()) == expected and expected


def test_contact_rate_from_raw_equals_the_rate_over_the_attributed_table(spark):
    people = [
        visitor(i, 100 + i % 3, touch=i % 11, shopper_key=1 if i % 3 else i % 17, is_hopper=int(i % 13 == 0))
        for i in range(1, 300)
    ]
    raw = spark.createDataFrame([(i % 17, i, moment(i % 25)) for i in range(200)], RAW_CONTACTS)
    table = visitors(spark, people)
    whole = contact_rate(table, attribute_contacts(table, raw, 7), config())
    direct = contact_rate_from_raw(table, raw, config())
    assert whole.count() == 2
    assert rows_by(direct, "test_sub_id") == rows_by(whole, "test_sub_id")


def test_a_busy_shopper_meets_each_contact_once_per_cell_and_day(spark):
    """Nine tenths of visitors share a shopper; the join grows with contacts, not with pairs."""
    from splitmetrics.operators.attribution import contacts_after_touch

    busy = spark.range(20_000).select(
        (100 + F.col("id") % 2).cast("int").alias("test_sub_id"),
        F.lit(1).cast("long").alias("shopper_key"),
        F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("touch_date"),
    )
    raw = spark.createDataFrame([(1, i, moment(i % 5)) for i in range(100)], RAW_CONTACTS)
    assert contacts_after_touch(busy.distinct(), raw, 7).count() <= 100 * 2 * 3
