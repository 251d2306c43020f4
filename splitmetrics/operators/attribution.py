"""Attributing raw orders, credits and contacts to the visitors of an experiment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitmetrics.operators import bloom
from splitmetrics.operators.population import CELL_COLUMNS
from splitmetrics.schema import ORDERS
from splitmetrics.sources.workspace import stage


def _days_after_touch(day: str) -> Column:
    return F.date_diff(F.col(day), F.col("touch_date"))


def touch_period(touches: DataFrame) -> tuple[date, date] | None:
    """The first and last touch date; None without any touch. One small aggregation, run at once."""
    return _period_and_count(touches)[0]


def _period_and_count(touches: DataFrame) -> tuple[tuple[date, date] | None, int]:
    day = F.to_date("touch_date")
    first, last, count = touches.agg(F.min(day), F.max(day), F.count("*")).first()
    return None if first is None else (first, last), count


def in_reach(
    events: DataFrame, at: str, period: tuple[date, date] | None, days: int
) -> DataFrame:
    """Events from the first touch to ``days`` after the last one.

    Both ends are constants compared with the stored column, so that the scan of the events
    skips the partitions and row groups outside.
    """
    if period is None:
        return events.where(F.lit(False))
    first, last = period
    end = last + timedelta(days=days + 1)
    return events.where((F.col(at) >= F.lit(first)) & (F.col(at) < F.lit(end)))


def of_visitors(events: DataFrame, visitors: DataFrame, count: int) -> DataFrame:
    """Events without most of those of visitors that are not in the test, by a Bloom filter of its ids.

    The filter's size is bounded; a test with too many visitors for it goes without one.
    """
    words = bloom.words_for(count)
    if words is None:
        return events
    known = stage(bloom.bloom_filter(visitors, "visitor_id", words), "visitor_filter")
    return bloom.probably_in(events, "visitor_id", known, words)


def attribute_orders(visitors: DataFrame, raw_orders: DataFrame, days: int) -> DataFrame:
    """Orders placed within ``days`` of the visitor's first touch, with their cell.

    ``order_count`` is the visitor's number of such orders. It is taken from daily counts,
    which are aggregated before they are shuffled by visitor, so no visitor's orders have
    to be gathered to count them. The counted visitors are staged: a join of two tables is
    one in which Spark splits a visitor with very many orders over several tasks. Orders of other
    visitors mostly go where they are read, so they are not shuffled.
    """
    period, count = _period_and_count(visitors)
    near = of_visitors(in_reach(raw_orders, "order_date", period, days), visitors, count)
    orders = near.withColumn("order_day", F.to_date("order_date"))
    touched = visitors.select(
        "visitor_id", "test_id", *CELL_COLUMNS, F.to_date("touch_date").alias("touch_date")
    )
    in_window = _days_after_touch("order_day").between(0, days)
    daily = orders.groupBy("visitor_id", "order_day").agg(F.count("*").alias("placed"))
    counted = stage(
        touched.join(daily, "visitor_id")
        .where(in_window)
        .groupBy(*touched.columns)
        .agg(F.sum("placed").alias("order_count")),
        "ordering_visitors",
    )
    return (
        orders.join(counted, "visitor_id")
        .where(in_window)
        .withColumn("days_from_touch", _days_after_touch("order_day"))
        .select(*ORDERS.fieldNames(), "order_id")
    )


def attribute_credits(orders: DataFrame, raw_credits: DataFrame, drop_reorders: bool) -> DataFrame:
    """Credited visitors with attributed orders, and their number of credits.

    Credits for reorders are left out if asked.
    """
    kept = raw_credits.where(~F.col("is_reorder")) if drop_reorders else raw_credits
    credited = kept.groupBy("visitor_id").agg(F.count("*").alias("credits"))
    ordering = orders.select("visitor_id").distinct()
    return credited.join(ordering, "visitor_id", "left_semi")


def contacts_after_touch(
    touches: DataFrame,
    raw_contacts: DataFrame,
    days: int,
    period: tuple[date, date] | None = None,
) -> DataFrame:
    """Contacts of a shopper within ``days`` after a touch, with the columns of ``touches``.

    ``period`` is that of the touches, or a longer one, if the caller knows it.

    Time is cut into spans as long as the window. A contact can then only match touches of
    its own span and the one before, so the span becomes part of the join key: a busy
    shopper is spread over many keys, and rows far apart in time never meet.
    """
    span = days + 1
    near = in_reach(raw_contacts, "contact_ts", period or touch_period(touches), days)
    contacts = (
        near.select(
            "shopper_key", "contact_id", F.to_date("contact_ts").alias("contact_day")
        )
        .withColumn("_day", F.unix_date("contact_day"))
        .withColumn(
            "_span",
            F.explode(
                F.array_distinct(
                    F.array(F.floor(F.col("_day") / span), F.floor((F.col("_day") - days) / span))
                )
            ),
        )
    )
    spanned = touches.where(F.col("shopper_key").isNotNull()).withColumn(
        "_span", F.floor(F.unix_date(F.to_date("touch_date")) / span)
    )
    return (
        spanned.join(contacts, ["shopper_key", "_span"])
        .where(F.date_diff("contact_day", F.to_date("touch_date")).between(0, days))
        .select(*touches.columns, "contact_id")
    )


def attribute_contacts(visitors: DataFrame, raw_contacts: DataFrame, days: int) -> DataFrame:
    """Each visitor's contacts within ``days`` after the first touch."""
    touches = visitors.select("visitor_id", "shopper_key", "touch_date")
    return contacts_after_touch(touches, raw_contacts, days).drop("touch_date")


@dataclass(frozen=True)
class ContactLinks:
    """Which contacts belong to which visitors, without a row for each pair.

    Visitors of one shopper with the same touch date share their contacts. ``classes`` has shopper_key, touch_date, the
    number of ``visitors`` and of ``contacts`` they each have; ``members`` says which visitors are in a class, and
    ``events`` has the contacts by shopper and day.
    """

    classes: DataFrame
    members: DataFrame
    events: DataFrame
    days: int

    def counts(self) -> DataFrame:
        """visitor_id and its number of contacts, for visitors with any."""
        linked = self.members.join(self.classes, ["shopper_key", "touch_date"])
        return linked.select("visitor_id", F.col("contacts"))

    def listed(self) -> DataFrame:
        """A row for each visitor and contact, as ``attribute_contacts`` has them."""
        touches = self.members.select("visitor_id", "shopper_key", "touch_date")
        return contacts_after_touch(touches, self.events, self.days).drop("touch_date")


def link_contacts(visitors: DataFrame, raw_contacts: DataFrame, days: int) -> ContactLinks:
    """The contacts of each shopper's touch dates: at most a row for each touch, and ``days + 1`` for each contact day.

    Contacts are counted by shopper and day and each count is given to the touch dates it is in reach of, so a
    shopper with very many visitors and contacts makes as many rows as it has days, never their product.
    """
    touches = visitors.where(F.col("shopper_key").isNotNull()).select(
        "visitor_id", "shopper_key", F.to_date("touch_date").alias("touch_date")
    )
    members = stage(touches, "touches")
    events = in_reach(raw_contacts, "contact_ts", touch_period(members), days)
    daily = events.groupBy("shopper_key", F.to_date("contact_ts").alias("day")).agg(F.count("*").alias("placed"))
    reached = daily.select(
        "shopper_key",
        "placed",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(days)), lambda k: F.date_sub("day", k))).alias("touch_date"),
    )
    contacts = stage(reached.groupBy("shopper_key", "touch_date").agg(F.sum("placed").alias("contacts")), "contact_days")
    dates = stage(members.groupBy("shopper_key", "touch_date").agg(F.count("*").alias("visitors")), "touch_dates")
    return ContactLinks(dates.join(contacts, ["shopper_key", "touch_date"]), members, events, days)
