"""Experiment tables derived from the TPC-H-like sample tables.

Customer orders stand in for visitors and returned line items for their orders. Money is
cut to whole cents with floor, so that sums agree between engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splitmetrics.plans.pipeline import InputTables, RawEvents


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def visitors(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation, region = (
        _table(spark, folder, name) for name in ("orders", "customer", "nation", "region")
    )
    key, customer_key = F.col("o_orderkey"), F.col("o_custkey")
    cell = key % 4
    return (
        orders.join(customer, customer_key == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (key + 1).alias("visitor_id"),
            F.lit(1).alias("test_id"),
            F.lit("EXP_1").alias("test_name"),
            (100 + cell).cast("int").alias("test_sub_id"),
            F.concat(F.lit("cell_"), (100 + cell).cast("string")).alias("test_sub_name"),
            F.when(cell == 0, "C").when(cell == 3, "AC").otherwise("T").alias("control_test"),
            F.when(key % 23 == 7, 1)
            .when(key % 23 == 8, 2)
            .when(key % 23 == 9, 3)
            .otherwise(0)
            .alias("is_hopper"),
            F.when(key % 7 == 0, 0).otherwise(1).alias("exposed_to_test"),
            F.date_add(F.lit("2024-01-01").cast("date"), (customer_key % 20).cast("int")).alias(
                "touch_date"
            ),
            (customer_key % 2).cast("int").alias("is_new"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("website_country"),
            F.col("o_orderpriority").alias("channel_group"),
            F.col("o_orderstatus").alias("initial_device_type"),
            F.when(customer_key % 11 != 0, customer_key).alias("shopper_key"),
        )
    )


def _returned_lines(spark: SparkSession, folder: str) -> DataFrame:
    cents = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) / 10)
    return (
        _table(spark, folder, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            (F.col("l_orderkey") + 1).alias("visitor_id"),
            "l_partkey",
            "l_linenumber",
            ((F.col("l_partkey") + F.col("l_suppkey")) % 15).cast("int").alias("days_from_touch"),
            (cents / 100.0).alias("booking_usd"),
            (F.floor(cents * (F.col("l_quantity") - 5) / 60) / 100.0).alias("gm_usd"),
        )
    )


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines with the visitor's cell and the date they fall on."""
    lines = _returned_lines(spark, folder)
    placed = lines.groupBy("visitor_id").agg(F.count("*").alias("order_count"))
    cells = visitors(spark, folder).select(
        "visitor_id",
        "test_id",
        "test_name",
        "test_sub_id",
        "test_sub_name",
        "control_test",
        "touch_date",
    )
    return lines.join(cells.join(placed, "visitor_id"), "visitor_id").withColumn(
        "order_date", F.date_add("touch_date", F.col("days_from_touch"))
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(spark, folder).drop("l_partkey", "l_linenumber")


def _is_credited():
    return F.col("l_partkey") % 9 == 0


def credits(spark: SparkSession, folder: str) -> DataFrame:
    """Credited lines all belong to visitors, so the lines alone say who was credited."""
    known = visitors(spark, folder).select("visitor_id")
    credited = _returned_lines(spark, folder).where(_is_credited()).select("visitor_id")
    return credited.join(known, "visitor_id", "left_semi")


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    from splitmetrics.operators.attribution import attribute_contacts

    return attribute_contacts(visitors(spark, folder), raw_contacts(spark, folder), 7)


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(spark, folder).select(
        "visitor_id",
        (F.col("visitor_id") * 10 + F.col("l_linenumber")).alias("order_id"),
        "order_date",
        "booking_usd",
        "gm_usd",
    )


def raw_credits(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _returned_lines(spark, folder)
        .where(_is_credited())
        .select("visitor_id", (F.col("l_linenumber") > 4).alias("is_reorder"))
    )


def raw_contacts(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _table(spark, folder, "events")
        .where(F.col("event_type") == "error")
        .select(
            F.col("user_id").alias("shopper_key"),
            F.col("event_id").alias("contact_id"),
            F.col("ts").alias("contact_ts"),
        )
    )


def input_tables(spark: SparkSession, folder: str) -> InputTables:
    return InputTables(
        visitors=visitors(spark, folder),
        orders=orders(spark, folder),
        credits=credits(spark, folder),
        contacts=contacts(spark, folder),
        raw=RawEvents(
            orders=raw_orders(spark, folder),
            credits=raw_credits(spark, folder),
            contacts=raw_contacts(spark, folder),
        ),
    )
