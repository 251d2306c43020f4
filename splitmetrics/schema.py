"""Schemas of the input tables, and checks against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*column) for column in columns])


VISITORS = _fields(
    ("visitor_id", T.LongType(), False),
    ("test_id", T.IntegerType(), False),
    ("test_name", T.StringType(), False),
    ("test_sub_id", T.IntegerType(), False),
    ("test_sub_name", T.StringType(), False),
    ("control_test", T.StringType(), False),
    ("is_hopper", T.IntegerType(), False),
    ("exposed_to_test", T.IntegerType(), False),
    ("touch_date", T.DateType(), False),
    ("is_new", T.IntegerType(), True),
    ("region", T.StringType(), True),
    ("website_country", T.StringType(), True),
    ("channel_group", T.StringType(), True),
    ("initial_device_type", T.StringType(), True),
    ("shopper_key", T.LongType(), True),
)

ORDERS = _fields(
    ("visitor_id", T.LongType(), False),
    ("test_id", T.IntegerType(), False),
    ("test_name", T.StringType(), False),
    ("test_sub_id", T.IntegerType(), False),
    ("test_sub_name", T.StringType(), False),
    ("control_test", T.StringType(), False),
    ("touch_date", T.DateType(), False),
    ("order_date", T.DateType(), False),
    ("days_from_touch", T.IntegerType(), False),
    ("order_count", T.LongType(), False),
    ("booking_usd", T.DoubleType(), True),
    ("gm_usd", T.DoubleType(), True),
)

CREDITS = _fields(("visitor_id", T.LongType(), False))

CONTACTS = _fields(
    ("visitor_id", T.LongType(), False),
    ("shopper_key", T.LongType(), True),
    ("contact_id", T.LongType(), False),
)

RAW_ORDERS = _fields(
    ("visitor_id", T.LongType(), False),
    ("order_id", T.LongType(), False),
    ("order_date", T.DateType(), False),
    ("booking_usd", T.DoubleType(), True),
    ("gm_usd", T.DoubleType(), True),
)

RAW_CREDITS = _fields(
    ("visitor_id", T.LongType(), False),
    ("is_reorder", T.BooleanType(), False),
)

RAW_CONTACTS = _fields(
    ("shopper_key", T.LongType(), False),
    ("contact_id", T.LongType(), False),
    ("contact_ts", T.TimestampNTZType(), False),
)

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NUMBERS = (T.NumericType,)


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    if isinstance(expected, _DATES):
        return isinstance(actual, _DATES)
    if isinstance(expected, T.NumericType):
        return isinstance(actual, (*_NUMBERS, T.BooleanType))
    return isinstance(actual, type(expected)) or isinstance(actual, T.NumericType)


def validate(table: DataFrame, expected: T.StructType, name: str) -> DataFrame:
    """Return ``table`` if it has the expected columns with usable types (no Spark job)."""
    problems = []
    for wanted in expected:
        if wanted.name not in table.columns:
            problems.append(f"{wanted.name} is missing")
        elif not _compatible(wanted.dataType, table.schema[wanted.name].dataType):
            found = table.schema[wanted.name].dataType.simpleString()
            problems.append(f"{wanted.name} is {found}, not {wanted.dataType.simpleString()}")
    if problems:
        raise ValueError(f"{name}: " + "; ".join(problems))
    return table


def check_visitors(visitors: DataFrame) -> None:
    """Raise if a cell has several names or roles, or a visitor several rows."""
    cells = [row["test_sub_id"] for row in conflicting_labels(visitors).limit(5).collect()]
    if cells:
        raise ValueError(f"visitors: cells with more than one name or role: {sorted(cells)}")
    ids = [row["visitor_id"] for row in repeated_visitors(visitors).limit(5).collect()]
    if ids:
        raise ValueError(f"visitors: ids on more than one row, among them {sorted(ids)}")


def conflicting_labels(visitors: DataFrame) -> DataFrame:
    """Cells whose id carries more than one name or role; empty in sound data."""
    names = ("test_sub_name", "control_test", "test_name")
    ends = [end(name).alias(f"{end.__name__}_{name}") for name in names for end in (F.min, F.max)]
    differs = [F.col(f"min_{name}") != F.col(f"max_{name}") for name in names]
    return visitors.groupBy("test_sub_id").agg(*ends).where(differs[0] | differs[1] | differs[2])


#: Ids of a bitmap and its bytes, and the bytes of a shuffled id with its count.
_BITMAP_IDS, _BITMAP_BYTES, _ROW_BYTES = 32_768, 4_096, 16


def repeated_visitors(visitors: DataFrame) -> DataFrame:
    """Visitor ids that occur on more than one row; empty in sound data.

    Every task marks its ids in bitmaps of 32,768 neighbouring ids each and only these are shuffled; where a range has more rows than
    marked ids, its rows are looked at. That is the smaller exchange where a task holds many ids of a range. Where the
    ids are scattered too widely for that, they are shuffled themselves.
    """
    ids = visitors.select("visitor_id")
    placed = ids.withColumn("task", F.spark_partition_id())
    low, high, count, tasks = placed.agg(
        F.min("visitor_id"), F.max("visitor_id"), F.count("*"), F.max("task") + 1
    ).first()
    if low is None:
        return _repeated(ids)
    bitmaps = min((high - low) // _BITMAP_IDS + 2, count)
    if bitmaps * _BITMAP_BYTES * tasks > count * _ROW_BYTES:
        return _repeated(ids)
    bucket = F.bitmap_bucket_number("visitor_id")
    crowded = (
        ids.groupBy(bucket.alias("bucket"))
        .agg(
            F.count("*").alias("rows"),
            F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("visitor_id"))).alias("ids"),
        )
        .where("rows > ids")
        .select(F.col("bucket").alias("crowded"))
    )
    return _repeated(ids.join(crowded, bucket.eqNullSafe(F.col("crowded")), "left_semi"))


def _repeated(ids: DataFrame) -> DataFrame:
    copies = ids.groupBy("visitor_id").agg(F.count("*").alias("copies"))
    return copies.where("copies > 1")
