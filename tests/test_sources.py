import os

import pytest
from frames import config, order, orders, visitor, visitors

from splitmetrics import schema
from splitmetrics.operators.rollups import order_profile
from splitmetrics.sources import results, workspace
from splitmetrics.sources.tables import (
    TableNames,
    chunk_predicates,
    read_chunks,
    read_table,
    save_bucketed,
    with_constraint,
)


def test_chunks_hold_every_key_once_negative_ones_too(spark):
    keys = spark.range(-50, 50).withColumnRenamed("id", "k")
    for chunks in (1, 3, 4):
        predicates = chunk_predicates("k", chunks)
        parts = [keys.where(p).count() for p in predicates]
        assert len(parts) == chunks and sum(parts) == 100 and max(parts) - min(parts) <= 1


def test_chunks_with_a_constraint(spark):
    keys = spark.range(100).withColumnRenamed("id", "k")
    for constraint in ("k < 10", "and k < 10"):
        assert sum(keys.where(p).count() for p in chunk_predicates("k", 4, constraint)) == 10
    for either in ("k < 10 or k > 89", "AND\n(k < 10) or k > 89", "and(k < 10 or k > 89)"):
        assert read_chunks(keys, "k", 4, either).count() == 20
        assert with_constraint(keys, either).count() == 20
    assert with_constraint(keys.withColumnRenamed("k", "android"), "android < 3").count() == 3
    with pytest.raises(ValueError, match="at least 1"):
        chunk_predicates("k", 0)


def test_constraint_text(spark):
    keys = spark.range(10)
    assert with_constraint(keys, "  AND id > 7 ").count() == 2
    assert with_constraint(keys, "").count() == with_constraint(keys, None).count() == 10


def test_names():
    names = TableNames(2, 6352)
    assert names.visitors == "visitors_2_6352"
    assert names.contacts == "visitors_2_6352_contact_level"
    assert TableNames(1, 7, order_prefix="ol", database="lab").credits == "lab.ol_1_7_credit_level"


def test_read_table_from_a_folder_or_the_catalog(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/numbers")
    assert read_table(spark, "numbers", str(tmp_path)).count() == 3
    spark.range(4).createOrReplaceTempView("numbers_view")
    assert read_table(spark, "numbers_view").count() == 4


def test_saving_replaces_only_the_experiments_own_partition(spark, tmp_path):
    base = str(tmp_path)
    first, second = config(test_id=1), config(test_id=2)
    results.save_frames({"numbers": spark.range(5)}, base, first)
    results.save_frames({"numbers": spark.range(7)}, base, second)
    results.save_frames({"numbers": spark.range(3)}, base, first)
    assert results.load_frame(spark, base, "numbers", first).count() == 3
    assert results.load_frame(spark, base, "numbers", second).count() == 7
    results.save_frames({"numbers": spark.range(0)}, base, second)
    assert results.load_frame(spark, base, "numbers", second).count() == 0
    assert results.load_frame(spark, base, "numbers", first).columns == ["id"]


def test_history_is_appended(spark, tmp_path):
    path = str(tmp_path / "history")
    results.append_run_history(spark, path, config(), {"summary": 1.5, "total_time": 2.0})
    before = set(os.listdir(path))
    results.append_run_history(spark, path, config(test_id=9), {"summary": 3.0})
    assert before <= set(os.listdir(path))
    rows = {r.test_id: r for r in results.read_run_history(spark, path).collect()}
    assert (rows[1].summary, rows[1].total_time, rows[1].cohort) == (1.5, 2.0, None)
    assert rows[9].spark_version == spark.version and rows[9].rundate is not None
    assert len(results.RUN_HISTORY) == 17


class _Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_stage_writes_to_the_shared_folder(spark):
    staged = workspace.stage(spark.range(4), "numbers")
    assert staged.count() == 4 and staged.columns == ["id"]
    folder = workspace.shared_folder(spark)
    assert all(f"{folder}/splitmetrics/" in file for file in staged.inputFiles())


def test_shared_folder_is_the_one_the_session_names():
    named = _Session(spark_checkpoint_dir="/shared/checkpoints/", spark_master="yarn")
    assert workspace.shared_folder(named) == "/shared/checkpoints"
    local = _Session(spark_master="local[4]", spark_app_id="app-1")
    assert workspace.shared_folder(local) == workspace.shared_folder(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_folder(_Session(spark_master="spark://host:7077"))


def test_validation(spark):
    table = visitors(spark, [visitor(1)])
    assert schema.validate(table, schema.VISITORS, "visitors") is table
    with pytest.raises(ValueError, match="visitors: shopper_key is missing"):
        schema.validate(table.drop("shopper_key"), schema.VISITORS, "visitors")
    wrong = table.withColumn("touch_date", table["touch_date"].cast("string"))
    with pytest.raises(ValueError, match="touch_date is string, not date"):
        schema.validate(wrong, schema.VISITORS, "visitors")
    placed = orders(spark, [order(1, 1, 1)])
    decimal = placed.withColumn("booking_usd", placed["booking_usd"].cast("decimal(12,2)"))
    assert schema.validate(decimal, schema.ORDERS, "orders") is decimal


def test_data_checks(spark):
    sound = [visitor(1), visitor(2, 101)]
    assert schema.conflicting_labels(visitors(spark, sound)).count() == 0
    renamed = [*sound, visitor(2, 101, test_sub_name="other")]
    assert [r.test_sub_id for r in schema.conflicting_labels(visitors(spark, renamed)).collect()] == [101]
    assert [r.visitor_id for r in schema.repeated_visitors(visitors(spark, renamed)).collect()] == [2]


@pytest.fixture
def bucketed(spark):
    """Orders as a table bucketed by visitor id; dropped again afterwards."""
    save_bucketed(orders(spark, [order(i, 10, 1) for i in range(1, 200, 3)]), "bucketed_orders", 4)
    yield spark.read.table("bucketed_orders")
    spark.sql("drop table bucketed_orders")


def test_the_profile_of_bucketed_orders_is_made_without_a_shuffle(spark, bucketed):
    plan = order_profile(bucketed)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan


def test_a_failed_save_leaves_the_rows_before(spark, tmp_path):
    results.save_frame(spark.range(3), str(tmp_path), "numbers", config())
    failing = spark.range(3).selectExpr("raise_error('no') as id")
    with pytest.raises(Exception, match="no"):
        results.save_frame(failing, str(tmp_path), "numbers", config())
    assert results.load_frame(spark, str(tmp_path), "numbers", config()).count() == 3


def test_closing_a_workspace_deletes_what_was_staged_in_it(spark, tmp_path):
    own = workspace.Workspace(spark, str(tmp_path))
    with own.active():
        staged = workspace.stage(spark.range(3), "numbers")
    outside = workspace.stage(spark.range(3), "numbers")
    assert staged.count() == 3 and os.listdir(tmp_path)
    own.close()
    assert os.listdir(tmp_path) == [] and outside.count() == 3
