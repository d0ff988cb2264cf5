"""Stored join sides are sent out by their true size."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from erpspark.operators.lookup import sized
from erpspark.operators.upsert import heal_keys, new_rows
from erpspark.plans import core, runner
from erpspark.session import written
from erpspark.sources import sinks


@pytest.fixture
def small_threshold(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "512k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _wide(spark, rows, *ids):
    """Ids beside many columns that are NULL, as a dimension or a fact has them."""
    columns = [F.col("id").alias(c) for c in ids] + [F.lit(None).cast("string").alias(f"c{i}") for i in range(40)]
    return spark.range(0, rows, 1, 1).select(*columns, F.lit(2020).alias("year"))


def _broadcasts(df) -> bool:
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_mostly_null_tables_are_not_broadcast(spark, small_threshold):
    """Of 60 000 stored keys 960 kB would be sent out; their share of the table's columns is a fraction of that."""
    stored = written(_wide(spark, 60000, "order_id", "customer_key", "employee_key"), "fact_orders")
    batch = spark.range(50000, 70000).withColumnRenamed("id", "order_id")
    assert _broadcasts(new_rows(stored, batch, "order_id"))  # what Spark's own estimate does
    added = new_rows(sized(stored, ["order_id"]), batch, "order_id")
    assert not _broadcasts(added) and added.count() == 10000
    fresh = sized(stored.select("order_id", "customer_key", "employee_key"))
    healed = heal_keys(stored, fresh, "order_id", ["customer_key", "employee_key"])
    assert not _broadcasts(healed) and healed.filter("key_fixed").count() == 0


def test_small_sides_are_still_broadcast(spark, small_threshold):
    stored = written(_wide(spark, 1000, "order_id"), "fact_orders")
    added = new_rows(sized(stored, ["order_id"]), spark.range(900, 1100).withColumnRenamed("id", "order_id"), "order_id")
    assert _broadcasts(added) and added.count() == 100


def test_runner_looks_keys_up_by_their_true_size(spark, database, small_threshold):
    """Orders meet 60 000 customers, most of whose columns are NULL."""
    star = runner.Star(spark, database("raw"), database("core"))
    sinks.replace_table(_wide(spark, 60000, "customer_id", "customer_key"), star.core("dim_customer"))
    sinks.replace_table(_wide(spark, 10, "staff_id", "staff_key"), star.core("dim_staff"))
    orders = spark.range(100).selectExpr("id", "id AS customer_id", "id % 20 AS employee_id", "date '2020-01-01' AS date")
    found = core.fact_rows("fact_orders", {"tbl_orders": orders}, star.key_maps("fact_orders"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
    assert found.filter("customer_key = order_id").count() == 100 and found.filter("employee_key is null").count() == 50
