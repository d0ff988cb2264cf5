"""Bucketed dimensions: results of several loads, and plans that leave the stored side where it is."""

import pytest

from erpspark.operators.keymap import BucketedDimension

DDL = "id bigint, name string, city string"


@pytest.fixture
def dim(spark, database):
    return BucketedDimension(spark, f"{database('dims')}.dim_x", "id", "key", 8)


def _by_id(dim):
    return {r["id"]: (r["key"], r["name"], r["city"]) for r in dim.rows().collect()}


def test_loads(spark, dim):
    dim.load(spark.createDataFrame([(i, f"n{i}", "a") for i in range(0, 40, 2)] + [(None, "lost", "a")], DDL))
    first = _by_id(dim)
    assert sorted(k for k, _, _ in first.values()) == list(range(1, 21))
    batch = spark.createDataFrame([(i, f"m{i}") for i in range(10, 30)], "id int, name string")  # narrower type, one column fewer
    for _ in range(2):  # the replay changes nothing
        dim.load(batch)
        now = _by_id(dim)
        assert {i: now[i][0] for i in first} == {i: v[0] for i, v in first.items()}
        assert sorted(k for k, _, _ in now.values()) == list(range(1, 31))
        assert all(now[i][1:] == ((f"m{i}" if 10 <= i < 30 else f"n{i}"), "a") for i in first)
        assert all(now[i][1:] == (f"m{i}", None) for i in range(11, 30, 2))
    dim.load(spark.createDataFrame([], DDL))
    assert _by_id(dim) == now and dim.keys().count() == 30


def test_load_that_broke_off(spark, dim):
    dim.load(spark.createDataFrame([(1, "a", "x")], DDL))
    batch = spark.createDataFrame([(1, "b", "x"), (2, "c", "y"), (3, "d", "y")], DDL)
    # the map got the new keys, the dimension did not
    dim._save(spark.createDataFrame([(3, 2), (2, 3)], "id bigint, key bigint"), dim.map_table, "append")
    dim.load(batch)
    assert _by_id(dim) == {1: (1, "b", "x"), 2: (3, "c", "y"), 3: (2, "d", "y")}


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan.count("Exchange")


def test_stored_side_is_not_shuffled(spark, dim):
    dim.load(spark.createDataFrame([(i, "n", "a") for i in range(50)], DDL))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = spark.createDataFrame([(i, "m", "b") for i in range(30, 70)], DDL)
        assert _exchanges(dim.matched(batch)) == (1, 1)  # the batch
        dim._save(dim.matched(batch).drop("__place"), f"{dim.table}__batch")
        assert _exchanges(dim.merged(spark.table(f"{dim.table}__batch"))) == (0, 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
