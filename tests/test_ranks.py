import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from erpspark.operators import ranks
from erpspark.operators.ranks import code, cumulative_desc, exact_percentiles, ntile_columns, percentile_values
from erpspark.operators.upsert import dense_positions


@pytest.mark.parametrize("n, distinct", [(1, 1), (2, 2), (7, 3), (1000, 1), (1000, 5), (1001, 900)])
def test_percentiles_equal_numpy(spark, n, distinct):
    rng = random.Random(n * 31 + distinct)
    pool = [rng.uniform(-50, 50) for _ in range(distinct)]
    values = [rng.choice(pool) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = percentile_values(df, "v", {"a": 0.0, "b": 0.33, "c": 0.5, "d": 0.67, "e": 1.0})
    want = np.percentile(values, [0, 33, 50, 67, 100])
    assert list(got.values()) == pytest.approx(list(want), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("few", [0, 3, 1 << 16])
def test_groups_at_every_number_of_digits(spark, monkeypatch, few):
    """From one pass over the leading digit to all four, the result is the same."""
    monkeypatch.setattr(ranks, "SORTED", few)
    rng = random.Random(few)
    rows = [("hot", float(i % 17)) for i in range(2000)] + [("cold", 1.0), ("cold", 2.0), (None, -3.5), (None, None)]
    rows += [("near", 1 + i * 2**-50) for i in range(40)] + [("wide", rng.choice((-1, 1)) * 2 ** rng.uniform(-300, 300)) for _ in range(99)]
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r["g"]: (r["m"], r["t"]) for r in df.groupBy("g").agg(F.percentile("v", 0.4).alias("m"), F.percentile("v", 0.9).alias("t")).collect()}
    got = {r["g"]: (r["m"], r["t"]) for r in exact_percentiles(df, "v", {"m": 0.4, "t": 0.9}, by=["g"]).collect()}
    assert set(got) == set(want) and all(got[g] == pytest.approx(want[g], rel=1e-14) for g in want)


def test_code_orders_like_the_value(spark):
    rng = random.Random(5)
    values = {0.0, 5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, float("inf"), 1.0, 8.0, np.nextafter(8.0, 0).item(), np.nextafter(8.0, 9).item()}
    values |= {2.0**e for e in range(-1000, 1000, 37)} | {np.nextafter(2.0**e, 0).item() for e in range(-1000, 1000, 37)} | {rng.uniform(0, 1e6) for _ in range(200)}
    values = sorted(values | {-v for v in values})
    codes = [r["c"] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", code(F.col("v")).alias("c")).orderBy("i").collect()]
    assert codes == sorted(codes)
    normal = [c for c, v in zip(codes, values) if abs(v) > 1e-300]
    assert len(set(normal)) == len(normal)


def test_input_is_read_once(spark, monkeypatch):
    """The plan that reads the input is run for the written table only."""
    frames = []
    keep = ranks.written
    monkeypatch.setattr(ranks, "written", lambda df, name: frames.append((name, df)) or keep(df, name))
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 7 % 100).cast("double").alias("v"))
    ntile_columns(df, 5, {"t": (F.col("v"), False)}, "k").count()
    plans = {name: f._jdf.queryExecution().optimizedPlan().toString() for name, f in frames}
    assert [name for name, plan in plans.items() if "Range (0, 1000" in plan] == ["ntile-rows"]


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert percentile_values(df, "v", {"m": 0.5}) == {"m": None}


@pytest.mark.parametrize("n", [1, 3, 5, 6, 23, 400])
def test_scaled_ntile_equals_builtin(spark, n):
    rng = random.Random(n)
    # a third of all rows share one value; some are NULL
    rows = [(i, 1 if i % 3 == 0 else rng.choice([None, 2, 3, i])) for i in range(n)]
    df = spark.createDataFrame(rows, "k bigint, v bigint")
    got = ntile_columns(df, 5, {"up": (F.col("v"), False), "down": (F.col("v"), True)}, "k")
    want = df.select(
        "k", "v",
        F.ntile(5).over(Window.orderBy(F.col("v").asc_nulls_last(), "k")).alias("up"),
        F.ntile(5).over(Window.orderBy(F.col("v").desc_nulls_first(), "k")).alias("down"),
    )
    assert sorted(got.select("k", "up", "down").collect()) == sorted(want.select("k", "up", "down").collect())


def test_cumulative_share_keeps_ties_together(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([5, 9, 5, 1, 5, 20])], "k int, v int")
    got = {r["k"]: r["c"] for r in cumulative_desc(df, "v", "c").collect()}
    assert got == {5: 20, 1: 29, 0: 44, 2: 44, 4: 44, 3: 45}


def test_dense_positions(spark):
    keys = [7, 1000, -3, 42, 5, 6]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r["k"]: r["p"] for r in dense_positions(df, "k", "p", after=10).collect()}
    assert got == {k: 11 + i for i, k in enumerate(sorted(keys))}
