"""Data-quality checks. Each returns rows (check_name, subject, status, observed, threshold)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from erpspark.functions.expr import first_match, pct, ratio, rounded, zero_if_null

# fixed values: minimum rows, NULL-rate limits (percent, known share) and tolerances
MIN_ROWS = {
    "dim_date": 3000, "dim_customer": 100, "dim_product": 5000, "dim_staff": 10, "dim_department": 5,
    "dim_warehouse": 1, "dim_warehouse_location": 1, "dim_supplier": 1, "dim_manufacture": 0, "dim_price_group": 0,
    "fact_orders": 1000, "fact_order_items": 1000, "fact_delivery_items": 1000, "fact_warehouse_stock": 100000,
    "fact_purchase_order_items": 1000, "fact_purchase_product_items": 1000, "fact_transfer_warehouse": 10000,
    "fact_production_order_items": 100, "fact_production_stages": 100,
}
LOW_VOLUME = {"fct_production_npl_cost": 100000, "fct_order_npl_cost": 10000}
NULL_LIMITS = [
    ("fact_orders", "customer_key", 0.5, None), ("fact_orders", "employee_key", 5.0, None),
    ("fact_order_items", "product_key", 0.5, None), ("fact_order_items", "customer_key", 0.5, None),
    ("fact_delivery_items", "product_key", 0.5, None), ("fact_delivery_items", "warehouse_key", 0.5, None),
    ("fact_warehouse_stock", "product_key", 2.0, 1.01), ("fact_warehouse_stock", "location_key", 1.0, None),
    ("fact_purchase_order_items", "product_key", 20.0, 14.78), ("fact_transfer_warehouse", "product_key", 5.0, 3.03),
    ("fact_purchase_product_items", "product_key", 0.5, None), ("fact_production_order_items", "product_key", 0.5, None),
]
KNOWN_SLACK = 1.5
LOT_TOLERANCE = 0.001
STALE_DAYS = 2
IN_TOLERANCE, OUT_TOLERANCE, NET_TOLERANCE = 0.1, 5.0, 5.0


def _row(check: str, subject: Column | str, status: Column, observed: Column, threshold: Column | float | None) -> list[Column]:
    return [
        F.lit(check).alias("check_name"),
        (F.lit(subject) if isinstance(subject, str) else subject).alias("subject"),
        status.alias("status"),
        observed.cast("double").alias("observed"),
        (F.lit(threshold) if not isinstance(threshold, Column) else threshold).cast("double").alias("threshold"),
    ]


def _passed(cond: Column) -> Column:
    return F.when(cond, "ok").otherwise("fail")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _unfold(stats: DataFrame, rows: list[list[Column]]) -> DataFrame:
    """Several result rows from one row of figures, so that what gives the figures is read once."""
    return stats.select(F.inline(F.array(*[F.struct(*r) for r in rows])))


@dataclass(frozen=True)
class Rules:
    """What is declared for one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    least: int | None = None  # fewer rows fail
    volume: int | None = None  # fewer rows warn
    null_rates: tuple[tuple[str, float, float | None], ...] = ()  # key, limit in percent, known share


def table_checks(df: DataFrame, table: str, rules: Rules) -> DataFrame:
    """All declared checks of a table from one read of it.

    Without unique keys that is one aggregate. With them, rows are first counted per key value (map-side partial
    counts; several keys as text, one pair per row and key), the other counts ride along with the first key, and a
    second aggregate sums up. NULLs do not count as repeated; an empty table has no NULLs.
    """
    columns = list(dict.fromkeys([*rules.not_null, *(c for c, _, _ in rules.null_rates)]))
    nulls = {c: f"__nulls_{i}" for i, c in enumerate(columns)}
    repeated = {c: f"__repeated_{i}" for i, c in enumerate(rules.unique)}
    flags = [F.col(c).isNull().cast("bigint").alias(n) for c, n in nulls.items()]
    if not rules.unique:
        stats = df.select(*flags).agg(F.count(F.lit(1)).alias("__rows"), *[F.sum(n).alias(n) for n in nulls.values()])
    else:
        if len(rules.unique) == 1:
            pairs = df.select(*flags, F.lit(0).alias("__i"), F.col(rules.unique[0]).alias("__v"))
        else:
            keys = F.array(*[F.struct(F.lit(i).alias("__i"), F.col(c).cast("string").alias("__v")) for i, c in enumerate(rules.unique)])
            pairs = df.select(*flags, F.inline(keys))
        counted = pairs.groupBy("__i", "__v").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(n).alias(n) for n in nulls.values()])
        first = F.col("__i") == 0
        twice = F.col("__v").isNotNull() & (F.col("__n") > 1)
        stats = counted.agg(
            F.sum(F.when(first, F.col("__n"))).alias("__rows"), *[F.sum(F.when(first, F.col(n))).alias(n) for n in nulls.values()],
            *[F.count_if(twice & (F.col("__i") == i)).alias(n) for i, n in enumerate(repeated.values())],
        )
    stats = stats.na.fill(0)
    n_rows = F.col("__rows")
    out = [_row("not_null", f"{table}.{c}", _passed(F.col(nulls[c]) == 0), F.col(nulls[c]), 0) for c in rules.not_null]
    out += [_row("unique", f"{table}.{c}", _passed(F.col(n) == 0), F.col(n), 0) for c, n in repeated.items()]
    if rules.least is not None:
        out.append(_row("min_rows", table, _passed(n_rows >= rules.least), n_rows, rules.least))
    if rules.volume is not None:
        out.append(_row("mart_volume", table, F.when(n_rows >= rules.volume, "ok").otherwise("warn"), n_rows, rules.volume))
    out += [_null_rate(f"{table}.{c}", zero_if_null(ratio(F.col(nulls[c]) * 100, n_rows)), limit, known) for c, limit, known in rules.null_rates]
    return _unfold(stats, out)


def _null_rate(subject: str, share: Column, limit: float, known: float | None) -> list[Column]:
    """Fail above the limit, only warn while below 1.5 x the known share."""
    levels = [(share <= limit, "ok")]
    if known is not None:
        levels.append((share < known * KNOWN_SLACK, "warn"))
    return _row("null_rate", subject, first_match(levels, "fail"), rounded(share, 4), limit)


def _unpivot(counts: DataFrame, table: str, names: list[str]) -> DataFrame:
    """One aggregate row into (subject, observed) rows."""
    pairs = F.array(*[F.struct(F.lit(f"{table}.{n}").alias("subject"), F.col(n).alias("observed")) for n in names])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = _unpivot(counts, table, columns)
    return rows.select(*_row("not_null", F.col("subject"), _passed(F.col("observed") == 0), F.col("observed"), 0))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    repeated = df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    n = repeated.agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_row("unique", f"{table}.{column}", _passed(F.col("n") == 0), F.col("n"), 0))


def must_be_empty(check: str, subject: str, rows: DataFrame) -> DataFrame:
    n = rows.agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_row(check, subject, _passed(F.col("n") == 0), F.col("n"), 0))


def month_stock_not_negative(monthly: DataFrame) -> DataFrame:
    return must_be_empty("month_stock_not_negative", "fct_stock_monthly_snapshot", monthly.filter("est_qty_end_month < 0"))


def min_rows(df: DataFrame, table: str, least: int | None = None) -> DataFrame:
    least = MIN_ROWS[table] if least is None else least
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_row("min_rows", table, _passed(F.col("n") >= least), F.col("n"), least))


def mart_volume(df: DataFrame, mart: str) -> DataFrame:
    low = LOW_VOLUME.get(mart, 1)
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return n.select(*_row("mart_volume", mart, F.when(F.col("n") >= low, "ok").otherwise("warn"), F.col("n"), low))


def null_rates(df: DataFrame, table: str, limits: list[tuple] | None = None) -> DataFrame:
    """NULL share per key: fail above the limit, only warn while below 1.5 x the known share."""
    return table_checks(df, table, Rules(null_rates=tuple(x[1:] for x in (limits or NULL_LIMITS) if x[0] == table)))


def freshness(state: DataFrame, as_of: date, days: int = STALE_DAYS) -> DataFrame:
    """Age of every high-water mark in days; marks that are not dates pass."""
    day = F.try_to_date(F.substring("last_loaded_at", 1, 10), "yyyy-MM-dd")
    age = F.datediff(F.lit(as_of), day)
    status = first_match([(F.col("last_loaded_at").isNull(), "warn"), (age > days, "warn")], "ok")
    return state.select(*_row("freshness", F.col("table_name"), status, age, days))


# --- stock reconciliation -------------------------------------------------------


def _lot_gap() -> Column:
    return F.col("quantity_left") - (F.col("quantity") - F.col("quantity_export"))


def lot_balance(lots: DataFrame) -> DataFrame:
    """Left = received - issued over all lots, with the number of lots that drift."""
    return lots.agg(
        F.count(F.lit(1)).alias("total_lots"),
        F.count_if(F.abs(_lot_gap()) > LOT_TOLERANCE).alias("lots_drift"),
        rounded(F.sum("quantity"), 2).alias("total_in"),
        rounded(F.sum("quantity_export"), 2).alias("total_out"),
        rounded(F.sum("quantity_left"), 2).alias("total_left"),
        rounded(F.sum("quantity") - F.sum("quantity_export"), 2).alias("expected_left"),
        rounded(F.sum(_lot_gap()), 2).alias("drift"),
    ).withColumn("status", F.when((F.abs("drift") < 0.01) & (F.col("lots_drift") == 0), "ok").otherwise("warn"))


def lot_drift_top(lots: DataFrame, k: int = 10) -> DataFrame:
    gap = _lot_gap()
    return (
        lots.filter(F.abs(gap) > LOT_TOLERANCE)
        .withColumn("expected_left", rounded(F.col("quantity") - F.col("quantity_export"), 2))
        .withColumn("drift", rounded(gap, 2))
        .orderBy(F.abs("drift").desc_nulls_last(), "stock_id")
        .limit(k)
    )


def snapshot_against_moves(snapshot: DataFrame, moves: DataFrame) -> DataFrame:
    """Receipts, issues and stock of the lots against the movement totals, each with a tolerance."""
    snap = snapshot.select(
        F.lit("snap").alias("side"), F.col("quantity").alias("q_in"), F.col("quantity_exported").alias("q_out"),
        F.col("quantity_left").alias("q_left"),
    )
    io = moves.select(
        F.lit("io").alias("side"), F.col("quantity_in").alias("q_in"), F.col("quantity_out").alias("q_out"),
        (F.col("quantity_in") - F.col("quantity_out")).alias("q_left"),
    )
    wide = snap.unionByName(io)
    sums = wide.agg(
        *[
            rounded(F.sum(F.when(F.col("side") == s, F.col(c))), 0).alias(f"{s}_{c}")
            for s in ("snap", "io")
            for c in ("q_in", "q_out", "q_left")
        ]
    )
    checks = []
    for name, c, base, limit in (
        ("receipts", "q_in", "io", IN_TOLERANCE), ("issues", "q_out", "io", OUT_TOLERANCE), ("stock", "q_left", "snap", NET_TOLERANCE),
    ):
        gap = zero_if_null(ratio(F.abs(F.col(f"snap_{c}") - F.col(f"io_{c}")) * 100, F.col(f"{base}_{c}")))
        checks.append(
            [
                *_row("snapshot_vs_moves", name, F.when(gap < limit, "ok").otherwise("warn"), rounded(gap, 4), limit),
                F.col(f"snap_{c}").cast("double").alias("snapshot_total"), F.col(f"io_{c}").cast("double").alias("movement_total"),
            ]
        )
    return _unfold(sums, checks)


def warehouse_drift(snapshot: DataFrame, moves: DataFrame, k: int = 10) -> DataFrame:
    snap = snapshot.groupBy("warehouse_key", "warehouse_name").agg(
        rounded(F.sum("quantity"), 0).alias("snap_in"), rounded(F.sum("quantity_exported"), 0).alias("snap_out"),
        rounded(F.sum("quantity_left"), 0).alias("snap_left"),
    )
    io = moves.groupBy("warehouse_key").agg(
        rounded(F.sum("quantity_in"), 0).alias("io_in"), rounded(F.sum("quantity_out"), 0).alias("io_out")
    )
    return (
        snap.join(io, "warehouse_key", "left")
        .withColumn("io_net", F.col("io_in") - F.col("io_out"))
        .withColumn("drift", F.col("snap_left") - F.col("io_net"))
        .orderBy(F.abs("drift").desc_nulls_last(), "warehouse_key")
        .limit(k)
    )


def lot_anomalies(lots: DataFrame) -> DataFrame:
    return lots.agg(
        F.count_if(F.col("quantity_left") < 0).alias("lots_negative"),
        F.count_if(F.col("quantity_export") > F.col("quantity")).alias("lots_overexport"),
        rounded(F.sum(F.when(F.col("quantity_left") < 0, F.col("quantity_left"))), 0).alias("total_negative"),
    ).withColumn("status", F.when((F.col("lots_negative") == 0) & (F.col("lots_overexport") == 0), "ok").otherwise("warn"))


def worst_lots(lots: DataFrame, products: DataFrame, warehouses: DataFrame, k: int = 10) -> DataFrame:
    """Lots with the smallest negative stock, with product and warehouse."""
    negative = lots.filter(F.col("quantity_left") < 0)
    return (
        negative.join(products.select("product_key", "product_code", "product_name"), "product_key")
        .join(warehouses.select("warehouse_key", "warehouse_name"), "warehouse_key")
        .orderBy("quantity_left", "stock_id")
        .limit(k)
    )


def yearly_flow(moves: DataFrame) -> DataFrame:
    per = (
        moves.filter(F.col("year").isNotNull())
        .groupBy("year")
        .agg(F.sum("quantity_in").alias("i"), F.sum("quantity_out").alias("o"))
    )
    return per.select(
        "year", rounded("i", 0).alias("quantity_in"), rounded("o", 0).alias("quantity_out"),
        rounded(F.col("i") - F.col("o"), 0).alias("net"), pct(F.col("i") - F.col("o"), "i", 1).alias("net_pct"),
        F.when(F.col("o") > F.col("i"), "warn").otherwise("ok").alias("status"),
    )


# --- structure ---------------------------------------------------------------------


def date_dim_checks(dates: DataFrame, start: date, end: date) -> DataFrame:
    weekend = F.col("day_of_week").isin(0, 6)
    days = (end - start).days + 1
    stats = dates.agg(
        F.count(F.lit(1)).alias("n"), F.min("full_date").alias("first"), F.max("full_date").alias("last"),
        F.count_distinct("date_key").alias("keys"), F.count_if(F.col("is_weekend") != weekend).alias("weekend"),
        F.count_if(F.col("date_key") != F.date_format("full_date", "yyyyMMdd").cast("int")).alias("format"),
    )
    return _unfold(
        stats,
        [
            _row("date_dim", "row_count", _passed(F.col("n") == days), F.col("n"), days),
            _row("date_dim", "first_day", _passed(F.col("first") == F.lit(start)), F.datediff("first", F.lit(start)), 0),
            _row("date_dim", "last_day", _passed(F.col("last") == F.lit(end)), F.datediff("last", F.lit(end)), 0),
            _row("date_dim", "unique_key", _passed(F.col("keys") == F.col("n")), F.col("n") - F.col("keys"), 0),
            _row("date_dim", "weekend_rule", _passed(F.col("weekend") == 0), F.col("weekend"), 0),
            _row("date_dim", "key_format", _passed(F.col("format") == 0), F.col("format"), 0),
        ],
    )


def schema_check(df: DataFrame, table: str, expected: T.StructType) -> DataFrame:
    """Expected columns of a table against its schema: ok, wrong type, or missing."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    rows = []
    for f in expected:
        have, want = found.get(f.name), f.dataType.simpleString()
        status = "ok" if have == want else ("fail" if have is None else "warn")
        rows.append((table, f.name, want, have, status))
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, expected string, found string, status string"
    )


def filled_counts(df: DataFrame) -> DataFrame:
    """Non-NULL values per column, one pass over the table."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def layer_inventory(frames: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df in frames.items()]
    )


def summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def run_failed(results: DataFrame, strict: bool = False) -> bool:
    """Whether a run should stop: on failures, and with ``strict`` on warnings too."""
    bad = ["fail", "warn"] if strict else ["fail"]
    return not results.filter(F.col("status").isin(bad)).isEmpty()


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "check_name string, subject string, status string, observed double, threshold double")
