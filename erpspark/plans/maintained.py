"""Revenue mart kept current by sums that can be added and subtracted.

Stored are partial sums per day, customer and branch, one partition per load. A load brings new, healed and
replaced orders and lines; what the orders that it touches counted for so far is subtracted, what they count for now
is added, and only that is written. The mart is the sum over all loads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from erpspark.functions.expr import pct, ratio
from erpspark.operators.lookup import lookup
from erpspark.plans import sales
from erpspark.session import written
from erpspark.sources import sinks

GRAIN = ["order_date_key", "customer_key", "id_branch"]
SUMS = "revenue cogs gross_profit total_tax total_discount revenue_raw spike_line_count".split()
PAIR = ["customer_key", "product_key"]
ITEM_COLUMNS = ["order_item_id", "order_id", "product_key", "quantity", "total_amount"]
ORDER_COLUMNS = [
    "order_id", "customer_key", "id_branch", "order_date_key", "order_date", "is_cancel", "grand_total", "total_cost", "total_tax",
    "total_discount_percent", "total_discount_direct",
]


def _counts(df: DataFrame) -> DataFrame:
    """Partial sums per grain of signed rows: orders, and per measure the sum and the number of values (a sum of none is NULL)."""
    out = df.groupBy(*GRAIN).agg(
        F.sum("orders").alias("orders"),
        *[F.sum(c).alias(c) for m in SUMS for c in (f"s_{m}", f"n_{m}")],
    )
    kinds = {f"s_{m}": "bigint" if m == "spike_line_count" else "decimal(38,4)" for m in SUMS}
    return out.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()})


def _contributions(orders: DataFrame, lines: DataFrame, by: tuple[str, ...] = ("order_id",), sign: Column | None = None) -> DataFrame:
    """What each order with its repaired lines counts for, subtracted where ``sign`` is negative."""
    rows = sales.adjusted(orders, lines, by, fulfilment=False)
    rows = rows.withColumn("total_discount", F.col("total_discount_percent") + F.col("total_discount_direct")).withColumn(
        "revenue_raw", F.col("grand_total")
    )
    kind = {m: "bigint" if m == "spike_line_count" else "decimal(28,4)" for m in SUMS}

    def signed(value: Column) -> Column:
        return value if sign is None else F.when(sign < 0, -value).otherwise(value)

    return rows.select(
        *GRAIN,
        signed(F.lit(1).cast("bigint")).alias("orders"),
        *[signed(F.coalesce(F.col(m), F.lit(0)).cast(kind[m])).alias(f"s_{m}") for m in SUMS],
        *[signed(F.col(m).isNotNull().cast("bigint")).alias(f"n_{m}") for m in SUMS],
    )


def _versions(stored: DataFrame, batch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows before and after ``replace_by_key``, once each; ``__old`` and ``__new`` say where a row counts."""
    named = batch.select(key).distinct().withColumn("__named", F.lit(True))
    before = lookup(stored.select(*dict.fromkeys([key, *columns])), named, key)
    return before.select(*columns, F.lit(True).alias("__old"), F.col("__named").isNull().alias("__new")).unionByName(
        batch.select(*columns, F.lit(False).alias("__old"), F.lit(True).alias("__new"))
    )


def _signed(df: DataFrame) -> DataFrame:
    """A row per version: -1 before, 1 after the batch."""
    signs = F.array(F.when(F.col("__old"), F.lit(-1)), F.when(F.col("__new"), F.lit(1)))
    return df.withColumn("__sign", F.explode(F.array_compact(signs))).drop("__old", "__new")


def revenue_change(items: DataFrame, orders: DataFrame, new_items: DataFrame, new_orders: DataFrame) -> DataFrame:
    """Signed partial sums of a batch against the stored facts (lines keyed by order_item_id, orders by order_id).

    A line's price is judged by what the same customer paid for the same product before, so an order is
    touched when the batch holds it or one of its lines, or when it shares a customer and product with such
    an order. The sums of touched orders need the lines of all their pairs; no other line is aggregated.

    Lines meet their orders once for both versions and are written; only lines of orders outside the batch
    are searched for neighbours.
    """
    own_customer = [c for c in ("customer_key",) if c in items.columns]
    measured = ["order_id", *own_customer, "product_key", "quantity", "total_amount"]
    heads = written(_versions(orders, new_orders, "order_id", ORDER_COLUMNS).filter("is_cancel = 0"), "heads")
    flags = heads.withColumnsRenamed({"__old": "__head_old", "__new": "__head_new"})
    base = sales.line_base(
        _versions(items, new_items, "order_item_id", measured), flags, ["__head_old", "__head_new"]
    ).select(
        "order_id", *PAIR, "quantity", "total_amount", "__month", "__live",
        (F.col("__old") & F.col("__head_old")).alias("__old"),
        (F.col("__new") & F.col("__head_new")).alias("__new"),
        (F.col("__head_old") != F.col("__head_new")).alias("__sent"),
    )
    base = written(base.filter("__old OR __new"), "lines")

    # orders outside the batch of which it changes a line
    sent, rest = base.filter("__sent"), base.filter("NOT __sent")
    revised = written(rest.filter("__old <> __new").select("order_id").distinct(), "revised")
    changed = sent.unionByName(rest.join(revised, "order_id", "left_semi"))
    rest = rest.join(revised, "order_id", "left_anti")
    # neighbours, and the lines that feed their month prices only
    near = rest.join(changed.select(*PAIR).distinct(), PAIR, "left_semi")
    neighbours = written(near.select("order_id").distinct(), "neighbours")
    theirs = rest.join(neighbours, "order_id", "left_semi")
    pairs = written(theirs.select(*PAIR).distinct(), "pairs")
    feeding = rest.join(neighbours, "order_id", "left_anti").join(pairs, PAIR, "left_semi")

    touched = new_orders.select("order_id").union(revised).union(neighbours).distinct()
    lines = _signed(changed.unionByName(theirs).unionByName(feeding))
    both = _signed(heads.join(touched, "order_id", "left_semi"))
    repaired = sales.repair(lines, [*PAIR, "__sign"])
    sums = _counts(_contributions(both, repaired, ("order_id", "__sign"), F.col("__sign")))
    some = F.greatest(*[F.abs(F.col(c)) for c in sums.columns if c not in GRAIN]) != 0
    return sums.filter(some)


class RevenueSums:
    """Stored partial sums of the revenue mart."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table

    def build(self, items: DataFrame, orders: DataFrame, load: int = 0) -> None:
        """First load: all orders."""
        live = sales.active_orders(orders)
        self._save(_counts(_contributions(live, sales.repaired_lines(items, live))), load)

    def apply(self, load: int, items: DataFrame, orders: DataFrame, new_items: DataFrame, new_orders: DataFrame) -> None:
        """Add a load, before the stored facts are changed by it.

        A call that broke off is repeated: it overwrites what it wrote. Once the facts hold the batch,
        a repeated call finds no change and leaves the load as it is.
        """
        self._save(revenue_change(items, orders, new_items, new_orders), load)

    def _save(self, sums: DataFrame, load: int) -> None:
        rows = sums.withColumn("load", F.lit(load))
        if sinks.exists(self.spark, self.table):
            sinks.replace_partitions(rows, self.table, "load")
        else:
            sinks.append_rows(rows, self.table, "load")

    def compact(self, load: int) -> None:
        """Merge all loads into one."""
        rows = _counts(self.spark.table(self.table)).filter("orders <> 0").withColumn("load", F.lit(load))
        loads = {r[0] for r in self.spark.table(self.table).select("load").distinct().collect()}  # one row per load
        sinks.replace_partitions(rows, self.table, "load", emptied=loads - {load})

    def mart(self, customers: DataFrame, dates: DataFrame) -> DataFrame:
        """The mart as ``sales.revenue`` builds it; order ids are taken to be unique."""
        sums = _counts(self.spark.table(self.table)).filter("orders <> 0")
        daily = (
            sums.select(
                *GRAIN,
                F.col("orders").alias("order_count"),
                *[F.when(F.col(f"n_{m}") > 0, F.col(f"s_{m}")).alias(m) for m in SUMS],
                ratio("s_revenue", "n_revenue").alias("avg_order_value"),
            )
            .withColumn("gross_margin_pct", pct("gross_profit", "revenue"))
            .withColumn("revenue_adjustment", F.col("revenue") - F.col("revenue_raw"))
        )
        return sales.enrich_daily(daily, customers, dates, sales.REVENUE_DATES, sales.REVENUE_CUSTOMER)
