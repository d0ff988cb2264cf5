"""Single building blocks that no mart query isolates."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from erpspark.catalog.registry import Erp, query
from erpspark.catalog.roles import PARAMS
from erpspark.catalog.sqltext import r
from erpspark.functions.expr import date_key, month_start, rounded, trimmed_or
from erpspark.operators.ranks import exact_percentiles, ntile_columns, percentile_values
from erpspark.operators.upsert import dense_positions, latest_per_key

DAY = PARAMS.as_of


@query(
    "prim_null_safe_update",
    "customer_key:l company:s representative:s differs:b",
    "SELECT customer_key, company, representative, company IS DISTINCT FROM representative AS differs FROM r_customers",
)
def _null_safe(e: Erp):
    return e.customers.withColumn("differs", ~F.col("company").eqNullSafe(F.col("representative")))


query(
    "prim_semi_join",
    "o_orderkey:l o_custkey:l",
    "SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
)(lambda e: e.table("orders").join(e.table("lineitem").filter("l_returnflag = 'R'"), F.expr("o_orderkey = l_orderkey"), "left_semi"))
query(
    "prim_anti_join",
    "o_orderkey:l o_custkey:l",
    "SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')",
)(lambda e: e.table("orders").join(e.table("lineitem").filter("l_returnflag = 'R'"), F.expr("o_orderkey = l_orderkey"), "left_anti"))
query(
    "prim_distinct_on",
    "product_key:l po_item_id:s po_date_key:l price_suppliers:d",
    """SELECT * FROM r_po_lines WHERE product_key IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY product_key ORDER BY po_date_key DESC, po_item_id DESC) = 1""",
)(
    lambda e: latest_per_key(
        e.po_lines.filter(F.col("product_key").isNotNull()).select("product_key", "po_item_id", "po_date_key", "price_suppliers"),
        "product_key", ["po_date_key", "po_item_id"],
    )
)
query(
    "prim_last_value",
    "product_key:l last_price:d",
    "SELECT product_key, arg_max_null(CASE WHEN quantity > 5 THEN price END, (order_id, order_item_id)) AS last_price FROM r_order_items GROUP BY product_key",
)(
    # the newest row counts even when its value is NULL
    lambda e: e.order_items.groupBy("product_key").agg(
        F.max_by(F.when(F.col("quantity") > 5, F.col("price")), F.struct("order_id", "order_item_id")).alias("last_price")
    )
)


@query(
    "prim_percentiles",
    "l_returnflag:s p10:d p50:d p90:d",
    "SELECT l_returnflag, " + ", ".join(f"{r(f'quantile_cont(l_extendedprice, 0.{p})', 4)} AS p{p}" for p in (10, 50, 90)) + " FROM lineitem GROUP BY 1",
)
def _percentiles(e: Erp):
    found = exact_percentiles(e.table("lineitem"), "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9}, by=["l_returnflag"])
    return found.select("l_returnflag", *[rounded(p, 4).alias(p) for p in ("p10", "p50", "p90")])


@query(
    "prim_global_percentile",
    "tier:s lines:l",
    """SELECT CASE WHEN l_extendedprice <= a THEN 'Low' WHEN l_extendedprice <= b THEN 'Mid' ELSE 'High' END AS tier, count(*) AS lines
       FROM lineitem, (SELECT quantile_cont(l_extendedprice, 0.33) AS a, quantile_cont(l_extendedprice, 0.67) AS b FROM lineitem) GROUP BY 1""",
)
def _global(e: Erp):
    lines = e.table("lineitem")
    cut = percentile_values(lines, "l_extendedprice", {"a": 0.33, "b": 0.67})
    price = F.col("l_extendedprice")
    tier = F.when(price <= cut["a"], "Low").when(price <= cut["b"], "Mid").otherwise("High")
    return lines.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("lines"))


query(
    "prim_filter_agg",
    "l_returnflag:s shipped:l cheap_qty:d any_free:b",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS shipped, sum(CASE WHEN l_extendedprice < 10000 THEN l_quantity ELSE 0 END) AS cheap_qty,
         bool_or(l_discount = 0) AS any_free FROM lineitem GROUP BY 1""",
)(
    lambda e: e.table("lineitem").groupBy("l_returnflag").agg(
        F.count_if(F.col("l_linestatus") == "F").alias("shipped"),
        F.sum(F.when(F.col("l_extendedprice") < 10000, F.col("l_quantity")).otherwise(0)).alias("cheap_qty"),
        F.bool_or(F.col("l_discount") == 0).alias("any_free"),
    )
)


def _daily(e: Erp):
    return e.deliveries.groupBy("product_key", "delivery_date_key").agg(F.sum("quantity").alias("qty"))


_DAILY = "(SELECT product_key, delivery_date_key, sum(quantity) AS qty FROM r_deliveries GROUP BY ALL)"
query(
    "prim_running_frame",
    "product_key:l delivery_date_key:l qty:d later_qty:d",
    f"""SELECT *, coalesce(sum(qty) OVER (PARTITION BY product_key ORDER BY delivery_date_key DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS later_qty
        FROM {_DAILY}""",
)(
    lambda e: _daily(e).withColumn(
        "later_qty",
        F.coalesce(
            F.sum("qty").over(
                Window.partitionBy("product_key").orderBy(F.desc("delivery_date_key")).rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
)
query(
    "prim_rolling_rows",
    "product_key:l delivery_date_key:l qty:d rolling_qty:d",
    f"SELECT *, sum(qty) OVER (PARTITION BY product_key ORDER BY delivery_date_key ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS rolling_qty FROM {_DAILY}",
)(
    lambda e: _daily(e).withColumn(
        "rolling_qty", F.sum("qty").over(Window.partitionBy("product_key").orderBy("delivery_date_key").rowsBetween(-29, 0))
    )
)
query(
    "prim_ntile_scaled",
    "o_orderkey:l by_price:l by_customer:l",
    "SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice DESC, o_orderkey) AS by_price, ntile(7) OVER (ORDER BY o_custkey, o_orderkey) AS by_customer FROM orders",
)(
    lambda e: ntile_columns(
        e.table("orders"), 7, {"by_price": (F.col("o_totalprice"), True), "by_customer": (F.col("o_custkey"), False)},
        "o_orderkey",
    )
)
query(
    "prim_dense_positions",
    "o_orderkey:l position:l",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS position FROM orders",
)(lambda e: dense_positions(e.table("orders"), "o_orderkey"))
query(
    "prim_union_distinct",
    "product_key:l warehouse_key:l",
    "SELECT product_key, warehouse_key FROM r_lots UNION SELECT product_key, warehouse_key FROM r_exports",
)(
    lambda e: e.lots.select("product_key", "warehouse_key").unionByName(e.exports.select("product_key", "warehouse_key")).distinct()
)
query(
    "prim_explode_list",
    "plan_id:l order_id:l",
    "SELECT id AS plan_id, cast(trim(unnest(string_split(options1_id, ','))) as bigint) AS order_id FROM r_plans WHERE options1_id <> ''",
)(
    lambda e: e.plans.filter("options1_id <> ''").select(F.col("id").alias("plan_id"), F.explode(F.split("options1_id", ",")).alias("s"))
    .withColumn("order_id", F.trim("s").try_cast("bigint"))
)
query(
    "prim_topk_abs",
    "c_custkey:l c_acctbal:d",
    "SELECT * FROM customer ORDER BY abs(c_acctbal - 4500) DESC NULLS LAST, c_custkey LIMIT 10",
)(lambda e: e.table("customer").orderBy(F.abs(F.col("c_acctbal") - 4500).desc_nulls_last(), "c_custkey").limit(10))
query(
    "prim_dates",
    "o_orderkey:l dk:l month_first:t month_last:t year_ago:t dow:l doy:l week:l quarter:l day_name:s month_name:s age:l",
    f"""SELECT o_orderkey, cast(strftime(d, '%Y%m%d') as int) AS dk, date_trunc('month', d) AS month_first, last_day(d) AS month_last,
          d - interval 12 month AS year_ago, dayofweek(d) AS dow, dayofyear(d) AS doy, weekofyear(d) AS week, quarter(d) AS quarter, dayname(d) AS day_name,
          monthname(d) AS month_name, DATE '{DAY}' - d AS age FROM (SELECT o_orderkey, cast(o_orderdate as date) AS d FROM orders)""",
)(
    lambda e: e.table("orders").withColumn("d", F.to_date("o_orderdate")).select(
        "o_orderkey", date_key("d").alias("dk"), month_start("d").alias("month_first"), F.last_day("d").alias("month_last"),
        F.add_months("d", -12).alias("year_ago"), (F.dayofweek("d") - 1).alias("dow"), F.dayofyear("d").alias("doy"),
        F.weekofyear("d").alias("week"), F.quarter("d").alias("quarter"), F.date_format("d", "EEEE").alias("day_name"),
        F.date_format("d", "MMMM").alias("month_name"), F.datediff(F.lit(DAY), "d").alias("age"),
    )
)
query(
    "prim_strings",
    "p_partkey:l joined:s trimmed:s is_ring:b starts_red:b zero_like:b",
    """SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, '') || '-' || p_name AS joined,
         coalesce(nullif(trim(CASE WHEN p_size > 40 THEN '  ' ELSE ' ' || p_name || ' ' END), ''), 'UNKNOWN') AS trimmed,
         p_name ILIKE '%RING' AS is_ring, p_name LIKE 'red%' AS starts_red, regexp_matches(p_brand, '^Brand#1') AS zero_like FROM part""",
)(
    lambda e: e.table("part").select(
        "p_partkey",
        F.concat(F.coalesce(F.when(F.col("p_size") > 25, F.col("p_brand")), F.lit("")), F.lit("-"), "p_name").alias("joined"),
        trimmed_or(F.when(F.col("p_size") > 40, F.lit("  ")).otherwise(F.concat(F.lit(" "), "p_name", F.lit(" "))), "UNKNOWN").alias("trimmed"),
        F.col("p_name").ilike("%RING").alias("is_ring"),
        F.col("p_name").like("red%").alias("starts_red"),
        F.col("p_brand").rlike("^Brand#1").alias("zero_like"),
    )
)
query(
    "prim_two_level_agg",
    "customer_key:l months:l best_month:d avg_month:d",
    f"""SELECT customer_key, count(*) AS months, max(v) AS best_month, {r('cast(sum(v) as double) / count(*)', 4)} AS avg_month
        FROM (SELECT o_custkey + 1 AS customer_key, date_trunc('month', o_orderdate) AS m, sum(cast(o_totalprice as decimal(22,4))) AS v FROM orders GROUP BY ALL) GROUP BY 1""",
)(
    lambda e: e.orders.groupBy("customer_key", month_start("date_created").alias("m")).agg(F.sum("grand_total").alias("v"))
    .groupBy("customer_key")
    .agg(F.count(F.lit(1)).alias("months"), F.max("v").alias("best_month"), rounded(F.sum("v").cast("double") / F.count("v"), 4).alias("avg_month"))
)
query(
    "prim_having",
    "o_custkey:l orders:l",
    "SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1 HAVING count(*) > 12",
)(lambda e: e.table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders")).filter("orders > 12"))
