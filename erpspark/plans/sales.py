"""Sales marts: repaired order lines, order performance, revenue, RFM segments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.functions.expr import exact_avg, first_match, month_start, pct, price_tier, ratio, rounded, zero_if_null
from erpspark.operators.lookup import decorate, lookup, sent_out, with_dates
from erpspark.operators.ranks import ntile_columns, percentile_values
from erpspark.plans import views
from erpspark.session import written
from erpspark.settings import PRICE_TIER_PROBS, SPIKE_FACTOR

# exact products of these stay within 38 digits
_AMOUNT, _QTY = "decimal(18,4)", "decimal(14,4)"


def active_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("is_cancel") == 0)


def line_base(items: DataFrame, orders: DataFrame, carry: list[str]) -> DataFrame:
    """Lines with the order attributes the price repair needs; cancelled orders kept and flagged."""
    head = orders.select(
        "order_id",
        "order_date",
        *carry,
        F.col("customer_key").alias("__customer"),
        F.coalesce(F.col("is_cancel") == 0, F.lit(False)).alias("__live"),
    )
    items = items.drop("order_date", *carry)  # the header's own values count
    if "customer_key" in items.columns:
        joined = items.join(head.drop("__customer"), "order_id")
    else:
        joined = items.join(head, "order_id").withColumnRenamed("__customer", "customer_key")
    return joined.withColumn("__month", month_start("order_date"))


def repaired_lines(
    items: DataFrame, orders: DataFrame, product: str = "product_key", carry: list[str] | None = None
) -> DataFrame:
    """Order lines with the price-spike repair.

    A line is a spike when its unit price exceeds three times the weighted unit
    price of the last month in which the same customer bought the same product;
    the comparison is made by cross-multiplying decimals, so exactly three times
    is not a spike. Cancelled orders neither feed the month prices nor are
    repaired; their lines stay in the result with ``__live`` = false. ``carry``
    names further order columns to keep, so lines meet the orders only once.
    """
    return repair(line_base(items, orders, carry or []), ["customer_key", product])


def _priced() -> Column:
    return F.col("__live") & (F.col("quantity") > 0) & (F.col("total_amount") > 0)


def previous_prices(base: DataFrame, keys: list[str]) -> DataFrame:
    """Sums of the last month before, per month and ``keys``; months without one are absent."""
    months = (
        base.filter(_priced())
        .groupBy(*keys, "__month")
        .agg(F.sum("total_amount").cast(_AMOUNT).alias("m_amount"), F.sum("quantity").cast(_QTY).alias("m_qty"))
    )
    # one row per month and pair reaches the window, never the lines themselves
    earlier = Window.partitionBy(*keys).orderBy("__month")
    return months.select(
        *keys,
        "__month",
        F.lag("m_amount").over(earlier).alias("prev_amount"),
        F.lag("m_qty").over(earlier).alias("prev_qty"),
    ).filter(F.col("prev_amount").isNotNull())


def repair(base: DataFrame, keys: list[str]) -> DataFrame:
    """The repair on lines that have met their orders (``line_base``); prices are compared within ``keys``."""
    return judged(base.join(previous_prices(base, keys), [*keys, "__month"], "left"))


def judged(joined: DataFrame) -> DataFrame:
    """Spikes and repaired prices of lines beside ``prev_amount`` and ``prev_qty``, the sums they are compared with."""
    priced = _priced()
    line_price, prev_price = F.col("line_unit_price"), F.col("prev_month_unit_price")
    comparable = priced & F.col("prev_amount").isNotNull()
    amount, qty = F.col("total_amount").cast(_AMOUNT), F.col("quantity").cast(_QTY)
    spike = comparable & (amount * F.col("prev_qty") > F.lit(SPIKE_FACTOR) * F.col("prev_amount") * qty)
    return (
        joined.withColumn("line_unit_price", ratio("total_amount", "quantity"))
        .withColumn("prev_month_unit_price", ratio("prev_amount", "prev_qty"))
        .withColumn("is_price_spike", F.coalesce(spike, F.lit(False)))
        .withColumn("spike_multiplier", F.when(comparable, line_price / prev_price))
        .withColumn("__price", F.when(F.col("is_price_spike"), prev_price).otherwise(line_price))
        .withColumn(
            "total_amount_adjusted",
            F.when(
                F.col("is_price_spike"),
                rounded(F.col("quantity").cast("double") * F.col("prev_month_unit_price"), 2),
            )
            .when(F.col("quantity") != 0, F.round("total_amount", 2))
            .cast("decimal(22,2)"),
        )
        .drop("prev_amount", "prev_qty")
    )


LINE_PRODUCT = ["product_code", "product_name", "type_products", "brand"]
LINE_CUSTOMER = ["customer_code", "customer_name", "price_group_name", "city"]


def _named(lines: DataFrame, pairs: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join ``dim`` onto lines that lie by order: the distinct pairs of order and key fetch its columns.
    A key that is listed twice gives two lines."""
    return lines.join(lookup(pairs, dim, key).repartition("order_id"), ["order_id", key], "left")


def decorate_lines(items: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``decorate`` for lines that meet their orders next; lines without an order are dropped, as they meet none."""
    dim = dim.select(key, *columns)
    if sent_out(dim):
        return decorate(items, dim, key, columns)
    lines = items.filter(F.col("order_id").isNotNull()).repartition("order_id")
    pairs = lines.filter(F.col(key).isNotNull()).select("order_id", key).distinct()
    return _named(lines, pairs, dim, key)


def order_items_detail(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame | None,
    product: str = "product_key",
    headers: DataFrame | None = None,
) -> DataFrame:
    """One row per line of a non-cancelled order, with repaired price and price tier.

    ``orders`` is the enriched order view. Tier thresholds are exact percentiles
    of the raw line price over all valid lines, found by a first pass (two numbers);
    ``headers`` are the plain orders, which spare that pass the view's joins. They must have the orders' dates and customers.
    """
    head = orders if headers is None else headers
    keys = ["customer_key", product]
    own = ["customer_key"] if "customer_key" in items.columns else []
    # Whole lines travel once, to their orders. What else they need is found on these few columns and comes to the orders too.
    live_first = Window.partitionBy("order_id").orderBy(F.coalesce(F.col("is_cancel") == 0, F.lit(False)).desc())
    head = head.filter(F.col("order_id").isNotNull()).withColumn("__head", F.row_number().over(live_first) == 1)
    measures = line_base(items.select("order_id", *own, product, "quantity", "total_amount"), head, ["__head"])
    place, pair = ["order_id", product, "customer_key", "__month"], ["order_id", product]

    def first(by: list[str]) -> Column:
        return F.row_number().over(Window.partitionBy(*by).orderBy(*place)) == 1

    narrow = written(measures.withColumns({"__first": first(place), "__pair": first(pair)}), "lines")
    low_p, high_p = PRICE_TIER_PROBS
    # a line counts once, however often its order is listed
    valid = narrow.filter(_priced() & F.col("__head")).select(ratio("total_amount", "quantity").alias("price"))
    limits = percentile_values(valid, "price", {"p33": low_p, "p67": high_p})
    p33, p67 = F.lit(limits["p33"]), F.lit(limits["p67"])

    previous = narrow.filter("__live AND __first").select(*place).join(previous_prices(narrow, keys), [*keys, "__month"])
    carry = ["order_date_key", "year", "quarter", "month_num", "month_name", "id_branch", *LINE_CUSTOMER]
    base = line_base(items, orders.filter(F.col("is_cancel") == 0), carry)
    out = judged(base.join(previous.repartition("order_id"), place, "left"))
    if products is not None:
        names = products.select(product, *LINE_PRODUCT)
        pairs = narrow.filter(F.col("__live") & F.col("__pair") & F.col(product).isNotNull()).select(*pair)
        out = decorate(out, names, product, LINE_PRODUCT) if sent_out(names) else _named(out, pairs, names, product)
    return (
        out.withColumn("unit_price", F.col("price"))
        .withColumn("unit_price_adjusted", rounded("__price", 2))
        .withColumn("spike_multiplier", rounded("spike_multiplier", 2))
        .withColumn("spike_amount_removed", F.round(F.col("total_amount") - F.col("total_amount_adjusted"), 2))
        .withColumn("price_tier", price_tier("__price", p33, p67))
        .withColumn("price_tier_p33", p33)
        .withColumn("price_tier_p67", p67)
        .drop("__price", "__live", "__month", "price")
    )


def _order_adjustments(lines: DataFrame, by: list[str], fulfilment: bool) -> DataFrame:
    """Per order: repaired amount and spike count of live lines, quantities of all lines."""
    live = F.col("__live")
    measures = [
        F.sum(F.when(live, F.col("total_amount_adjusted"))).alias("adjusted"),
        F.sum((live & F.col("is_price_spike")).cast("bigint")).alias("spikes"),
    ]
    if fulfilment:
        measures += [
            F.sum("quantity").alias("ordered"),
            F.sum("quantity_delivery").alias("delivered"),
            F.sum("quantity_not_delivery").alias("outstanding"),
            F.sum("quantity_returned").alias("returned"),
            F.count(F.lit(1)).alias("lines"),
        ]
    return lines.groupBy(*by).agg(*measures)


def adjusted(orders: DataFrame, lines: DataFrame, by: tuple[str, ...] = ("order_id",), fulfilment: bool = True) -> DataFrame:
    joined = orders.join(_order_adjustments(lines, list(by), fulfilment), list(by), "left")
    total = F.coalesce(F.col("adjusted"), F.col("grand_total"))
    share = F.when(F.col("grand_total") == 0, F.lit(1.0)).otherwise(ratio(total, "grand_total"))
    return (
        joined.withColumn("revenue", total.cast("decimal(22,4)"))
        .withColumn("cogs", rounded(F.col("total_cost").cast("double") * share, 4).cast("decimal(22,4)"))
        .withColumn("gross_profit", F.col("revenue") - F.col("cogs"))
        .withColumn("spike_line_count", zero_if_null("spikes"))
    )


def order_performance(items: DataFrame, orders: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """One row per order, cancelled ones included: repaired value, margin, fulfilment.

    ``headers`` are the orders with their date only; lines then skip the view's joins.
    """
    out = adjusted(orders, repaired_lines(items, orders if headers is None else headers))
    return out.select(
        "order_key", "order_id", "reference_no", "order_date_key", "order_date", "year", "quarter", "month_num",
        "month_name", "is_weekend", "customer_key", "customer_code", "customer_name", "city", "type_client",
        "price_group_name", "vip_rating", "id_branch", "employee_key", "revenue",
        F.col("grand_total").alias("revenue_raw"),
        (F.col("revenue") - F.col("grand_total")).alias("revenue_adjustment"),
        "cogs", "gross_profit", "spike_line_count",
        zero_if_null("ordered").alias("qty_ordered"),
        zero_if_null("delivered").alias("qty_delivered"),
        zero_if_null("outstanding").alias("qty_outstanding"),
        zero_if_null("returned").alias("qty_returned"),
        zero_if_null("lines").alias("line_item_count"),
        pct(zero_if_null("delivered"), zero_if_null("ordered")).alias("fulfilment_rate_pct"),
        (zero_if_null("outstanding") == 0).cast("int").alias("is_fully_delivered"),
        F.col("is_end").alias("is_completed"),
        "is_cancel", "status", "status_orders", "type_orders", "type_bills",
    )


def enrich_daily(df: DataFrame, customers: DataFrame, dates: DataFrame, date_cols, customer_cols) -> DataFrame:
    out = with_dates(df, dates, "order_date_key", date_cols)
    return decorate(out, views.customers(customers), "customer_key", customer_cols)


REVENUE_DATES = {"full_date": "order_date", **{c: c for c in "year quarter month_num month_name week_of_year is_weekend".split()}}
REVENUE_CUSTOMER = {
    "customer_code": "customer_code", "fullname": "customer_name",
    **{c: c for c in "company city type_client price_group_code price_group_name vip_rating".split()},
}


def revenue(items: DataFrame, orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily repaired revenue per customer and branch.

    Measures are grouped by the three keys first; the attributes, which depend on
    those keys alone, are attached to the much smaller result.
    """
    live = active_orders(orders)
    daily = (
        adjusted(live, repaired_lines(items, live))
        .groupBy("order_date_key", "customer_key", "id_branch")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("revenue").alias("revenue"),
            F.sum("cogs").alias("cogs"),
            F.sum("gross_profit").alias("gross_profit"),
            exact_avg("revenue").alias("avg_order_value"),
            F.sum("total_tax").alias("total_tax"),
            F.sum(F.col("total_discount_percent") + F.col("total_discount_direct")).alias("total_discount"),
            F.sum("grand_total").alias("revenue_raw"),
            F.sum("spike_line_count").alias("spike_line_count"),
        )
        .withColumn("gross_margin_pct", pct("gross_profit", "revenue"))
        .withColumn("revenue_adjustment", F.col("revenue") - F.col("revenue_raw"))
    )
    return enrich_daily(daily, customers, dates, REVENUE_DATES, REVENUE_CUSTOMER)


# fixed values: segment rules in order, on (recency, frequency, monetary) scores
def _segment(r: Column, f: Column, m: Column) -> Column:
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((r >= 3) & (f >= 3), "Loyal"),
            ((r >= 4) & (f <= 2), "Promising"),
            ((r >= 3) & (f >= 2) & (m >= 3), "Potential Loyalist"),
            ((r <= 2) & (f >= 3), "At Risk"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
            (f == 1, "New"),
        ],
        "Others",
    )


def rfm_scores(orders: DataFrame, as_of: date) -> DataFrame:
    """Recency, frequency and monetary quintiles per customer with orders."""
    per_customer = (
        active_orders(orders)
        .groupBy("customer_key")
        .agg(
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("grand_total").alias("monetary"),
            exact_avg("grand_total").alias("avg_order_value"),
        )
        .withColumn("days_since_last_order", F.datediff(F.lit(as_of), "last_order_date"))
    )
    scored = ntile_columns(
        per_customer,
        5,
        {
            "recency_score": (F.col("days_since_last_order"), True),
            "frequency_score": (F.col("total_orders"), False),
            "monetary_score": (F.col("monetary"), False),
        },
        "customer_key",
    )
    r, f, m = F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
    return scored.withColumn("rfm_total_score", r + f + m).withColumn("rfm_segment", _segment(r, f, m))


def customer_segmentation(orders: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """One row per customer; those without orders are Inactive with the lowest scores."""
    who = views.customers(customers).select(
        "customer_key", "customer_code", F.col("fullname").alias("customer_name"), "company", "city", "type_client",
        "price_group_name", "vip_rating", "is_active", F.col("datecreated").alias("customer_since"), "debt_limit",
        "debt_limit_day",
    )
    out = who.join(rfm_scores(orders, as_of), "customer_key", "left")
    defaults = {"total_orders": 0, "recency_score": 1, "frequency_score": 1, "monetary_score": 1, "rfm_total_score": 3}
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return (
        out.withColumn("lifetime_revenue", F.coalesce(F.col("monetary"), F.lit(0).cast("decimal(22,4)")))
        .withColumn("avg_order_value", F.coalesce(F.col("avg_order_value"), F.lit(0.0)))
        .withColumn("rfm_segment", F.coalesce(F.col("rfm_segment"), F.lit("Inactive")))
        .drop("monetary")
    )
