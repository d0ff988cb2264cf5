"""KPI queries over the marts. Each takes mart DataFrames and returns a small report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.functions.expr import exact_avg, key_to_date, pct, ratio, rounded, zero_if_null
from erpspark.operators.ranks import cumulative_desc, exact_percentiles
from erpspark.plans.inventory import average_lot_price
from erpspark.session import written
from erpspark.settings import TARGET_BAND, TRANSFER_CODE


def whole(c: str) -> Column:
    """Sum rounded to a whole number."""
    return rounded(F.sum(c), 0)


def top(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def share_of_total(df: DataFrame, value: str, digits: int = 2) -> Column:
    """Share of a small grouped report's total, in percent."""
    return pct(F.col(value), df.agg(F.sum(value)).scalar(), digits)


# --- sales --------------------------------------------------------------------


def sales_overview(revenue: DataFrame) -> DataFrame:
    return revenue.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer_key").alias("unique_customers"),
        F.count_distinct("order_date_key").alias("unique_dates"),
        F.min("order_date").alias("date_from"),
        F.max("order_date").alias("date_to"),
        whole("revenue").alias("total_revenue"),
        whole("cogs").alias("total_cogs"),
        whole("gross_profit").alias("total_gross_profit"),
        rounded(exact_avg("gross_margin_pct"), 2).alias("avg_gp_margin_pct"),
    )


def sales_by_year(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("year").agg(
        F.count_distinct("customer_key").alias("customers"),
        F.sum("order_count").alias("orders"),
        whole("revenue").alias("revenue"),
        whole("gross_profit").alias("gross_profit"),
        rounded(exact_avg("gross_margin_pct"), 2).alias("avg_gp_pct"),
    )


def top_customers(revenue: DataFrame, k: int = 10) -> DataFrame:
    per = revenue.groupBy("customer_code", "customer_name").agg(
        F.sum("revenue").alias("raw"),
        whole("revenue").alias("revenue"),
        whole("gross_profit").alias("gross_profit"),
        F.sum("order_count").alias("orders"),
    )
    return top(per, "raw", k, "customer_code")


def fulfilment_overview(performance: DataFrame) -> DataFrame:
    return performance.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("is_cancel").alias("cancelled"),
        F.sum("is_fully_delivered").alias("fully_delivered"),
        F.sum("is_completed").alias("completed"),
        rounded(exact_avg("fulfilment_rate_pct"), 2).alias("avg_fulfilment_pct"),
        rounded(ratio(F.sum("is_fully_delivered"), F.count(F.lit(1))), 4).alias("fulfilment_rate"),
    )


def fulfilment_histogram(performance: DataFrame, width: int = 10) -> DataFrame:
    """Orders per fulfilment bucket; 100 % has its own bucket."""
    bucket = F.floor(F.col("fulfilment_rate_pct") / width) * width
    return performance.groupBy(bucket.cast("int").alias("bucket_from")).agg(F.count(F.lit(1)).alias("orders"))


def segment_profile(segments: DataFrame) -> DataFrame:
    return segments.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        whole("lifetime_revenue").alias("total_revenue"),
        rounded(exact_avg("lifetime_revenue"), 0).alias("avg_revenue"),
        rounded(exact_avg("total_orders"), 1).alias("avg_orders"),
        rounded(exact_avg("days_since_last_order"), 0).alias("avg_days_since_order"),
    )


def at_risk_customers(segments: DataFrame, days: int = 90) -> DataFrame:
    return segments.filter(F.col("days_since_last_order") > days).select(
        "customer_key", "customer_code", "customer_name", "rfm_segment", "last_order_date", "days_since_last_order",
        "lifetime_revenue",
    )


def cohort_by_year(segments: DataFrame) -> DataFrame:
    return segments.groupBy(F.year("customer_since").alias("cohort_year")).agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("total_orders") > 0).alias("active_customers"),
        whole("lifetime_revenue").alias("revenue"),
    )


def revenue_by_month(revenue: DataFrame) -> DataFrame:
    return revenue.groupBy("year", "month_num").agg(F.sum("revenue").alias("revenue"))


def revenue_yoy(revenue: DataFrame) -> DataFrame:
    """Monthly revenue with the same month of the year before."""
    now = revenue_by_month(revenue)
    before = now.select((F.col("year") + 1).alias("year"), "month_num", F.col("revenue").alias("revenue_py"))
    return now.join(before, ["year", "month_num"], "left").withColumn(
        "revenue_yoy_pct", pct(F.col("revenue") - F.col("revenue_py"), "revenue_py")
    )


def order_value_trend(performance: DataFrame) -> DataFrame:
    """Orders, AOV and units per order by year with the change to the year before."""
    live = performance.filter((F.col("is_cancel") == 0) & F.col("year").isNotNull())
    per_year = live.groupBy("year").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("qty_ordered").alias("units"),
    )
    # one row per year
    prior = Window.orderBy("year")
    out = per_year.withColumn("aov", ratio("revenue", "orders")).withColumn("upt", ratio("units", "orders"))
    for c in ("orders", "revenue", "aov", "upt"):
        before = F.lag(c).over(prior)
        out = out.withColumn(f"{c}_change_pct", rounded(ratio(F.col(c) - before, before) * 100, 2))
    return out.withColumn("aov", rounded("aov", 4)).withColumn("upt", rounded("upt", 4))


def revenue_by(revenue: DataFrame, *by: str) -> DataFrame:
    return revenue.groupBy(*by).agg(
        F.sum("order_count").alias("orders"),
        F.sum("revenue").alias("revenue"),
        rounded(ratio(F.sum("revenue"), F.sum("order_count")), 2).alias("aov"),
    )


def undelivered_backlog(performance: DataFrame) -> DataFrame:
    late = performance.filter((F.col("is_cancel") == 0) & (F.col("qty_outstanding") > 0))
    return late.groupBy("year", "month_num").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("qty_outstanding").alias("qty_outstanding")
    )


def pareto_customers(revenue: DataFrame, a_share: float = 80.0, b_share: float = 95.0) -> DataFrame:
    """ABC class per customer by cumulative revenue share, largest first; customers without revenue are class C, with no share."""
    every = written(revenue.groupBy("customer_key").agg(F.sum("revenue").alias("revenue")), "customer-revenue")
    per = every.filter(F.col("revenue") > 0)
    rest = every.filter(F.coalesce(F.col("revenue") <= 0, F.lit(True)))
    total = per.agg(F.sum("revenue")).scalar()
    out = cumulative_desc(per, "revenue", "cumulative_revenue")
    share = ratio("cumulative_revenue", total) * 100
    out = out.withColumn("cumulative_pct", rounded(share, 4)).unionByName(rest, allowMissingColumns=True)
    return out.withColumn(
        "abc_class",
        F.when(F.col("cumulative_pct") <= a_share, "A").when(F.col("cumulative_pct") <= b_share, "B").otherwise("C"),
    )


# --- finance ------------------------------------------------------------------


def profit_by_year(profit: DataFrame) -> DataFrame:
    return profit.groupBy("year").agg(
        whole("revenue").alias("revenue"),
        whole("cogs").alias("cogs"),
        whole("gross_profit").alias("gross_profit"),
        rounded(exact_avg("gp_margin_pct"), 2).alias("avg_gp_pct"),
        whole("total_vat").alias("total_vat"),
        pct(F.sum("cogs"), F.sum("revenue")).alias("cogs_share_pct"),
    )


def credit_status_mix(credit: DataFrame) -> DataFrame:
    return credit.groupBy("credit_status").agg(
        F.count(F.lit(1)).alias("customers"),
        whole("lifetime_revenue").alias("outstanding_ar"),
        whole("debt_limit").alias("total_credit_limit"),
        rounded(exact_avg("credit_utilisation_pct"), 2).alias("avg_utilisation_pct"),
    )


def top_receivables(credit: DataFrame, k: int = 10) -> DataFrame:
    owing = credit.filter(F.col("lifetime_revenue") > 0).select(
        "customer_code", "customer_name", F.col("lifetime_revenue").alias("raw"),
        rounded("lifetime_revenue", 0).alias("outstanding_ar"), rounded("debt_limit", 0).alias("debt_limit"),
        rounded("credit_utilisation_pct", 1).alias("utilisation_pct"), "credit_status",
    )
    return top(owing, "raw", k, "customer_code")


def near_limit(credit: DataFrame) -> DataFrame:
    return credit.filter(F.col("credit_status") == "Near Limit").select(
        "customer_key", "customer_code", "debt_limit", "lifetime_revenue", "credit_utilisation_pct", "credit_headroom"
    )


def procurement_overview(purchases: DataFrame) -> DataFrame:
    return purchases.agg(
        F.count_distinct("supplier_key").alias("unique_suppliers"),
        F.count_distinct("product_key").alias("unique_products"),
        F.sum("po_count").alias("total_pos"),
        whole("qty_ordered").alias("total_qty_ordered"),
        whole("actual_cost").alias("total_actual_cost"),
        whole("price_variance").alias("total_price_variance"),
        F.min("po_date").alias("date_from"),
        F.max("po_date").alias("date_to"),
    )


def supplier_spend(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("supplier_name").agg(
        F.sum("actual_cost").alias("raw"),
        F.sum("po_count").alias("pos"),
        whole("actual_cost").alias("actual_cost"),
        whole("price_variance").alias("price_variance"),
    )


def top_suppliers(purchases: DataFrame, k: int = 10) -> DataFrame:
    return top(supplier_spend(purchases), "raw", k, "supplier_name")


def supplier_concentration(purchases: DataFrame, k: int = 3) -> DataFrame:
    """Spend share and variance of the k largest suppliers."""
    spend = supplier_spend(purchases)
    total = spend.agg(F.sum("raw")).scalar()
    return (
        top(spend, "raw", k, "supplier_name")
        .withColumn("spend_share_pct", pct("raw", total))
        .select("supplier_name", "actual_cost", "price_variance", "spend_share_pct")
    )


def purchases_by_month(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("supplier_key", "supplier_name", "year", "month_num").agg(
        F.sum("actual_cost").alias("actual_cost"),
        F.sum("price_variance").alias("price_variance"),
        pct(F.sum("price_variance"), F.sum("expected_cost")).alias("variance_pct"),
    )


# --- stock --------------------------------------------------------------------


def stock_overview(snapshot: DataFrame) -> DataFrame:
    return snapshot.agg(
        F.count(F.lit(1)).alias("lot_count"),
        F.count_distinct("product_key").alias("unique_products"),
        F.count_distinct("warehouse_key").alias("unique_warehouses"),
        whole("quantity_left").alias("total_qty_in_stock"),
        whole("stock_value").alias("total_stock_value"),
        F.count_if(F.col("quantity_left") == 0).alias("empty_lots"),
        rounded(F.sum(F.when(F.col("is_valued"), F.col("stock_value"))), 0).alias("valued_stock"),
        pct(F.count_if("is_valued"), F.count(F.lit(1))).alias("valued_lot_pct"),
    )


def top_stock_products(snapshot: DataFrame, k: int = 10) -> DataFrame:
    per = (
        snapshot.filter(F.col("quantity_left") > 0)
        .groupBy("product_code", "product_name")
        .agg(F.sum("stock_value").alias("raw"), whole("quantity_left").alias("qty_left"), whole("stock_value").alias("stock_value"))
    )
    return top(per, "raw", k, "product_code")


def stock_by_warehouse(snapshot: DataFrame, k: int = 10) -> DataFrame:
    per = (
        snapshot.filter(F.col("quantity_left") > 0)
        .groupBy("warehouse_name")
        .agg(
            F.sum("stock_value").alias("raw"),
            F.count_distinct("product_key").alias("products"),
            whole("quantity_left").alias("qty_left"),
            whole("stock_value").alias("stock_value"),
        )
    )
    return top(per, "raw", k, "warehouse_name")


def movement_overview(moves: DataFrame) -> DataFrame:
    return moves.groupBy("movement_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("product_key").alias("unique_products"),
        whole("quantity_in").alias("total_qty_in"),
        whole("quantity_out").alias("total_qty_out"),
        whole("value_in").alias("total_value_in"),
        whole("value_out").alias("total_value_out"),
        F.min("movement_date").alias("date_from"),
        F.max("movement_date").alias("date_to"),
    )


def movement_by_year(moves: DataFrame) -> DataFrame:
    return (
        moves.filter(F.col("year").isNotNull())
        .groupBy("year", "movement_type")
        .agg(
            whole("quantity_in").alias("qty_in"),
            whole("quantity_out").alias("qty_out"),
            whole("net_movement").alias("net_movement"),
        )
    )


def movement_month_to_date(moves: DataFrame, as_of: date) -> DataFrame:
    this_month = (F.col("movement_date") >= F.trunc(F.lit(as_of), "MM")) & (F.col("movement_date") <= F.lit(as_of))
    return moves.filter(this_month).groupBy("movement_type").agg(
        F.sum("quantity_in").alias("quantity_in"), F.sum("quantity_out").alias("quantity_out")
    )


def dead_stock(snapshot: DataFrame, as_of: date, days: int = 180) -> DataFrame:
    """Lots received more than ``days`` ago with stock left, per warehouse."""
    age = F.datediff(F.lit(as_of), key_to_date("import_date_key"))
    return (
        snapshot.filter((age > days) & (F.col("quantity_left") > 0))
        .groupBy("warehouse_key", "item_type")
        .agg(F.count(F.lit(1)).alias("lots"), F.sum("quantity_left").alias("dead_qty"), F.sum("stock_value").alias("dead_value"))
    )


def expired_lots(snapshot: DataFrame, as_of: date) -> DataFrame:
    return snapshot.filter((F.col("date_sd") < F.lit(as_of)) & (F.col("quantity_left") > 0)).select(
        "stock_id", "item_type", "item_code", "warehouse_key", "lot_code", "date_sd", "quantity_left", "stock_value"
    )


def price_source_share(snapshot: DataFrame) -> DataFrame:
    per = snapshot.groupBy("item_type", "price_source").agg(
        F.count(F.lit(1)).alias("lots"), whole("quantity_left").alias("qty_left"), whole("stock_value").alias("stock_value")
    )
    # a handful of labels per item type
    return per.withColumn("lot_share_pct", pct("lots", F.sum("lots").over(Window.partitionBy("item_type"))))


def month_stock_by_type(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("month_end", "item_type").agg(
        F.sum("est_qty_end_month").alias("qty"),
        F.sum(F.when(F.col("is_valued"), F.col("est_value_end_month"))).alias("value"),
    )


def _last_months(column: str, as_of: date, months: int = 12) -> Column:
    this_month = F.trunc(F.lit(as_of), "MM")
    return (F.col(column) >= F.add_months(this_month, -months)) & (F.col(column) < this_month)


def _turns(used: Column, level: Column) -> tuple[Column, Column]:
    turns = ratio(used, level)
    return rounded(turns, 2), rounded(ratio(F.lit(365), turns), 0)


def inventory_turnover(item_moves: DataFrame, monthly: DataFrame, snapshot: DataFrame, as_of: date) -> DataFrame:
    """Turnover over the last twelve full months: raw material by cost, product by quantity.

    ``item_moves`` are movements by item (item_type, item_key); internal transfers do not count.
    """
    out = item_moves.filter(
        (F.col("movement_type") == "OUTBOUND")
        & (F.col("movement_subtype") != TRANSFER_CODE)
        & _last_months("movement_date", as_of)
    )
    prices = average_lot_price(snapshot, 4)
    used = (
        out.join(prices, ["item_type", "item_key"], "left")
        .groupBy("item_type")
        .agg(
            rounded(F.sum((F.col("quantity_out").cast("double") * F.col("avg_unit_price").cast("double")).cast("decimal(28,4)")), 0).alias("cost"),
            whole("quantity_out").alias("qty_consumed"),
        )
    )
    level = (
        monthly.filter(_last_months("month_end", as_of))
        .groupBy("item_type", "month_end")
        .agg(F.sum("est_qty_end_month").alias("qty"), F.sum("est_value_end_month").alias("value"))
        .groupBy("item_type")
        .agg(rounded(exact_avg("qty"), 0).alias("avg_qty"), rounded(exact_avg("value"), 0).alias("avg_value"))
    )
    joined = used.join(level, "item_type")
    by_cost = F.col("item_type") == "nvl"
    turns, days = _turns(
        F.when(by_cost, F.col("cost")).otherwise(F.col("qty_consumed")),
        F.when(by_cost, F.col("avg_value")).otherwise(F.col("avg_qty")),
    )
    return joined.filter(F.col("item_type").isin("nvl", "product")).select(
        F.when(by_cost, "NVL").otherwise("Product (qty basis)").alias("item_type"),
        F.when(by_cost, F.col("cost")).alias("cogs_vnd_12m"),
        F.when(by_cost, F.col("avg_value")).alias("avg_inventory_vnd"),
        turns.alias("inventory_turnover"),
        days.alias("days_on_hand"),
        "qty_consumed",
        F.when(~by_cost, F.col("avg_qty")).alias("avg_stock_qty"),
    )


def unit_turnover(moves: DataFrame, monthly: DataFrame, dates: DataFrame) -> DataFrame:
    """Average month-end stock, unit turnover and days on hand over the whole calendar."""
    level = monthly.groupBy("month_end").agg(F.sum("est_qty_end_month").alias("qty")).agg(exact_avg("qty")).scalar()
    days = dates.agg(F.count(F.lit(1))).scalar()
    used = moves.agg(F.sum("quantity_out").alias("quantity_out"))
    return used.select(
        "quantity_out",
        rounded(level, 2).alias("avg_inventory_qty"),
        rounded(F.coalesce(ratio("quantity_out", level), F.lit(0.0)), 4).alias("inventory_turnover"),
        rounded(F.coalesce(ratio(level * days, "quantity_out"), F.lit(0.0)), 2).alias("days_on_hand"),
    )


# --- production -----------------------------------------------------------------


def production_overview(efficiency: DataFrame) -> DataFrame:
    return efficiency.filter(F.col("qty_planned") > 0).agg(
        F.count_distinct("productions_orders_id").alias("orders"),
        F.count_distinct("product_key").alias("unique_products"),
        whole("qty_planned").alias("total_planned"),
        whole("qty_produced").alias("total_produced"),
        rounded(exact_avg("efficiency_pct"), 2).alias("avg_efficiency_pct"),
        whole("total_hours").alias("total_hours_logged"),
        rounded(exact_avg("output_per_hour"), 4).alias("avg_output_per_hour"),
    )


def low_efficiency_orders(efficiency: DataFrame, below: int = 80) -> DataFrame:
    """Orders under the efficiency mark. Order totals repeat on every item, so the
    daily value is taken once and the largest planned quantity counts."""
    per_day = efficiency.groupBy("productions_orders_id", "stage_date_key").agg(
        F.max("qty_planned").alias("planned"), F.max("qty_produced").alias("made")
    )
    per_order = per_day.groupBy("productions_orders_id").agg(
        F.max("planned").alias("qty_planned"), F.sum("made").alias("qty_produced")
    )
    return per_order.withColumn("efficiency_pct", pct("qty_produced", "qty_planned")).filter(
        F.col("efficiency_pct") < below
    )


def labour_productivity(efficiency: DataFrame) -> DataFrame:
    return (
        efficiency.filter(F.col("stage_date_key").isNotNull())
        .groupBy("productions_orders_id", "stage_date_key")
        .agg(
            F.max("total_hours").alias("total_hours"),
            F.max("total_workers").alias("total_workers"),
            F.max("qty_produced").alias("qty_produced"),
        )
        .withColumn("hours_per_worker", rounded(ratio("total_hours", "total_workers"), 4))
        .withColumn("output_per_hour", rounded(ratio("qty_produced", "total_hours"), 4))
    )


# --- material cost ----------------------------------------------------------------


def _weighted(cond: Column | None = None) -> Column:
    num, den = F.col("allocated_npl_materials_vnd"), F.col("revenue_vnd")
    if cond is not None:
        num, den = F.when(cond, num), F.when(cond, den)
    return pct(F.sum(num), F.sum(den))


def _billions(c: str, cond: Column | None = None) -> Column:
    value = F.col(c) if cond is None else F.when(cond, F.col(c))
    return rounded(F.sum(value).cast("double") / 1e9, 2)


def _regular() -> Column:
    return (F.col("npl_quality") == "normal") & ~F.col("is_sample_order")


def cost_overview(order_cost: DataFrame, year: int) -> DataFrame:
    in_year = F.col("year") == year
    q = F.col("npl_quality")
    return order_cost.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(in_year).alias("orders_year"),
        F.count_if(in_year & (q == "normal")).alias("normal_year"),
        F.count_if(in_year & (q == "high_cost")).alias("high_cost_year"),
        F.count_if(in_year & (q == "suspect_data")).alias("suspect_year"),
        F.count_if(in_year & F.col("is_sample_order")).alias("sample_year"),
        F.count_if(in_year & _regular()).alias("regular_normal"),
        _billions("revenue_vnd", in_year).alias("total_rev_bn"),
        _billions("allocated_npl_materials_vnd", in_year).alias("total_npl_bn"),
        _weighted(in_year & _regular()).alias("weighted_npl_pct"),
        _weighted(in_year).alias("weighted_npl_pct_all"),
    )


def _cost_rows(order_cost: DataFrame) -> DataFrame:
    """What the cost reports with percentiles read, written: the costs are built once for all their passes."""
    columns = ["npl_quality", "npl_materials_pct", "revenue_vnd", "allocated_npl_materials_vnd"]
    return written(order_cost.select(*columns), "cost-rows")


def cost_quality_mix(order_cost: DataFrame, year: int) -> DataFrame:
    rows = _cost_rows(order_cost.filter(F.col("year") == year))
    mix = rows.groupBy("npl_quality").agg(
        F.count(F.lit(1)).alias("orders"),
        rounded(exact_avg("npl_materials_pct"), 1).alias("avg_npl_pct"),
        _billions("revenue_vnd").alias("rev_bn"),
        _billions("allocated_npl_materials_vnd").alias("npl_bn"),
        _weighted().alias("weighted_pct"),
    )
    median = exact_percentiles(rows, "npl_materials_pct", {"m": 0.5}, by=["npl_quality"])
    return mix.join(median, "npl_quality", "left").withColumn("median_npl_pct", rounded("m", 1))


def regular_cost_percentiles(order_cost: DataFrame, year: int) -> DataFrame:
    rows = _cost_rows(order_cost.filter((F.col("year") == year) & _regular()))
    probs = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    spread = exact_percentiles(rows, "npl_materials_pct", probs)
    lo, hi = TARGET_BAND
    stats = rows.agg(
        F.count(F.lit(1)).alias("orders"),
        rounded(exact_avg("npl_materials_pct"), 2).alias("avg_pct"),
        _weighted().alias("weighted_avg_pct"),
        F.count_if(F.col("npl_materials_pct").between(lo, hi)).alias("in_target_range"),
    )
    return stats.select(
        "*", *[rounded(spread.select(p).scalar(), 1).alias(p) for p in probs],
        pct("in_target_range", "orders").alias("in_target_pct"),
    )


def cost_by_month(order_cost: DataFrame, year: int) -> DataFrame:
    normal = F.col("npl_quality") == "normal"
    return order_cost.filter(F.col("year") == year).groupBy("month").agg(
        F.count_if(normal).alias("normal_orders"),
        F.count_if(~normal).alias("other_orders"),
        _weighted(normal).alias("weighted_npl_pct_normal"),
    )


def compare_with_expected(order_cost: DataFrame, expected: DataFrame) -> DataFrame:
    """Allocated cost share next to an expected share per order (order_id, expected_pct)."""
    return order_cost.join(expected, "order_id").select(
        "order_id", "npl_materials_pct", "expected_pct", "npl_quality", "is_sample_order",
        rounded(F.col("npl_materials_pct").cast("double") - F.col("expected_pct").cast("double"), 1).alias("difference"),
    )


def top_suspects(order_cost: DataFrame, year: int, k: int = 15) -> DataFrame:
    rows = order_cost.filter((F.col("year") == year) & (F.col("npl_quality") == "suspect_data"))
    return top(rows, "allocated_npl_materials_vnd", k, "order_id").select(
        "order_id", "order_reference_no", "revenue_vnd", "allocated_npl_materials_vnd", "npl_materials_pct",
        "total_quantity", "linked_plan_count", "total_bom_items",
    )


# --- key coverage -------------------------------------------------------------------


def key_match_rates(lots: DataFrame, products: DataFrame, materials: DataFrame) -> DataFrame:
    """Per item type: lots whose product key and material key resolve."""
    p = products.select("product_key", F.lit(1).alias("p"))
    m = materials.select("material_key", F.lit(1).alias("m"))
    keys = lots.groupBy("type_items", "product_key", "material_key").agg(F.count(F.lit(1)).alias("n"))
    return (
        keys.join(p, "product_key", "left")
        .join(m, "material_key", "left")
        .groupBy("type_items")
        .agg(
            F.sum("n").alias("total"),
            zero_if_null(F.sum(F.when(F.col("m") == 1, F.col("n")))).alias("match_material"),
            zero_if_null(F.sum(F.when(F.col("p") == 1, F.col("n")))).alias("match_product"),
        )
    )


def purchase_match_rates(po_lines: DataFrame, materials: DataFrame) -> DataFrame:
    """Purchase lines that name a known material, and lines with a price."""
    m = materials.select("material_key", F.lit(1).alias("m"))
    keys = po_lines.groupBy("material_key").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("price_suppliers") > 0).alias("priced")
    )
    return (
        keys.join(m, "material_key", "left")
        .agg(
            F.sum("n").alias("lines"),
            zero_if_null(F.sum(F.when(F.col("m") == 1, F.col("n")))).alias("matched"),
            F.sum("priced").alias("priced"),
        )
        .withColumn("matched_pct", pct("matched", "lines", 1))
        .withColumn("priced_pct", pct("priced", "lines", 1))
    )
