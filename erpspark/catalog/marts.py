"""Mart and view queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from erpspark.catalog.registry import Erp, query
from erpspark.catalog.roles import PARAMS
from erpspark.catalog.sqltext import avg, div, part, pct, r
from erpspark.plans import maintained, sales, shared, views
from erpspark.session import work_dir, written

AS_OF = f"DATE '{PARAMS.as_of}'"

# --- views -------------------------------------------------------------------
VIEW_SPECS = {
    "customers": "customer_key:l customer_id:l customer_code:s prefix_client:s company:s company_short:s representative:s fullname:s phonenumber:s email:s type_client:s vip_rating:l status_clients:l is_active:b country:l city:s address:s debt_limit:d debt_limit_day:l discount:d time_payment:l price_group_key:l price_group_code:s price_group_name:s datecreated:t",
    "dates": "date_key:l full_date:t day_of_week:l day_name:s day_of_month:l day_of_year:l week_of_year:l month_num:l month_name:s quarter:l year:l is_weekend:b is_holiday:b",
    "materials": "material_key:l material_id:l material_code:s material_name:s material_name_supplier:s category_id:l unit_id:l price_import:d species:s is_zinc:b mode_id:l is_single_use:b is_active:b id_branch:l",
    "order_items": "order_item_id:s order_id:l product_key:l quantity:d price:d amount:d tax_amount_item:d discount_percent_item:d discount_percent_amount_item:d discount_direct_amount_item:d total_amount:d cost:d profit:d quantity_delivery:d quantity_not_delivery:d quantity_returned:d type_item:s type_gift:l unit_id:l",
    "orders": "order_key:l order_id:l reference_no:s customer_key:l employee_key:l order_date_key:l warehouse_id:l id_branch:l count_items:l total_quantity:d total_tax:d total_discount_percent:d total_discount_direct:d cost_delivery:d grand_total:d total_cost:d total_profit:d total_payment:d status:s status_payment:l status_orders:s type_orders:s type_bills:s is_cancel:l is_end:l currencies:l date_created:t date_updated:t",
    "products": "product_key:l product_id:l product_code:s product_name:s product_name_customer:s type_products:s category_id:l unit_id:l species:s brand:s brand_id:l price_import:d price_sell:d status:l is_active:b date_created:t",
    "suppliers": "supplier_key:l supplier_id:l supplier_code:s company:s city:s groups_in:s debt_limit:d is_active:b",
    "warehouses": "warehouse_key:l warehouse_id:l warehouse_code:s warehouse_name:s address:s supplier_id:l id_branch:l is_virtual:b",
}
part("k_customers", "SELECT *, coalesce(representative, company, customer_code) AS fullname FROM r_customers")
for _name, _spec in VIEW_SPECS.items():
    if _name == "dates":
        continue
    _src = "k_customers" if _name == "customers" else f"r_{_name}"
    query(f"view_{_name}", _spec, f"SELECT * FROM {_src}")(
        lambda e, n=_name: getattr(views, n)(e.role(n))
    )


@query(
    "view_dates",
    VIEW_SPECS["dates"],
    "SELECT * FROM r_dates WHERE full_date IN (SELECT cast(o_orderdate as date) FROM orders)",
)
def _dates(e: Erp):
    # the calendar days orders were placed on
    ordered = e.table("orders").select(F.to_date("o_orderdate").alias("full_date"))
    return views.dates(e.dates).join(ordered, "full_date", "left_semi")


@query(
    "view_staff",
    "staff_key:l staff_id:l firstname:s lastname:s fullname:s staff_role:l is_admin:l is_active:b",
    "SELECT * RENAME (role AS staff_role, admin AS is_admin) FROM r_staff",
)
def _staff(e: Erp):
    return views.staff(e.staff)


part(
    "k_enriched",
    """SELECT o.*, full_date AS order_date, day_of_week, day_name, day_of_month, week_of_year, month_num, month_name,
         quarter, year, is_weekend, customer_code, fullname AS customer_name, company, company_short, city, type_client,
         price_group_key, price_group_code, price_group_name, vip_rating
       FROM r_orders o LEFT JOIN r_dates d ON d.date_key = o.order_date_key
       LEFT JOIN k_customers c ON c.customer_key = o.customer_key""",
)
query(
    "view_orders_enriched",
    "order_key:l order_id:l reference_no:s order_date_key:l order_date:t day_of_week:l day_name:s day_of_month:l "
    "week_of_year:l month_num:l month_name:s quarter:l year:l is_weekend:b customer_key:l customer_code:s "
    "customer_name:s company:s company_short:s city:s type_client:s price_group_key:l price_group_code:s "
    "price_group_name:s vip_rating:l id_branch:l employee_key:l warehouse_id:l count_items:l total_quantity:d "
    "grand_total:d total_cost:d total_profit:d total_payment:d total_tax:d total_discount_percent:d "
    "total_discount_direct:d cost_delivery:d status:s status_payment:l status_orders:s type_orders:s type_bills:s "
    "is_cancel:l is_end:l date_created:t date_updated:t",
    "SELECT * FROM k_enriched",
)(lambda e: e.enriched)


# --- order lines with repaired prices ---------------------------------------
def _line_parts(tag: str, item_source: str, product: str) -> None:
    part(
        f"k_base{tag}",
        f"""SELECT i.*, o.customer_key, o.order_date, o.order_date_key, o.year, o.quarter, o.month_num, o.month_name,
              o.id_branch, o.customer_code, o.customer_name, o.price_group_name, o.city, o.is_cancel,
              date_trunc('month', o.order_date) AS mon,
              o.is_cancel = 0 AND i.quantity > 0 AND i.total_amount > 0 AS priced
            FROM {item_source} i JOIN k_enriched o ON o.order_id = i.order_id""",
    )
    part(
        f"k_prev{tag}",
        f"""SELECT customer_key, {product}, mon,
              lag(amt) OVER w AS p_amt, lag(qty) OVER w AS p_qty
            FROM (SELECT customer_key, {product}, mon, sum(total_amount) AS amt, sum(quantity) AS qty
                  FROM k_base{tag} WHERE priced GROUP BY ALL)
            WINDOW w AS (PARTITION BY customer_key, {product} ORDER BY mon)""",
    )
    part(
        f"k_lines{tag}",
        f"""SELECT *, CASE WHEN is_price_spike THEN prev_month_unit_price ELSE line_unit_price END AS raw_adjusted,
              CASE WHEN is_price_spike THEN {r('cast(quantity as double) * prev_month_unit_price', 2)}
                   WHEN quantity <> 0 THEN round(total_amount, 2) END AS total_amount_adjusted
            FROM (SELECT b.*, {div('total_amount', 'quantity')} AS line_unit_price,
                    {div('p_amt', 'p_qty')} AS prev_month_unit_price,
                    coalesce(priced AND cast(total_amount as decimal(18,4)) * cast(p_qty as decimal(14,4))
                       > 3 * cast(p_amt as decimal(18,4)) * cast(quantity as decimal(14,4)), false) AS is_price_spike,
                    CASE WHEN priced AND p_amt IS NOT NULL THEN {div('total_amount', 'quantity')} / {div('p_amt', 'p_qty')} END AS mult
                  FROM k_base{tag} b LEFT JOIN k_prev{tag} p
                    ON p.customer_key = b.customer_key AND p.{product} = b.{product} AND p.mon = b.mon)""",
    )
    part(
        f"k_detail{tag}",
        f"""SELECT l.*, price AS unit_price, {r('mult', 2)} AS spike_multiplier, {r('raw_adjusted', 2)} AS unit_price_adjusted,
              round(total_amount - total_amount_adjusted, 2) AS spike_amount_removed,
              CASE WHEN raw_adjusted IS NULL OR raw_adjusted = 0 THEN NULL WHEN raw_adjusted <= p33 THEN 'Low'
                   WHEN raw_adjusted <= p67 THEN 'Mid' ELSE 'High' END AS price_tier,
              {r('p33', 6)} AS price_tier_p33, {r('p67', 6)} AS price_tier_p67
            FROM k_lines{tag} l, (SELECT quantile_cont(line_unit_price, 0.33) AS p33, quantile_cont(line_unit_price, 0.67) AS p67
                                  FROM k_lines{tag} WHERE priced) q
            WHERE is_cancel = 0""",
    )


DETAIL = (
    "order_item_id:s order_id:l order_date_key:l order_date:t year:l quarter:l month_num:l month_name:s customer_key:l "
    "customer_code:s customer_name:s price_group_name:s city:s product_key:l product_code:s product_name:s "
    "type_products:s brand:s id_branch:l unit_id:l type_item:s type_gift:l quantity:d unit_price:d line_unit_price:d "
    "prev_month_unit_price:d is_price_spike:b spike_multiplier:d unit_price_adjusted:d amount:d tax_amount_item:d "
    "discount_percent_item:d discount_percent_amount_item:d discount_direct_amount_item:d total_amount:d "
    "total_amount_adjusted:d spike_amount_removed:d cost:d profit:d quantity_delivery:d quantity_not_delivery:d "
    "quantity_returned:d price_tier:s price_tier_p33:d price_tier_p67:d"
)


def _round_limits(df):
    for c in ("price_tier_p33", "price_tier_p67"):
        df = df.withColumn(c, F.round(F.col(c).cast("decimal(38,8)"), 6))
    return df


_line_parts("", "r_order_items", "product_key")
query(
    "mart_order_items_detail",
    DETAIL,
    "SELECT d.*, p.product_code, p.product_name, p.type_products, p.brand FROM k_detail d "
    "LEFT JOIN r_products p ON p.product_key = d.product_key",
)(lambda e: _round_limits(e.detail))

part(
    "k_brand_items",
    "SELECT i.* EXCLUDE (product_key), p.brand_id AS product_key FROM r_order_items i "
    "LEFT JOIN r_products p ON p.product_key = i.product_key",
)
_line_parts("_brand", "k_brand_items", "product_key")


@query(
    "mart_order_items_detail_brand",
    " ".join(c for c in DETAIL.split() if c.split(":")[0] not in ("product_code", "product_name", "type_products", "brand")),
    "SELECT * FROM k_detail_brand",
)
def _detail_brand(e: Erp):
    brand_of = e.products.select("product_key", "brand_id")
    items = sales.decorate_lines(e.order_items, brand_of, "product_key", ["brand_id"]).drop("product_key")
    items = items.withColumnRenamed("brand_id", "product_key")
    return _round_limits(sales.order_items_detail(items, e.enriched, None, headers=e.dated_orders))


part(
    "k_order_sums",
    """SELECT order_id, sum(total_amount_adjusted) FILTER (is_cancel = 0) AS adj,
         count(*) FILTER (is_cancel = 0 AND is_price_spike) AS spikes, sum(quantity) AS q, sum(quantity_delivery) AS qd,
         sum(quantity_not_delivery) AS qo, sum(quantity_returned) AS qr, count(*) AS n
       FROM k_lines GROUP BY order_id""",
)
part(
    "k_adjusted",
    f"""SELECT *, revenue - cogs AS gross_profit FROM (
          SELECT o.*, coalesce(adj, grand_total) AS revenue, coalesce(spikes, 0) AS spike_line_count, q, qd, qo, qr, n,
            {r(f"cast(total_cost as double) * CASE WHEN grand_total = 0 THEN 1.0 ELSE {div('coalesce(adj, grand_total)', 'grand_total')} END", 4)} AS cogs
          FROM k_enriched o LEFT JOIN k_order_sums s ON s.order_id = o.order_id)""",
)
part(
    "m_performance",
    f"""SELECT *, grand_total AS revenue_raw, revenue - grand_total AS revenue_adjustment, coalesce(q, 0) AS qty_ordered,
          coalesce(qd, 0) AS qty_delivered, coalesce(qo, 0) AS qty_outstanding, coalesce(qr, 0) AS qty_returned,
          coalesce(n, 0) AS line_item_count, {pct('coalesce(qd, 0)', 'coalesce(q, 0)')} AS fulfilment_rate_pct,
          CASE WHEN coalesce(qo, 0) = 0 THEN 1 ELSE 0 END AS is_fully_delivered, is_end AS is_completed
        FROM k_adjusted""",
)
query(
    "mart_order_performance",
    "order_key:l order_id:l reference_no:s order_date_key:l order_date:t year:l quarter:l month_num:l month_name:s "
    "is_weekend:b customer_key:l customer_code:s customer_name:s city:s type_client:s price_group_name:s vip_rating:l "
    "id_branch:l employee_key:l revenue:d revenue_raw:d revenue_adjustment:d cogs:d gross_profit:d spike_line_count:l "
    "qty_ordered:d qty_delivered:d qty_outstanding:d qty_returned:d line_item_count:l fulfilment_rate_pct:d "
    "is_fully_delivered:l is_completed:l is_cancel:l status:s status_orders:s type_orders:s type_bills:s",
    "SELECT * FROM m_performance",
)(lambda e: e.performance)

part(
    "m_revenue",
    f"""SELECT order_date_key, order_date, year, quarter, month_num, month_name, week_of_year, is_weekend, customer_key,
          customer_code, customer_name, company, city, type_client, price_group_code, price_group_name, vip_rating, id_branch,
          count(DISTINCT order_id) AS order_count, sum(revenue) AS revenue, sum(cogs) AS cogs, sum(gross_profit) AS gross_profit,
          {pct('sum(gross_profit)', 'sum(revenue)')} AS gross_margin_pct, {avg('revenue')} AS avg_order_value,
          sum(total_tax) AS total_tax, sum(total_discount_percent + total_discount_direct) AS total_discount,
          sum(grand_total) AS revenue_raw, sum(revenue) - sum(grand_total) AS revenue_adjustment,
          sum(spike_line_count) AS spike_line_count
        FROM k_adjusted WHERE is_cancel = 0 GROUP BY ALL""",
)
REVENUE_SPEC = (
    "order_date_key:l order_date:t year:l quarter:l month_num:l month_name:s week_of_year:l is_weekend:b customer_key:l "
    "customer_code:s customer_name:s company:s city:s type_client:s price_group_code:s price_group_name:s vip_rating:l "
    "id_branch:l order_count:l revenue:d cogs:d gross_profit:d gross_margin_pct:d avg_order_value:d total_tax:d "
    "total_discount:d revenue_raw:d revenue_adjustment:d spike_line_count:l"
)
query("mart_revenue", REVENUE_SPEC, "SELECT * FROM m_revenue")(lambda e: e.revenue)


@query("mart_revenue_incremental", REVENUE_SPEC, "SELECT * FROM m_revenue")
def _revenue_incremental(e: Erp):
    """The mart after two loads: orders before 2000, those of 1999 with doubled amounts; then the orders from 2000 on
    and those of 1999 as they should be. The second load is given twice."""
    schema = f"mart_{uuid.uuid4().hex}"
    e.spark.sql(f"CREATE DATABASE {schema} LOCATION '{work_dir(e.spark)}/{schema}'")
    early, late, wrong = (F.col("order_date_key") < 20000101), (F.col("order_date_key") >= 19990101), F.col("order_date_key").between(19990101, 19991231)

    def doubled(df, columns):
        flagged = df.withColumns({c: F.when(wrong, F.col(c) * 2).otherwise(F.col(c)).cast(df.schema[c].dataType) for c in columns})
        return flagged.select(*df.columns)

    source = written(e.dated_orders.select(*maintained.ORDER_COLUMNS), "orders")
    days = source.select("order_id", "order_date_key")
    lines = written(e.order_items.select(*maintained.ITEM_COLUMNS).join(days, "order_id"), "items")
    items, orders = doubled(lines.filter(early), ["total_amount"]), doubled(source.filter(early), ["grand_total", "total_tax"])
    sums = maintained.RevenueSums(e.spark, f"{schema}.revenue_sums")
    sums.build(items, orders, 1)
    for _ in range(2):
        sums.apply(2, items, orders, lines.filter(late), source.filter(late))
    sums.compact(3)
    out = written(sums.mart(e.customers, e.dates), "revenue")
    e.spark.sql(f"DROP DATABASE {schema} CASCADE")
    return out

part(
    "m_profit",
    f"""SELECT order_date_key, order_date, year, quarter, month_num, month_name, customer_key, customer_code, customer_name,
          price_group_code, price_group_name, type_client, vip_rating, id_branch, count(DISTINCT order_id) AS order_count,
          sum(grand_total) AS revenue, sum(cost_delivery) AS delivery_revenue, sum(total_tax) AS total_vat,
          sum(total_cost) AS cogs, bool_or(total_cost > 0) AS is_cogs_available, sum(total_profit) AS gross_profit,
          {pct('sum(total_profit)', 'sum(grand_total)')} AS gp_margin_pct,
          sum(total_discount_percent + total_discount_direct) AS total_discount
        FROM k_enriched WHERE is_cancel = 0 GROUP BY ALL""",
)
query(
    "mart_gross_profit",
    "order_date_key:l order_date:t year:l quarter:l month_num:l month_name:s customer_key:l customer_code:s "
    "customer_name:s price_group_code:s price_group_name:s type_client:s vip_rating:l id_branch:l order_count:l "
    "revenue:d delivery_revenue:d total_vat:d cogs:d is_cogs_available:b gross_profit:d gp_margin_pct:d total_discount:d",
    "SELECT * FROM m_profit",
)(lambda e: e.profit)

# --- customers ---------------------------------------------------------------
part(
    "k_rfm",
    f"""SELECT *, rs + fs + ms AS total,
          CASE WHEN rs >= 4 AND fs >= 4 AND ms >= 4 THEN 'Champions' WHEN rs >= 3 AND fs >= 3 THEN 'Loyal'
               WHEN rs >= 4 AND fs <= 2 THEN 'Promising' WHEN rs >= 3 AND fs >= 2 AND ms >= 3 THEN 'Potential Loyalist'
               WHEN rs <= 2 AND fs >= 3 THEN 'At Risk' WHEN rs <= 2 AND fs <= 2 AND ms <= 2 THEN 'Lost'
               WHEN fs = 1 THEN 'New' ELSE 'Others' END AS seg
        FROM (SELECT *, ntile(5) OVER (ORDER BY days DESC NULLS FIRST, customer_key NULLS LAST) AS rs,
                ntile(5) OVER (ORDER BY n, customer_key NULLS LAST) AS fs,
                ntile(5) OVER (ORDER BY amt NULLS LAST, customer_key NULLS LAST) AS ms
              FROM (SELECT customer_key, max(order_date) AS last_day, min(order_date) AS first_day,
                      count(DISTINCT order_id) AS n, sum(grand_total) AS amt, {avg('grand_total')} AS mean,
                      {AS_OF} - max(order_date) AS days
                    FROM k_enriched WHERE is_cancel = 0 GROUP BY customer_key))""",
)
part(
    "m_segmentation",
    """SELECT c.customer_key, customer_code, fullname AS customer_name, company, city, type_client, price_group_name,
         vip_rating, is_active, datecreated AS customer_since, debt_limit, debt_limit_day, coalesce(n, 0) AS total_orders,
         coalesce(amt, 0) AS lifetime_revenue, coalesce(mean, 0) AS avg_order_value, first_day AS first_order_date,
         last_day AS last_order_date, days AS days_since_last_order, coalesce(rs, 1) AS recency_score,
         coalesce(fs, 1) AS frequency_score, coalesce(ms, 1) AS monetary_score, coalesce(total, 3) AS rfm_total_score,
         coalesce(seg, 'Inactive') AS rfm_segment
       FROM k_customers c LEFT JOIN k_rfm f ON f.customer_key = c.customer_key""",
)
SEGMENTS = (
    "customer_key:l customer_code:s customer_name:s company:s city:s type_client:s price_group_name:s vip_rating:l "
    "is_active:b customer_since:t debt_limit:d debt_limit_day:l total_orders:l lifetime_revenue:d avg_order_value:d "
    "first_order_date:t last_order_date:t days_since_last_order:l recency_score:l frequency_score:l monetary_score:l "
    "rfm_total_score:l rfm_segment:s"
)
query("mart_customer_segmentation", SEGMENTS, "SELECT * FROM m_segmentation")(lambda e: e.segmentation)
query("mart_customer_segmentation_scaled", SEGMENTS, "SELECT * FROM m_segmentation")(
    # kept under its old name: one form serves all sizes
    lambda e: sales.customer_segmentation(e.dated_orders, e.customers, e.params.as_of)
)

part(
    "m_credit",
    f"""SELECT *, {pct('lifetime_revenue', 'nullif(debt_limit, 0)')} AS credit_utilisation_pct,
          debt_limit - lifetime_revenue AS credit_headroom,
          CASE WHEN debt_limit = 0 THEN NULL WHEN lifetime_revenue > debt_limit THEN 1 ELSE 0 END AS is_over_limit,
          CASE WHEN debt_limit = 0 THEN 'No Limit Set' WHEN lifetime_revenue >= debt_limit THEN 'Over Limit'
               WHEN lifetime_revenue >= debt_limit * 0.8 THEN 'Near Limit' WHEN lifetime_revenue > 0 THEN 'Within Limit'
               ELSE 'Clear' END AS credit_status
        FROM (SELECT c.* EXCLUDE (debt_limit), fullname AS customer_name, datecreated AS customer_since,
                coalesce(debt_limit, 0) AS debt_limit, coalesce(rev, 0) AS lifetime_revenue,
                coalesce(days, 0) AS active_days, last_order_date
              FROM k_customers c LEFT JOIN (SELECT customer_key, sum(revenue) AS rev, count(DISTINCT order_date_key) AS days,
                                              max(order_date) AS last_order_date FROM m_revenue GROUP BY customer_key) v
                ON v.customer_key = c.customer_key)""",
)
query(
    "mart_customer_credit",
    "customer_key:l customer_code:s customer_name:s company:s city:s type_client:s price_group_name:s vip_rating:l "
    "is_active:b customer_since:t phonenumber:s email:s debt_limit:d debt_limit_day:l time_payment:l discount:d "
    "lifetime_revenue:d last_order_date:t active_days:l credit_utilisation_pct:d credit_headroom:d is_over_limit:l credit_status:s",
    "SELECT * FROM m_credit",
)(lambda e: e.credit)

part(
    "m_purchase",
    f"""SELECT v.*, full_date AS po_date, year, quarter, month_num, month_name, supplier_code, s.company AS supplier_name,
          s.city AS supplier_city, s.groups_in AS supplier_group, product_code, product_name, type_products, category_id,
          brand, price_import AS std_import_price
        FROM (SELECT po_date_key, supplier_key, product_key, count(DISTINCT po_id) AS po_count, count(*) AS line_count,
                sum(quantity) AS qty_ordered, sum(quantity_suppliers) AS qty_received, sum(total_expected) AS expected_cost,
                sum(total_suppliers) AS actual_cost, sum(total_suppliers) - sum(total_expected) AS price_variance,
                {r(div('sum(total_suppliers)', 'sum(quantity_suppliers)'), 4)} AS avg_unit_cost, sum(subtotal) AS subtotal,
                sum(total_expected) - sum(subtotal) AS tax_amount, sum(quantity) - sum(quantity_suppliers) AS qty_gap
              FROM r_po_lines GROUP BY ALL) v
        LEFT JOIN r_dates d ON d.date_key = v.po_date_key LEFT JOIN r_suppliers s ON s.supplier_key = v.supplier_key
        LEFT JOIN r_products p ON p.product_key = v.product_key""",
)
query(
    "mart_purchase_cost",
    "po_date_key:l po_date:t year:l quarter:l month_num:l month_name:s supplier_key:l supplier_code:s supplier_name:s "
    "supplier_city:s supplier_group:s product_key:l product_code:s product_name:s type_products:s category_id:l brand:s "
    "std_import_price:d po_count:l line_count:l qty_ordered:d qty_received:d expected_cost:d actual_cost:d "
    "price_variance:d avg_unit_cost:d subtotal:d tax_amount:d qty_gap:d",
    "SELECT * FROM m_purchase",
)(lambda e: e.purchases)

# --- shared dimensions -------------------------------------------------------
part(
    "k_sold",
    f"""SELECT product_key, {r(div('sum(cast(unit_price_adjusted as decimal(18,2)) * cast(quantity as decimal(14,4)))', 'sum(quantity)'), 2)} AS avg_sell_price_actual,
          {r('quantile_cont(cast(unit_price_adjusted as double), 0.5)', 2)} AS median_sell_price_actual,
          arg_max_null(unit_price_adjusted, (order_date, order_item_id)) AS last_sell_price_actual,
          count(DISTINCT order_id) AS sold_order_count_12m
        FROM k_detail WHERE unit_price_adjusted > 0 GROUP BY product_key""",
)
part(
    "m_product",
    """SELECT p.*, date_created AS product_created_at, avg_sell_price_actual, median_sell_price_actual,
         last_sell_price_actual, sold_order_count_12m,
         CASE WHEN avg_sell_price_actual IS NULL OR avg_sell_price_actual = 0 THEN NULL
              WHEN cast(avg_sell_price_actual as double) <= lo THEN 'Low'
              WHEN cast(avg_sell_price_actual as double) <= hi THEN 'Mid' ELSE 'High' END AS price_tier
       FROM r_products p LEFT JOIN k_sold s ON s.product_key = p.product_key,
         (SELECT quantile_cont(cast(avg_sell_price_actual as double), 0.33) AS lo,
                 quantile_cont(cast(avg_sell_price_actual as double), 0.67) AS hi
          FROM k_sold WHERE avg_sell_price_actual > 0) q""",
)
query(
    "mart_product",
    "product_key:l product_id:l product_code:s product_name:s product_name_customer:s type_products:s category_id:l "
    "brand:s brand_id:l unit_id:l species:s price_import:d price_sell:d avg_sell_price_actual:d "
    "median_sell_price_actual:d last_sell_price_actual:d sold_order_count_12m:l price_tier:s status:l is_active:b product_created_at:t",
    "SELECT * FROM m_product",
)(lambda e: e.product_mart)

part(
    "m_material",
    """SELECT *, material_name ILIKE 'Gi%y %' OR material_name ILIKE '%(kh%ng%d%ng)Gi%y%' OR material_name ILIKE 'Decal Gi%y%'
           OR material_name ILIKE 'D%y B%ng Gi%y%' AS is_giay,
         CASE WHEN is_zinc THEN 'Kem in' WHEN material_name ILIKE 'Gi%y %' THEN 'Giay' WHEN material_name ILIKE 'Decal%' THEN 'Decal'
              WHEN material_name ILIKE 'Muc%' OR material_name ILIKE 'UV%' THEN 'Muc / UV'
              WHEN material_name ILIKE 'Bao bi%' OR material_name ILIKE 'Tui%' THEN 'Bao bi'
              WHEN material_name ILIKE 'Bang keo%' OR material_name ILIKE 'Bang d%n%' THEN 'Bang keo / Dan'
              WHEN material_name ILIKE 'Hop%' OR material_name ILIKE 'Carton%' OR material_name ILIKE 'VTDG%' THEN 'Vat tu dong goi'
              ELSE 'Khac' END AS npl_type
       FROM r_materials""",
)
query(
    "mart_material",
    "material_key:l material_id:l material_code:s material_name:s material_name_supplier:s category_id:l unit_id:l "
    "species:s mode_id:l is_zinc:b is_giay:b npl_type:s price_import:d is_single_use:b is_active:b id_branch:l",
    "SELECT * FROM m_material",
)(lambda e: e.material_mart)
query(
    "mart_customer",
    "customer_key:l customer_id:l customer_code:s prefix_client:s company:s company_short:s representative:s "
    "customer_name:s phonenumber:s email:s type_client:s vip_rating:l price_group_code:s price_group_name:s "
    "status_clients:l is_active:b city:s district:s address:s debt_limit:d debt_limit_day:l discount:d time_payment:l customer_created_at:t",
    "SELECT *, fullname AS customer_name, datecreated AS customer_created_at FROM k_customers",
)(lambda e: shared.customer_mart(e.customers))
