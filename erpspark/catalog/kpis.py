"""KPI queries."""

from __future__ import annotations


from erpspark.catalog.registry import Erp, query
from erpspark.catalog.roles import PARAMS
from erpspark.catalog.sqltext import avg, div, part, pct, r
from erpspark.functions.expr import pct as pct_col
from erpspark.plans import inventory, kpi

DAY = PARAMS.as_of
AS_OF = f"DATE '{DAY}'"
YEAR = 1998


def whole(x: str) -> str:
    return r(f"sum({x})", 0)


# --- sales ----------------------------------------------------------------------
query(
    "kpi_sales_overview",
    "rows:l unique_customers:l unique_dates:l date_from:t date_to:t total_revenue:d total_cogs:d total_gross_profit:d avg_gp_margin_pct:d",
    f"""SELECT count(*) AS rows, count(DISTINCT customer_key) AS unique_customers, count(DISTINCT order_date_key) AS unique_dates,
          min(order_date) AS date_from, max(order_date) AS date_to, {whole('revenue')} AS total_revenue, {whole('cogs')} AS total_cogs,
          {whole('gross_profit')} AS total_gross_profit, {r(avg('gross_margin_pct'), 2)} AS avg_gp_margin_pct FROM m_revenue""",
)(lambda e: kpi.sales_overview(e.revenue))
query(
    "kpi_sales_by_year",
    "year:l customers:l orders:l revenue:d gross_profit:d avg_gp_pct:d",
    f"""SELECT year, count(DISTINCT customer_key) AS customers, sum(order_count) AS orders, {whole('revenue')} AS revenue,
          {whole('gross_profit')} AS gross_profit, {r(avg('gross_margin_pct'), 2)} AS avg_gp_pct FROM m_revenue GROUP BY year""",
)(lambda e: kpi.sales_by_year(e.revenue))
query(
    "kpi_top_customers",
    "customer_code:s customer_name:s revenue:d gross_profit:d orders:l",
    f"""SELECT customer_code, customer_name, {whole('revenue')} AS revenue, {whole('gross_profit')} AS gross_profit, sum(order_count) AS orders
        FROM m_revenue GROUP BY customer_code, customer_name ORDER BY sum(m_revenue.revenue) DESC, customer_code LIMIT 10""",
)(lambda e: kpi.top_customers(e.revenue))
query(
    "kpi_fulfilment_overview",
    "total_orders:l cancelled:l fully_delivered:l completed:l avg_fulfilment_pct:d fulfilment_rate:d",
    f"""SELECT count(*) AS total_orders, sum(is_cancel) AS cancelled, sum(is_fully_delivered) AS fully_delivered, sum(is_completed) AS completed,
          {r(avg('fulfilment_rate_pct'), 2)} AS avg_fulfilment_pct, {r(div('sum(is_fully_delivered)', 'count(*)'), 4)} AS fulfilment_rate FROM m_performance""",
)(lambda e: kpi.fulfilment_overview(e.performance))
query(
    "kpi_fulfilment_histogram",
    "bucket_from:l orders:l",
    "SELECT floor(fulfilment_rate_pct / 10) * 10 AS bucket_from, count(*) AS orders FROM m_performance GROUP BY 1",
)(lambda e: kpi.fulfilment_histogram(e.performance))
query(
    "kpi_segment_profile",
    "rfm_segment:s customers:l total_revenue:d avg_revenue:d avg_orders:d avg_days_since_order:d",
    f"""SELECT rfm_segment, count(*) AS customers, {whole('lifetime_revenue')} AS total_revenue, {r(avg('lifetime_revenue'), 0)} AS avg_revenue,
          {r(avg('total_orders'), 1)} AS avg_orders, {r(avg('days_since_last_order'), 0)} AS avg_days_since_order
        FROM m_segmentation GROUP BY rfm_segment""",
)(lambda e: kpi.segment_profile(e.segmentation))
query(
    "kpi_at_risk_customers",
    "customer_key:l customer_code:s customer_name:s rfm_segment:s last_order_date:t days_since_last_order:l lifetime_revenue:d",
    "SELECT * FROM m_segmentation WHERE days_since_last_order > 90",
)(lambda e: kpi.at_risk_customers(e.segmentation))
query(
    "kpi_cohort_by_year",
    "cohort_year:l customers:l active_customers:l revenue:d",
    f"""SELECT year(customer_since) AS cohort_year, count(*) AS customers, count(*) FILTER (total_orders > 0) AS active_customers,
          {whole('lifetime_revenue')} AS revenue FROM m_segmentation GROUP BY 1""",
)(lambda e: kpi.cohort_by_year(e.segmentation))
query(
    "kpi_revenue_yoy",
    "year:l month_num:l revenue:d revenue_py:d revenue_yoy_pct:d",
    f"""SELECT a.year, a.month_num, a.v AS revenue, b.v AS revenue_py, {pct('a.v - b.v', 'b.v')} AS revenue_yoy_pct
        FROM (SELECT year, month_num, sum(revenue) AS v FROM m_revenue GROUP BY ALL) a
        LEFT JOIN (SELECT year, month_num, sum(revenue) AS v FROM m_revenue GROUP BY ALL) b
          ON b.year = a.year - 1 AND b.month_num = a.month_num""",
)(lambda e: kpi.revenue_yoy(e.revenue))
query(
    "kpi_order_value_trend",
    "year:l orders:l revenue:d aov:d upt:d orders_change_pct:d revenue_change_pct:d aov_change_pct:d upt_change_pct:d",
    f"""SELECT year, orders, revenue, {r('aov', 4)} AS aov, {r('upt', 4)} AS upt,
          {pct('orders - lag(orders) OVER w', 'lag(orders) OVER w')} AS orders_change_pct,
          {pct('revenue - lag(revenue) OVER w', 'lag(revenue) OVER w')} AS revenue_change_pct,
          {pct('aov - lag(aov) OVER w', 'lag(aov) OVER w')} AS aov_change_pct, {pct('upt - lag(upt) OVER w', 'lag(upt) OVER w')} AS upt_change_pct
        FROM (SELECT year, count(*) AS orders, sum(revenue) AS revenue, {div('sum(revenue)', 'count(*)')} AS aov,
                {div('sum(qty_ordered)', 'count(*)')} AS upt FROM m_performance WHERE is_cancel = 0 AND year IS NOT NULL GROUP BY year)
        WINDOW w AS (ORDER BY year)""",
)(lambda e: kpi.order_value_trend(e.performance))
for _name, _cols, _spec in [
    ("day", "order_date", "order_date:t"),
    ("month", "year, month_num", "year:l month_num:l"),
    ("quarter", "year, quarter", "year:l quarter:l"),
    ("city", "city", "city:s"),
    ("client_type", "type_client", "type_client:s"),
]:
    query(
        f"kpi_revenue_by_{_name}",
        f"{_spec} orders:l revenue:d aov:d",
        f"""SELECT {_cols}, sum(order_count) AS orders, sum(revenue) AS revenue, {r(div('sum(revenue)', 'sum(order_count)'), 2)} AS aov
            FROM m_revenue GROUP BY {_cols}""",
    )(lambda e, c=_cols: kpi.revenue_by(e.revenue, *c.split(", ")))
query(
    "kpi_undelivered_backlog",
    "year:l month_num:l orders:l qty_outstanding:d",
    "SELECT year, month_num, count(*) AS orders, sum(qty_outstanding) AS qty_outstanding FROM m_performance "
    "WHERE is_cancel = 0 AND qty_outstanding > 0 GROUP BY year, month_num",
)(lambda e: kpi.undelivered_backlog(e.performance))
query(
    "kpi_pareto_customers",
    "customer_key:l revenue:d cumulative_revenue:d cumulative_pct:d abc_class:s",
    f"""SELECT *, CASE WHEN cumulative_pct <= 80 THEN 'A' WHEN cumulative_pct <= 95 THEN 'B' ELSE 'C' END AS abc_class
        FROM (SELECT customer_key, revenue, cum AS cumulative_revenue, {pct('cum', 'total', 4)} AS cumulative_pct
              FROM (SELECT customer_key, revenue, sum(revenue) OVER (ORDER BY revenue DESC RANGE UNBOUNDED PRECEDING) AS cum,
                      sum(revenue) OVER () AS total
                    FROM (SELECT customer_key, sum(revenue) AS revenue FROM m_revenue GROUP BY customer_key HAVING sum(m_revenue.revenue) > 0))
              UNION ALL SELECT customer_key, sum(revenue), NULL, NULL FROM m_revenue GROUP BY customer_key HAVING NOT coalesce(sum(m_revenue.revenue) > 0, false))""",
)(lambda e: kpi.pareto_customers(e.revenue))

# --- finance ----------------------------------------------------------------------
query(
    "kpi_profit_by_year",
    "year:l revenue:d cogs:d gross_profit:d avg_gp_pct:d total_vat:d cogs_share_pct:d",
    f"""SELECT year, {whole('revenue')} AS revenue, {whole('cogs')} AS cogs, {whole('gross_profit')} AS gross_profit,
          {r(avg('gp_margin_pct'), 2)} AS avg_gp_pct, {whole('total_vat')} AS total_vat,
          {pct('sum(m_profit.cogs)', 'sum(m_profit.revenue)')} AS cogs_share_pct FROM m_profit GROUP BY year""",
)(lambda e: kpi.profit_by_year(e.profit))
query(
    "kpi_credit_status",
    "credit_status:s customers:l outstanding_ar:d total_credit_limit:d avg_utilisation_pct:d",
    f"""SELECT credit_status, count(*) AS customers, {whole('lifetime_revenue')} AS outstanding_ar, {whole('debt_limit')} AS total_credit_limit,
          {r(avg('credit_utilisation_pct'), 2)} AS avg_utilisation_pct FROM m_credit GROUP BY credit_status""",
)(lambda e: kpi.credit_status_mix(e.credit))
query(
    "kpi_top_receivables",
    "customer_code:s customer_name:s outstanding_ar:d debt_limit:d utilisation_pct:d credit_status:s",
    f"""SELECT customer_code, customer_name, {r('lifetime_revenue', 0)} AS outstanding_ar, {r('debt_limit', 0)} AS debt_limit,
          {r('credit_utilisation_pct', 1)} AS utilisation_pct, credit_status
        FROM m_credit WHERE lifetime_revenue > 0 ORDER BY lifetime_revenue DESC, customer_code LIMIT 10""",
)(lambda e: kpi.top_receivables(e.credit))
query(
    "kpi_near_limit",
    "customer_key:l customer_code:s debt_limit:d lifetime_revenue:d credit_utilisation_pct:d credit_headroom:d",
    "SELECT * FROM m_credit WHERE credit_status = 'Near Limit'",
)(lambda e: kpi.near_limit(e.credit))
query(
    "kpi_procurement_overview",
    "unique_suppliers:l unique_products:l total_pos:l total_qty_ordered:d total_actual_cost:d total_price_variance:d date_from:t date_to:t",
    f"""SELECT count(DISTINCT supplier_key) AS unique_suppliers, count(DISTINCT product_key) AS unique_products, sum(po_count) AS total_pos,
          {whole('qty_ordered')} AS total_qty_ordered, {whole('actual_cost')} AS total_actual_cost,
          {whole('price_variance')} AS total_price_variance, min(po_date) AS date_from, max(po_date) AS date_to FROM m_purchase""",
)(lambda e: kpi.procurement_overview(e.purchases))
query(
    "kpi_top_suppliers",
    "supplier_name:s pos:l actual_cost:d price_variance:d",
    f"""SELECT supplier_name, sum(po_count) AS pos, {whole('actual_cost')} AS actual_cost, {whole('price_variance')} AS price_variance
        FROM m_purchase GROUP BY supplier_name ORDER BY sum(m_purchase.actual_cost) DESC, supplier_name LIMIT 10""",
)(lambda e: kpi.top_suppliers(e.purchases))
query(
    "kpi_supplier_concentration",
    "supplier_name:s actual_cost:d price_variance:d spend_share_pct:d",
    f"""SELECT supplier_name, {r('c', 0)} AS actual_cost, {r('v', 0)} AS price_variance, {pct('c', 'total')} AS spend_share_pct
        FROM (SELECT supplier_name, sum(actual_cost) AS c, sum(price_variance) AS v, sum(sum(actual_cost)) OVER () AS total
              FROM m_purchase GROUP BY supplier_name) ORDER BY c DESC, supplier_name LIMIT 3""",
)(lambda e: kpi.supplier_concentration(e.purchases))
query(
    "kpi_purchases_by_month",
    "supplier_key:l supplier_name:s year:l month_num:l actual_cost:d price_variance:d variance_pct:d",
    f"""SELECT supplier_key, supplier_name, year, month_num, sum(actual_cost) AS actual_cost, sum(price_variance) AS price_variance,
          {pct('sum(m_purchase.price_variance)', 'sum(m_purchase.expected_cost)')} AS variance_pct FROM m_purchase GROUP BY ALL""",
)(lambda e: kpi.purchases_by_month(e.purchases))

# --- stock ------------------------------------------------------------------------
query(
    "kpi_stock_overview",
    "lot_count:l unique_products:l unique_warehouses:l total_qty_in_stock:d total_stock_value:d empty_lots:l valued_stock:d valued_lot_pct:d",
    f"""SELECT count(*) AS lot_count, count(DISTINCT product_key) AS unique_products, count(DISTINCT warehouse_key) AS unique_warehouses,
          {whole('quantity_left')} AS total_qty_in_stock, {whole('stock_value')} AS total_stock_value,
          count(*) FILTER (quantity_left = 0) AS empty_lots, {r('sum(stock_value) FILTER (is_valued)', 0)} AS valued_stock,
          {pct('count(*) FILTER (is_valued)', 'count(*)')} AS valued_lot_pct FROM m_snapshot""",
)(lambda e: kpi.stock_overview(e.snapshot))
query(
    "kpi_top_stock_products",
    "product_code:s product_name:s qty_left:d stock_value:d",
    f"""SELECT product_code, product_name, {whole('quantity_left')} AS qty_left, {whole('stock_value')} AS stock_value FROM m_snapshot
        WHERE quantity_left > 0 GROUP BY ALL ORDER BY sum(m_snapshot.stock_value) DESC NULLS LAST, product_code NULLS FIRST LIMIT 10""",
)(lambda e: kpi.top_stock_products(e.snapshot))
query(
    "kpi_stock_by_warehouse",
    "warehouse_name:s products:l qty_left:d stock_value:d",
    f"""SELECT warehouse_name, count(DISTINCT product_key) AS products, {whole('quantity_left')} AS qty_left, {whole('stock_value')} AS stock_value
        FROM m_snapshot WHERE quantity_left > 0 GROUP BY ALL ORDER BY sum(m_snapshot.stock_value) DESC NULLS LAST, warehouse_name LIMIT 10""",
)(lambda e: kpi.stock_by_warehouse(e.snapshot))
query(
    "kpi_movement_overview",
    "movement_type:s rows:l unique_products:l total_qty_in:d total_qty_out:d total_value_in:d total_value_out:d date_from:t date_to:t",
    f"""SELECT movement_type, count(*) AS rows, count(DISTINCT product_key) AS unique_products, {whole('quantity_in')} AS total_qty_in,
          {whole('quantity_out')} AS total_qty_out, {whole('value_in')} AS total_value_in, {whole('value_out')} AS total_value_out,
          min(movement_date) AS date_from, max(movement_date) AS date_to FROM m_moves GROUP BY movement_type""",
)(lambda e: kpi.movement_overview(e.moves))
query(
    "kpi_movement_by_year",
    "year:l movement_type:s qty_in:d qty_out:d net_movement:d",
    f"""SELECT year, movement_type, {whole('quantity_in')} AS qty_in, {whole('quantity_out')} AS qty_out, {whole('net_movement')} AS net_movement
        FROM m_moves WHERE year IS NOT NULL GROUP BY year, movement_type""",
)(lambda e: kpi.movement_by_year(e.moves))
query(
    "kpi_movement_month_to_date",
    "movement_type:s quantity_in:d quantity_out:d",
    f"""SELECT movement_type, sum(quantity_in) AS quantity_in, sum(quantity_out) AS quantity_out FROM m_moves
        WHERE movement_date >= date_trunc('month', {AS_OF}) AND movement_date <= {AS_OF} GROUP BY movement_type""",
)(lambda e: kpi.movement_month_to_date(e.moves, DAY))
query(
    "kpi_dead_stock",
    "warehouse_key:l item_type:s lots:l dead_qty:d dead_value:d",
    f"""SELECT warehouse_key, item_type, count(*) AS lots, sum(quantity_left) AS dead_qty, sum(stock_value) AS dead_value FROM m_snapshot
        WHERE {AS_OF} - strptime(cast(import_date_key as varchar), '%Y%m%d')::date > 180 AND quantity_left > 0 GROUP BY ALL""",
)(lambda e: kpi.dead_stock(e.snapshot, DAY))
query(
    "kpi_expired_lots",
    "stock_id:s item_type:s item_code:s warehouse_key:l lot_code:s date_sd:t quantity_left:d stock_value:d",
    f"SELECT * FROM m_snapshot WHERE date_sd < {AS_OF} AND quantity_left > 0",
)(lambda e: kpi.expired_lots(e.snapshot, DAY))
query(
    "kpi_price_source_share",
    "item_type:s price_source:s lots:l qty_left:d stock_value:d lot_share_pct:d",
    f"""SELECT item_type, price_source, count(*) AS lots, {whole('quantity_left')} AS qty_left, {whole('stock_value')} AS stock_value,
          {pct('count(*)', 'sum(count(*)) OVER (PARTITION BY item_type)')} AS lot_share_pct FROM m_snapshot GROUP BY item_type, price_source""",
)(lambda e: kpi.price_source_share(e.snapshot))
query(
    "kpi_month_stock_by_type",
    "month_end:t item_type:s qty:d value:d",
    "SELECT month_end, item_type, sum(est_qty_end_month) AS qty, sum(est_value_end_month) FILTER (is_valued) AS value FROM m_monthly GROUP BY ALL",
)(lambda e: kpi.month_stock_by_type(e.monthly))
part(
    "k_item_moves",
    f"""SELECT item_type, item, qty FROM (
          SELECT type_items AS item_type, CASE type_items WHEN 'nvl' THEN material_key ELSE product_key END AS item, coalesce(quantity, 0) AS qty,
            strptime(cast(export_date_key as varchar), '%Y%m%d')::date AS d, coalesce(nullif(trim(type_export), ''), 'UNKNOWN') AS sub FROM r_exports)
        WHERE sub <> '17' AND d >= date_trunc('month', {AS_OF}) - interval 12 month AND d < date_trunc('month', {AS_OF})""",
)
query(
    "kpi_inventory_turnover",
    "item_type:s cogs_vnd_12m:d avg_inventory_vnd:d inventory_turnover:d days_on_hand:d qty_consumed:d avg_stock_qty:d",
    f"""SELECT CASE item_type WHEN 'nvl' THEN 'NVL' ELSE 'Product (qty basis)' END AS item_type,
          CASE item_type WHEN 'nvl' THEN cost END AS cogs_vnd_12m, CASE item_type WHEN 'nvl' THEN av END AS avg_inventory_vnd,
          {r('t', 2)} AS inventory_turnover, {r(div('365', 't'), 0)} AS days_on_hand, used AS qty_consumed,
          CASE item_type WHEN 'product' THEN aq END AS avg_stock_qty
        FROM (SELECT *, CASE item_type WHEN 'nvl' THEN {div('cost', 'av')} ELSE {div('used', 'aq')} END AS t
              FROM (SELECT item_type, {r("sum(cast(cast(qty as double) * cast(p4 as double) as decimal(28,4)))", 0)} AS cost, {whole('qty')} AS used
                    FROM k_item_moves LEFT JOIN (SELECT item_type, coalesce(product_key, material_key) AS item, {r(div('sum(stock_value)', 'sum(quantity_left)'), 4)} AS p4
                       FROM m_snapshot WHERE item_type <> 'UNKNOWN' AND quantity_left > 0 AND stock_value IS NOT NULL GROUP BY ALL) USING (item_type, item)
                    GROUP BY item_type)
              JOIN (SELECT item_type, {r(avg('q'), 0)} AS aq, {r(avg('v'), 0)} AS av
                    FROM (SELECT item_type, month_end, sum(est_qty_end_month) AS q, sum(est_value_end_month) AS v FROM m_monthly
                          WHERE month_end >= date_trunc('month', {AS_OF}) - interval 12 month AND month_end < date_trunc('month', {AS_OF}) GROUP BY ALL)
                    GROUP BY item_type) USING (item_type))""",
)(
    lambda e: kpi.inventory_turnover(
        inventory.item_movements(e.lots, e.exports, e.dates), e.monthly, e.snapshot, DAY
    )
)
query(
    "kpi_unit_turnover",
    "quantity_out:d avg_inventory_qty:d inventory_turnover:d days_on_hand:d",
    f"""SELECT o AS quantity_out, {r('lvl', 2)} AS avg_inventory_qty, {r(f"coalesce({div('o', 'lvl')}, 0)", 4)} AS inventory_turnover,
          {r(f"coalesce({div('lvl * n', 'o')}, 0)", 2)} AS days_on_hand
        FROM (SELECT sum(quantity_out) AS o FROM m_moves),
             (SELECT {avg('q')} AS lvl FROM (SELECT month_end, sum(est_qty_end_month) AS q FROM m_monthly GROUP BY 1)),
             (SELECT count(*) AS n FROM r_dates)""",
)(lambda e: kpi.unit_turnover(e.moves, e.monthly, e.dates))

# --- production ---------------------------------------------------------------------
query(
    "kpi_production_overview",
    "orders:l unique_products:l total_planned:d total_produced:d avg_efficiency_pct:d total_hours_logged:d avg_output_per_hour:d",
    f"""SELECT count(DISTINCT productions_orders_id) AS orders, count(DISTINCT product_key) AS unique_products, {whole('qty_planned')} AS total_planned,
          {whole('qty_produced')} AS total_produced, {r(avg('efficiency_pct'), 2)} AS avg_efficiency_pct, {whole('total_hours')} AS total_hours_logged,
          {r(avg('output_per_hour'), 4)} AS avg_output_per_hour FROM m_efficiency WHERE qty_planned > 0""",
)(lambda e: kpi.production_overview(e.efficiency))
query(
    "kpi_low_efficiency_orders",
    "productions_orders_id:l qty_planned:d qty_produced:d efficiency_pct:d",
    f"""SELECT * FROM (SELECT productions_orders_id, max(p) AS qty_planned, sum(m) AS qty_produced, {pct('sum(m)', 'max(p)')} AS efficiency_pct
          FROM (SELECT productions_orders_id, stage_date_key, max(qty_planned) AS p, max(qty_produced) AS m FROM m_efficiency GROUP BY ALL)
          GROUP BY productions_orders_id) WHERE efficiency_pct < 80""",
)(lambda e: kpi.low_efficiency_orders(e.efficiency))
query(
    "kpi_labour_productivity",
    "productions_orders_id:l stage_date_key:l total_hours:d total_workers:d qty_produced:d hours_per_worker:d output_per_hour:d",
    f"""SELECT *, {r(div('total_hours', 'total_workers'), 4)} AS hours_per_worker, {r(div('qty_produced', 'total_hours'), 4)} AS output_per_hour
        FROM (SELECT productions_orders_id, stage_date_key, max(total_hours) AS total_hours, max(total_workers) AS total_workers,
                max(qty_produced) AS qty_produced FROM m_efficiency WHERE stage_date_key IS NOT NULL GROUP BY ALL)""",
)(lambda e: kpi.labour_productivity(e.efficiency))

# --- material cost --------------------------------------------------------------------
REG = "npl_quality = 'normal' AND NOT is_sample_order"


def _w(cond: str = "true") -> str:
    return pct(f"sum(allocated_npl_materials_vnd) FILTER ({cond})", f"sum(revenue_vnd) FILTER ({cond})")


def _bn(x: str, cond: str = "true") -> str:
    return r(f"cast(sum({x}) FILTER ({cond}) as double) / 1e9", 2)


query(
    "kpi_cost_overview",
    "total_orders:l orders_year:l normal_year:l high_cost_year:l suspect_year:l sample_year:l regular_normal:l total_rev_bn:d total_npl_bn:d weighted_npl_pct:d weighted_npl_pct_all:d",
    f"""SELECT count(*) AS total_orders, count(*) FILTER (year = {YEAR}) AS orders_year,
          count(*) FILTER (year = {YEAR} AND npl_quality = 'normal') AS normal_year, count(*) FILTER (year = {YEAR} AND npl_quality = 'high_cost') AS high_cost_year,
          count(*) FILTER (year = {YEAR} AND npl_quality = 'suspect_data') AS suspect_year, count(*) FILTER (year = {YEAR} AND is_sample_order) AS sample_year,
          count(*) FILTER (year = {YEAR} AND {REG}) AS regular_normal, {_bn('revenue_vnd', f'year = {YEAR}')} AS total_rev_bn,
          {_bn('allocated_npl_materials_vnd', f'year = {YEAR}')} AS total_npl_bn, {_w(f'year = {YEAR} AND {REG}')} AS weighted_npl_pct,
          {_w(f'year = {YEAR}')} AS weighted_npl_pct_all FROM m_order_cost""",
)(lambda e: kpi.cost_overview(e.order_cost, YEAR))
query(
    "kpi_cost_quality",
    "npl_quality:s orders:l avg_npl_pct:d median_npl_pct:d rev_bn:d npl_bn:d weighted_pct:d",
    f"""SELECT npl_quality, count(*) AS orders, {r(avg('npl_materials_pct'), 1)} AS avg_npl_pct,
          {r('quantile_cont(cast(npl_materials_pct as double), 0.5)', 1)} AS median_npl_pct, {_bn('revenue_vnd')} AS rev_bn,
          {_bn('allocated_npl_materials_vnd')} AS npl_bn, {_w()} AS weighted_pct FROM m_order_cost WHERE year = {YEAR} GROUP BY npl_quality""",
)(lambda e: kpi.cost_quality_mix(e.order_cost, YEAR))
query(
    "kpi_regular_cost_percentiles",
    "orders:l avg_pct:d p10:d p25:d p50:d p75:d p90:d weighted_avg_pct:d in_target_range:l in_target_pct:d",
    f"""SELECT count(*) AS orders, {r(avg('npl_materials_pct'), 2)} AS avg_pct, """
    + ", ".join(f"{r(f'quantile_cont(cast(npl_materials_pct as double), 0.{p})', 1)} AS p{p}" for p in (10, 25, 50, 75, 90))
    + f""", {_w()} AS weighted_avg_pct, count(*) FILTER (npl_materials_pct BETWEEN 20 AND 35) AS in_target_range,
          {pct('count(*) FILTER (npl_materials_pct BETWEEN 20 AND 35)', 'count(*)')} AS in_target_pct
        FROM m_order_cost WHERE year = {YEAR} AND {REG}""",
)(lambda e: kpi.regular_cost_percentiles(e.order_cost, YEAR))
query(
    "kpi_cost_by_month",
    "month:l normal_orders:l other_orders:l weighted_npl_pct_normal:d",
    f"""SELECT month, count(*) FILTER (npl_quality = 'normal') AS normal_orders, count(*) FILTER (npl_quality <> 'normal') AS other_orders,
          {_w("npl_quality = 'normal'")} AS weighted_npl_pct_normal FROM m_order_cost WHERE year = {YEAR} GROUP BY month""",
)(lambda e: kpi.cost_by_month(e.order_cost, YEAR))


@query(
    "kpi_cost_against_expected",
    "order_id:l npl_materials_pct:d expected_pct:d npl_quality:s is_sample_order:b difference:d",
    f"""SELECT order_id, npl_materials_pct, e.expected_pct, npl_quality, is_sample_order,
          {r('cast(npl_materials_pct as double) - cast(e.expected_pct as double)', 1)} AS difference
        FROM m_order_cost JOIN (SELECT order_id, {pct('total_cost', 'grand_total')} AS expected_pct FROM r_orders) e USING (order_id)""",
)
def _expected(e: Erp):
    # the cost share recorded on the order is the expectation
    recorded = e.orders.select("order_id", pct_col("total_cost", "grand_total").alias("expected_pct"))
    return kpi.compare_with_expected(e.order_cost, recorded)


query(
    "kpi_top_suspects",
    "order_id:l order_reference_no:s revenue_vnd:d allocated_npl_materials_vnd:d npl_materials_pct:d total_quantity:d linked_plan_count:l total_bom_items:l",
    f"""SELECT * FROM m_order_cost WHERE year = {YEAR} AND npl_quality = 'suspect_data'
        ORDER BY allocated_npl_materials_vnd DESC, order_id LIMIT 15""",
)(lambda e: kpi.top_suspects(e.order_cost, YEAR))

# --- key coverage -----------------------------------------------------------------------
query(
    "kpi_key_match_rates",
    "type_items:s total:l match_material:l match_product:l",
    """SELECT type_items, count(*) AS total, count(m.material_key) AS match_material, count(p.product_key) AS match_product
       FROM r_lots l LEFT JOIN r_products p ON p.product_key = l.product_key LEFT JOIN r_materials m ON m.material_key = l.material_key
       GROUP BY type_items""",
)(lambda e: kpi.key_match_rates(e.lots, e.products, e.materials))
query(
    "kpi_purchase_match_rates",
    "lines:l matched:l priced:l matched_pct:d priced_pct:d",
    f"""SELECT *, {pct('matched', 'lines', 1)} AS matched_pct, {pct('priced', 'lines', 1)} AS priced_pct
        FROM (SELECT count(*) AS lines, count(m.material_key) AS matched, count(*) FILTER (price_suppliers > 0) AS priced
              FROM r_po_lines l LEFT JOIN r_materials m ON m.material_key = l.material_key)""",
)(lambda e: kpi.purchase_match_rates(e.po_lines, e.materials))
