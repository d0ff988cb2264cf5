"""Production marts: efficiency, production against sales, material cost and its allocation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.functions.expr import first_match, pct, ratio, rounded, zero_if_null
from erpspark.operators.lookup import decorate, lookup, with_dates
from erpspark.plans.shared import is_paper
from erpspark.session import written
from erpspark.settings import COST_HIGH, COST_SUSPECT, SAMPLE_QTY, SAMPLE_REVENUE, ZINC_ITEM_CODE, ZINC_ITEM_NAME

PRODUCT_COLS = ["product_code", "product_name", "type_products", "brand"]


def production_efficiency(items: DataFrame, stages: DataFrame, products: DataFrame, dates: DataFrame) -> DataFrame:
    """Production order items against the stage work of their order, per stage date.

    Stage totals belong to the order, so they repeat on every item of it.
    """
    work = (
        stages.filter(F.col("active") == 1)
        .groupBy("productions_orders_id", "stage_date_key")
        .agg(
            F.sum("number").alias("total_workers"),
            F.count_distinct("staff_key").alias("distinct_workers"),
            F.sum("number_hours").alias("total_hours"),
            F.sum("total_time").alias("total_time"),
            F.sum("number_face").alias("qty_produced"),
            F.sum("number_operations").alias("total_operations"),
        )
    )
    out = items.withColumnRenamed("quantity", "qty_planned").join(work, "productions_orders_id", "left")
    for c in "total_workers distinct_workers total_hours total_time qty_produced total_operations".split():
        out = out.withColumn(c, zero_if_null(c))
    out = with_dates(
        out, dates, "prod_date_key", {"full_date": "prod_date", **{c: c for c in "year quarter month_num month_name".split()}}
    )
    out = with_dates(out, dates, "stage_date_key", {"full_date": "stage_date"})
    return (
        decorate(out, products, "product_key", PRODUCT_COLS)
        .withColumn("efficiency_pct", pct("qty_produced", "qty_planned"))
        .withColumn("output_per_hour", rounded(ratio("qty_produced", "total_hours"), 4))
    )


def production_sales(
    stages: DataFrame,
    items: DataFrame,
    deliveries: DataFrame,
    levels: DataFrame,
    products: DataFrame,
    dates: DataFrame,
    start: date,
    as_of: date,
) -> DataFrame:
    """Produced against delivered quantity per day and product with activity.

    The two sides meet in a full outer join of their daily sums; the day range and
    the product master then limit the rows, so no calendar scaffold is needed.
    ``levels`` are the steps of ``inventory.product_levels``; each day takes the last one up to it.
    """
    made = (
        stages.filter(F.col("active") == 1)
        .join(
            items.select(F.col("prod_item_id").alias("productions_orders_items_id"), "product_key"),
            "productions_orders_items_id",
        )
        .groupBy(F.col("stage_date_key").alias("date_key"), "product_key")
        .agg(F.sum("number_face").alias("made"), F.count_distinct("productions_orders_id").alias("prod_order_count"))
    )
    sold = deliveries.groupBy(F.col("delivery_date_key").alias("date_key"), "product_key").agg(
        F.sum("quantity").alias("sold"), F.count_distinct("delivery_id").alias("delivery_count")
    )
    days = dates.filter((F.col("full_date") >= F.lit(start)) & (F.col("full_date") <= F.lit(as_of)))
    both = (
        made.join(sold, ["date_key", "product_key"], "full")
        .filter((F.col("made") > 0) | (F.col("sold") > 0))
        .withColumn("qty_produced", zero_if_null("made"))
        .withColumn("qty_sold", zero_if_null("sold"))
    )
    both = with_dates(both, days, "date_key", ["full_date", "year", "month_num", "month_name"]).filter(
        F.col("full_date").isNotNull()
    )
    both = both.join(products.select("product_key", *PRODUCT_COLS), "product_key")
    # one row per day and product: a year of rows is the frame
    year = Window.partitionBy("product_key").orderBy("date_key").rowsBetween(-364, 0)
    rows = both.withColumn("rolling_12m_sales", F.sum("qty_sold").over(year)).withColumns({"__at": F.col("full_date"), "__day": F.lit(True)})
    steps = levels.select("product_key", F.col("month").alias("__at"), "level", F.lit(False).alias("__day"))
    # a step comes before the first day that it holds for
    until = Window.partitionBy("product_key").orderBy("__at", "__day").rowsBetween(Window.unboundedPreceding, 0)
    out = (
        rows.unionByName(steps, allowMissingColumns=True)
        .withColumn("avg_stock_level", F.last("level", ignorenulls=True).over(until)["avg"])
        .filter("__day")
    )
    turnover = F.when(
        F.col("avg_stock_level") > 0, rounded(ratio("rolling_12m_sales", "avg_stock_level"), 2)
    )
    return (
        out.withColumn("production_sales_variance", F.col("qty_produced") - F.col("qty_sold"))
        .withColumn("inventory_turnover", turnover)
        .drop("made", "sold", "level", "__at", "__day")
    )


# --- material cost ----------------------------------------------------------


def latest_purchase_price(po_lines: DataFrame, po_heads: DataFrame) -> DataFrame:
    """Effective unit price of the newest valid purchase line per item (ties: highest line id)."""
    valid = po_lines.filter(
        (F.col("price_suppliers") > 0) & (F.col("quantity_unit") > 0) & (F.col("total_suppliers") > 0)
    ).select("id", "id_purchase_order", "product_id", ratio("total_suppliers", "quantity_unit").alias("price"))
    newest = (
        valid.join(po_heads.select(F.col("id").alias("id_purchase_order"), F.to_date("date").alias("po_day")), "id_purchase_order")
        .groupBy("product_id")
        .agg(
            F.max_by(
                F.struct("price", "po_day"),
                # newest date first; undated lines count as newest
                F.struct(F.coalesce("po_day", F.lit(date(9999, 12, 31))), "id"),
            ).alias("line")
        )
    )
    return newest.select(
        "product_id",
        rounded("line.price", 4).alias("unit_price_vnd"),
        F.col("line.po_day").alias("last_po_date"),
    )


def _items(products: DataFrame, materials: DataFrame, prices: DataFrame) -> DataFrame:
    """What the masters and the purchases know of an item: the three lookups share one key and are merged, to be probed once."""
    return (
        products.select(
            F.col("product_id").alias("npl_product_id"), F.lit(True).alias("material_matched"),
            F.col("product_name").alias("product_master_name"), F.col("product_code").alias("product_master_code"),
        )
        .join(
            materials.select(
                F.col("material_id").alias("npl_product_id"), "material_key",
                F.col("material_name").alias("__m_name"), F.col("material_code").alias("__m_code"),
            ),
            "npl_product_id", "full",
        )
        .join(prices.withColumnRenamed("product_id", "npl_product_id"), "npl_product_id", "full")
    )


def production_cost(
    bom: DataFrame,
    plan_items: DataFrame,
    plans: DataFrame,
    po_lines: DataFrame,
    po_heads: DataFrame,
    products: DataFrame,
    materials: DataFrame,
    dates: DataFrame,
    zinc_item_id: int,
) -> DataFrame:
    """Cost of every material line of the production plans.

    Plan items without a zinc plate get one plate added. The material id is looked
    up in both the product and the material master, as the source does not tell
    the two apart here.
    """
    planned = plan_items.filter(F.col("quantity_total_details") > 0).select(
        F.col("id").alias("productions_plan_items_id"), "productions_plan_id",
        F.col("product_id").alias("finished_product_id"), F.col("quantity_total_details").alias("finished_qty_planned"),
    )
    heads = plans.select(
        F.col("id").alias("productions_plan_id"), F.to_date("date").alias("plan_date"),
        F.col("options1_id").alias("source_order_ids"), F.col("status").alias("plan_status"),
    )
    material_lines = bom.filter(F.col("item_type") == "materials")
    own_lines = (
        material_lines.filter((F.col("item_id") > 0) & (F.col("quantity") > 0))
        .select(
            F.col("id").alias("bom_line_id"), "productions_plan_id", "productions_plan_items_id", F.col("item_id").alias("npl_product_id"),
            F.col("item_code").alias("npl_code"), F.col("item_name").alias("npl_name"), "unit_id",
            F.col("quantity_single").alias("qty_single"), F.col("quantity").alias("qty_bom"),
            zero_if_null("quantity_compensation").alias("qty_compensation"),
            F.nullif(F.col("number_children_size"), F.lit(0)).alias("number_children_size"),
            zero_if_null("is_zinc").cast("int").alias("is_zinc"),
        )
    )
    # Lines meet the items before they meet their plans: added plates share one item, which is looked up by itself, and the
    # result lies by plan, as the sums over a plan need it.
    # The items are written, so that the shuffles of the purchase lines are gone when the lines of the plans travel.
    known = written(_items(products, materials, latest_purchase_price(po_lines, po_heads)), "items")
    own_lines = lookup(own_lines, known, "npl_product_id").withColumn("__own", F.lit(True))
    with_zinc = (
        material_lines.filter((F.col("is_zinc") == 1) & F.col("productions_plan_items_id").isNotNull())
        .select("productions_plan_items_id").distinct().withColumn("__zinc", F.lit(True))
    )
    # a plan item gives one row for its own lines and, without a plate among them, one for the plate to add
    wanted = planned.withColumnRenamed("productions_plan_id", "__plan").join(with_zinc, "productions_plan_items_id", "left").withColumn(
        "is_zinc_injected", F.explode(F.when(F.col("__zinc"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True))))
    )
    own_lines = own_lines.withColumnRenamed("productions_plan_items_id", "__item")
    added = F.col("is_zinc_injected")
    lines = wanted.join(
        own_lines, (F.col("productions_plan_items_id") == F.col("__item")) & ~added, "left"
    ).filter(added | F.col("__own"))
    one, zinc = F.lit(1).cast("decimal(22,4)"), F.lit(zinc_item_id).cast("bigint")
    plate = known.filter(F.col("npl_product_id") == zinc)
    attributes = [c for c in plate.columns if c != "npl_product_id"]
    # one item
    plate = F.broadcast(plate.select(*[F.col(c).alias(f"__z_{c}") for c in plate.columns]))
    of_plate = {
        "productions_plan_id": F.col("__plan"),
        "npl_product_id": zinc,
        "npl_code": F.lit(ZINC_ITEM_CODE), "npl_name": F.lit(ZINC_ITEM_NAME),
        "qty_single": one, "qty_bom": one, "qty_compensation": F.lit(0).cast("decimal(22,4)"),
        "is_zinc": F.lit(1),
        **{c: F.col(f"__z_{c}") for c in attributes},
    }
    out = (
        lines.join(plate, added & (F.col("__z_npl_product_id") == zinc), "left")
        .withColumns({c: F.when(added, value).otherwise(F.col(c)) for c, value in of_plate.items()})
        .drop("__plan", "__zinc", "__item", "__own", "__z_npl_product_id", *[f"__z_{c}" for c in attributes])
    )
    qty, waste = F.col("qty_bom"), F.col("qty_compensation")
    # converted once per row, used by every cost column
    out = out.withColumns(
        {
            "__price": zero_if_null("unit_price_vnd").cast("double"),
            "__qty": qty.cast("double"),
            "__waste": waste.cast("double"),
            "__total": (qty + waste).cast("double"),
            "qty_per_sp": F.when(F.col("is_zinc") == 1, ratio(qty, "finished_qty_planned")).otherwise(
                ratio("qty_single", "number_children_size")
            ),
        }
    )

    def cost(q: str) -> Column:
        return rounded(F.col(q) * F.col("__price"), 0).cast("decimal(18,0)")

    calendar = dates.select(F.col("full_date").alias("__day"), "year", F.col("month_num").alias("month"), "quarter")
    return (
        out.withColumn("qty_total", qty + waste)
        .withColumn("material_matched", F.coalesce("material_matched", F.lit(False)))
        .withColumn("has_price", F.col("unit_price_vnd").isNotNull())
        .withColumn("npl_name_resolved", F.coalesce("__m_name", "npl_name"))
        .withColumn("npl_code_resolved", F.coalesce("__m_code", "npl_code"))
        .withColumn("is_giay", is_paper(F.col("npl_name")))
        .withColumn("npl_cost_vnd", cost("__qty"))
        .withColumn("npl_cost_with_waste_vnd", cost("__total"))
        .withColumn("waste_cost_per_order_vnd", cost("__waste"))
        .withColumn("waste_cost_vnd", F.col("npl_cost_with_waste_vnd") - F.col("npl_cost_vnd"))
        .withColumn("npl_cost_per_sp_vnd", rounded(F.col("qty_per_sp") * F.col("__price"), 4))
        .join(heads, "productions_plan_id")
        # calendar: bounded, one row per day
        .join(F.broadcast(calendar), F.col("plan_date") == F.col("__day"), "left")
        .drop("__day", "__m_name", "__m_code", "__price", "__qty", "__waste", "__total")
    )


def _in_vnd(fx: dict) -> Column:
    rate = F.lit("1.0").cast("decimal(9,1)")
    for code, value in fx.items():
        rate = F.when(F.col("currencies") == code, F.lit(value).cast("decimal(9,1)")).otherwise(rate)
    return F.col("grand_total") * rate


def order_product_lines(orders: DataFrame, items: DataFrame, products: DataFrame, fx: dict) -> DataFrame:
    """Quantity per order and finished product, with the order total in VND."""
    head = orders.filter(F.col("is_cancel") == 0).select("order_id", _in_vnd(fx).alias("revenue_vnd"))
    # products first, so that the lines come to their orders only once; a key that is listed twice gives two rows
    names = products.groupBy("product_key", F.col("product_id").alias("finished_product_id")).agg(F.count(F.lit(1)).alias("__times"))
    per_product = (
        items.select("order_id", "product_key", "quantity").join(names, "product_key").repartition("order_id")
        .groupBy("order_id", "product_key", "finished_product_id", "__times")
        .agg(F.sum("quantity").alias("product_qty"))
        .withColumn("__one", F.explode(F.sequence(F.lit(1).cast("bigint"), "__times")))
    )
    return per_product.drop("product_key", "__times", "__one").join(head, "order_id")


def allocate_to_orders(plan_cost: DataFrame, order_lines: DataFrame, plans: DataFrame | None = None) -> DataFrame:
    """Share plan costs out to the listed orders: by quantity, else revenue, else equally.

    Costs stay with their plan, and the lines of the listed orders are brought there. ``plans`` are the plans with their
    lists (``productions_plan_id``, ``source_order_ids``), which spare a second pass over the costs.
    """
    listed = F.col("source_order_ids").isNotNull() & (F.col("source_order_ids") != "")
    # plan totals are looked up by product, so lines without one take no part
    per_plan = (
        plan_cost.filter(listed & F.col("finished_product_id").isNotNull())
        .groupBy("productions_plan_id", "source_order_ids", "finished_product_id")
        .agg(
            F.count_distinct("productions_plan_items_id").alias("bom_item_count"),
            # shares are taken in double
            F.sum("npl_cost_vnd").cast("double").alias("materials"),
            F.sum("waste_cost_per_order_vnd").cast("double").alias("waste"),
            F.sum("npl_cost_with_waste_vnd").cast("double").alias("total"),
            F.count_if(~F.col("has_price")).alias("items_without_price"),
        )
    )
    # empty entries are skipped; an entry that is no number stops the build, as its cost would go to other orders
    entry = F.trim("__id")
    fault = F.raise_error(F.concat(F.lit("not an order id: "), entry)).cast("bigint")
    pairs = (
        per_plan.withColumn("__id", F.explode(F.split("source_order_ids", ",")))
        .filter(entry != "")
        .withColumn("order_id", F.coalesce(entry.try_cast("bigint"), fault))
        .drop("__id")
    )
    lists = (plan_cost if plans is None else plans).filter(listed).select(
        "productions_plan_id", F.explode(F.split("source_order_ids", ",")).alias("__id")
    )
    wanted = lists.select("productions_plan_id", entry.try_cast("bigint").alias("order_id")).repartition("order_id").distinct()
    arrived = order_lines.join(wanted, "order_id").repartition("productions_plan_id").withColumn("__met", F.lit(True))
    joined = pairs.join(arrived, ["productions_plan_id", "order_id", "finished_product_id"], "left")
    # a plan and product own one list, so these groups are as long as one list cell
    plan = Window.partitionBy("productions_plan_id", "finished_product_id")
    joined = (
        joined.withColumn("plan_qty", F.sum("product_qty").over(plan))
        .withColumn("plan_revenue", F.sum("revenue_vnd").over(plan))
        .withColumn("plan_order_count", F.count(F.lit(1)).over(plan))
    )
    share = first_match(
        [
            (F.col("plan_qty") > 0, ratio("product_qty", "plan_qty")),
            (F.col("plan_revenue") > 0, ratio("revenue_vnd", "plan_revenue")),
        ],
        ratio(F.lit(1), "plan_order_count"),
    )
    return joined.withColumn("alloc_ratio", share)


def order_cost(
    plan_cost: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, fx: dict, plans: DataFrame | None = None
) -> DataFrame:
    """Material cost per sales order with its share of revenue and a quality label (``plans`` as for ``allocate_to_orders``)."""
    shares = allocate_to_orders(plan_cost, order_product_lines(orders, items, products, fx), plans)

    def allocated(c: str) -> Column:
        # decimal terms: the sum does not depend on the order of rows
        part = F.col("alloc_ratio") * F.col(c).cast("double")
        return F.round(F.sum(part.cast("decimal(28,8)")), 0)

    per_order = shares.groupBy("order_id").agg(
        allocated("materials").alias("allocated_npl_materials_vnd"),
        allocated("waste").alias("allocated_npl_waste_vnd"),
        allocated("total").alias("allocated_npl_total_vnd"),
        F.count_distinct("productions_plan_id").alias("linked_plan_count"),
        F.max("__met").alias("__met"),
        F.sum("bom_item_count").alias("total_bom_items"),
        F.sum("items_without_price").alias("total_items_without_price"),
    )
    # what only depends on the order joins the sums, not their terms; orders without a matching line have none of it
    live = F.col("is_cancel") == 0
    values = {"revenue_vnd": _in_vnd(fx), **{c: F.col(c) for c in "total_quantity status status_payment is_end currencies grand_total".split()}}
    known = orders.groupBy("order_id").agg(*[F.max(F.when(live, v)).alias(c) for c, v in values.items()]).withColumn("__met", F.lit(True))
    per_order = per_order.join(known, ["order_id", "__met"], "left").drop("__met")
    head = orders.select(
        "order_id", F.col("reference_no").alias("order_reference_no"), F.to_date("date_created").alias("order_date")
    )
    day, rev, mat = F.col("order_date"), F.col("revenue_vnd"), F.col("allocated_npl_materials_vnd")
    burden = ratio(mat, rev)
    return (
        per_order.join(head, "order_id")
        .withColumnRenamed("grand_total", "grand_total_original")
        .withColumn("year", F.year(day))
        .withColumn("month", F.month(day))
        .withColumn("quarter", F.quarter(day))
        .withColumn("npl_materials_pct", F.when(rev > 0, pct(mat, rev)))
        .withColumn("npl_total_pct", F.when(rev > 0, pct("allocated_npl_total_vnd", rev)))
        .withColumn(
            "npl_quality",
            first_match(
                [
                    (rev.isNull() | (rev <= 0), "no_revenue"),
                    (burden > COST_SUSPECT, "suspect_data"),
                    (burden > COST_HIGH, "high_cost"),
                ],
                "normal",
            ),
        )
        .withColumn(
            "is_sample_order",
            F.coalesce((F.col("total_quantity") < SAMPLE_QTY) | (rev < SAMPLE_REVENUE), F.lit(False)),
        )
    )
