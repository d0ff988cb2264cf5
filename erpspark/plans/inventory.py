"""Stock marts: lot valuation, movements, month-end stock by backward projection."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from erpspark.functions.expr import first_match, key_to_date, month_start, ratio, rounded, trimmed_or, zero_if_null
from erpspark.operators.lookup import decorate, lookup, with_dates
from erpspark.settings import PRICE_CAP, UNCAPPED_CODE_PREFIX


def latest_po_price(po_lines: DataFrame, key: str, name: str) -> DataFrame:
    """Supplier price of the newest priced purchase line per item (ties: highest line id)."""
    return (
        po_lines.filter((F.col("price_suppliers") > 0) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max_by("price_suppliers", F.struct("po_date_key", "po_item_id")).alias(name))
    )


def item_type(product: Column, material: Column) -> Column:
    return first_match([(product.isNotNull(), "product"), (material.isNotNull(), "nvl")], "UNKNOWN")


def _valuation(df: DataFrame) -> DataFrame:
    """Unit price ladder: lot price, purchase price of the item, master price.

    Each rung is a column of its own, so the decimals are converted once per row.
    """
    df = df.withColumns(
        {
            "__lot": F.nullif(ratio("price", "quantity"), F.lit(0.0)),
            "__master": F.col("price_import").cast("double"),
            "__left": F.col("quantity_left").cast("double"),
            "__priced": F.coalesce(F.col("price") > 0, F.lit(False)),
        }
    )
    lot, po, npl, master = F.col("__lot"), F.col("po_price"), F.col("npl_price"), F.col("__master")
    ladder = F.coalesce(lot, po, npl, master)
    without_npl = F.coalesce(lot, po, master)
    has_lot_price = F.col("__priced")
    kind = F.col("type_items")
    capped = first_match(
        [
            (ladder.isNull(), F.lit(None).cast("double")),
            (kind == "nvl", F.coalesce(lot, npl)),
            (F.col("product_code").startswith(UNCAPPED_CODE_PREFIX), without_npl),
        ],
        # least ignores NULL, so a price known only from the material side gives the cap
        F.least(without_npl, F.lit(float(PRICE_CAP))),
    )
    df = df.withColumn("__capped", capped)
    finished = F.col("type_products").isin("products", "semi_products")
    return (
        df.withColumn("lot_price", F.col("price"))
        .withColumn("po_fallback_price", F.coalesce(po, npl))
        .withColumn("unit_price", rounded(ladder, 2))
        .withColumn("unit_price_capped", rounded("__capped", 2))
        .withColumn("stock_value", rounded(F.col("__left") * F.col("__capped"), 2).cast("decimal(28,2)"))
        .withColumn("is_valued", has_lot_price)
        .withColumn(
            "price_source",
            first_match(
                [(has_lot_price, "lot_price"), (po.isNotNull(), "po_fallback"), (npl.isNotNull(), "npl_po_fallback")],
                "no_price",
            ),
        )
        .withColumn(
            "value_note",
            first_match(
                [
                    (has_lot_price, "lot_price"),
                    (npl.isNotNull() & (kind == "nvl"), "npl_po_fallback"),
                    (po.isNotNull() & finished, "po_fallback_outsourced"),
                    (po.isNotNull(), "po_fallback_material"),
                    (master > 0, "product_master_fallback"),
                ],
                "unpriced_no_eln_receipt",
            ),
        )
        .drop("price", "po_price", "npl_price", "price_import", "__lot", "__master", "__left", "__priced", "__capped")
    )


def stock_snapshot(
    lots: DataFrame, po_lines: DataFrame, products: DataFrame, materials: DataFrame, warehouses: DataFrame
) -> DataFrame:
    """One row per stock lot with item, warehouse and value.

    Product attributes and prices are merged per item before the lots are
    touched, so each lot meets one lookup per key.
    """
    product_side = products.select(
        "product_key", "product_code", "product_name", "type_products", "brand",
        F.col("unit_id").alias("__p_unit"), "price_import",
    ).join(latest_po_price(po_lines, "product_key", "po_price"), "product_key", "full")
    material_side = materials.select(
        "material_key", "material_code", "material_name", F.col("unit_id").alias("__m_unit")
    ).join(latest_po_price(po_lines, "material_key", "npl_price"), "material_key", "full")
    out = lookup(lots, product_side, "product_key")
    out = lookup(out, material_side, "material_key")
    out = decorate(out, warehouses, "warehouse_key", ["warehouse_code", "warehouse_name", "id_branch", "is_virtual"])
    return (
        _valuation(out)
        .withColumn("item_code", F.coalesce("product_code", "material_code"))
        .withColumn("item_name", F.coalesce("product_name", "material_name"))
        .withColumn("item_type", item_type(F.col("product_key"), F.col("material_key")))
        .withColumn("unit_id", F.coalesce("__p_unit", "__m_unit"))
        .withColumnRenamed("quantity_export", "quantity_exported")
        .drop("__p_unit", "__m_unit")
    )


def _moves(df: DataFrame, day: str, kind: str, direction: str, by: list[str]) -> DataFrame:
    inbound = direction == "INBOUND"
    qty = F.sum("quantity") if inbound else F.sum(zero_if_null("quantity"))
    zero = F.lit(0).cast("decimal(32,4)")
    return (
        df.withColumn("movement_date_key", F.col(day))
        .withColumn("movement_subtype", trimmed_or(kind, "UNKNOWN"))
        .groupBy("movement_date_key", *by, "warehouse_key", "movement_subtype")
        .agg(qty.cast("decimal(32,4)").alias("__qty"), F.count(F.lit(1)).alias("transaction_count"))
        .withColumn("movement_type", F.lit(direction))
        .withColumn("quantity_in", F.col("__qty") if inbound else zero)
        .withColumn("quantity_out", zero if inbound else F.col("__qty"))
        .drop("__qty")
    )


def movements(lots: DataFrame, exports: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Daily receipts and issues per item, warehouse and subtype."""
    by = by or ["product_key"]
    return _moves(lots, "import_date_key", "type_items", "INBOUND", by).unionByName(
        _moves(exports, "export_date_key", "type_export", "OUTBOUND", by)
    )


def movement_purpose() -> Column:
    sub = F.col("movement_subtype")
    out = F.col("movement_type") == "OUTBOUND"
    # fixed values: export codes
    return first_match(
        [
            (out & (sub == "1"), "Sales"),
            (out & (sub == "17"), "Internal Transfer"),
            (out & sub.isin("2", "4"), "Loss/Return"),
            (out, "Production Consumption/Other"),
            (F.col("product_key").isNotNull() & ~sub.isin("purchase", "buy"), "Production Output"),
        ],
        "Purchase/Other Inbound",
    )


MOVE_DATES = {"full_date": "movement_date", **{c: c for c in "year quarter month_num month_name".split()}}


def inbound_outbound(
    lots: DataFrame, exports: DataFrame, products: DataFrame, warehouses: DataFrame, dates: DataFrame
) -> DataFrame:
    """Stock movement per day, product, warehouse, type and subtype."""
    out = with_dates(movements(lots, exports), dates, "movement_date_key", MOVE_DATES)
    out = decorate(out, products, "product_key", ["product_code", "product_name", "type_products", "brand"])
    out = decorate(out, warehouses, "warehouse_key", ["warehouse_code", "warehouse_name", "id_branch", "is_virtual"])
    zero = F.lit(0).cast("decimal(22,4)")
    return (
        out.withColumn("movement_purpose", movement_purpose())
        .withColumn("net_movement", F.col("quantity_in") - F.col("quantity_out"))
        .withColumn("value_in", zero)
        .withColumn("value_out", zero)
    )


# --- month-end stock -------------------------------------------------------

PAIR = ["item_type", "item_key", "warehouse_key"]


def _item_rows(df: DataFrame, day: str, measures: dict[str, Column]) -> DataFrame:
    """Product and raw-material rows with one item key; other rows carry no item."""
    kind = F.col("type_items")
    key = first_match(
        [(kind == "product", F.col("product_key")), (kind == "nvl", F.col("material_key"))],
        F.lit(None).cast("bigint"),
    )
    return df.select(
        kind.alias("item_type"),
        key.alias("item_key"),
        "warehouse_key",
        month_start(key_to_date(day)).alias("month"),
        *[m.cast("decimal(22,4)").alias(n) for n, m in measures.items()],
    ).filter(F.col("item_key").isNotNull() & F.col("warehouse_key").isNotNull())


def stock_stretches(lots: DataFrame, exports: DataFrame, start: date, as_of: date) -> DataFrame:
    """Estimated month-end stock as stretches of months (``first`` to ``last``), from today's stock backwards.

    estimate(month) = stock now + issues after it - receipts after it, where only
    months up to the last full one count. Between two months with moves the
    estimate is constant, so the running sum is taken over months with moves only.
    Stretches at or below zero are dropped; those of an item and warehouse share no month.
    """
    zero = F.lit(0)
    rows = _item_rows(
        lots, "import_date_key", {"qty_in": F.col("quantity"), "qty_out": zero, "left": F.col("quantity_left")}
    ).unionByName(
        _item_rows(exports, "export_date_key", {"qty_in": zero, "qty_out": F.col("quantity"), "left": zero})
    )
    first_month = F.trunc(F.lit(start), "MM")
    this_month = F.trunc(F.lit(as_of), "MM")
    in_scope = F.coalesce((F.col("month") >= first_month) & (F.col("month") < this_month), F.lit(False))
    # moves outside the projected months count as none, but their pair and stock do
    monthly = (
        rows.select(
            *PAIR,
            F.when(in_scope, F.col("month")).otherwise(first_month).alias("month"),
            F.when(in_scope, F.col("qty_in")).alias("qty_in"),
            F.when(in_scope, F.col("qty_out")).alias("qty_out"),
            "left",
        )
        .groupBy(*PAIR, "month")
        .agg(F.sum("qty_in").alias("qty_in"), F.sum("qty_out").alias("qty_out"), F.sum("left").alias("left"))
    )
    sparse = monthly.select(
        *PAIR, "month", zero_if_null("qty_in").alias("qty_in"), zero_if_null("qty_out").alias("qty_out"),
        zero_if_null("left").alias("left"),
    )
    # at most one row per month reaches a pair's windows
    pair = Window.partitionBy(*PAIR)
    later = pair.orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
    forward = pair.orderBy("month")
    estimated = (
        sparse.withColumn("stock_now", F.sum("left").over(pair))
        .withColumn("after", F.coalesce(F.sum(F.col("qty_out") - F.col("qty_in")).over(later), F.lit(0)))
        .withColumn("before_first", F.sum(F.col("qty_out") - F.col("qty_in")).over(pair))
        .withColumn("is_first", F.row_number().over(forward) == 1)
        .withColumn("next_month", F.lead("month").over(forward))
    )
    last_month = F.add_months(this_month, -1)
    stretch_end = F.coalesce(F.add_months("next_month", -1), last_month)
    own = F.struct(
        F.col("month").alias("from"), stretch_end.alias("to"), (F.col("stock_now") + F.col("after")).alias("est"),
        F.lit(True).alias("has_moves"),
    )
    # months before the first one with moves
    lead_in = F.struct(
        first_month.alias("from"), F.add_months("month", -1).alias("to"),
        (F.col("stock_now") + F.col("before_first")).alias("est"), F.lit(False).alias("has_moves"),
    )
    need_lead_in = F.col("is_first") & (F.col("month") > first_month)
    stretches = estimated.select(
        *PAIR, "month", "qty_in", "qty_out",
        F.explode(F.when(need_lead_in, F.array(own, lead_in)).otherwise(F.array(own))).alias("s"),
    )
    return stretches.select(
        *PAIR, "month", "qty_in", "qty_out", F.round("s.est", 0).alias("est"), F.col("s.has_moves").alias("has_moves"),
        F.col("s.from").alias("first"), F.col("s.to").alias("last"),
    ).filter((F.col("est") > 0) & (F.col("first") <= F.col("last")))


def product_levels(stretches: DataFrame) -> DataFrame:
    """Mean month-end stock over the warehouses that hold a product, as steps: ``level.avg`` counts from ``month`` until the next step.

    A stretch adds to its product where it begins and takes away where it ends, so no month is filled in; one row per
    product and month reaches the window.
    """
    begin = F.struct(F.col("first").alias("month"), F.col("est").alias("qty"), F.lit(1).alias("held"))
    end = F.struct(F.add_months("last", 1).alias("month"), (-F.col("est")).alias("qty"), F.lit(-1).alias("held"))
    changes = (
        stretches.filter(F.col("item_type") == "product")
        .select(F.col("item_key").alias("product_key"), F.inline(F.array(begin, end)))
        .groupBy("product_key", "month")
        .agg(F.sum("qty").alias("qty"), F.sum("held").alias("held"))
    )
    so_far = Window.partitionBy("product_key").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    level = F.struct(ratio(F.sum("qty").over(so_far), F.sum("held").over(so_far)).alias("avg"))
    return changes.select("product_key", "month", level.alias("level"))


def _expanded(stretches: DataFrame, *carried: str) -> DataFrame:
    """Every stretch as its months; ``carried`` columns come along."""
    months = stretches.withColumn("m", F.explode(F.sequence("first", "last", F.expr("interval 1 month"))))
    moved = F.col("has_moves") & (F.col("m") == F.col("month"))
    nothing = F.lit(0).cast("decimal(32,4)")
    return months.select(
        F.last_day("m").alias("month_end"),
        *PAIR,
        F.when(F.col("item_type") == "product", F.col("item_key")).alias("product_key"),
        F.when(F.col("item_type") == "nvl", F.col("item_key")).alias("material_key"),
        F.col("est").alias("est_qty_end_month"),
        F.when(moved, F.col("qty_in")).otherwise(nothing).alias("inbound_this_month"),
        F.when(moved, F.col("qty_out")).otherwise(nothing).alias("outbound_this_month"),
        *carried,
    )


def month_end_quantities(lots: DataFrame, exports: DataFrame, start: date, as_of: date) -> DataFrame:
    """Estimated stock at each month end: every stretch expanded to its months."""
    return _expanded(stock_stretches(lots, exports, start, as_of))


def average_lot_price(snapshot: DataFrame, digits: int = 2) -> DataFrame:
    """Weighted unit price per item over valued stock on hand."""
    key = F.when(F.col("item_type") == "product", F.col("product_key")).otherwise(F.col("material_key"))
    return (
        snapshot.filter(
            F.col("item_type").isin("product", "nvl") & (F.col("quantity_left") > 0) & F.col("stock_value").isNotNull()
        )
        .groupBy("item_type", key.alias("item_key"))
        .agg(rounded(ratio(F.sum("stock_value"), F.sum("quantity_left")), digits).alias("avg_unit_price"))
    )


def stock_monthly(
    lots: DataFrame,
    exports: DataFrame,
    snapshot: DataFrame,
    products: DataFrame,
    materials: DataFrame,
    warehouses: DataFrame,
    start: date,
    as_of: date,
) -> DataFrame:
    """Month-end quantity and value per item and warehouse (``materials`` is the material mart)."""
    items = (
        products.select(
            F.lit("product").alias("item_type"), F.col("product_key").alias("item_key"),
            F.col("product_code").alias("item_code"), F.col("product_name").alias("item_name"), "unit_id",
            "type_products", F.lit(None).cast("string").alias("npl_type"),
        )
        .unionByName(
            materials.select(
                F.lit("nvl").alias("item_type"), F.col("material_key").alias("item_key"),
                F.col("material_code").alias("item_code"), F.col("material_name").alias("item_name"), "unit_id",
                F.lit(None).cast("string").alias("type_products"), "npl_type",
            )
        )
        .join(average_lot_price(snapshot), ["item_type", "item_key"], "full")
    )
    # a stretch meets its item and warehouse before it becomes months, which are many more rows
    names = ["item_code", "item_name", "unit_id", "type_products", "npl_type"]
    places = ["warehouse_code", "warehouse_name", "is_virtual"]
    stretches = stock_stretches(lots, exports, start, as_of).join(items, ["item_type", "item_key"], "left")
    stretches = decorate(stretches, warehouses, "warehouse_key", places)
    value = rounded(F.col("est").cast("double") * F.col("avg_unit_price").cast("double"), 0)
    valued = stretches.withColumn("est_value_end_month", value.cast("decimal(28,0)")).withColumn("is_valued", F.col("avg_unit_price").isNotNull())
    return (
        _expanded(valued, *names, *places, "est_value_end_month", "is_valued")
        .withColumn("net_movement", F.col("inbound_this_month") - F.col("outbound_this_month"))
        .drop("item_key")
    )


def item_movements(lots: DataFrame, exports: DataFrame, dates: DataFrame) -> DataFrame:
    """Movements by item (product or raw material) instead of by product key."""

    def keyed(df: DataFrame) -> DataFrame:
        kind = F.col("type_items")
        return df.withColumn("item_type", kind).withColumn(
            "item_key", F.when(kind == "nvl", F.col("material_key")).otherwise(F.col("product_key"))
        )

    rows = movements(keyed(lots), keyed(exports), ["item_type", "item_key"])
    return with_dates(rows, dates, "movement_date_key", {"full_date": "movement_date"})
