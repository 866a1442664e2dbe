"""Purchase requisitions: demand of confirmed orders netted against stock and pending movements."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from stockloom.functions.scalars import as_int, as_numeric, bracket_label
from stockloom.operators.joins import attach
from stockloom.operators.lookups import agent_warehouse, fulfilment_center, locations_of_type, look_up
from stockloom.operators.maintenance import first_per_key, number_documents
from stockloom.operators.orders import not_duplicate, order_names_by_product


def requisition_orders(orders: DataFrame, partners: DataFrame, run_date: date) -> DataFrame:
    """Orders confirmed on the run date and not yet requisitioned, with the agent's warehouse.

    Unlike confirmation, an unknown duplicate or requisition flag keeps the order out.
    """
    rows = orders.filter(
        (F.col("confirmation_date") == F.lit(run_date))
        & not_duplicate(null_counts=False)
        & ~F.col("state").isin("draft", "cancel", "rejected")
        & F.coalesce(~F.col("requisitioned"), F.lit(False))
    )
    return agent_warehouse(rows.select("id", "name", "partner_id", "company_id", "date_order", "date_delivery"), partners)


def staged_lines(
    staged_orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    templates: DataFrame,
    uoms: DataFrame,
    warehouses: DataFrame,
    stocked: DataFrame,
) -> DataFrame:
    """Lines of the staged orders with purchase unit, factor, purchase quantity and fulfilment centre."""
    units = (
        products.select(F.col("id").alias("product_id"), "product_tmpl_id")
        .join(templates.select(F.col("id").alias("product_tmpl_id"), F.col("uom_po_id").alias("purchase_uom_id")), "product_tmpl_id")
        .join(uoms.select(F.col("id").alias("purchase_uom_id"), as_numeric("factor", 10, 6).alias("purchase_factor")), "purchase_uom_id")
        .select("product_id", "purchase_uom_id", "purchase_factor")
    )
    heads = staged_orders.select(F.col("id").alias("order_id"), F.col("name").alias("order_name"), "warehouse_id")
    rows = (
        lines.select("id", "order_id", "product_id", "company_id", as_numeric("product_uom_qty", 10, 6).alias("order_qty"))
        .join(heads, "order_id")
        .join(units, "product_id")
        .withColumn("purchase_qty", as_numeric(F.col("order_qty") * F.col("purchase_factor"), 12, 4))
    )
    return fulfilment_center(rows, warehouses, stocked)


def requisition_demand(staged: DataFrame, products: DataFrame, templates: DataFrame, categories: DataFrame) -> DataFrame:
    """Demand per product, company, purchase unit, centre and factor with labels and category.

    The orders a demand stems from are a relation of their own, see :func:`requisition_line_orders`.
    """
    demand = staged.groupBy("product_id", "company_id", "purchase_uom_id", "ofc_id", "purchase_factor").agg(
        as_numeric(F.sum("purchase_qty"), 12, 4).alias("po_qty_ordered"),
        as_numeric(F.sum("order_qty"), 12, 4).alias("qty_ordered"),
    )
    labels = (
        products.select(F.col("id").alias("product_id"), "product_tmpl_id")
        .join(
            templates.select(
                F.col("id").alias("product_tmpl_id"),
                "categ_id",
                "default_code",
                bracket_label("default_code", "name").alias("product_name"),
            ),
            "product_tmpl_id",
        )
        .drop("product_tmpl_id")
    )
    rows = attach(demand.withColumnRenamed("ofc_id", "warehouse_id"), labels, {"product_id": "product_id"})
    return look_up(rows, categories, "categ_id", "name", "category_name")


def net_purchase_qty(
    demand: DataFrame,
    warehouses: DataFrame,
    locations: DataFrame,
    levels: DataFrame,
    pending: DataFrame,
) -> DataFrame:
    """Add stock, pending quantities and ``topurchase_qty``: what free stock at the centre does not cover.

    ``levels`` are those of :func:`~stockloom.operators.balances.stock_and_pending_in`.
    """
    stock = locations_of_type(warehouses, locations, "stock")
    place = ["location_id", "product_id"]
    rows = attach(demand, stock, {"warehouse_id": "warehouse_id"})
    rows = attach(rows, levels.select(*place, "qty_on_hand", F.col("pending_in").alias("__in")), {c: c for c in place})
    rows = attach(rows, pending, {"product_id": "product_id"})
    zero, factor = F.lit(0), F.col("purchase_factor")
    rows = rows.withColumns(
        {
            "qtyonhand": as_int(F.coalesce("qty_on_hand", zero)),
            "pending_in": as_numeric(F.coalesce("__in", zero) * factor, 12, 4),
            "pending_out": as_numeric(F.coalesce("pending_qty", zero) * factor, 12, 4),
        }
    ).withColumn("po_qtyonhand", as_int(F.col("qtyonhand") * factor))
    free = F.col("po_qtyonhand") - F.col("pending_out")
    return rows.withColumn("topurchase_qty", as_int(F.greatest(F.col("po_qty_ordered") - free, F.lit(0)))).drop(
        "qty_on_hand", "__in", "pending_qty"
    )


def reorder_qty(net: DataFrame, orderpoints: DataFrame) -> DataFrame:
    """Add ``reorder_qty`` from the active order point of the centre; without one the limits are 0, 0 and 1."""
    keys = ["warehouse_id", "location_id", "company_id", "product_id"]
    points = first_per_key(
        orderpoints.filter("active").select(*keys, "id", "product_max_qty", "product_min_qty", "qty_multiple"), keys, ["id"]
    ).drop("id")
    rows = attach(net, points, {c: c for c in keys})
    rows = rows.withColumns(
        {
            "product_max_qty": as_numeric(F.coalesce("product_max_qty", F.lit(0)), 12, 4),
            "product_min_qty": as_numeric(F.coalesce("product_min_qty", F.lit(0)), 12, 4),
            "qty_multiple": as_numeric(F.coalesce("qty_multiple", F.lit(1)), 12, 4),
        }
    ).withColumn("projected_qty", as_numeric(F.col("qtyonhand") - F.col("pending_out"), 12, 4))
    low = F.col("projected_qty") <= F.col("product_min_qty")
    rows = rows.withColumn(
        "required_qty", as_numeric(F.when(low, F.col("product_max_qty") - F.col("projected_qty")).otherwise(0), 12, 4)
    )
    amount = F.floor(F.col("required_qty") / F.col("qty_multiple") * F.col("purchase_factor"))
    return rows.withColumn("reorder_qty", as_numeric(F.when(low, amount).otherwise(0), 12, 4))


def requisition_headers(
    requisition: DataFrame,
    warehouses: DataFrame,
    run_date: date,
    start: int,
    increment: int,
    prefix: str | None,
    on_date: date,
) -> DataFrame:
    """One numbered header per centre and company that has demand, an unknown centre or company included.

    Any rows with ``warehouse_id`` and ``company_id`` will do, for instance the staged lines.
    """
    # NULL sorts last, as the numbering needs a value in every level.
    last = F.lit(2**62)
    pairs = (
        requisition.select("warehouse_id", "company_id")
        .distinct()
        .withColumns({"__w": F.coalesce("warehouse_id", last), "__c": F.coalesce("company_id", last)})
    )
    numbered = number_documents(pairs, ["__c"], start, increment, prefix, on_date, levels=["__w"]).drop("__w", "__c")
    named = look_up(numbered, warehouses, "warehouse_id", "name", "warehouse_name")
    return named.select(
        F.col("document_no").alias("requisition_no"),
        F.concat(
            F.coalesce("document_name", F.lit("")), F.lit("("), F.coalesce("warehouse_name", F.lit("")), F.lit(")")
        ).alias("name"),
        F.concat(F.lit("SOs for "), F.date_format(F.lit(run_date), "dd MMM yyyy")).alias("origin"),
        "warehouse_id",
        "company_id",
        F.lit("in_progress").alias("state"),
        F.lit("multiple").alias("exclusive"),
        F.lit("Retail").alias("type"),
        F.lit(on_date).alias("date_start"),
    )


def requisition_lines(requisition: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines of the headers; demand without centre or company belongs to no header's equality and stays out."""
    heads = headers.select("requisition_no", "warehouse_id", "company_id")
    return requisition.join(heads, ["warehouse_id", "company_id"]).select(
        "requisition_no",
        "product_id",
        F.col("purchase_uom_id").alias("product_uom_id"),
        "company_id",
        F.col("category_name").alias("category"),
        "pending_out",
        "pending_in",
        "reorder_qty",
        F.col("topurchase_qty").alias("qty_to_purchase"),
        F.col("po_qty_ordered").alias("product_qty"),
        F.col("po_qtyonhand").alias("qty_available"),
    )


def requisition_line_orders(lines: DataFrame, staged: DataFrame) -> DataFrame:
    """``(requisition_no, product_id, order_id, order_name, line_count)``: the origin of each requisition line.

    Like the text it stands for, it names all staged orders of the product. A popular product has many rows here, none
    of which has to meet the others.
    """
    named = lines.select("requisition_no", "product_id").distinct()
    return order_names_by_product(staged).join(named, "product_id").select(
        "requisition_no", "product_id", "order_id", "order_name", "line_count"
    )


def requisitioned_changes(staged_orders: DataFrame) -> DataFrame:
    """Change set ``(id, requisitioned)`` of the source orders."""
    return staged_orders.select("id", F.lit(True).alias("requisitioned"))
