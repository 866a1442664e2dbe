"""Order confirmation: which draft orders are confirmed, held or cancelled."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import as_money, as_numeric, half_money, new_delivery_date, unpaid_cutoff
from stockloom.operators.joins import attach
from stockloom.operators.lookups import agent_warehouse, fulfilment_center, item_location
from stockloom.operators.orders import not_duplicate, order_prepayment, previous_orders

# Category parents exempt from bulk handling and from the high-value test, and the limits.
NEVER_BULKY = (354, 352)
NEVER_HIGH_VALUE = (365,)
BULKY_WEIGHT = 10
ORDER_THRESHOLD = Decimal(10000)
UNIT_THRESHOLD = Decimal(6000)
CANCEL_NOTE = "High Value Order Cancelled by Order Confirmation Process"


def confirm_candidates(orders: DataFrame, run_date: date, order_id: int | None = None) -> DataFrame:
    """Draft orders up to the run date that were never confirmed and are not known duplicates."""
    rows = orders.filter(
        (F.col("state") == "draft")
        & (F.col("date_order") <= F.lit(run_date))
        & F.col("confirmation_date").isNull()
        & not_duplicate(null_counts=True)
    )
    return rows if order_id is None else rows.filter(F.col("id") == order_id)


def resolvable_lines(lines: DataFrame, products: DataFrame, templates: DataFrame) -> DataFrame:
    """Lines whose product and template exist, with the template, weight, size and category."""
    known = products.select(F.col("id").alias("product_id"), "product_tmpl_id", F.col("weight").alias("unit_weight")).join(
        templates.select(F.col("id").alias("product_tmpl_id"), "size", "categ_id"), "product_tmpl_id"
    )
    return lines.join(known, "product_id")


def split_empty_orders(candidates: DataFrame, known_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(with lines, empty)``: candidates that have a resolvable line, and those that are cancelled for lack of one."""
    held = known_lines.select(F.col("order_id").alias("id"))
    return candidates.join(held, "id", "left_semi"), candidates.join(held, "id", "left_anti")


def _in_families(categories: DataFrame, parents: Collection[int]) -> DataFrame:
    return categories.filter(F.col("parent_id").isin(*parents)).select(
        F.col("id").alias("categ_id"), F.lit(True).alias("__exempt")
    )


def order_line_facts(
    candidates: DataFrame,
    known_lines: DataFrame,
    orders: DataFrame,
    categories: DataFrame,
    partners: DataFrame,
    warehouses: DataFrame,
    stocked: DataFrame,
    ofc_locations: DataFrame,
    location_products: DataFrame,
) -> DataFrame:
    """Weight, bulk flag, warehouse, centre, place and earlier order counts of each candidate line.

    The customer of a staged line is its agent, so both earlier-order counts are looked up by agent id.
    """
    rows = known_lines.select(
        "id", "order_id", "product_id", "product_uom_qty", "unit_weight", "size", "categ_id"
    ).join(candidates.select(F.col("id").alias("order_id"), "partner_id"), "order_id")
    weight = as_numeric(F.col("product_uom_qty") * F.col("unit_weight"), 12, 4)
    heavy = F.coalesce(F.col("size") == "big", F.lit(False)) | F.coalesce(F.col("weight") >= BULKY_WEIGHT, F.lit(False))
    rows = rows.withColumn("weight", weight).join(_in_families(categories, NEVER_BULKY), "categ_id", "left")
    rows = rows.withColumn("is_bulk", heavy & F.col("__exempt").isNull())
    rows = agent_warehouse(rows, partners)
    rows = fulfilment_center(rows, warehouses, stocked)
    rows = item_location(rows, ofc_locations, location_products)
    by_agent = previous_orders(orders, "partner_id").withColumnRenamed("previous_orders", "previousagentorders")
    by_customer = previous_orders(orders, "customer_id").withColumnRenamed("previous_orders", "previouscustorders")
    rows = attach(rows, by_agent, {"partner_id": "partner_id"})
    rows = attach(rows, by_customer, {"partner_id": "customer_id"})
    zero = F.lit(0).cast("bigint")
    return rows.select(
        "id",
        "order_id",
        "product_id",
        "weight",
        "is_bulk",
        F.col("warehouse_id").alias("default_ofc_id"),
        "ofc_id",
        "ofc_location_id",
        F.coalesce("previousagentorders", zero).alias("previousagentorders"),
        F.coalesce("previouscustorders", zero).alias("previouscustorders"),
    )


def refill_locations(lines: DataFrame, ofc_locations: DataFrame, location_products: DataFrame) -> DataFrame:
    """Second pass over all lines: a line with a centre but no place gets one."""
    found = item_location(lines, ofc_locations, location_products, out="__place")
    return found.withColumn("ofc_location_id", F.coalesce("ofc_location_id", "__place")).drop("__place")


def high_value(
    known_lines: DataFrame,
    categories: DataFrame,
    order_threshold: Decimal = ORDER_THRESHOLD,
    unit_threshold: Decimal = UNIT_THRESHOLD,
    exempt: Collection[int] = NEVER_HIGH_VALUE,
) -> DataFrame:
    """``(order_id, amount, high)`` per order with lines; lines of exempt families do not count."""
    counting = F.col("__exempt").isNull()
    price = as_money("price_unit")
    return (
        known_lines.join(_in_families(categories, exempt), "categ_id", "left")
        .groupBy("order_id")
        .agg(
            as_money(F.coalesce(F.sum(F.when(counting, price * F.col("product_uom_qty"))), F.lit(0))).alias("amount"),
            F.coalesce(F.bool_or(counting & (price >= F.lit(unit_threshold))), F.lit(False)).alias("__dear"),
        )
        .select("order_id", "amount", (F.col("__dear") | (F.col("amount") >= F.lit(order_threshold))).alias("high"))
    )


def order_disposition(
    candidates: DataFrame, known_lines: DataFrame, categories: DataFrame, vouchers: DataFrame, today: date
) -> DataFrame:
    """One row per candidate with ``amount``, ``prepayment`` and ``disposition``.

    ``cancel_empty``: nothing to deliver; ``cancel_unpaid``: held past the cut-off; ``hold``: waits for money;
    ``confirm``: goes ahead. Prepayments are only looked at for high-value and layaway orders.
    """
    rows = (
        candidates.select(F.col("id").alias("order_id"), "date_order", "date_delivery", "islayaway")
        .join(high_value(known_lines, categories), "order_id", "left")
        .join(order_prepayment(vouchers), "order_id", "left")
    )
    layaway = F.coalesce("islayaway", F.lit(False))
    read = F.col("high") | layaway
    paid = as_money(F.when(read, F.coalesce("prepayment", F.lit(0))).otherwise(0))
    rows = rows.withColumn("prepayment", paid)
    amount, prepayment = F.col("amount"), F.col("prepayment")
    held = F.when(layaway, prepayment < amount).otherwise(F.col("high") & (prepayment < half_money(amount)))
    overdue = ~F.coalesce("islayaway", F.lit(True)) & (F.col("date_order") < unpaid_cutoff(F.lit(today)))
    return rows.select(
        "order_id",
        "date_order",
        "date_delivery",
        "amount",
        "prepayment",
        F.when(amount.isNull(), "cancel_empty")
        .when(~held, "confirm")
        .when(overdue, "cancel_unpaid")
        .otherwise("hold")
        .alias("disposition"),
    )


def _is(disposition: str) -> Column:
    return F.col("disposition") == disposition


def order_changes(dispositions: DataFrame, run_date: date, today: date) -> DataFrame:
    """Change set of orders: ``(id, state, note, confirmation_date, date_delivery)``, NULL where nothing changes."""
    moved = _is("confirm") & (F.col("prepayment") > 0) & (F.col("date_order") < F.lit(run_date))
    return dispositions.filter(~_is("hold")).select(
        F.col("order_id").alias("id"),
        F.when(_is("confirm"), "progress").otherwise("cancel").alias("state"),
        F.when(_is("cancel_unpaid"), CANCEL_NOTE).alias("note"),
        F.when(_is("confirm"), F.lit(today)).alias("confirmation_date"),
        F.when(moved, new_delivery_date("date_order", "date_delivery", F.lit(today))).alias("date_delivery"),
    )


def line_changes(dispositions: DataFrame, lines: DataFrame) -> DataFrame:
    """Change set of order lines: ``(id, state)``; lines of confirmed and of unpaid orders move."""
    decided = dispositions.filter(_is("confirm") | _is("cancel_unpaid")).select("order_id", "disposition")
    return lines.select("id", "order_id").join(decided, "order_id").select(
        "id", F.when(_is("confirm"), "confirmed").otherwise("cancel").alias("state")
    )


def workflow_changes(dispositions: DataFrame, instances: DataFrame) -> DataFrame:
    """Change set ``(id, state)`` of workflow rows: those of confirmed orders become active."""
    waiting = instances.filter((F.col("res_type") == "sale.order") & (F.col("state") != "active"))
    confirmed = dispositions.filter(_is("confirm")).select(F.col("order_id").alias("res_id"))
    return waiting.join(confirmed, "res_id", "left_semi").select("id", F.lit("active").alias("state"))
