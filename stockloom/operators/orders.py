"""Aggregations over orders and their lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import as_int, as_numeric


def not_duplicate(null_counts: bool) -> Column:
    """``is_duplicate`` is false; NULL passes only if ``null_counts``."""
    flag = F.col("is_duplicate")
    return ~F.coalesce(flag, F.lit(False)) if null_counts else F.coalesce(~flag, F.lit(False))


def previous_orders(orders: DataFrame, by: str) -> DataFrame:
    """``(by, previous_orders)``: done, non-duplicate orders per agent or customer; absent keys mean 0."""
    done = orders.filter((F.col("state") == "done") & not_duplicate(null_counts=False) & F.col(by).isNotNull())
    return done.groupBy(by).agg(F.count("id").alias("previous_orders"))


def order_prepayment(vouchers: DataFrame) -> DataFrame:
    """``(order_id, prepayment)`` of booked vouchers; absent orders mean 0."""
    booked = vouchers.filter((F.col("state") == "booked") & F.col("order_id").isNotNull())
    return booked.groupBy("order_id").agg(F.coalesce(as_numeric(F.sum("amount"), 12, 4), F.lit(0)).alias("prepayment"))


def fully_invoiced(orders: DataFrame, lines: DataFrame, invoice_lines: DataFrame) -> DataFrame:
    """``(order_id, fully_invoiced)``: false only if more is ordered (lines not cancelled) than invoiced (all lines).

    An order without any invoice or any open line counts as fully invoiced.
    """
    invoiced = invoice_lines.filter(F.col("order_line_id").isNotNull()).select(
        F.col("order_line_id").alias("id"), F.col("quantity").alias("__invoiced")
    )
    per_order = (
        lines.select("id", "order_id", "state", "product_uom_qty")
        .withColumn("__ordered", F.when(F.col("state") != "cancel", F.col("product_uom_qty")))
        .select("id", "order_id", "__ordered", F.lit(None).cast("decimal(18,4)").alias("__invoiced"))
        .unionByName(
            lines.select("id", "order_id").join(invoiced, "id").select(
                "id", "order_id", F.lit(None).cast("int").alias("__ordered"), F.col("__invoiced").cast("decimal(18,4)")
            )
        )
        .groupBy("order_id")
        .agg(as_int(F.sum("__ordered")).alias("ordered"), as_int(F.sum("__invoiced")).alias("invoiced"))
    )
    return (
        orders.select(F.col("id").alias("order_id"))
        .join(per_order, "order_id", "left")
        .select(
            "order_id", "ordered", "invoiced", F.coalesce(~(F.col("ordered") > F.col("invoiced")), F.lit(True)).alias("fully_invoiced")
        )
    )


def order_names_by_product(staged_lines: DataFrame) -> DataFrame:
    """Long form of the origin text: ``(product_id, order_id, order_name, line_count)``, one row per order."""
    return staged_lines.groupBy("product_id", "order_id").agg(
        F.coalesce(F.max("order_name"), F.lit("")).alias("order_name"), F.count(F.lit(1)).alias("line_count")
    )


def product_origins(staged_lines: DataFrame) -> DataFrame:
    """``(product_id, origin)``: order names of all lines of a product, by order id, joined with ``, ``.

    One row holds the whole text of a product, so this is a report for products of interest; runs carry the long form
    above instead.
    """
    names = order_names_by_product(staged_lines.filter(F.col("product_id").isNotNull()))
    text = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("order_id", "order_name", "line_count"))),
            lambda x: F.array_join(F.array_repeat(x["order_name"], x["line_count"].cast("int")), ", "),
        ),
        ", ",
    )
    return names.groupBy("product_id").agg(text.alias("origin"))


def pending_orders(orders: DataFrame, lines: DataFrame, run_date: date, today: date) -> DataFrame:
    """``(product_id, pending_qty)`` of orders in progress that are confirmed but not yet delivered."""
    waiting = orders.filter(
        (F.col("state") == "progress")
        & (F.col("date_delivery") > F.lit(run_date))
        & (F.col("date_order") < F.lit(run_date))
        & (F.col("confirmation_date") < F.lit(today))
    ).select(F.col("id").alias("order_id"))
    return (
        lines.filter(F.col("product_id").isNotNull())
        .select("order_id", "product_id", "product_uom_qty")
        .join(waiting, "order_id")
        .groupBy("product_id")
        .agg(as_int(F.sum("product_uom_qty")).alias("pending_qty"))
    )


def line_cost(consumed: DataFrame) -> DataFrame:
    """``(order_line_id, quant_qty, quant_total, line_cost)``: average cost of the lots a line consumed."""
    total = as_numeric(F.col("quant_cost") * F.col("quant_qty"), 12, 4)
    per_line = (
        consumed.filter(F.col("quant_qty") > 0)
        .groupBy("order_line_id")
        .agg(F.sum("quant_qty").alias("__qty"), F.sum(total).alias("__total"))
    )
    return per_line.select(
        "order_line_id",
        as_int("__qty").alias("quant_qty"),
        as_numeric("__total", 18, 4).alias("quant_total"),
        as_numeric(F.col("__total") / F.col("__qty"), 12, 4).alias("line_cost"),
    )
