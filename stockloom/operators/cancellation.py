"""Cancellation requests applied to order lines as one set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from stockloom.functions.scalars import as_numeric
from stockloom.operators.intake import unprocessed
from stockloom.operators.joins import attach

# Columns a split line takes over; the centre is not among them.
SPLIT_COLUMNS = ("product_id", "product_uom", "price_unit", "name", "company_id", "order_partner_id")


@dataclass(frozen=True)
class Cancellation:
    """Results of one run. ``split_lines`` and ``split_taxes`` are keyed by the request that caused them."""

    lines: DataFrame
    split_lines: DataFrame
    split_taxes: DataFrame
    order_changes: DataFrame
    request_changes: DataFrame


def _line_requests(requests: DataFrame, lines: DataFrame) -> DataFrame:
    """Requests that name a line, with the ordered quantity before the run and what they amount to."""
    named = requests.filter(F.coalesce("line_id", F.lit(0)) != 0)
    facts = lines.select(
        F.col("id").alias("line_id"),
        F.struct(F.lit(True).alias("found"), "order_id", "ofc_id", "product_uom_qty", "commission", *SPLIT_COLUMNS).alias("line"),
    )
    joined = named.join(facts, "line_id", "left")
    ordered = F.when(F.col("line.found"), F.col("line.product_uom_qty")).otherwise(F.lit(0))
    here = (F.col("line.order_id") == F.col("order_id")) & (F.col("line.ofc_id") == F.col("ofc_id"))
    return joined.withColumns(
        {
            "ordered": ordered,
            "partial": F.coalesce(F.col("cancelled_qty") < ordered, F.lit(False)),
            "matches": F.coalesce(here, F.lit(False)),
        }
    )


def apply_cancellations(
    requests: DataFrame, lines: DataFrame, orders: DataFrame, taxes: DataFrame, commission: str = "literal"
) -> Cancellation:
    """Apply all unprocessed requests (``id, order_id, ofc_id, user_id, line_id, cancelled_qty, processed``).

    Without a line every line of the order at that centre is cancelled. Less than the ordered quantity splits the
    line: the original shrinks (not below 0) and, if order and centre match, a cancelled line takes the rest. Anything
    else cancels the matching line. Requests commute, since the ordered quantity is the one before the run and states
    only move to cancelled. ``commission`` is ``literal`` (whole-number share: any real split loses it) or
    ``proportional``.
    """
    todo = requests.filter(unprocessed())
    named = _line_requests(todo, lines)
    whole = ~F.col("partial") & F.col("matches")
    per_line = named.groupBy(F.col("line_id").alias("id")).agg(
        F.sum(F.when(F.col("partial"), F.col("cancelled_qty"))).alias("__reduced"),
        F.max(F.when(whole, F.struct(F.col("id").alias("request"), "user_id"))).alias("__whole"),
    )
    per_order = (
        todo.filter(F.coalesce("line_id", F.lit(0)) == 0)
        .groupBy(F.col("order_id").alias("__order"), F.col("ofc_id").alias("__ofc"))
        .agg(F.max(F.struct(F.col("id").alias("request"), "user_id")).alias("__all"))
    )
    joined = attach(lines.join(per_line, "id", "left"), per_order, {"order_id": "__order", "ofc_id": "__ofc"})
    reduced = F.coalesce("__reduced", F.lit(0))
    left = F.greatest(F.col("product_uom_qty") - reduced, F.lit(0))
    if commission == "literal":
        share = F.when(reduced == 0, F.col("commission")).otherwise(F.lit(0))
    else:
        share = F.when(reduced == 0, F.col("commission")).otherwise(F.col("commission") * left / F.col("product_uom_qty"))
    last = F.greatest("__whole", "__all")
    kinds = {c: lines.schema[c].dataType for c in ("product_uom_qty", "commission")}
    updated = joined.withColumns(
        {
            "commission": share.cast(kinds["commission"]),
            "product_uom_qty": F.when(F.col("__reduced").isNull(), F.col("product_uom_qty"))
            .otherwise(left)
            .cast(kinds["product_uom_qty"]),
            "state": F.when(last.isNotNull(), "cancel").otherwise(F.col("state")),
            "write_uid": F.coalesce(last["user_id"], F.col("write_uid")) if "write_uid" in lines.columns else last["user_id"],
        }
    ).drop("__reduced", "__whole", "__all")

    part = F.lit(0) if commission == "literal" else F.col("line.commission") * F.col("cancelled_qty") / F.col("ordered")
    split_lines = named.filter(F.col("partial") & F.col("matches")).select(
        F.col("id").alias("request_id"),
        F.col("line_id").alias("original_line"),
        "order_id",
        F.lit(None).cast("bigint").alias("ofc_id"),
        F.col("cancelled_qty").alias("product_uom_qty"),
        F.lit("cancel").alias("state"),
        as_numeric(part, 12, 2).alias("commission"),
        F.col("user_id").alias("create_uid"),
        *[F.col(f"line.{c}").alias(c) for c in SPLIT_COLUMNS],
    )
    split_taxes = taxes.join(
        split_lines.select("request_id", F.col("original_line").alias("order_line_id")), "order_line_id"
    ).select("request_id", "tax_id")

    touched = (
        todo.groupBy("order_id")
        .agg(F.max_by("user_id", "id").alias("write_uid"))
        .join(orders.select(F.col("id").alias("order_id")), "order_id", "left_semi")
    )
    open_lines = updated.filter(F.col("state") == "confirmed").select("order_id")
    order_changes = touched.join(open_lines, "order_id", "left_anti").select(
        F.col("order_id").alias("id"), F.lit("cancel").alias("state"), "write_uid"
    )
    request_changes = todo.select("id", F.lit(True).alias("processed"))
    return Cancellation(updated, split_lines, split_taxes, order_changes, request_changes)
