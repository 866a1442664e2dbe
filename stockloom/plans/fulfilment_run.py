"""Process delivered receipts: cancellations, duplicates, kitting, invoices and postings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, functions as F

from stockloom.operators import balances, intake, invoicing, kitting, lookups, maintenance, orders as order_ops
from stockloom.operators.cancellation import apply_cancellations
from stockloom.plans.confirmation_run import stock_closure
from stockloom.session import materialize
from stockloom.sources.schemas import TABLES


@dataclass(frozen=True)
class Counters:
    """Document counters of one run."""

    internal: Mapping[str, object] = field(default_factory=lambda: {"start": 1, "increment": 1, "prefix": "INT/%(year)s/"})
    outgoing: Mapping[str, object] = field(default_factory=lambda: {"start": 1, "increment": 1, "prefix": "OUT/%(year)s/"})
    invoice: Mapping[str, object] = field(default_factory=lambda: {"start": 1, "increment": 1, "prefix": "INV/%(year)s/"})


def fresh_deliveries(tables: Mapping[str, DataFrame], limit: int | None = None) -> DataFrame:
    """Deliveries after duplicate marking, restricted to receipts without a live picking (and to one batch)."""
    marked = intake.mark_duplicate_deliveries(tables["ofs_delivery"])
    fresh = marked.join(intake.live_documents(tables["receipt_document"]), intake.RECEIPT, "left_anti")
    return fresh if limit is None else intake.of_receipts(fresh, intake.intake_receipts(tables["ofs_delivery"], limit))


def fresh_waiting(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The unprocessed ones of :func:`fresh_deliveries`, for plans that need no others."""
    waiting = intake.waiting_deliveries(tables["ofs_delivery"])
    return waiting.join(intake.live_documents(tables["receipt_document"]), intake.RECEIPT, "left_anti")


def fresh_receipts(tables: Mapping[str, DataFrame], receipts: DataFrame) -> DataFrame:
    """The ``receipts`` without a live picking; to drop these is cheaper than to drop all their deliveries."""
    return intake.split_already_processed(receipts, tables["receipt_document"])[0]


def delivered_order_lines(tables: Mapping[str, DataFrame], deliveries: DataFrame) -> dict[str, DataFrame]:
    """The tables with only those order lines that the deliveries name, stored; no later step of the deliveries needs others.

    Only the columns are kept that the invoicing of the deliveries reads, and those of the lines' products, which are met where the
    lines are dealt by product for their price. Lines of unknown products drop out.
    """
    named = deliveries.select(F.col("line_id").alias("id"))
    columns = ("id", "order_id", "product_id", "name", "product_uom", "default_ofc_id", "price_unit")
    lines = tables["sale_order_line"].select(*columns).join(named, "id", "left_semi")
    products = tables["product_product"].select(F.col("id").alias("product_id"), "product_tmpl_id", F.col("weight").alias("unit_weight"))
    products = products.join(tables["product_template"].select(F.col("id").alias("product_tmpl_id")), "product_tmpl_id", "left_semi")
    lines = materialize(lines.join(products, "product_id"))
    return {**{name: tables[name] for name in TABLES}, "sale_order_line": lines}


def usable(tables: Mapping[str, DataFrame], deliveries: DataFrame, today: date) -> DataFrame:
    names = ("sale_order_line", "sale_order", "product_product", "product_template")
    return kitting.usable_deliveries(deliveries, *[tables[n] for n in names], today)


def with_stock(tables: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    """Stored lines with the stock each receipt finds when its turn comes."""
    lines, closure = materialize(lines), stock_closure(tables)
    done = tables["stock_move"].filter(F.col("state") == "done")
    done = done.join(lines.select("product_id").distinct(), "product_id", "left_semi")
    flows = balances.subtree_flows(done, tables["product_uom"], closure)
    names = ("product_uom", "res_partner", "stock_warehouse", "stock_location")
    return kitting.kitting_lines(lines, flows, closure, *[tables[n] for n in names])


def consumption(tables: Mapping[str, DataFrame], lines: DataFrame) -> DataFrame:
    demand = lines.select(F.col("delivery_id").alias("id"), "order_line_id", "warehouse_id", "product_id", F.col("product_uom_qty").alias("qty"))
    stock = lookups.locations_of_type(tables["stock_warehouse"], tables["stock_location"], "stock")
    return kitting.consume_quants(demand, tables["stock_quant"], stock)


def transfer_headers(
    tables: Mapping[str, DataFrame], lines: DataFrame, counters: Counters, today: date, totals: DataFrame | None = None
) -> DataFrame:
    """Headers of all receipts of ``lines``; ``totals`` are their receipts, if less than all columns will do."""
    names = ("res_partner", "stock_warehouse", "stock_location", "stock_picking_type")
    totals = kitting.receipt_totals(lines) if totals is None else totals
    return kitting.transfer_headers(totals, *[tables[n] for n in names], counters.internal, counters.outgoing, today)


def transfer_moves(tables: Mapping[str, DataFrame], lines: DataFrame, costs: DataFrame | None, today: date) -> DataFrame:
    names = ("res_partner", "stock_warehouse", "stock_location", "stock_picking_type")
    return kitting.transfer_moves(lines, kitting.receipt_agents(lines), costs, *[tables[n] for n in names], today)


def delivered_lines(tables: Mapping[str, DataFrame], receipts: DataFrame, moves: DataFrame) -> DataFrame:
    names = ("sale_order_line", "product_product", "product_template", "receipt_invoice")
    return invoicing.delivered_lines(receipts, moves, *[tables[n] for n in names])


def line_taxes(tables: Mapping[str, DataFrame], delivered: DataFrame) -> DataFrame:
    return invoicing.line_taxes(delivered, tables["product_taxes_rel"], tables["account_tax"])


def invoice_headers(
    tables: Mapping[str, DataFrame], lines: DataFrame, receipts: DataFrame, counters: Counters, today: date
) -> DataFrame:
    names = ("sale_order", "res_company", "ir_property")
    return invoicing.invoice_headers(lines, receipts, *[tables[n] for n in names], counters.invoice, today)


def run_fulfilment(
    tables: Mapping[str, DataFrame],
    today: date,
    limit: int | None = None,
    counters: Counters | None = None,
    checkpoint: bool = True,
) -> dict[str, DataFrame]:
    """One run over the queues: cancellations first, then all receipts, or the first ``limit`` of them.

    ``checkpoint`` stores the stages that feed several outputs in the shared folder: they are computed once, plans stay
    small, and a lost executor does not repeat the whole run.
    """
    keep = materialize if checkpoint else (lambda df: df)
    counters = counters or Counters()
    cancelled = apply_cancellations(
        tables["ofs_cancel_order"], tables["sale_order_line"], tables["sale_order"], tables["sale_order_tax"]
    )
    now = dict(tables)
    now["sale_order_line"] = keep(cancelled.lines)
    now["sale_order"] = maintenance.apply_changes(
        tables["sale_order"], cancelled.order_changes.select("id", "state")
    )
    marked = intake.mark_duplicate_deliveries(tables["ofs_delivery"])
    fresh = fresh_deliveries(tables, limit)
    fresh = keep(fresh)
    lines = keep(with_stock(now, usable(now, fresh, today)))
    consumed = keep(consumption(now, lines))
    headers = keep(transfer_headers(now, lines, counters, today))
    moves = keep(transfer_moves(now, lines, order_ops.line_cost(consumed), today))
    receipts = invoicing.receipt_orders(fresh)
    delivered = keep(delivered_lines(now, receipts, moves))
    taxes = line_taxes(now, delivered)
    billed = keep(invoicing.invoice_lines(delivered, taxes))
    invoices = keep(invoice_headers(now, billed, receipts, counters, today))
    repeated = intake.split_already_processed(
        marked.filter(intake.unprocessed()).select(*intake.RECEIPT).distinct(), tables["receipt_document"]
    )[1]
    return {
        "cancelled_lines": cancelled.lines,
        "split_lines": cancelled.split_lines,
        "split_taxes": cancelled.split_taxes,
        "cancelled_orders": cancelled.order_changes,
        "cancel_requests": cancelled.request_changes,
        "deliveries": marked,
        "repeated": intake.repeated_changes(marked, repeated),
        "invalid": kitting.invalid_changes(fresh, lines),
        "kit_lines": lines,
        "consumed": consumed,
        "lot_moves": kitting.lot_moves(consumed, lines),
        "lots": kitting.lot_changes(consumed, tables["stock_quant"]),
        "stock_exceptions": kitting.upsert_stock_exceptions(tables["stock_exceptions"], lines, today),
        "transfer_headers": headers,
        "transfer_moves": moves,
        "closed_deliveries": kitting.delivery_changes(fresh, headers),
        "invoice_lines": billed,
        "tax_rows": taxes,
        "invoices": invoices,
        "journal_entries": invoicing.journal_entries(invoices),
        "journal_lines": invoicing.journal_lines(invoices, billed, taxes, tables["account_account"], tables["account_journal"]),
        "tax_summary": invoicing.tax_summary(taxes),
        "line_taxes": invoicing.line_tax_relation(taxes),
        "line_orders": invoicing.order_line_relation(billed),
        "invoiced_deliveries": invoicing.invoiced_changes(fresh, invoices),
        "invoiced_pickings": invoicing.picking_changes(invoices),
    }
