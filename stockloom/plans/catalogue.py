"""Registered queries: every operator applied to whole tables. Keys follow the operator inventory."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockloom.functions import scalars as fn
from stockloom.operators import (
    balances,
    confirmation,
    intake,
    invoicing,
    kitting,
    lookups,
    maintenance,
    orders,
    requisition,
    valuation,
)
from stockloom.operators.cancellation import Cancellation, apply_cancellations
from stockloom.plans import confirmation_run as confirming, fulfilment_run as fulfilling
from stockloom.session import materialize
from stockloom.sources.schemas import TABLES
from stockloom.sources.star_schema import CONFIRMED_ON, DEMAND_DATE, RUN_DATE, Business

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Callable[[Business], DataFrame]) -> Callable[[Business], DataFrame]:
    """Register a function of the business tables under its own name."""
    QUERIES[function.__name__] = lambda spark, folder: function(Business(spark, folder))
    return function


def _dec(col: Column | str, scale: int = 2) -> Column:
    return fn.as_numeric(col, 18, scale)


def _date_lit(day) -> Column:
    return F.lit(day)


# -- tables -----------------------------------------------------------------------------------------------------------


@query
def a1_domain_scan(b: Business) -> DataFrame:
    counts = [b[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name in TABLES]
    out = counts[0]
    for part in counts[1:]:
        out = out.unionByName(part)
    return out


@query
def a2_ensure_columns(b: Business) -> DataFrame:
    bare = b["sale_order_line"].select("id", "ofc_id")
    columns = {
        "ofc_id": ("int", None),
        "previousagentorders": ("int", None),
        "previouscustorders": ("int", None),
        "is_bulk": ("boolean", False),
    }
    return maintenance.ensure_columns(bare, columns)


@query
def a3_update_from(b: Business) -> DataFrame:
    target = b["sale_order_line"].select("id", "product_id", "ofc_location_id")
    sets = {"ofc_location_id": F.col("source.location_id")}
    return maintenance.update_from(target, b["location_product_rel"], ["product_id"], sets, ["location_id"])


@query
def a4_apply_changes(b: Business) -> DataFrame:
    changes = confirmation.order_changes(confirming.dispositions(b, RUN_DATE, RUN_DATE), RUN_DATE, RUN_DATE)
    return maintenance.apply_changes(b["sale_order"].select("id", "state", "confirmation_date", "date_delivery", "note"), changes)


@query
def a6_document_numbers(b: Business) -> DataFrame:
    numbered = maintenance.number_documents(
        b["sale_order"].select("id", "date_order"), ["date_order", "id"], 1000, 3, "SO/%(year)s-%(month)s-%(day)s/", RUN_DATE
    )
    return numbered.select("id", "document_no", "document_name")


@query
def a6_next_counter(b: Business) -> DataFrame:
    return maintenance.next_counter(b["sale_order"], 1000, 3)


# -- scalar functions -------------------------------------------------------------------------------------------------


@query
def b1_datediff(b: Business) -> DataFrame:
    key = F.col("o_orderkey")
    end = F.expr("timestamp_ntz'2000-03-01 07:30:15.6' + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 100000)")
    units = F.array(*[F.lit(u) for u in ("year", "m", "ww", "day", "hh", "mi", "second")])
    rows = b.raw("orders").select(key, F.col("o_orderdate").alias("s"), end.alias("e"), F.explode(units).alias("unit"))
    return rows.select("o_orderkey", "unit", fn.datediff_units(F.col("unit"), "s", "e").alias("diff"))


@query
def b2_new_delivery_date(b: Business) -> DataFrame:
    start = F.date_add(_date_lit(RUN_DATE), (F.col("id") % 7).cast("int"))
    return b["sale_order"].select("id", fn.new_delivery_date("date_order", "date_delivery", start).alias("delivery"))


@query
def b3_tax_amount(b: Business) -> DataFrame:
    taxes = b["account_tax"].select(F.col("id").alias("tax_id"), F.col("amount").alias("rate"), F.col("amount_type").alias("kind"))
    rows = b["sale_order_line"].withColumn("tax_id", (1 + F.col("id") % 4).cast("int")).join(taxes, "tax_id")
    total = F.col("rate") + F.lit(8).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    amount = fn.tax_amount("price_unit", "product_uom_qty", "rate", total.cast("decimal(12,6)"), "kind")
    return rows.select("id", amount.alias("tax"))


@query
def b4_property_keys(b: Business) -> DataFrame:
    keys = b["res_partner"].select("id", fn.property_key("res.partner", "id").alias("res_id"))
    named = b["ir_property"].filter(F.col("name") == "property_account_receivable_id")
    return keys.join(named, "res_id", "left").select(
        "id", "res_id", fn.reference_id("value_reference", "account.account").alias("account_id")
    )


@query
def b5_business_calendar(b: Business) -> DataFrame:
    day = b.raw("events").select("event_id", fn.business_day("ts").alias("day"))
    return day.select("event_id", "day", fn.is_business_day("day").alias("runs"), fn.unpaid_cutoff("day").alias("cutoff"))


@query
def b6_expand_prefix(b: Business) -> DataFrame:
    prefix = F.when(F.col("id") % 10 != 0, F.lit("SO/%(year)s/%(month)s/%(day)s/"))
    return b["sale_order"].select("id", F.concat(fn.expand_prefix(prefix, "date_order"), F.col("id").cast("string")).alias("name"))


@query
def b7_labels(b: Business) -> DataFrame:
    return b["product_template"].select(
        "id", fn.dash_label("default_code", "name").alias("dashed"), fn.bracket_label("default_code", "name").alias("bracketed")
    )


@query
def b8_round2(b: Business) -> DataFrame:
    value = (F.col("remaining_value") * F.lit(125) / F.lit(1000)).cast("decimal(18,6)")
    return b["stock_move"].select("id", fn.round2(value).cast("decimal(18,2)").alias("amount"))


@query
def b9_fixed_scale(b: Business) -> DataFrame:
    value = (F.col("price_unit") * F.col("product_uom_qty") * F.lit(25) / F.lit(1000)).cast("decimal(18,5)")
    return b["sale_order_line"].select("id", fn.as_numeric(value, 12, 2).alias("cents"), fn.as_int(value).alias("whole"))


@query
def b10_posting_text(b: Business) -> DataFrame:
    name = F.repeat(F.concat(F.col("name"), F.lit(" / ")), 9)
    return b["product_template"].select("id", fn.posting_name(name).alias("name"), fn.posting_reference(name).alias("ref"))


# -- lookups ----------------------------------------------------------------------------------------------------------


@query
def c1_location_closure(b: Business) -> DataFrame:
    return lookups.location_closure(b["stock_location"])


@query
def c2_warehouse_locations(b: Business) -> DataFrame:
    return lookups.warehouse_locations(b["stock_warehouse"], b["stock_location"])


@query
def c3_picking_type(b: Business) -> DataFrame:
    key, home = F.col("id"), F.col("ofc_id")
    requests = b["sale_order_line"].select(
        "id",
        home.alias("warehouse_id"),
        F.when(key % 3 == 0, "incoming").otherwise("outgoing").alias("code"),
        F.when(key % 3 == 0, 3).when(key % 3 == 1, 1000 + home).otherwise(1001 + home).cast("bigint").alias("source_id"),
        F.when(key % 5 == 0, None).when(key % 5 == 1, 2).otherwise(1000 + home).cast("bigint").alias("destination_id"),
    )
    return lookups.match_picking_type(requests, b["stock_picking_type"]).select("id", "picking_type_id")


def _stocked(b: Business) -> DataFrame:
    return lookups.stocked_products(b["ofc_locations"], b["location_product_rel"])


@query
def c4_fulfilment_center(b: Business) -> DataFrame:
    rows = b["sale_order_line"].select("id", F.col("ofc_id").alias("warehouse_id"), "product_id")
    return lookups.fulfilment_center(rows, b["stock_warehouse"], _stocked(b)).select("id", "ofc_id")


@query
def c5_item_location(b: Business) -> DataFrame:
    rows = b["sale_order_line"].select("id", "ofc_id", "product_id")
    return lookups.item_location(rows, b["ofc_locations"], b["location_product_rel"]).select("id", "ofc_location_id")


@query
def c6_properties(b: Business) -> DataFrame:
    rows, props = b["res_partner"].select("id"), b["ir_property"]
    rows = lookups.resolve_property(
        rows, props, "property_account_receivable_id", "res.partner", "id", "value", "account.account", out="account_id"
    )
    for kind in ("text", "integer", "float", "datetime"):
        rows = lookups.resolve_property(rows, props, "property_limit", "res.partner", "id", kind, out=f"p_{kind}")
    return rows


@query
def c7_client_vendor(b: Business) -> DataFrame:
    return lookups.client_vendor(b["sale_order"])


@query
def c8_account_and_currency(b: Business) -> DataFrame:
    rows = b["sale_order"].select("id", "company_id", (690 + F.col("partner_id")).alias("account_id"))
    rows = lookups.default_currency(lookups.account_type(rows, b["account_account"]), b["res_company"])
    return rows.select("id", "user_type_id", "currency_id", lookups.journal_account(b["account_journal"], "INV").alias("sale_account"))


@query
def c9_agent_warehouse(b: Business) -> DataFrame:
    return lookups.agent_warehouse(b["sale_order"].select("id", "partner_id"), b["res_partner"])


@query
def c10_product_matrix(b: Business) -> DataFrame:
    return lookups.product_matrix(b["stock_warehouse"], b["warehouse_product_rel"], b["product_product"], b["product_template"])


@query
def c11_line_enrichment(b: Business) -> DataFrame:
    lines = b["sale_order_line"].select("id", "order_id", "product_id", "order_partner_id")
    return lookups.enrich_lines(lines, b["sale_order"], b["product_product"], b["product_template"], b["res_partner"])


# -- balances ---------------------------------------------------------------------------------------------------------


@query
def d1_qty_on_hand(b: Business) -> DataFrame:
    return balances.qty_on_hand(b["stock_move"], b["product_uom"], confirming.stock_closure(b))


@query
def d1_qty_on_hand_tree(b: Business) -> DataFrame:
    """Every place of the tree as an ancestor, regions and nations included."""
    return balances.qty_on_hand(b["stock_move"], b["product_uom"], materialize(lookups.location_closure(b["stock_location"])))


@query
def d2_stock_flow_report(b: Business) -> DataFrame:
    closure = materialize(lookups.location_closure(b["stock_location"]))
    return balances.stock_flow_report(b["stock_move"], b["product_uom"], closure, b["product_product"])


@query
def d3_pending_in(b: Business) -> DataFrame:
    return balances.pending_in(b["stock_move"], b["product_uom"], confirming.stock_closure(b), b["stock_picking"])


@query
def d4_pending_out(b: Business) -> DataFrame:
    return balances.pending_out(b["sale_order"], b["sale_order_line"], b["res_partner"], DEMAND_DATE)


@query
def d5_available_qoh(b: Business) -> DataFrame:
    return balances.available_qoh(d1_qty_on_hand(b), d4_pending_out(b), b["stock_warehouse"], b["stock_location"])


@query
def d6_available_by_warehouse(b: Business) -> DataFrame:
    return balances.available_for_pairs(b["warehouse_product_rel"], d5_available_qoh(b), b["stock_warehouse"])


@query
def d6_available_for_product(b: Business) -> DataFrame:
    return balances.available_by_warehouse([7], d5_available_qoh(b), b["stock_warehouse"])


@query
def d7_expected_qoh(b: Business) -> DataFrame:
    lines = b["sale_order_line"].select("order_id", "product_id")
    agents = b["sale_order"].select(F.col("id").alias("order_id"), "partner_id")
    requests = lines.join(agents, "order_id").select("partner_id", "product_id").distinct()
    return balances.expected_qoh(requests, b["res_partner"], b["stock_warehouse"], _stocked(b), d5_available_qoh(b))


@query
def d8_stock_per_location(b: Business) -> DataFrame:
    return balances.stock_per_location(b["stock_quant"], b["product_product"], b["product_template"], b["stock_location"])


# -- order aggregations -----------------------------------------------------------------------------------------------


@query
def d9_previous_agent_orders(b: Business) -> DataFrame:
    return orders.previous_orders(b["sale_order"], "partner_id")


@query
def d10_previous_customer_orders(b: Business) -> DataFrame:
    return orders.previous_orders(b["sale_order"], "customer_id")


@query
def d11_order_prepayment(b: Business) -> DataFrame:
    return orders.order_prepayment(b["account_voucher"]).select("order_id", _dec("prepayment", 4).alias("prepayment"))


@query
def d12_fully_invoiced(b: Business) -> DataFrame:
    return orders.fully_invoiced(b["sale_order"], b["sale_order_line"], b["account_invoice_line"])


@query
def d13_product_origins(b: Business) -> DataFrame:
    return orders.product_origins(confirming.staged(b, CONFIRMED_ON))


@query
def d13_order_names_by_product(b: Business) -> DataFrame:
    names = b["sale_order"].select(F.col("id").alias("order_id"), F.col("name").alias("order_name"))
    return orders.order_names_by_product(b["sale_order_line"].select("order_id", "product_id").join(names, "order_id"))


@query
def d14_pending_orders(b: Business) -> DataFrame:
    return orders.pending_orders(b["sale_order"], b["sale_order_line"], DEMAND_DATE, RUN_DATE)


def _usable(b: Business, deliveries: DataFrame | None = None) -> DataFrame:
    # deliveries and their order lines are both made of the numbered lines
    b.store_lines()
    return fulfilling.usable(b, fulfilling.fresh_waiting(b) if deliveries is None else deliveries, RUN_DATE)


@query
def d15_line_cost(b: Business) -> DataFrame:
    return orders.line_cost(fulfilling.consumption(b, _usable(b)))


# -- confirmation -----------------------------------------------------------------------------------------------------


@query
def e1_confirm_candidates(b: Business) -> DataFrame:
    return confirmation.confirm_candidates(b["sale_order"], RUN_DATE).select("id", "name", "partner_id", "date_order")


@query
def e2_empty_orders(b: Business) -> DataFrame:
    known = confirmation.resolvable_lines(b["sale_order_line"], b["product_product"], b["product_template"])
    return confirmation.split_empty_orders(confirmation.confirm_candidates(b["sale_order"], RUN_DATE), known)[1].select("id", "name")


@query
def e3_order_line_facts(b: Business) -> DataFrame:
    return confirming.line_facts(b, RUN_DATE)


@query
def e3_refilled_locations(b: Business) -> DataFrame:
    lines = b["sale_order_line"].select("id", "product_id", "ofc_id", "ofc_location_id")
    return confirmation.refill_locations(lines, b["ofc_locations"], b["location_product_rel"]).select("id", "ofc_location_id")


@query
def e4_high_value(b: Business) -> DataFrame:
    known = confirmation.resolvable_lines(b["sale_order_line"], b["product_product"], b["product_template"])
    return confirmation.high_value(known, b["product_category"])


@query
def e5_disposition(b: Business) -> DataFrame:
    return confirming.dispositions(b, RUN_DATE, RUN_DATE).select("order_id", "amount", "prepayment", "disposition")


@query
def e6_order_changes(b: Business) -> DataFrame:
    return confirmation.order_changes(confirming.dispositions(b, RUN_DATE, RUN_DATE), RUN_DATE, RUN_DATE)


@query
def e6_line_changes(b: Business) -> DataFrame:
    return confirmation.line_changes(confirming.dispositions(b, RUN_DATE, RUN_DATE), b["sale_order_line"])


@query
def e6_workflow_changes(b: Business) -> DataFrame:
    return confirmation.workflow_changes(confirming.dispositions(b, RUN_DATE, RUN_DATE), b["wkf_instance"])


# -- requisition ------------------------------------------------------------------------------------------------------


@query
def e7_requisition_orders(b: Business) -> DataFrame:
    return requisition.requisition_orders(b["sale_order"], b["res_partner"], CONFIRMED_ON)


@query
def e8_requisition_demand(b: Business) -> DataFrame:
    return requisition.requisition_demand(
        confirming.staged(b, CONFIRMED_ON), b["product_product"], b["product_template"], b["product_category"]
    )


_REQUISITION_KEY = ("product_id", "company_id", "purchase_uom_id", "warehouse_id")


@query
def e9_net_purchase_qty(b: Business) -> DataFrame:
    return confirming.requisition_plan(b, CONFIRMED_ON, RUN_DATE).select(
        *_REQUISITION_KEY, "location_id", "po_qty_ordered", "qtyonhand", "po_qtyonhand", "pending_in", "pending_out", "topurchase_qty"
    )


@query
def e10_reorder_qty(b: Business) -> DataFrame:
    return confirming.requisition_plan(b, CONFIRMED_ON, RUN_DATE).select(
        *_REQUISITION_KEY, "product_min_qty", "product_max_qty", "projected_qty", "required_qty", "reorder_qty"
    )


def _requisition(b: Business) -> tuple[DataFrame, DataFrame]:
    return _requisition_of(b, None)


def _requisition_of(b: Business, staged: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    plan = materialize(confirming.requisition_plan(b, CONFIRMED_ON, RUN_DATE, staged))
    headers = requisition.requisition_headers(plan, b["stock_warehouse"], CONFIRMED_ON, 100, 1, "PR%(year)s-", RUN_DATE)
    return headers, requisition.requisition_lines(plan, headers)


@query
def e11_requisition_headers(b: Business) -> DataFrame:
    return _requisition(b)[0].select("requisition_no", "name", "origin", "warehouse_id", "company_id")


@query
def e11_requisition_lines(b: Business) -> DataFrame:
    return _requisition(b)[1].select(
        "requisition_no", "product_id", "product_uom_id", "company_id", "category", "reorder_qty", "qty_to_purchase", "product_qty", "qty_available"
    )


@query
def e11_requisition_line_orders(b: Business) -> DataFrame:
    staged = materialize(confirming.staged(b, CONFIRMED_ON))
    return requisition.requisition_line_orders(_requisition_of(b, staged)[1], staged)


@query
def e12_confirm_and_requisition(b: Business) -> DataFrame:
    run = confirming.run_confirmation(b.tables(), RUN_DATE, RUN_DATE, True)
    return run["requisition_lines"].select("requisition_no", "product_id", "product_uom_id", "company_id", "qty_to_purchase", "product_qty")


# -- intake and cancellation ------------------------------------------------------------------------------------------


@query
def e13_intake_receipts(b: Business) -> DataFrame:
    return intake.intake_receipts(b["ofs_delivery"])


@query
def e14_duplicate_deliveries(b: Business) -> DataFrame:
    return intake.mark_duplicate_deliveries(b["ofs_delivery"]).select("id", "processed", "remarks")


def _cancellation(b: Business, commission: str = "literal") -> Cancellation:
    return apply_cancellations(b["ofs_cancel_order"], b["sale_order_line"], b["sale_order"], b["sale_order_tax"], commission)


@query
def e15_cancelled_lines(b: Business) -> DataFrame:
    return _cancellation(b).lines.select("id", "state", "product_uom_qty", "commission", "write_uid")


@query
def e15_split_lines(b: Business) -> DataFrame:
    return _cancellation(b).split_lines.select(
        "request_id", "original_line", "order_id", "product_id", "product_uom_qty", "state", "commission", "create_uid"
    )


@query
def e15_proportional_commission(b: Business) -> DataFrame:
    return _cancellation(b, "proportional").lines.select("id", "product_uom_qty", "commission")


@query
def e15_split_taxes(b: Business) -> DataFrame:
    return _cancellation(b).split_taxes


@query
def e15_order_changes(b: Business) -> DataFrame:
    return _cancellation(b).order_changes


@query
def e16_repeated_receipts(b: Business) -> DataFrame:
    receipts = b["ofs_delivery"].filter(intake.unprocessed()).select(*intake.RECEIPT).distinct()
    repeated = intake.split_already_processed(receipts, b["receipt_document"])[1]
    return intake.repeated_changes(b["ofs_delivery"], repeated)


@query
def e16_invoiced_receipts(b: Business) -> DataFrame:
    receipts = invoicing.receipt_orders(fulfilling.fresh_deliveries(b))
    return intake.split_already_processed(receipts, b["receipt_invoice"])[1].select(*intake.RECEIPT, "order_id")


# -- kitting ----------------------------------------------------------------------------------------------------------


@query
def e17_kitting_lines(b: Business) -> DataFrame:
    return fulfilling.with_stock(b, _usable(b))


@query
def e17_receipt_totals(b: Business) -> DataFrame:
    return kitting.receipt_totals(_usable(b))


@query
def e17_invalid_receipts(b: Business) -> DataFrame:
    return kitting.invalid_changes(fulfilling.fresh_deliveries(b), _usable(b))


@query
def e18_stock_exceptions(b: Business) -> DataFrame:
    return kitting.upsert_stock_exceptions(b["stock_exceptions"], e17_kitting_lines(b), RUN_DATE)


@query
def e19_consumed_quants(b: Business) -> DataFrame:
    return fulfilling.consumption(b, _usable(b))


@query
def e19_lot_moves(b: Business) -> DataFrame:
    return kitting.lot_moves(fulfilling.consumption(b, _usable(b)), _usable(b))


@query
def e19_lot_changes(b: Business) -> DataFrame:
    return kitting.lot_changes(fulfilling.consumption(b, _usable(b)), b["stock_quant"])


@query
def e20_transfer_headers(b: Business) -> DataFrame:
    return fulfilling.transfer_headers(b, _usable(b), fulfilling.Counters(), RUN_DATE)


def _moves(b: Business) -> DataFrame:
    return fulfilling.transfer_moves(b, materialize(_usable(b)), None, RUN_DATE)


@query
def e20_transfer_moves(b: Business) -> DataFrame:
    lines = materialize(_usable(b))
    costs = orders.line_cost(fulfilling.consumption(b, lines))
    moves = fulfilling.transfer_moves(b, lines, costs, RUN_DATE)
    return moves.drop("name", "date_expected", "date", "move_dest_leg")


@query
def e21_chained_moves(b: Business) -> DataFrame:
    return kitting.chain_moves(materialize(_moves(b)))


@query
def e21_closed_deliveries(b: Business) -> DataFrame:
    b.store_lines()
    waiting = fulfilling.fresh_waiting(b)
    lines = _usable(b, waiting)
    headers = fulfilling.transfer_headers(b, lines, fulfilling.Counters(), RUN_DATE, kitting.receipt_routes(lines))
    return kitting.delivery_changes(waiting, headers)


# -- invoicing --------------------------------------------------------------------------------------------------------


class Billing:
    """The invoicing stages of the test tables.

    Numbered lines, the order lines that deliveries name, the kit lines' narrow columns and the delivered lines are stored once.
    Receipts with a live picking are left out when moves meet their receipt, so deliveries need not be compared with pickings.
    """

    #: What the lines to invoice need of kit lines.
    KIT = ("delivery_id", *invoicing.LINE_KEY, "partner_id", "product_id", "product_uom", "product_uom_qty", "default_ofc_id")

    def __init__(self, b: Business) -> None:
        self.b = b
        b.store_lines()
        self.deliveries = b["ofs_delivery"]
        self.receipts = fulfilling.fresh_receipts(b, invoicing.receipt_orders(self.deliveries))
        receipts = fulfilling.fresh_receipts(b, invoicing.receipt_order_ids(self.deliveries))
        waiting = intake.waiting_deliveries(self.deliveries)
        named = fulfilling.delivered_order_lines(b, self.deliveries.filter(intake.unprocessed()))
        lines = materialize(fulfilling.usable(named, waiting, RUN_DATE).select(*self.KIT))
        moves = fulfilling.transfer_moves(named, lines, None, RUN_DATE)
        self.delivered = materialize(fulfilling.delivered_lines(named, receipts, moves))
        self.taxes = fulfilling.line_taxes(b, self.delivered)
        self.lines = invoicing.invoice_lines(self.delivered, self.taxes)

    @cached_property
    def headers(self) -> DataFrame:
        return fulfilling.invoice_headers(self.b, self.lines, self.receipts, fulfilling.Counters(), RUN_DATE)


@query
def e22_invoice_lines(b: Business) -> DataFrame:
    return Billing(b).lines


@query
def e23_line_taxes(b: Business) -> DataFrame:
    return Billing(b).taxes.select(*invoicing.LINE_KEY, "tax_id", "tax_name", "tax_account_id", "total_rate", "tax_amount")


@query
def e24_invoice_headers(b: Business) -> DataFrame:
    return Billing(b).headers.drop("origin")


@query
def e25_journal_entries(b: Business) -> DataFrame:
    return invoicing.journal_entries(Billing(b).headers).drop("narration")


@query
def e25_journal_lines(b: Business) -> DataFrame:
    bill = Billing(b)
    return invoicing.journal_lines(bill.headers, bill.lines, bill.taxes, b["account_account"], b["account_journal"])


@query
def e26_tax_summary(b: Business) -> DataFrame:
    return invoicing.tax_summary(Billing(b).taxes)


@query
def e26_line_taxes(b: Business) -> DataFrame:
    return invoicing.line_tax_relation(Billing(b).taxes)


@query
def e26_line_orders(b: Business) -> DataFrame:
    return invoicing.order_line_relation(Billing(b).lines)


@query
def e27_invoiced_deliveries(b: Business) -> DataFrame:
    bill = Billing(b)
    return invoicing.invoiced_changes(bill.deliveries, bill.headers)


# -- valuation --------------------------------------------------------------------------------------------------------


@query
def e28_fifo_allocations(b: Business) -> DataFrame:
    return valuation.fifo_allocations(b["stock_move"])


@query
def e28_fifo_moves(b: Business) -> DataFrame:
    return valuation.fifo_vacuum(b["stock_move"]).moves.drop("company_id", "is_in")


@query
def e29_valuation_corrections(b: Business) -> DataFrame:
    return valuation.valuation_corrections(valuation.fifo_vacuum(b["stock_move"]), b["product_product"]).drop("company_id")
