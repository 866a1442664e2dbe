"""Confirm draft orders and, if asked, requisition what they need."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, functions as F

from stockloom.operators import balances, confirmation, lookups, maintenance, orders as order_ops, requisition
from stockloom.session import materialize

#: Document counter of requisitions unless the caller passes another.
REQUISITION_COUNTER = {"start": 1, "increment": 1, "prefix": "PR/%(year)s/"}


def dispositions(tables: Mapping[str, DataFrame], run_date: date, today: date, order_id: int | None = None) -> DataFrame:
    candidates = confirmation.confirm_candidates(tables["sale_order"], run_date, order_id)
    known = confirmation.resolvable_lines(tables["sale_order_line"], tables["product_product"], tables["product_template"])
    return confirmation.order_disposition(candidates, known, tables["product_category"], tables["account_voucher"], today)


def line_facts(tables: Mapping[str, DataFrame], run_date: date) -> DataFrame:
    candidates = confirmation.confirm_candidates(tables["sale_order"], run_date)
    known = confirmation.resolvable_lines(tables["sale_order_line"], tables["product_product"], tables["product_template"])
    return confirmation.order_line_facts(
        candidates,
        known,
        tables["sale_order"],
        tables["product_category"],
        tables["res_partner"],
        tables["stock_warehouse"],
        lookups.stocked_products(tables["ofc_locations"], tables["location_product_rel"]),
        tables["ofc_locations"],
        tables["location_product_rel"],
    )


def staged(tables: Mapping[str, DataFrame], run_date: date) -> DataFrame:
    """Lines of the orders to requisition."""
    return requisition.staged_lines(
        requisition.requisition_orders(tables["sale_order"], tables["res_partner"], run_date),
        tables["sale_order_line"],
        tables["product_product"],
        tables["product_template"],
        tables["product_uom"],
        tables["stock_warehouse"],
        lookups.stocked_products(tables["ofc_locations"], tables["location_product_rel"]),
    )


def stock_closure(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Subtrees of the warehouses' stock places only, stored."""
    places = tables["stock_warehouse"].select(F.col("lot_stock_id").alias("id"))
    return materialize(lookups.location_closure(tables["stock_location"], places).select("ancestor_id", "descendant_id"))


def requisition_plan(
    tables: Mapping[str, DataFrame], run_date: date, today: date, rows: DataFrame | None = None
) -> DataFrame:
    """Demand of the run date, netted and with reorder quantities; ``rows`` are its staged lines, if these are stored already."""
    rows = staged(tables, run_date) if rows is None else rows
    demand = materialize(
        requisition.requisition_demand(rows, tables["product_product"], tables["product_template"], tables["product_category"])
    )
    # only moves of products in demand matter
    moves = tables["stock_move"].join(demand.select("product_id").distinct(), "product_id", "left_semi")
    net = requisition.net_purchase_qty(
        demand,
        tables["stock_warehouse"],
        tables["stock_location"],
        balances.stock_and_pending_in(moves, tables["product_uom"], stock_closure(tables), tables["stock_picking"]),
        order_ops.pending_orders(tables["sale_order"], tables["sale_order_line"], run_date, today),
    )
    return requisition.reorder_qty(net, tables["stock_warehouse_orderpoint"])


def run_confirmation(
    tables: Mapping[str, DataFrame],
    run_date: date,
    today: date,
    create_requisition: bool,
    counter: Mapping[str, object] = REQUISITION_COUNTER,
    checkpoint: bool = True,
) -> dict[str, DataFrame]:
    """All change sets of one run; nothing happens on a Sunday.

    The requisition part works on the confirmed orders of ``run_date``, so it sees this run's confirmations only if
    ``run_date`` is ``today``. ``checkpoint`` stores the dispositions, which several outputs
    read, and the requisition plan.
    """
    decided = dispositions(tables, run_date, today)
    facts = line_facts(tables, run_date)
    if today.weekday() == 6:
        decided, facts = decided.filter(F.lit(False)), facts.filter(F.lit(False))
    elif checkpoint:
        decided = materialize(decided)
    order_changes = confirmation.order_changes(decided, run_date, today)
    line_changes = confirmation.line_changes(decided, tables["sale_order_line"])
    out = {"dispositions": decided, "line_facts": facts, "orders": order_changes, "order_lines": line_changes}
    if "wkf_instance" in tables:
        out["workflow"] = confirmation.workflow_changes(decided, tables["wkf_instance"])
    if create_requisition:
        # Line states play no part in the requisition, so only the orders are brought up to date.
        after = dict(tables)
        after["sale_order"] = maintenance.apply_changes(tables["sale_order"], order_changes)
        plan = requisition_plan(after, run_date, today)
        if checkpoint:
            plan = materialize(plan)
        headers = requisition.requisition_headers(plan, tables["stock_warehouse"], run_date, on_date=today, **counter)
        out["requisitions"] = headers
        out["requisition_lines"] = requisition.requisition_lines(plan, headers)
        out["requisition_line_orders"] = requisition.requisition_line_orders(out["requisition_lines"], staged(after, run_date))
        out["requisitioned"] = requisition.requisitioned_changes(
            requisition.requisition_orders(after["sale_order"], tables["res_partner"], run_date)
        )
    return out
