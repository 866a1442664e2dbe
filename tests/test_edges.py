"""Hand-made rows for the odd rules."""

from __future__ import annotations

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockloom.operators import balances, confirmation, intake, kitting, lookups, maintenance, orders, requisition
from stockloom.plans.confirmation_run import run_confirmation
from stockloom.operators.invoicing import receipt_orders
from stockloom.plans.fulfilment_run import delivered_lines, fresh_deliveries, run_fulfilment, transfer_moves, usable, with_stock
from stockloom.sources.schemas import schema
from stockloom.sources.star_schema import RUN_DATE
from stockloom.sources.tables import conform, load, load_catalog, save

MOVE = "product_id bigint, product_qty decimal(12,4), product_uom int, location_id bigint, location_dest_id bigint, state string, picking_id bigint"


@pytest.fixture(scope="module")
def uoms(spark):
    return spark.createDataFrame([(1, Decimal("1")), (2, Decimal("0.5"))], "id int, factor decimal(12,6)")


@pytest.fixture(scope="module")
def closure(spark):
    return spark.createDataFrame([(10, 10), (10, 11)], "ancestor_id bigint, descendant_id bigint")


def moves(spark, rows):
    return spark.createDataFrame([(p, Decimal(q), u, s, d, "done", 1) for p, q, u, s, d in rows], MOVE)


def test_on_hand_without_inflow_is_zero(spark, uoms, closure):
    rows = moves(spark, [(1, 5, 1, 10, 99), (2, 6, 2, 99, 11), (2, 1, 1, 11, 98), (3, 4, 1, 10, 11), (4, 4, 1, None, 11)])
    got = {r.product_id: r.qty_on_hand for r in balances.qty_on_hand(rows, uoms, closure).collect()}
    # inner moves and moves from nowhere leave no row
    assert got == {1: 0, 2: Decimal(11)}


def test_flows_of_all_places_equal_a_loop(spark, uoms):
    """Random moves over a random tree: each place counts the moves that cross its border."""
    rng = random.Random(8)
    parent = {i: rng.randrange(i) for i in range(1, 25)}
    above = {i: {i} for i in range(25)}
    for i in range(1, 25):
        above[i] |= above[parent[i]]
    for wanted in (set(range(25)), set(rng.sample(range(25), 7))):
        closure = spark.createDataFrame([(a, d) for d in above for a in above[d] & wanted], "ancestor_id bigint, descendant_id bigint")
        rows = [(rng.randint(1, 3), rng.randint(1, 9), rng.randint(1, 3), *(rng.choice([None, 99, *range(25)]) for _ in range(2))) for _ in range(200)]
        expected = {}
        for p, q, u, s, d in rows:
            if u < 3 and s is not None and d is not None:
                for place in above.get(d, set()) ^ above.get(s, set()):
                    if place in wanted:
                        flow = expected.setdefault((place, p, u), [None, None])
                        k = 0 if place in above.get(d, set()) else 1
                        flow[k] = (flow[k] or 0) + (q if u == 1 else 2 * q)
        got = balances.subtree_flows(moves(spark, rows), uoms, closure).collect()
        assert {(r.location_id, r.product_id, r.product_uom): [r.qty_in, r.qty_out] for r in got} == expected
        assert all((r.has_in, r.has_out) == (r.qty_in is not None, r.qty_out is not None) for r in got)


def test_flow_report_pairs_every_in_unit_with_every_out_unit(spark, uoms, closure):
    rows = moves(spark, [(1, 6, 1, 99, 10), (1, 2, 2, 99, 10), (1, 1, 1, 10, 99), (2, 3, 1, 99, 10)])
    products = spark.createDataFrame([(1, "A", "a", True), (2, "B", "b", True)], "id bigint, default_code string, name string, active boolean")
    got = [tuple(r) for r in balances.stock_flow_report(rows, uoms, closure, products).collect()]
    assert got == [(10, 1, "A", "a", Decimal(8), Decimal(10), Decimal(2))]


def test_available_by_warehouse_keeps_zeros(spark):
    available = spark.createDataFrame([(1, 7, Decimal(3))], "warehouse_id bigint, product_id bigint, available_qoh decimal(12,2)")
    warehouses = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    got = {(r.warehouse_id, r.product_id): r.available_qoh for r in balances.available_by_warehouse([7], available, warehouses).collect()}
    assert got == {(1, 7): 3, (2, 7): 0}


def test_report_drill_down_and_folding(business):
    tables = [business[n] for n in ("stock_quant", "product_product", "product_template", "stock_location")]
    one = balances.stock_per_location(*tables, product_id=5)
    assert {r.level for r in one.select("level").distinct().collect()} == {2, 4}
    folded = balances.stock_per_location(*tables, unfolded=[5])
    assert {r.product_id for r in folded.filter("level = 4").select("product_id").distinct().collect()} == {5}
    assert folded.filter("level = 0").count() == 1


def test_nothing_invoiced_counts_as_fully_invoiced(spark):
    lines = spark.createDataFrame([(1, 1, "confirmed", 2), (2, 2, "confirmed", 2), (3, 3, "confirmed", 2)], "id bigint, order_id bigint, state string, product_uom_qty int")
    invoices = spark.createDataFrame([(2, Decimal(1)), (3, Decimal(2))], "order_line_id bigint, quantity decimal(12,2)")
    got = {r.order_id: r.fully_invoiced for r in orders.fully_invoiced(spark.range(1, 5), lines, invoices).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def test_origin_text_has_no_limit(spark):
    staged = spark.createDataFrame([(1, 1, 1, "SO1"), (1, 1, 2, "SO1"), (1, 2, 3, None), (2, 3, 4, "SO3")], "product_id bigint, order_id bigint, id bigint, order_name string")
    assert {r.product_id: r.origin for r in orders.product_origins(staged).collect()} == {1: "SO1, SO1, ", 2: "SO3"}
    popular = spark.range(1_000_000).selectExpr("1L product_id", "id order_id", "id", "'SO' || lpad(id, 8, '0') order_name")
    assert orders.order_names_by_product(popular).count() == 1_000_000
    lines = spark.createDataFrame([(7, 1)], "requisition_no bigint, product_id bigint")
    assert requisition.requisition_line_orders(lines, popular).count() == 1_000_000
    assert orders.product_origins(popular).selectExpr("length(origin) n").first().n == 12 * 1_000_000 - 2


def test_layaway_orders(spark):
    candidates = spark.createDataFrame(
        [(i, date(2001, 7, 2), date(2001, 7, 5), flag) for i, flag in ((1, True), (2, True), (3, False), (4, False), (5, None))],
        "id bigint, date_order date, date_delivery date, islayaway boolean",
    )
    lines = spark.createDataFrame(
        [(i, price, 1, 1) for i, price in ((1, Decimal(100)), (2, Decimal(100)), (3, Decimal(6000)), (5, Decimal(6000)))],
        "order_id bigint, price_unit decimal(12,2), product_uom_qty int, categ_id bigint",
    )
    categories = spark.createDataFrame([(1, 100)], "id bigint, parent_id bigint")
    vouchers = spark.createDataFrame([(1, Decimal(100), "booked"), (2, Decimal(99), "booked"), (3, Decimal(2999), "booked"), (3, Decimal(9999), "draft")], "order_id bigint, amount decimal(12,4), state string")
    got = {r.order_id: r.disposition for r in confirmation.order_disposition(candidates, lines, categories, vouchers, RUN_DATE).collect()}
    # an unknown layaway flag keeps an unpaid order on hold, a draft voucher does not count
    assert got == {1: "confirm", 2: "hold", 3: "cancel_unpaid", 4: "cancel_empty", 5: "hold"}


def test_header_without_centre_has_no_lines(spark):
    demand = spark.createDataFrame([(1, 1, 5), (None, 1, 6), (1, None, 7)], "warehouse_id bigint, company_id bigint, product_id bigint")
    warehouses = spark.createDataFrame([(1, "Main")], "id bigint, name string")
    heads = requisition.requisition_headers(demand, warehouses, date(1997, 2, 1), 7, 1, None, date(1997, 2, 2))
    got = [(r.requisition_no, r.name, r.warehouse_id, r.company_id) for r in heads.orderBy("requisition_no").collect()]
    assert got == [(7, "(Main)", 1, 1), (8, "(Main)", 1, None), (9, "()", None, 1)]
    assert heads.first().origin == "SOs for 01 Feb 1997"
    assert demand.join(heads, ["warehouse_id", "company_id"]).count() == 1


def test_update_takes_smallest_source_and_keeps_unmatched(spark):
    target = spark.createDataFrame([(1, 5), (2, 6)], "id int, v int")
    source = spark.createDataFrame([(1, 9, 2), (1, 8, 1)], "id int, w int, rank int")
    got = {r.id: r.v for r in maintenance.update_from(target, source, ["id"], {"v": F.col("source.w")}, ["rank"]).collect()}
    assert got == {1: 8, 2: 6}


def test_exceptions_add_up_and_insert(spark):
    shape = schema("stock_exceptions")
    day = RUN_DATE
    table = spark.createDataFrame([(1, 1, day, "new", 3, 4, 9), (1, 2, day, "done", 3, 4, 9), (1, 4, day, "new", 1, 1, 1)], shape)
    rows = [(1, 1, 1, 2, 100), (1, 1, 1, 3, 100), (1, 2, 1, 5, 1), (1, 3, 1, 5, 9)]
    lines = spark.createDataFrame(rows, "warehouse_id bigint, product_id bigint, receipt_id bigint, product_uom_qty int, product_qoh int")
    out = kitting.upsert_stock_exceptions(table, lines, day)
    got = sorted((r.product_id, r.state, r.initial_qoh, r.kitted_qty, r.adjusted_qty) for r in out.collect())
    assert got == [(1, "new", 3, 9, 0), (2, "done", 3, 4, 9), (2, "new", 1, 5, 0), (4, "new", 1, 1, 1)]


def test_duplicates_need_line_and_quantity(spark):
    rows = [(i, 1, 1, line, qty, done) for i, line, qty, done in ((5, 1, 2, False), (3, 1, 2, False), (1, 1, 2, True), (6, None, 2, False), (7, None, 2, False), (8, 1, None, False))]
    df = conform(spark.createDataFrame(rows, "id bigint, warehouse_id bigint, receipt_id bigint, line_id bigint, qty int, processed boolean"), "ofs_delivery")
    got = {r.id: r.remarks for r in intake.mark_duplicate_deliveries(df).collect()}
    assert {k for k, v in got.items() if v} == {5}


def test_intake_limit(business):
    assert intake.intake_receipts(business["ofs_delivery"], 7).count() == 7
    waiting = business["ofs_delivery"].filter("not processed").select("warehouse_id", "receipt_id").distinct()
    assert intake.intake_receipts(business["ofs_delivery"]).count() == waiting.count()


def test_closure_of_wide_intervals(spark):
    spans = {1: (0, 2**48 - 1), 2: (5, 5), 3: (2**47, 2**47 + 9), 4: (1, 2**49), 5: (2**48 + 5, 2**48 + 5), 6: (0, 2**62 - 1), 7: (2**61 + 3, 2**61 + 3)}
    rows = [(i, str(i), str(i), a, b) for i, (a, b) in spans.items()]
    df = spark.createDataFrame(rows, "id bigint, name string, complete_name string, parent_left bigint, parent_right bigint")
    got = {(r.ancestor_id, r.descendant_id) for r in lookups.location_closure(df).collect()}
    assert got == {(i, j) for i, (a, b) in spans.items() for j, (left, _) in spans.items() if a <= left <= b}


def test_unknown_location_type_is_null(spark, business):
    for kind, expected in (("transit", None), ("loss", 4), ("customer", 2), ("procurement", None)):
        rows = lookups.locations_of_type(business["stock_warehouse"], business["stock_location"], kind)
        assert {r.location_id for r in rows.collect()} == {expected}


def test_tables_round_trip(spark, business, tmp_path):
    save(business["sale_order"], f"{tmp_path}/sale_order")
    assert load(spark, str(tmp_path), "sale_order").schema == schema("sale_order")
    load_catalog(spark, str(tmp_path), ["sale_order"])
    assert spark.sql("select count(*) as n from sale_order").first().n == business["sale_order"].count()


def test_sunday_run_changes_nothing(business):
    run = run_confirmation(business.tables(), date(2001, 7, 29), date(2001, 7, 29), False)
    assert run["orders"].count() == 0 and run["line_facts"].count() == 0


def test_fulfilment_run_balances(business):
    run = run_fulfilment(business.tables(), RUN_DATE, limit=200)
    sums = run["journal_lines"].groupBy("warehouse_id", "receipt_id").agg(F.sum("balance").alias("b")).filter("b <> 0")
    assert sums.count() == 0
    assert run["invoices"].count() > 0
    receipts = run["kit_lines"].select(*intake.RECEIPT).distinct().count()
    assert receipts <= 200
    # every line but the last leg has a successor
    moves = run["transfer_moves"]
    chained = kitting.chain_moves(moves)
    assert chained.count() == moves.filter("leg < 3").count()
    assert chained.join(moves, [*intake.RECEIPT, "delivery_id", "leg"]).filter("next_leg <> move_dest_leg").count() == 0


def test_picking_and_invoice_guards_are_separate(business):
    """A live invoice keeps a receipt from being invoiced again, but not from being kitted."""
    live = business["receipt_invoice"].filter("state <> 'cancel'").select("warehouse_id", "receipt_id")
    pickings = business["receipt_document"].filter("state <> 'cancel'").select("warehouse_id", "receipt_id")
    fresh = fresh_deliveries(business)
    lines = usable(business, fresh, RUN_DATE)
    invoiced = live.join(pickings, ["warehouse_id", "receipt_id"], "left_anti")
    assert lines.join(invoiced, ["warehouse_id", "receipt_id"], "left_semi").count() > 0
    assert lines.join(pickings, ["warehouse_id", "receipt_id"], "left_semi").count() == 0
    moves = transfer_moves(business, with_stock(business, lines), None, RUN_DATE)
    billed = delivered_lines(business, receipt_orders(fresh), moves)
    assert billed.count() > 0 and billed.join(live, ["warehouse_id", "receipt_id"], "left_semi").count() == 0
