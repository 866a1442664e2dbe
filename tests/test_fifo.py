"""FIFO repair and lot consumption against plain loops on random small inputs."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockloom.operators.kitting import consume_quants, lot_changes, lot_moves
from stockloom.operators.maintenance import apply_changes
from stockloom.operators.valuation import fifo_vacuum, valuation_corrections

MOVES = (
    "id bigint, product_id bigint, company_id bigint, date date, remaining_qty decimal(18,6), "
    "remaining_value decimal(18,6), price_unit decimal(12,2), is_in boolean, is_out boolean"
)


def random_moves(rng, products):
    out = []
    for n in range(products):
        for _ in range(rng.randint(1, 12) if n else 60):  # product 0 is the hot one
            qty = Decimal(rng.randint(-6, 6)) / 2
            incoming = rng.random() < 0.6
            if not incoming and qty > 0:
                qty = -qty
            price = Decimal(rng.randint(1, 9))
            out.append([len(out) * 37 % 5003, n, 1, date(2020, 1, 1) + timedelta(days=rng.randint(0, 4)), qty, qty * price, price, incoming, not incoming])
    return out


def loop(moves):
    """Each taker in date and id order empties later givers."""
    rows = {m[0]: {"q": m[4], "v": m[5]} for m in moves}
    pairs, taken = {}, {}
    order = sorted(moves, key=lambda m: (m[3], m[0]))
    for m in order:
        if m[4] >= 0 or not (m[7] or m[8]):
            continue
        need, value = -rows[m[0]]["q"], Decimal(0)
        later = [g for g in order if g[1] == m[1] and g[7] and rows[g[0]]["q"] > 0 and (g[3], g[0]) > (m[3], m[0])]
        if not later:
            continue
        for g in later:
            part = min(need, rows[g[0]]["q"])
            if part == 0:
                break
            pairs[(m[0], g[0])] = part
            rows[g[0]]["q"] -= part
            rows[g[0]]["v"] -= part * g[6]
            need, value = need - part, value + part * g[6]
        taken[m[0]] = value
        rows[m[0]] = {"q": -need, "v": Decimal(0) if need == 0 else m[5] + value}
    return pairs, rows, taken


@pytest.mark.parametrize("seed", range(3))
def test_fifo_vacuum(spark, seed):
    moves = random_moves(random.Random(seed), 40)
    pairs, rows, taken = loop(moves)
    repair = fifo_vacuum(spark.createDataFrame(moves, MOVES), pieces=9)
    assert {(r.taker_id, r.giver_id): r.qty for r in repair.allocations.collect()} == pairs
    changed = {r.id: r for r in repair.moves.collect()}
    for m in moves:
        q, v = rows[m[0]]["q"], rows[m[0]]["v"]
        if m[0] in changed:
            assert (changed[m[0]].remaining_qty, changed[m[0]].remaining_value) == (q, v)
        else:
            assert (q, v) == (m[4], m[5])
    products = spark.range(40).select(F.col("id"), F.when(F.col("id") % 2 == 0, "real_time").otherwise("manual").alias("valuation"))
    expected = {}
    for m in moves:
        if m[0] in taken and m[1] % 2 == 0:
            amount = taken[m[0]] + min(m[5], Decimal(0))
            expected[m[0]] = -amount if m[7] else amount
    assert {r.id: r.amount for r in valuation_corrections(repair, products).collect()} == expected


@pytest.mark.parametrize("seed", range(2))
def test_consume_quants(spark, seed):
    rng = random.Random(seed)
    demand = [(i * 31 % 997, 5000 + i, rng.randint(0, 1), rng.choice([0, 0, 1, 2]), rng.randint(1, 5)) for i in range(120)]
    quants = [
        (i * 17 % 499, rng.choice([0, 0, 1, 2]), 100 + rng.randint(0, 1), Decimal(rng.randint(-2, 4)), Decimal(rng.randint(1, 9)),
         None if rng.random() < 0.1 else date(2020, 1, 1) + timedelta(days=rng.randint(0, 3)))
        for i in range(80)
    ]
    stock = {}
    for q in sorted(quants, key=lambda q: (q[5] or date(9999, 12, 31), q[0])):
        if q[3] > 0:
            stock.setdefault((q[2] - 100, q[1]), []).append([q[0], q[3], q[4]])
    expected = {}
    for i, line, wh, product, qty in sorted(demand):
        need = Decimal(qty)
        for lot in stock.get((wh, product), []):
            part = min(need, lot[1])
            if part > 0:
                expected[(i, line, lot[0])] = (part, lot[2])
                lot[1] -= part
                need -= part
        if need > 0:
            expected[(i, line, None)] = (-need, None)
    got = consume_quants(
        spark.createDataFrame(demand, "id bigint, order_line_id bigint, warehouse_id bigint, product_id bigint, qty int"),
        spark.createDataFrame(quants, "id bigint, product_id bigint, location_id bigint, quantity decimal(12,2), unit_cost decimal(12,4), in_date date"),
        spark.createDataFrame([(0, 100), (1, 101)], "warehouse_id bigint, location_id bigint"),
        pieces=7,
    )
    assert {(r.demand_id, r.order_line_id, r.quant_id): (r.quant_qty, r.quant_cost) for r in got.collect()} == expected


def test_a_second_run_leaves_used_lots_alone(spark):
    demand = spark.createDataFrame([(1, 10, 0, 7, 5), (2, 11, 0, 7, 4)], "id bigint, order_line_id bigint, warehouse_id bigint, product_id bigint, qty int")
    quants = [(1, 7, 100, Decimal(3)), (2, 7, 100, Decimal(4)), (3, 7, 100, Decimal(6))]
    lots = spark.createDataFrame([(*q, Decimal(2), date(2020, 1, q[0])) for q in quants], "id bigint, product_id bigint, location_id bigint, quantity decimal(18,4), unit_cost decimal(12,4), in_date date")
    stock = spark.createDataFrame([(0, 100)], "warehouse_id bigint, location_id bigint")
    used = []
    for _ in range(2):
        taken = consume_quants(demand, lots, stock)
        used.append(sorted(((r.demand_id, r.quant_id, int(r.quant_qty)) for r in taken.collect()), key=str))
        places = spark.createDataFrame([(1, 0, 50), (2, 0, 51)], "delivery_id bigint, warehouse_id bigint, receipt_id bigint")
        links = lot_moves(taken, places).collect()
        assert {(r.delivery_id, r.receipt_id, r.leg) for r in links} == {(1, 50, 1), (2, 51, 1)}
        assert all(r.negative == (r.quant_id is None) for r in links)
        lots = apply_changes(lots, lot_changes(taken, lots))
    assert used[0] == sorted([(1, 1, 3), (1, 2, 2), (2, 2, 2), (2, 3, 2)], key=str)
    assert used[1] == sorted([(1, 3, 4), (1, None, -1), (2, None, -4)], key=str)
