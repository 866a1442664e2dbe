"""The set form of cancellations against a request-by-request loop."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest

from stockloom.operators.cancellation import apply_cancellations

LINES = (
    "id bigint, order_id bigint, ofc_id bigint, product_uom_qty int, commission decimal(12,2), state string, product_id bigint, "
    "product_uom int, price_unit decimal(12,2), name string, company_id bigint, order_partner_id bigint"
)
REQUESTS = "id bigint, order_id bigint, ofc_id bigint, user_id bigint, line_id bigint, cancelled_qty int, processed boolean"


def case(rng):
    lines = [
        (i, i % 12, rng.randint(0, 2), rng.choice([None, 1, 3, 5, 8]), Decimal(10), rng.choice(["confirmed", "draft"]), i, 1, Decimal(2), f"n{i}", 1, 1)
        for i in range(1, 60)
    ]
    requests = []
    for i in range(1, 70):
        line = rng.choice([None, 0] + [rng.randint(1, 75)] * 5)
        order, ofc = (line % 12, lines[line - 1][2]) if line and line < 60 else (rng.randint(0, 14), rng.randint(0, 2))
        if rng.random() < 0.2:
            ofc += 1
        requests.append((i, order, ofc, i % 7, line, rng.choice([None, 0, 1, 2, 4, 9]), rng.random() < 0.1))
    return lines, requests


def loop(lines, requests):
    state = {x[0]: {"order": x[1], "ofc": x[2], "qty": x[3], "com": x[4], "state": x[5]} for x in lines}
    before = {k: v["qty"] for k, v in state.items()}
    splits, cancelled = {}, {}
    for i, order, ofc, user, line, qty, done in requests:
        if done:
            continue
        if not line:
            for v in state.values():
                if (v["order"], v["ofc"]) == (order, ofc):
                    v["state"] = "cancel"
        else:
            ordered = before.get(line, 0)
            row = state.get(line)
            here = row and (row["order"], row["ofc"]) == (order, ofc)
            if ordered is not None and qty is not None and qty < ordered:
                if here:
                    splits[i] = (line, qty)
                row["com"] = row["com"] * int((ordered - qty) / ordered)
                row["qty"] -= qty
                if row["qty"] < 0:
                    row["qty"], row["com"] = 0, Decimal(0)
            elif here:
                row["state"] = "cancel"
        if order < 12 and not any(v["order"] == order and v["state"] == "confirmed" for v in state.values()):
            cancelled[order] = user
    return state, splits, cancelled


@pytest.mark.parametrize("seed", range(4))
def test_set_form_equals_loop(spark, seed):
    lines, requests = case(random.Random(seed))
    state, splits, cancelled = loop(lines, requests)
    orders = spark.range(12)
    taxes = spark.createDataFrame([(x[0], 3) for x in lines if x[0] % 2], "order_line_id bigint, tax_id int")
    out = apply_cancellations(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(lines, LINES), orders, taxes)
    got = {r.id: (r.product_uom_qty, r.commission, r.state) for r in out.lines.collect()}
    assert got == {k: (v["qty"], v["com"], v["state"]) for k, v in state.items()}
    assert {r.request_id: (r.original_line, r.product_uom_qty) for r in out.split_lines.collect()} == splits
    assert {(r.request_id, r.tax_id) for r in out.split_taxes.collect()} == {(k, 3) for k, v in splits.items() if v[0] % 2}
    assert {r.id: r.write_uid for r in out.order_changes.collect()} == cancelled
    assert {r.id for r in out.request_changes.collect()} == {r[0] for r in requests if not r[6]}


def test_proportional_parts_sum_to_the_original(spark):
    lines = [(1, 1, 1, 5, Decimal(10), "confirmed", 1, 1, Decimal(2), "n", 1, 1)]
    requests = [(i, 1, 1, 1, 1, q, False) for i, q in ((1, 2), (2, 1))]
    taxes = spark.createDataFrame([], "order_line_id bigint, tax_id int")
    out = apply_cancellations(
        spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(lines, LINES), spark.range(5), taxes, "proportional"
    )
    parts = [r.commission for r in out.lines.collect()] + [r.commission for r in out.split_lines.collect()]
    assert sum(parts) == Decimal(10)


def test_over_cancelled_line_stops_at_zero(spark):
    lines = [(1, 1, 1, 5, Decimal(10), "confirmed", 1, 1, Decimal(2), "n", 1, 1)]
    requests = [(i, 1, 1, 1, 1, q, False) for i, q in ((1, 2), (2, 2), (3, 4))]
    taxes = spark.createDataFrame([], "order_line_id bigint, tax_id int")
    out = apply_cancellations(spark.createDataFrame(requests, REQUESTS), spark.createDataFrame(lines, LINES), spark.range(5), taxes)
    assert [r.product_uom_qty for r in out.lines.collect()] == [0]
    assert sorted(r.product_uom_qty for r in out.split_lines.collect()) == [2, 2, 4]
