"""Registered queries against their SQL on the smallest data set; STOCKLOOM_ALL=1 runs every query."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import assert_same
from conftest import DATA

CORE = (
    "a3_update_from",
    "a4_apply_changes",
    "a6_document_numbers",
    "b1_datediff",
    "b3_tax_amount",
    "c1_location_closure",
    "c3_picking_type",
    "c6_properties",
    "d1_qty_on_hand_tree",
    "d2_stock_flow_report",
    "d5_available_qoh",
    "d8_stock_per_location",
    "d12_fully_invoiced",
    "d13_product_origins",
    "e3_order_line_facts",
    "e5_disposition",
    "e10_reorder_qty",
    "e14_duplicate_deliveries",
    "e15_cancelled_lines",
    "e17_kitting_lines",
    "e18_stock_exceptions",
    "e19_consumed_quants",
    "e20_transfer_headers",
    "e25_journal_lines",
    "e28_fifo_allocations",
    "e29_valuation_corrections",
    "s1_event_intake",
)
#: The business queries; those of the training-data operators have tests of their own.
NAMES = (*entry.QUERIES, *entry.STREAM_QUERIES) if os.environ.get("STOCKLOOM_ALL") else CORE


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert_same(entry.queries()[name](spark, DATA), duck, entry.oracle_sql()[name])


def test_every_query_has_sql():
    business = {**entry.QUERIES, **entry.STREAM_QUERIES}
    assert set(business) == set(entry.STATEMENTS) | set(entry.STREAM_STATEMENTS)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
