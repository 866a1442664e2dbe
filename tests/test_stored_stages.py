"""Stages that several outputs read, and keys that very many rows share."""

from __future__ import annotations

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import DATA
from stockloom.operators import balances, intake, lookups
from stockloom.plans import catalogue
from stockloom.session import materialize
from stockloom.sources.star_schema import Business

MOVE = "id bigint, product_id bigint, product_uom int, product_qty int, location_id bigint, location_dest_id bigint"


def plan(df):
    return df._jdf.queryExecution().toString()


def test_flows_are_not_gathered_by_a_frequent_place(spark):
    """All moves end at place 2: neither end alone may be what the flows are dealt by."""
    locations = spark.createDataFrame(
        [(1, "a", "a", 0, 9), (2, "b", "b", 1, 2), (3, "c", "c", 3, 6), (4, "d", "d", 4, 5)],
        "id bigint, name string, complete_name string, parent_left bigint, parent_right bigint",
    )
    closure = materialize(lookups.location_closure(locations))
    moves = spark.createDataFrame([(i, i % 3, 1, 2, 3 + i % 2, 2) for i in range(12)] + [(12, 1, 1, 5, 4, 3), (13, 1, 1, 7, 4, None)], MOVE)
    uoms = spark.createDataFrame([(1, 1.0)], "id int, factor double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flows = balances.subtree_flows(moves, uoms, closure)
        text = plan(flows)
        rows = {(r.location_id, r.product_id): (r.qty_in, r.qty_out) for r in flows.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = text.split("== Physical Plan ==")[1].splitlines()
    below = [dealt[i + 1 : i + 8] for i, line in enumerate(dealt) if "hashpartitioning(array(location" in line]
    # only the distinct pairs of places are dealt by one end, and these carry no quantity
    assert below and not any("qty" in line for lines in below for line in lines)
    assert rows[2, 0] == (8, None) and rows[3, 1] == (None, 8) and rows[4, 1] == (None, 9) and not any(k[0] == 1 for k in rows)


def test_few_ids_in_many_rows_are_looked_up_without_gathering_them(spark):
    rows = materialize(spark.range(0, 5000, 1, 4).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 4).alias("partner_id")))
    partners = materialize(spark.range(1, 200_000).unionByName(spark.range(1, 2)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        found = lookups.only_known(rows, partners, "partner_id")
        text = plan(found).split("== Physical Plan ==")[1]
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
        expected = [i for i in range(5000) if i % 10 and i % 4]
        assert sorted(r.id for r in found.collect()) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_invoices_number_the_order_lines_once(spark):
    """What the plan still has to do reads stored stages, not the order lines of the test tables again."""
    b = Business(spark, DATA)
    bill = catalogue.Billing(b)
    assert b._stored and not any("lineitem" in f for f in bill.deliveries.inputFiles() + bill.delivered.inputFiles())
    assert not any("lineitem" in f for f in b["ofs_delivery"].inputFiles() + b["sale_order_line"].inputFiles())


def test_transfer_headers_read_stored_receipts(spark):
    headers = entry.queries()["e20_transfer_headers"](spark, DATA)
    assert headers.inputFiles() and not any("lineitem" in f for f in headers.inputFiles())


def test_waiting_deliveries_are_those_that_marking_leaves(spark):
    rows = [(1, 1, 5, 10, 2, False), (2, 1, 5, 10, 2, False), (3, 1, 5, 10, 3, None), (4, 1, 5, None, 2, False), (5, 1, 5, None, 2, False)]
    rows += [(6, None, 5, 10, 2, False), (7, 1, 6, 10, 2, True), (8, 1, 6, 10, 2, False), (9, 1, 6, 10, None, False)]
    df = spark.createDataFrame(
        [(*row, f"r{row[0]}") for row in rows],
        "id bigint, warehouse_id bigint, receipt_id bigint, line_id bigint, qty int, processed boolean, receipt_ref string",
    ).withColumn("remarks", F.lit(None).cast("string"))
    expected = intake.mark_duplicate_deliveries(df).filter(intake.unprocessed())
    got = intake.waiting_deliveries(df)
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str) and got.count() == 6


def exchanges(df):
    return plan(df).split("== Physical Plan ==")[1].count("Exchange hashpartitioning")


def test_invoicing_deals_deliveries_and_receipts_less_often(spark):
    """Without broadcasts, as for large tables: the rows of deliveries and headers are not dealt once more for each lookup."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = Business(spark, DATA)
        assert exchanges(intake.waiting_deliveries(b["ofs_delivery"])) < exchanges(
            intake.mark_duplicate_deliveries(b["ofs_delivery"]).filter(intake.unprocessed())
        )
        bill = catalogue.Billing(b)
        # the receipts' orders meet the moves without the wide leading row, and the stored kit lines hold no texts
        assert not any(c in bill.KIT for c in ("product_name", "order_name", "receipt_ref", "weight"))
        headers = bill.headers
        assert "__record" not in plan(headers)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
