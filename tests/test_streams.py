"""Streams over several files store what one batch gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stockloom.operators.cancellation import apply_cancellations
from stockloom.operators.intake import DELIVERY_KEY, mark_duplicate_deliveries, unprocessed
from stockloom.session import new_folder
from stockloom.sources.schemas import schema
from stockloom.sources.tables import conform
from stockloom.streaming.catalogue import STREAM_QUERIES
from stockloom.streaming.cancel_stream import LineState, start_cancellations
from stockloom.streaming.intake_stream import accept_deliveries, start_intake
from stockloom.streaming.ledger import Ledger


def _split(df, folder, parts=4, by="id"):
    """Files in no particular order of ids."""
    for i in range(parts):
        part = df.filter(F.pmod(F.xxhash64(F.lit(17), by), F.lit(parts)) == i)
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def test_intake_stream(spark, business):
    folder = _split(business["ofs_delivery"], new_folder(spark, "deliveries"))
    source = spark.readStream.schema(schema("ofs_delivery")).option("maxFilesPerTrigger", 1).parquet(folder)
    ledger = Ledger(new_folder(spark, "ledger"), schema("ofs_delivery"))
    seen = []
    start_intake(source, ledger, new_folder(spark, "cp"), process=lambda df, i: seen.append((i, df.count()))).awaitTermination()
    expected = mark_duplicate_deliveries(business["ofs_delivery"]).filter(unprocessed())
    assert sorted(r.id for r in ledger.current(spark, DELIVERY_KEY).collect()) == sorted(r.id for r in expected.collect())
    assert len(seen) == 4 and sum(n for _, n in seen) == ledger.rows(spark).count() >= expected.count()


def test_replayed_batch_changes_nothing(spark, business):
    ledger = Ledger(new_folder(spark, "ledger"), schema("ofs_delivery"))
    rows = business["ofs_delivery"]
    for batch_id in (0, 1, 1):
        ledger.write(accept_deliveries(rows, ledger.before(spark, batch_id)), batch_id)
    kept = mark_duplicate_deliveries(rows).filter(unprocessed())
    undated = kept.filter("line_id is null or qty is null").count()
    assert ledger.rows(spark).count() == kept.count() + undated


def test_cancel_stream(spark, business):
    folder = _split(business["ofs_cancel_order"], new_folder(spark, "requests"))
    source = spark.readStream.schema(schema("ofs_cancel_order")).option("maxFilesPerTrigger", 2).parquet(folder)
    ledger = Ledger(new_folder(spark, "ledger"), schema("ofs_cancel_order"))
    first = (business["sale_order_line"], business["sale_order"], business["sale_order_tax"])
    lines = LineState(new_folder(spark, "state"), first[0])

    def sink(result, batch_id):
        lines.store(result.lines, batch_id)

    start_cancellations(source, ledger, new_folder(spark, "cp"), lambda i: (lines.before(i), *first[1:]), sink).awaitTermination()
    batch = apply_cancellations(business["ofs_cancel_order"], *first).lines.select("id", "state", "product_uom_qty")
    streamed = lines.before(9).select("id", "state", "product_uom_qty")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_later_batches_see_earlier_reductions(spark, business):
    line = business["sale_order_line"].filter("product_uom_qty >= 3").orderBy("id").first()
    lines = LineState(new_folder(spark, "state"), business["sale_order_line"])
    request = spark.createDataFrame([(1, line.order_id, line.ofc_id, 7, line.id, 1, False)], "id bigint, order_id bigint, ofc_id bigint, user_id bigint, line_id bigint, cancelled_qty int, processed boolean")
    for batch_id in (0, 1, 1):
        lines.store(apply_cancellations(request, lines.before(batch_id), business["sale_order"], business["sale_order_tax"]).lines, batch_id)
    assert lines.before(2).filter(F.col("id") == line.id).first().product_uom_qty == line.product_uom_qty - 2
    assert lines.changes.rows(spark).count() == 2


def test_a_batch_reads_the_last_snapshot_and_what_came_since(spark):
    """Thirty batches, some replayed: the same lines as from all changes, out of a bounded number of folders."""
    shape = "id bigint, product_uom_qty int, commission decimal(12,2), state string, write_uid bigint"
    first = spark.createDataFrame([(i, 50, None, "confirmed", None) for i in range(20)], shape)
    lines = LineState(new_folder(spark, "state"), first, every=4)
    quantity = {i: 50 for i in range(20)}
    for batch_id in (0, 1, 2, 3, 3, 4, 5, 6, 7, 7, *range(8, 14)):
        before = {r.id: r.product_uom_qty for r in lines.before(batch_id).collect()}
        hit = {batch_id % 20, batch_id * 7 % 20}
        lines.store(spark.createDataFrame([(i, q - (i in hit), None, "confirmed", None) for i, q in before.items()], shape), batch_id)
        quantity = {i: q - (i in hit) for i, q in before.items()}
    assert {r.id: r.product_uom_qty for r in lines.before(14).collect()} == quantity
    assert sum(50 - q for q in quantity.values()) == sum(len({b % 20, b * 7 % 20}) for b in range(14))
    assert lines.snapshots.batches(spark) == [3, 7, 11]
    read = {f.rsplit("/", 2)[1] for f in lines.changed(14).inputFiles()}
    assert read == {"batch=11", "batch=12", "batch=13"}
    # a replay of batch 11 does not see its own snapshot
    read = {f.rsplit("/", 2)[1] for f in lines.changed(11).inputFiles()}
    assert read == {"batch=7", "batch=8", "batch=9", "batch=10"}


def test_a_ledger_with_a_horizon_looks_back_so_far_only(spark):
    ledger = Ledger(new_folder(spark, "ledger"), schema("ofs_delivery"), horizon=2)
    row = spark.createDataFrame([(9, 1, 1, 1, 2, False)], "id bigint, warehouse_id bigint, receipt_id bigint, line_id bigint, qty int, processed boolean")
    row = conform(row, "ofs_delivery")
    accepted = []
    for batch_id, rows in enumerate([row, row, row.limit(0), row.limit(0), row]):
        ledger.write(accept_deliveries(rows, ledger.before(spark, batch_id)), batch_id)
        accepted.append(ledger.between(spark, batch_id, batch_id + 1).count())
        assert len(ledger.before(spark, batch_id).inputFiles()) <= 2 * 4
    assert accepted == [1, 0, 0, 0, 1]


def test_queries_do_not_depend_on_the_files(spark):
    whole = "/root/testdata/sf0.001"
    cut = new_folder(spark, "cut")
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        df = spark.read.parquet(f"{whole}/{name}.parquet")
        _split(df, f"{cut}/{name}.parquet", 4, df.columns[0]) if name in ("lineitem", "events") else df.write.parquet(f"{cut}/{name}.parquet")
    for query in STREAM_QUERIES.values():
        one, many = ([tuple(r) for r in query(spark, folder).collect()] for folder in (whole, cut))
        assert sorted(one, key=str) == sorted(many, key=str) and one


def test_only_a_missing_ledger_is_empty(spark, tmp_path):
    ledger = Ledger(f"{tmp_path}/ledger", schema("ofs_delivery"))
    assert ledger.rows(spark).count() == 0
    (tmp_path / "ledger" / "batch=0").mkdir(parents=True)
    (tmp_path / "ledger" / "batch=0" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        ledger.rows(spark).collect()


def test_a_batch_works_on_the_lines_its_requests_concern(spark):
    """Requests by line, by order, for a line of another order and for unknown ones: the same changes as from all lines."""
    shape = "id bigint, order_id bigint, ofc_id bigint, product_uom_qty int, commission decimal(12,2), state string, product_id bigint, product_uom int, price_unit decimal(12,2), name string, company_id bigint, order_partner_id bigint"
    rows = [(i, i // 4, 1, 5, None, "confirmed", i, 1, None, f"n{i}", 1, 1) for i in range(4000)] + [(None, None, 1, 5, None, "confirmed", 1, 1, None, "n", 1, 1)]
    first = spark.createDataFrame(rows, shape)
    requests = spark.createDataFrame(
        [(1, 5, 1, 7, 21, 2, False), (2, 900, 1, 7, None, 0, False), (3, 6, 1, 7, 3000, 1, False), (4, 7, 2, 7, 29, 9, False), (5, None, 1, 7, 9999, 1, False), (6, 10**15, 1, 7, None, 1, False)],
        "id bigint, order_id bigint, ofc_id bigint, user_id bigint, line_id bigint, cancelled_qty int, processed boolean",
    )
    orders, taxes = spark.range(1000), spark.createDataFrame([(21, 1)], "order_line_id bigint, tax_id int")
    whole, part = (LineState(new_folder(spark, "state"), first) for _ in range(2))
    assert {r.id for r in part.before(0, requests).collect()} == {*range(20, 32), *range(3600, 3604), 3000}
    assert part.before(0, requests.limit(0)).count() == 0
    for batch_id in (0, 1):
        all_lines, near = whole.before(batch_id), part.before(batch_id, requests)
        one, two = (apply_cancellations(requests, x, orders, taxes) for x in (all_lines, near))
        for name in ("split_lines", "split_taxes", "order_changes"):
            assert sorted(map(str, getattr(one, name).collect())) == sorted(map(str, getattr(two, name).collect()))
        whole.store(one.lines, batch_id)
        part.store(two.lines, batch_id, near)
        assert sorted(map(str, whole.changes.rows(spark).collect())) == sorted(map(str, part.changes.rows(spark).collect()))
    assert part.changes.rows(spark).count() > 4
