"""Registered streams: they run over the test tables to the end and return what they stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockloom.operators.intake import DELIVERY_KEY
from stockloom.plans.catalogue import Query
from stockloom.session import materialize, new_folder
from stockloom.sources.schemas import schema
from stockloom.sources.star_schema import STAR_SCHEMA, Business
from stockloom.sources.tables import conform
from stockloom.streaming.cancel_stream import LineState, start_cancellations
from stockloom.streaming.intake_stream import start_intake
from stockloom.streaming.ledger import Ledger


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def s1_event_intake(spark: SparkSession, folder: str) -> DataFrame:
    """Events taken in like deliveries: the smallest id per user, hour and quantity wins."""
    source = spark.readStream.schema(STAR_SCHEMA["events"]).option("maxFilesPerTrigger", 1).parquet(f"{folder}/events.parquet*")
    ledger = Ledger(new_folder(spark, "intake"), schema("ofs_delivery"))

    def prepare(batch: DataFrame) -> DataFrame:
        return conform(
            batch.select(
                F.col("event_id").alias("id"),
                (F.col("user_id") % 10).alias("warehouse_id"),
                F.hour("ts").cast("bigint").alias("receipt_id"),
                F.when(F.col("event_type") != "error", F.col("user_id")).alias("line_id"),
                (F.col("event_id") % 3).alias("qty"),
                (F.col("event_id") % 7 == 0).alias("processed"),
            ),
            "ofs_delivery",
        )

    _run(start_intake(source, ledger, new_folder(spark, "intake-checkpoint"), prepare=prepare))
    return ledger.current(spark, DELIVERY_KEY).select("id", "warehouse_id", "receipt_id", "line_id", "qty")


def s2_cancellations(spark: SparkSession, folder: str) -> DataFrame:
    """Cancellation requests as a stream; the split lines are stored per batch and line changes move on to the next.

    Order lines are numbered over the whole table, which no micro-batch can do, so the queue of requests is written
    with its ids first and then streamed. Requests and lines are stored in the order of their orders, so a batch reads the
    part of the lines that its requests concern and not the whole table.
    """
    business = Business(spark, folder)
    business.store_lines()
    queue, out = new_folder(spark, "request-queue"), new_folder(spark, "cancelled")
    business["ofs_cancel_order"].repartitionByRange("order_id").write.parquet(queue)
    source = spark.readStream.schema(schema("ofs_cancel_order")).option("maxFilesPerTrigger", 4).parquet(queue)
    ledger = Ledger(new_folder(spark, "requests"), schema("ofs_cancel_order"))
    ordered = materialize(business["sale_order_line"].repartitionByRange("order_id").sortWithinPartitions("order_id"))
    lines = LineState(new_folder(spark, "line-changes"), ordered)
    started: dict[int, DataFrame] = {}

    def state(batch_id: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        requests = ledger.between(spark, batch_id, batch_id + 1).drop("batch")
        started[batch_id] = materialize(lines.before(batch_id, requests))
        return started[batch_id], business["sale_order"], business["sale_order_tax"]

    def sink(result, batch_id: int) -> None:
        lines.store(result.lines, batch_id, started.pop(batch_id))
        result.split_lines.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run(start_cancellations(source, ledger, new_folder(spark, "requests-checkpoint"), state, sink))
    return spark.read.parquet(out).select("request_id", "original_line", "order_id", "product_uom_qty", "state")


STREAM_QUERIES: dict[str, Query] = {"s1_event_intake": s1_event_intake, "s2_cancellations": s2_cancellations}
