"""Delivery intake: batches, duplicate marking and guards against running twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DUPLICATE_REMARK = "possible duplicate"
PICKING_REMARK = "Duplicate Stock Picking Detected"
RECEIPT = ["warehouse_id", "receipt_id"]
DELIVERY_KEY = [*RECEIPT, "line_id", "qty"]


def unprocessed() -> Column:
    return F.coalesce(~F.col("processed"), F.lit(False))


def intake_receipts(deliveries: DataFrame, limit: int | None = None) -> DataFrame:
    """Receipts with unprocessed deliveries; with ``limit`` only the first ones in key order."""
    waiting = deliveries.filter(unprocessed()).select(*RECEIPT).distinct()
    return waiting if limit is None else waiting.orderBy(*RECEIPT).limit(limit)


def of_receipts(rows: DataFrame, receipts: DataFrame) -> DataFrame:
    return rows.join(receipts.select(*RECEIPT), RECEIPT, "left_semi")


def kept_deliveries(deliveries: DataFrame) -> DataFrame:
    """``(id)`` of the unprocessed delivery kept per warehouse, receipt, line and quantity: the smallest id."""
    complete = deliveries.filter(unprocessed()).dropna(subset=DELIVERY_KEY)
    return complete.groupBy(*DELIVERY_KEY).agg(F.min("id").alias("id")).select("id")


def mark_duplicate_deliveries(deliveries: DataFrame) -> DataFrame:
    """All deliveries, later copies marked processed with a remark; rows without line or quantity are never copies.

    Copies are recognised by joining on the row id, which is unique, so a line delivered very often stays spread.
    """
    kept = kept_deliveries(deliveries).withColumn("__kept", F.lit(True))
    complete = F.lit(True)
    for name in DELIVERY_KEY:
        complete = complete & F.col(name).isNotNull()
    copy = unprocessed() & complete & F.col("__kept").isNull()
    marked = deliveries.join(kept, "id", "left").withColumns(
        {
            "remarks": F.when(copy, DUPLICATE_REMARK).otherwise(F.col("remarks")),
            "processed": F.col("processed") | copy,
        }
    )
    return marked.select(*deliveries.columns)


def waiting_deliveries(deliveries: DataFrame) -> DataFrame:
    """What :func:`mark_duplicate_deliveries` leaves unprocessed, for plans that need no other deliveries.

    Copies fall together in an aggregate, which is combined before it is shuffled, so the deliveries themselves are not brought
    to their kept ids. Columns that nobody reads are not carried along.
    """
    waiting = deliveries.filter(unprocessed())
    complete = F.lit(True)
    for name in DELIVERY_KEY:
        complete = complete & F.col(name).isNotNull()
    rest = [c for c in deliveries.columns if c not in ("id", *DELIVERY_KEY)]
    kept = waiting.filter(complete).groupBy(*DELIVERY_KEY).agg(F.min("id").alias("id"), *[F.min_by(c, "id").alias(c) for c in rest])
    return kept.select(*deliveries.columns).unionByName(waiting.filter(~complete))


def live_documents(documents: DataFrame) -> DataFrame:
    """Receipts of documents that are not cancelled; documents carry ``warehouse_id, receipt_id, state``."""
    return documents.filter(F.col("state") != "cancel").select(*RECEIPT)


def split_already_processed(receipts: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(fresh, repeated)`` receipts: those without and with a live document."""
    live = live_documents(documents)
    return receipts.join(live, RECEIPT, "left_anti"), receipts.join(live, RECEIPT, "left_semi")


def repeated_changes(deliveries: DataFrame, repeated: DataFrame) -> DataFrame:
    """Change set closing unprocessed deliveries whose receipt already has a picking."""
    return of_receipts(deliveries.filter(unprocessed()), repeated).select(
        "id", F.lit(True).alias("processed"), F.lit(PICKING_REMARK).alias("remarks")
    )
