"""Delivery intake as a stream: the smallest id per warehouse, receipt, line and quantity wins.

Files arrive in any order, so a copy with a smaller id may come after the one that was accepted. It is then accepted too
and takes the other's place; :meth:`Ledger.current` names the rows in force, which do not depend on how the input was cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.operators.intake import DELIVERY_KEY, RECEIPT, live_documents, mark_duplicate_deliveries, unprocessed
from stockloom.streaming.ledger import Ledger


def accept_deliveries(batch: DataFrame, accepted: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Rows of a micro-batch to process: no copies inside it, none of an earlier smaller id, no finished receipts.

    Rows without a line or quantity are never copies.
    """
    kept = mark_duplicate_deliveries(batch).filter(unprocessed())
    least = accepted.dropna(subset=DELIVERY_KEY).groupBy(*DELIVERY_KEY).agg(F.min("id").alias("__least"))
    fresh = kept.join(least, DELIVERY_KEY, "left").filter("__least is null or id < __least").select(*kept.columns)
    if documents is not None:
        fresh = fresh.join(live_documents(documents), RECEIPT, "left_anti")
    return fresh


def start_intake(
    deliveries: DataFrame,
    ledger: Ledger,
    checkpoint: str,
    documents: DataFrame | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    process: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the stream over ``deliveries``; cap its batches at the source (``maxFilesPerTrigger``).

    ``prepare`` turns source rows into deliveries; ``process`` receives the accepted rows of a batch as stored.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        earlier = ledger.before(batch.sparkSession, batch_id)
        ledger.write(accept_deliveries(rows, earlier, documents), batch_id)
        if process:
            stored = ledger.rows(batch.sparkSession)
            process(stored.filter(stored["batch"] == batch_id).drop("batch"), batch_id)

    return (
        deliveries.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
