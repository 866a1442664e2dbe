"""Cancellation requests as a stream: every micro-batch is applied to the order lines once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from stockloom.operators.cancellation import Cancellation, apply_cancellations
from stockloom.session import materialize
from stockloom.streaming.ledger import Ledger

#: Columns of an order line that a cancellation changes.
CHANGED = ("product_uom_qty", "commission", "state", "write_uid")
State = Callable[[int], tuple[DataFrame, DataFrame, DataFrame]]


def lines_of_requests(lines: DataFrame, requests: DataFrame, parts: int = 64) -> DataFrame:
    """The lines that cancellation requests name and all lines of the orders they name.

    The named orders are few intervals of order ids, at most ``parts``. Of lines stored in the order of ``order_id`` only the
    row groups of these intervals are read; of others all are read, but only lines within the intervals are shuffled.
    A line id names one line, as in :class:`LineState`.
    """
    orders = requests.select("order_id").filter("order_id is not null").distinct()
    found = _within(lines, "order_id", orders, parts).join(orders, "order_id", "left_semi")
    # a request may name a line of another order
    named = requests.select(F.col("line_id").alias("id")).filter("id is not null").distinct()
    apart = materialize(named.join(found.select("id"), "id", "left_anti"))
    strays = _within(lines, "id", apart, parts)
    if strays is lines:
        return found
    return found.unionByName(strays.join(apart, "id", "left_semi"))


def _within(rows: DataFrame, column: str, keys: DataFrame, parts: int) -> DataFrame:
    """``rows`` whose integer ``column`` lies in one of the intervals, at most ``parts``, that hold all ``keys``; without keys as they are."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    if low is None:
        return rows
    part = F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) // parts + 1))
    near = F.lit(False)
    for r in keys.groupBy(part.alias("part")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect():
        near = near | F.col(column).between(r.low, r.high)
    return rows.filter(near)


class LineState:
    """Order lines as they stand before a batch: the table they started from and the changes of all earlier batches.

    Only changed lines are stored, one folder per batch, so a replayed batch replaces its own changes. Every ``every``
    batches the changes so far are put together as a snapshot, one row per changed line; a batch reads the newest snapshot before it
    and the changes since, however long the stream has been running.
    """

    def __init__(self, folder: str, lines: DataFrame, every: int = 8) -> None:
        self.lines = lines if "write_uid" in lines.columns else lines.withColumn("write_uid", F.lit(None).cast("bigint"))
        kept = StructType([f for f in self.lines.schema if f.name in ("id", *CHANGED)])
        self.changes, self.snapshots, self.every = Ledger(folder, kept), Ledger(f"{folder.rstrip('/')}-snapshots", kept), every

    def changed(self, batch_id: int) -> DataFrame:
        """The changed lines as they stand before a batch, one row each."""
        spark = self.lines.sparkSession
        # the snapshot of batch b holds the changes up to and with b
        start = max([b for b in self.snapshots.batches(spark) if b < batch_id], default=None)
        recent = self.changes.between(spark, -1 if start is None else start + 1, batch_id)
        if start is not None:
            recent = recent.unionByName(self.snapshots.between(spark, start, start + 1))
        latest = recent.groupBy("id").agg(F.max_by(F.struct(*CHANGED), "batch").alias("new"))
        return latest.select("id", *[F.col(f"new.{c}").alias(c) for c in CHANGED])

    def before(self, batch_id: int, requests: DataFrame | None = None) -> DataFrame:
        """The lines as they stand before a batch; with its ``requests`` only those that concern them, stored."""
        lines = self.lines if requests is None else materialize(lines_of_requests(self.lines, requests))
        latest = self.changed(batch_id).select("id", F.struct(*CHANGED).alias("__new"))
        joined = lines.join(latest, "id", "left")
        now = {c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in CHANGED}
        return joined.withColumns(now).select(*self.lines.columns)

    def store(self, updated: DataFrame, batch_id: int, before: DataFrame | None = None) -> None:
        """Store what a batch changed; ``before`` are the lines it started from, if these are at hand."""
        before = self.before(batch_id) if before is None else before
        old = before.select("id", F.struct(*CHANGED).alias("__old"))
        changed = updated.select("id", *[F.col(c).cast(self.lines.schema[c].dataType).alias(c) for c in CHANGED]).join(old, "id")
        changed = changed.filter(~F.struct(*CHANGED).eqNullSafe(F.col("__old"))).select("id", *CHANGED)
        self.changes.write(changed, batch_id)
        if batch_id % self.every == self.every - 1:
            self.snapshots.write(self.changed(batch_id + 1), batch_id)


def start_cancellations(
    requests: DataFrame,
    ledger: Ledger,
    checkpoint: str,
    state: State,
    sink: Callable[[Cancellation, int], None],
) -> StreamingQuery:
    """Start the stream over ``requests``, a queue that carries its own ids.

    ``state`` returns the order lines, orders and line taxes as they stand before a batch; ``sink`` stores what the
    batch changed. Both take the batch id, so a replayed batch starts from the same state and replaces its own output.
    The request id is the key that keeps a request from being applied twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = ledger.before(spark, batch_id).select("id")
        fresh = batch.dropDuplicates(["id"]).join(done, "id", "left_anti")
        ledger.write(fresh, batch_id)
        stored = ledger.rows(spark)
        lines, orders, taxes = state(batch_id)
        sink(apply_cancellations(stored.filter(stored["batch"] == batch_id).drop("batch"), lines, orders, taxes), batch_id)

    return (
        requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
