"""FIFO valuation repair: moves below zero take value from later receipts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from stockloom.functions.scalars import round2
from stockloom.operators.allocation import match_intervals
from stockloom.operators.joins import attach
from stockloom.operators.ordered import in_pieces, running_balance
from stockloom.session import materialize

KEYS = ["product_id", "company_id"]
QTY = "decimal(18,6)"


@dataclass(frozen=True)
class FifoRepair:
    """``allocations``: what each giver gave to each taker; ``moves``: the changed moves."""

    allocations: DataFrame
    moves: DataFrame


def _backlog(moves: DataFrame, pieces: int | None) -> DataFrame:
    """Takers and givers with unserved demand before each of them, in date and id order.

    With ``N`` the running sum of demand less supply, the backlog is ``N - min(0, lowest N so far)``; a giver serves
    what is waiting when its turn comes, so its share is known before any pairing.
    """
    qty = F.col("remaining_qty").cast(QTY)
    in_or_out = F.coalesce(F.col("is_in") | F.col("is_out"), F.lit(False))
    giver = F.coalesce(F.col("is_in"), F.lit(False)) & (qty > 0)
    taker = in_or_out & (qty < 0)
    rows = moves.filter(giver | taker).select(
        *KEYS,
        "id",
        "date",
        taker.alias("is_taker"),
        F.abs(qty).alias("amount"),
        "price_unit",
        "remaining_value",
    )
    demand = F.when(F.col("is_taker"), F.col("amount")).otherwise(F.lit(0).cast(QTY))
    change = F.when(F.col("is_taker"), F.col("amount")).otherwise(-F.col("amount"))
    # Two passes follow (piece totals, rows); they read these few columns, not the moves.
    rows = in_pieces(rows.dropna(subset=[*KEYS, "date"]), KEYS, ["date", "id"], pieces)
    rows = running_balance(rows, change, KEYS, ["piece"], ["date", "id"], {"asked": demand})
    backlog = F.col("net") - F.least(F.lit(0).cast("decimal(38,6)"), F.col("low"))
    return rows.withColumn("backlog", backlog.cast("decimal(38,6)")).withColumn(
        "used", F.when(F.col("is_taker"), F.lit(0)).otherwise(F.least("amount", "backlog")).cast("decimal(38,6)")
    )


def fifo_allocations(moves: DataFrame, pieces: int | None = None) -> DataFrame:
    """``(product_id, company_id, taker_id, giver_id, qty, value)``.

    ``moves`` carry ``id, product_id, company_id, date, remaining_qty, remaining_value, price_unit, is_in, is_out``.
    Every in- or out-move below zero takes from later in-moves that still hold quantity, both in date and id order.
    The placed takers and givers are stored once, as the matching reads them several times.
    """
    rows = materialize(_backlog(moves, pieces))
    chunk = F.col("piece").alias("chunk")
    takers = rows.filter("is_taker").select(
        *KEYS, "id", chunk, F.col("asked").alias("lo"), (F.col("asked") + F.col("amount")).alias("hi")
    )
    served = F.col("asked") - F.col("backlog")
    givers = rows.filter(~F.col("is_taker") & (F.col("used") > 0)).select(
        *KEYS, F.struct("id", "price_unit").alias("id"), chunk, served.alias("lo"), (served + F.col("used")).alias("hi")
    )
    pairs = match_intervals(takers, givers, KEYS)
    return pairs.select(
        *KEYS,
        F.col("demand_id").alias("taker_id"),
        F.col("supply_id.id").alias("giver_id"),
        F.col("qty").cast(QTY).alias("qty"),
        (F.col("qty").cast(QTY) * F.col("supply_id.price_unit")).cast(QTY).alias("value"),
    )


def fifo_vacuum(moves: DataFrame, pieces: int | None = None) -> FifoRepair:
    """Allocations and the moves they change: remaining quantity, remaining value and value taken.

    A taker served in full keeps no value, one served in part adds the value it took; a giver loses quantity and its
    own price times that quantity. A taker nobody serves stays as it is.
    """
    allocations = fifo_allocations(moves, pieces)
    taken = allocations.groupBy(F.col("taker_id").alias("id")).agg(F.sum("qty").alias("qty"), F.sum("value").alias("value"))
    given = allocations.groupBy(F.col("giver_id").alias("id")).agg(F.sum("qty").alias("qty"), F.sum("value").alias("value"))
    sums = taken.withColumn("is_taker", F.lit(True)).unionByName(given.withColumn("is_taker", F.lit(False)))
    joined = moves.join(sums, "id")
    taker = F.col("is_taker")
    quantity = F.col("remaining_qty") + F.when(taker, F.col("qty")).otherwise(-F.col("qty"))
    value = F.when(taker & (quantity == 0), F.lit(0)).otherwise(
        F.col("remaining_value") + F.when(taker, F.col("value")).otherwise(-F.col("value"))
    )
    changed = joined.select(
        "id",
        *KEYS,
        "is_in",
        "is_taker",
        F.col("remaining_value").alias("old_value"),
        quantity.cast(QTY).alias("remaining_qty"),
        value.cast(QTY).alias("remaining_value"),
        F.when(taker, F.col("value")).cast(QTY).alias("taken_value"),
    )
    return FifoRepair(allocations, changed)


def valuation_corrections(repair: FifoRepair, products: DataFrame) -> DataFrame:
    """``(id, product_id, company_id, amount)`` to post per served taker of a product valued in real time.

    The value taken, less what was already posted at an estimated price; in-moves post with the opposite sign.
    """
    valued = products.filter(F.col("valuation") == "real_time").select(F.col("id").alias("product_id"), F.lit(True).alias("__valued"))
    served = attach(repair.moves.filter("is_taker"), valued, {"product_id": "product_id"}).filter("__valued")
    old = round2("old_value")
    amount = round2("taken_value") + F.when(old < 0, old).otherwise(F.lit(0))
    return served.select("id", *KEYS, F.when(F.col("is_in"), -amount).otherwise(amount).cast("decimal(18,2)").alias("amount"))
