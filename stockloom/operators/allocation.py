"""First-in-first-out matching of demand and supply laid out on one quantity axis per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def _segments(ends: DataFrame, within: Sequence[str], floor) -> DataFrame:
    """Cut an axis at all end points; each piece names the demand and the supply that cover it.

    The axis is walked from the far end, so "next end at or after this point" is a growing window frame.
    """
    down = Window.partitionBy(*within).orderBy(F.col("pos").desc())
    seen = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        ends.withColumns(
            {
                "seg_lo": F.coalesce(F.lead("pos").over(down), floor),
                "seg_demand": F.last("demand", ignorenulls=True).over(seen),
                "seg_supply": F.last("supply", ignorenulls=True).over(seen),
            }
        )
        .filter(F.col("seg_demand").isNotNull() & F.col("seg_supply").isNotNull() & (F.col("seg_lo") < F.col("pos")))
    )


def match_intervals(demand: DataFrame, supply: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlap of two gap-free interval sets per key, both starting at 0.

    Both inputs carry ``keys, id, chunk, lo, hi`` where ``hi > lo`` and ``chunk`` grows with the position and bounds
    the rows that may meet in one task. First whole chunks are matched, then the rows of each matching chunk pair.
    Returns ``keys, demand_id, supply_id, qty``; every pair appears once.
    """
    keys = list(keys)

    def spans(side: DataFrame) -> DataFrame:
        return side.groupBy(*keys, "chunk").agg(F.max("hi").alias("pos"))

    demand_spans = spans(demand).select(*keys, "pos", F.col("chunk").alias("demand"))
    supply_spans = spans(supply).select(*keys, "pos", F.col("chunk").alias("supply"))
    ends = demand_spans.unionByName(supply_spans, allowMissingColumns=True)
    pairs = _segments(ends, keys, F.lit(0)).select(
        *keys,
        F.col("seg_demand").alias("demand_chunk"),
        F.col("seg_supply").alias("supply_chunk"),
        F.col("seg_lo").alias("pair_lo"),
        F.col("pos").alias("pair_hi"),
    )

    def pieces(side: DataFrame, own: str, label: str) -> DataFrame:
        return (
            side.withColumnRenamed("chunk", own)
            .join(pairs, [*keys, own])
            .filter((F.col("lo") < F.col("pair_hi")) & (F.col("hi") > F.col("pair_lo")))
            .select(
                *keys,
                "demand_chunk",
                "supply_chunk",
                "pair_lo",
                F.least("hi", "pair_hi").alias("pos"),
                F.col("id").alias(label),
            )
        )

    rows = pieces(demand, "demand_chunk", "demand").unionByName(
        pieces(supply, "supply_chunk", "supply"), allowMissingColumns=True
    )
    return _segments(rows, [*keys, "demand_chunk", "supply_chunk"], F.col("pair_lo")).select(
        *keys,
        F.col("seg_demand").alias("demand_id"),
        F.col("seg_supply").alias("supply_id"),
        (F.col("pos") - F.col("seg_lo")).alias("qty"),
    )
