"""Running aggregates that do not need one task per key.

A plain window over ``partitionBy(key)`` sorts all rows of a key in one task. Here the order is cut into nested levels
(pieces of equal row counts, or columns of the data): totals per level are pre-aggregated before they are shuffled, the running value
is carried through the small tables of totals, and only rows of one finest block meet in one window group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.session import materialize

_FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}

#: A block holds at most ``2 ** BLOCK_BITS`` distinct ids.
BLOCK_BITS = 18


def id_block(col: Column | str, bits: int = BLOCK_BITS) -> Column:
    """Block number of an integer id; it grows with the id, so it is a valid level."""
    return F.shiftright(F.col(col) if isinstance(col, str) else col, bits)


def in_pieces(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], pieces: int | None = None) -> DataFrame:
    """Store ``rows`` with ``piece``: consecutive ranges of the order (keys, then ``order_by``) of about equal row counts.

    The ranges come from a sample of the rows themselves, so a key with very many rows spans as many pieces as its rows
    need and rare keys share one. ``piece`` grows with the order inside a key and is a valid level. It is stored, as a
    second execution may draw other ranges. ``pieces`` is only for tests; by default the session's shuffle settings and
    adaptive execution decide.
    """
    order = [*keys, *order_by]
    dealt = rows.repartitionByRange(pieces, *order) if pieces else rows.repartitionByRange(*order)
    return materialize(dealt.withColumn("piece", F.spark_partition_id()))


def _merge(how: str, carried: Column, local: Column) -> Column:
    if how == "sum":
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))
    return (F.least if how == "min" else F.greatest)(carried, local)


def running(
    rows: DataFrame,
    values: Mapping[str, Column],
    how: str,
    keys: Sequence[str],
    levels: Sequence[str],
    order_by: Sequence[str],
    inclusive: bool = False,
) -> DataFrame:
    """Add one running ``sum``, ``min`` or ``max`` per entry of ``values``, over the rows before the current one.

    ``levels`` are columns from coarse to fine, each growing with the order inside the level above; ``order_by``
    orders the rows of one finest level. Keys and levels must not be NULL. Without earlier rows a sum is 0, the
    others are NULL.
    """
    fold = _FOLDS[how]
    group = [*keys, *levels]
    raw = {name: f"__value_{name}" for name in values}
    rows = rows.withColumns({raw[name]: col for name, col in values.items()})

    totals = [rows.groupBy(*group).agg(*[fold(c).alias(c) for c in raw.values()])]
    for depth in range(len(levels) - 1, 0, -1):
        outer = [*keys, *levels[:depth]]
        totals.insert(0, totals[0].groupBy(*outer).agg(*[fold(c).alias(c) for c in raw.values()]))

    carried = None
    for depth, level in enumerate(levels, 1):
        outer = [*keys, *levels[: depth - 1]]
        before = Window.partitionBy(*outer).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        current = totals[depth - 1]
        if carried is not None:
            current = current.join(carried, outer)
        carried = current.select(
            *outer,
            level,
            *[
                _merge(how, F.lit(None) if depth == 1 else F.col(f"__carry_{n}"), fold(c).over(before)).alias(
                    f"__carry_{n}"
                )
                for n, c in raw.items()
            ],
        )

    if carried is not None:
        rows = rows.join(carried, group)
    frame = Window.partitionBy(*group).orderBy(*order_by)
    frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    return rows.withColumns(
        {
            n: _merge(how, F.lit(None) if carried is None else F.col(f"__carry_{n}"), fold(c).over(frame))
            for n, c in raw.items()
        }
    ).drop(*raw.values(), *[f"__carry_{n}" for n in values])


def running_balance(
    rows: DataFrame,
    change: Column,
    keys: Sequence[str],
    levels: Sequence[str],
    order_by: Sequence[str],
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``net``, the sum of ``change`` over earlier rows, and ``low``, the lowest balance reached so far.

    ``low`` is NULL before the first row. ``totals`` adds further running sums in the same pass. Keys and levels as in
    :func:`running`.
    """
    group = [*keys, *levels]
    sums = {"net": "__change", **{name: f"__value_{name}" for name in totals or {}}}
    rows = rows.withColumns({"__change": change, **{sums[n]: c for n, c in (totals or {}).items()}})

    def before(*by: str):
        return Window.partitionBy(*by).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)

    upto = Window.partitionBy(*group).orderBy(*order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    folds = [F.sum(c).alias(c) for c in sums.values()]
    blocks = [
        rows.select(*group, *order_by, *sums.values())
        .withColumn("__low", F.sum("__change").over(upto))
        .groupBy(*group)
        .agg(*folds, F.min("__low").alias("__low"))
    ]

    def earlier(outer: Sequence[str], level: str):
        return Window.partitionBy(*outer).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)

    for depth in range(len(levels) - 1, 0, -1):
        outer = [*keys, *levels[:depth]]
        start = F.coalesce(F.sum("__change").over(earlier(outer, levels[depth])), F.lit(0))
        lowered = blocks[0].withColumn("__low", start + F.col("__low"))
        blocks.insert(0, lowered.groupBy(*outer).agg(*folds, F.min("__low").alias("__low")))

    carried = None
    for depth, level in enumerate(levels, 1):
        outer = [*keys, *levels[: depth - 1]]
        current = blocks[depth - 1]
        if carried is not None:
            current = current.join(carried, outer)
        frame = earlier(outer, level)
        current = current.withColumns(
            {
                f"__at_{n}": (F.lit(0) if carried is None else F.col(f"__carry_{n}"))
                + F.coalesce(F.sum(c).over(frame), F.lit(0))
                for n, c in sums.items()
            }
        ).withColumn("__lowest", F.col("__at_net") + F.col("__low"))
        sofar = F.min("__lowest").over(frame)
        lowest = sofar if carried is None else F.least("__carry_low", sofar)
        carried = current.select(
            *outer, level, *[F.col(f"__at_{n}").alias(f"__carry_{n}") for n in sums], lowest.alias("__carry_low")
        )

    frame = before(*group)
    placed = rows.join(carried, group).withColumns(
        {n: F.col(f"__carry_{n}") + F.coalesce(F.sum(c).over(frame), F.lit(0)) for n, c in sums.items()}
    )
    placed = placed.withColumn("__after", F.col("net") + F.col("__change"))
    low = F.least("__carry_low", F.min("__after").over(frame))
    return placed.withColumn("low", low).drop(
        "__after", "__carry_low", *sums.values(), *[f"__carry_{n}" for n in sums]
    )
