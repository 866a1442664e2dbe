"""Joining rows to per-key facts when some keys are very frequent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F


def attach(rows: DataFrame, facts: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Left join ``facts`` (one row per key) to ``rows`` (any number of rows per key); ``on`` maps row to fact columns.

    The key is compared as one struct. A fact table that was just aggregated by the same columns therefore gets an
    exchange of its own below the join, which is what adaptive execution needs to split the partition of a frequent
    key, or to broadcast the facts once they turn out small. NULL keys match nothing.
    """
    keys = {f"__fact_{right}": F.col(right) for right in on.values()}
    rest = [c for c in facts.columns if c not in on.values()]
    side = facts.dropna(subset=list(on.values())).select(*[v.alias(k) for k, v in keys.items()], *rest)
    condition = F.struct(*[F.col(left).alias(f"k{i}") for i, left in enumerate(on)]) == F.struct(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    )
    if len(on) == 1:
        # A one-field struct would behave the same; hashing the bare value needs no struct and still differs from the
        # aggregate's own key.
        left, right = next(iter(on)), next(iter(keys))
        condition = F.array(F.col(left)) == F.array(F.col(right))
    return rows.join(side, condition, "left").drop(*keys)
