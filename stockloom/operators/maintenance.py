"""Table upkeep: missing columns, keyed updates, change sets and document numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.functions.scalars import expand_prefix
from stockloom.operators.joins import attach
from stockloom.operators.ordered import in_pieces, running


def ensure_columns(df: DataFrame, columns: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Add each column of ``{name: (type, default)}`` the table does not have yet."""
    return df.withColumns(
        {name: F.lit(default).cast(kind) for name, (kind, default) in columns.items() if name not in df.columns}
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by``; pre-aggregated, so a hot key does not fill one task."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("__row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def update_from(
    target: DataFrame, source: DataFrame, on: Sequence[str], sets: Mapping[str, Column], tie_break: Sequence[str]
) -> DataFrame:
    """Overwrite columns of the target rows that have a source row; others keep their values.

    ``sets`` maps target columns to expressions over source columns, which are reachable as ``source.<name>``. If
    several source rows share a key the smallest by ``tie_break`` is used.
    """
    unique = first_per_key(source, on, tie_break)
    packed = unique.select(
        *[F.col(c).alias(f"__on_{c}") for c in on], F.struct(*unique.columns).alias("source")
    )
    matched = F.col("source").isNotNull()
    return (
        attach(target, packed, {c: f"__on_{c}" for c in on})
        .withColumns({c: F.when(matched, value).otherwise(F.col(c)) for c, value in sets.items()})
        .select(*target.columns)
    )


def apply_changes(table: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Overwrite rows by a change set keyed like the table; NULL in a change keeps the old value."""
    columns = [c for c in changes.columns if c != key]
    right = changes.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__new_{c}") for c in columns])
    joined = table.join(right, F.col(key) == F.col("__key"), "left")
    return joined.select(
        *[F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns]
    )


def accumulate(
    table: DataFrame, additions: DataFrame, keys: Sequence[str], quantity: str, insert: Column, reset: Sequence[str] = ()
) -> DataFrame:
    """Upsert: add ``quantity`` to rows that exist, insert the additions that satisfy ``insert``.

    Additions are summed per key first (other columns: the row is taken as is from the smallest). Columns in
    ``reset`` become 0 on matched rows.
    """
    new = additions.select(
        *keys, *[F.col(c).alias(f"__add_{c}") for c in additions.columns if c not in keys], F.lit(True).alias("__new")
    )
    old = table.withColumn("__old", F.lit(True))
    joined = old.join(new, list(keys), "full_outer")
    known, added = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    provided = {c for c in additions.columns if c not in keys}

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        inserted = F.col(f"__add_{name}") if name in provided else F.lit(None)
        if name == quantity:
            kept = F.col(name) + F.coalesce(F.col(f"__add_{name}"), F.lit(0))
        elif name in reset:
            kept = F.when(added, F.lit(0)).otherwise(F.col(name))
        else:
            kept = F.col(name)
        return F.when(known, kept).otherwise(inserted).cast(table.schema[name].dataType).alias(name)

    return joined.filter(known | insert).select(*[value(c) for c in table.columns])


def number_documents(
    documents: DataFrame,
    order_by: Sequence[str],
    start: int,
    increment: int,
    prefix: str | None,
    on_date: date,
    levels: Sequence[str] = (),
    pieces: int | None = None,
) -> DataFrame:
    """Give documents gap-free numbers in ``order_by`` order: ``start + k * increment`` and a prefixed name.

    Without explicit ``levels`` the documents are stored in pieces of the order, so the only rows that meet in one task
    are one per piece.
    """
    added = []
    if not levels:
        documents, levels, added = in_pieces(documents, [], order_by, pieces), ["piece"], ["piece"]
    rank = running(documents, {"__rank": F.lit(1).cast("bigint")}, "sum", [], levels, order_by)
    number = F.lit(start).cast("bigint") + F.col("__rank") * F.lit(increment)
    name = F.concat(expand_prefix(F.lit(prefix).cast("string"), F.lit(on_date)), number.cast("string"))
    return rank.withColumns({"document_no": number, "document_name": name}).drop("__rank", *added)


def next_counter(documents: DataFrame, start: int, increment: int) -> DataFrame:
    """The counter value after numbering: one row ``number_next``."""
    return documents.agg((F.lit(start).cast("bigint") + F.count(F.lit(1)) * F.lit(increment)).alias("number_next"))
