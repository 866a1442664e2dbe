"""Reading and writing business tables as files Spark can scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockloom.operators.maintenance import apply_changes
from stockloom.sources.schemas import TABLES, schema


def load(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one table with its declared schema (no inference), e.g. ``<folder>/sale_order``."""
    return spark.read.schema(schema(name)).format(fmt).load(f"{folder.rstrip('/')}/{name}")


def load_catalog(spark: SparkSession, folder: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Scan several tables and register each as a temporary view of the same name."""
    tables = {name: load(spark, folder, name) for name in names or TABLES}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast and order the columns of a frame to the declared schema; missing columns become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(name).fields
        ]
    )


def save(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Write a new version of a table. A table read in the same plan needs another path."""
    df.write.mode("errorifexists").format(fmt).partitionBy(*partition_by).save(path)


def rewrite_changed(spark: SparkSession, folder: str, changes: DataFrame, partition_by: Sequence[str], key: str = "id") -> None:
    """Apply a change set to a stored, partitioned table, writing only the partitions that hold a changed row.

    The partitions are found by a join of keys; the read that follows is pruned to them at run time, and the dynamic
    overwrite replaces them at its commit. Files of other partitions are not touched, and a run that fails leaves the table as
    it was. A change set may not name a partition column, as a row would have to leave one partition and enter another.
    """
    moved = set(partition_by) & set(changes.columns)
    if moved:
        raise ValueError(f"changes would move rows between partitions: {sorted(moved)}")
    table = spark.read.parquet(folder)
    touched = table.join(changes.select(key), key, "left_semi").select(*partition_by).distinct()
    touched = touched.select(*[F.col(c).alias(f"__touched_{c}") for c in partition_by])
    same = F.lit(True)
    for name in partition_by:
        same = same & F.col(name).eqNullSafe(F.col(f"__touched_{name}"))
    rows = apply_changes(table.join(touched, same, "left_semi"), changes, key)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(folder)
