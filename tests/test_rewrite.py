"""A change set rewrites the partitions it touches and no others."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stockloom.operators.maintenance import apply_changes
from stockloom.sources.tables import rewrite_changed


def files(folder):
    found = {}
    for at, _, names in os.walk(folder):
        found |= {os.path.join(at, n): os.stat(os.path.join(at, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return found


def rows(df):
    return sorted(tuple(r) for r in df.select("id", "state", "qty", "day", "place").fillna("-").collect())


def test_only_touched_partitions_are_written(spark, tmp_path):
    folder = f"{tmp_path}/orders"
    day = F.when(F.col("id") % 7 != 6, F.concat(F.lit("d"), F.col("id") % 7))
    table = spark.range(700).select("id", F.lit("draft").alias("state"), (F.col("id") * 2).alias("qty"), day.alias("day"), (F.col("id") % 2).cast("string").alias("place"))
    table.write.partitionBy("day", "place").parquet(folder)
    before, stored = files(folder), spark.read.parquet(folder)
    changes = spark.createDataFrame([(8, "done", None), (22, None, 5), (13, "done", 7), (9999, "done", 1)], "id bigint, state string, qty bigint")
    expected = rows(apply_changes(stored, changes))
    rewrite_changed(spark, folder, changes, ["day", "place"])
    after = files(folder)
    spark.catalog.refreshByPath(folder)
    assert rows(spark.read.parquet(folder)) == expected
    # ids 8 and 22 lie in one partition, 13 in that without a day
    kept = {f for f in before if after.get(f) == before[f]}
    gone = {os.path.relpath(f, folder).rsplit("/", 1)[0] for f in before if f not in after}
    assert gone == {"day=d1/place=0", "day=__HIVE_DEFAULT_PARTITION__/place=1"}
    assert len(kept) == len(before) - len(set(before) - set(after))

    failing = changes.withColumn("qty", F.when(F.col("id") == 13, F.raise_error(F.lit("no"))).otherwise(F.col("qty")))
    with pytest.raises(Exception, match="no"):
        rewrite_changed(spark, folder, failing, ["day", "place"])
    assert files(folder) == after and rows(spark.read.parquet(folder)) == expected
    with pytest.raises(ValueError, match="day"):
        rewrite_changed(spark, folder, changes.withColumn("day", F.lit("d2")), ["day", "place"])
