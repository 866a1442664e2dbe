"""Shape of the physical plans: no pairwise joins, pushed filters, narrow scans, split hot keys."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import DATA
from stockloom.operators.joins import attach


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["c1_location_closure", "d1_qty_on_hand", "d8_stock_per_location", "e5_disposition", "e14_duplicate_deliveries", "e15_cancelled_lines", "e20_transfer_headers"])
def test_no_pairwise_joins(spark, name):
    text = plan(entry.queries()[name](spark, DATA))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["d9_previous_agent_orders"](spark, DATA)).split("== Physical Plan ==")[1]
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"o_orderkey", "o_custkey", "o_orderstatus"}
    assert "PushedFilters: [" in text


def test_hot_key_is_split(spark):
    """A third of the rows on one key, joined to facts that were just aggregated by it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 16).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"))
        facts = spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).agg(F.count("id").alias("n"))
        joined = attach(rows, facts, {"k": "k"})
        assert joined.agg(F.sum("n").alias("s")).first().s == 4 * 300_000
        joined.write.format("noop").mode("overwrite").save()
        ran = joined.filter("n > 0")
        ran.collect()
        assert "skew=true" in ran._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
