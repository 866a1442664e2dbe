"""Running values over many small blocks equal plain loops."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockloom.operators.maintenance import number_documents
from stockloom.operators.ordered import id_block, in_pieces, running, running_balance


def sample(spark, seed, rows=300):
    rng = random.Random(seed)
    # key 0 holds about a third of the rows
    data = [
        (rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6]), date(2020, 1, 1) + timedelta(days=rng.randrange(6)), i, rng.randint(-5, 5))
        for i in rng.sample(range(10_000), rows)
    ]
    df = spark.createDataFrame(data, "k int, d date, id bigint, v int").withColumn("block", id_block("id", 9))
    return data, df


@pytest.mark.parametrize("seed", range(2))
def test_running(spark, seed):
    data, df = sample(spark, seed)
    sums = running(df, {"before": F.col("v")}, "sum", ["k"], ["d", "block"], ["id"])
    lows = running(sums, {"low": F.col("v")}, "min", ["k"], ["d", "block"], ["id"], inclusive=True)
    total, low, expected = {}, {}, {}
    for k, _, i, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        low[k] = min(low.get(k, v), v)
        expected[i] = (total.get(k, 0), low[k])
        total[k] = total.get(k, 0) + v
    assert {r.id: (r.before, r.low) for r in lows.collect()} == expected


@pytest.mark.parametrize("seed", range(2))
def test_running_balance(spark, seed):
    data, df = sample(spark, seed)
    got = running_balance(df, F.col("v"), ["k"], ["d", "block"], ["id"], {"count": F.lit(1)})
    total, low, count, expected = {}, {}, {}, {}
    for k, _, i, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        expected[i] = (total.get(k, 0), low.get(k), count.get(k, 0))
        total[k] = total.get(k, 0) + v
        low[k] = min(low.get(k, total[k]), total[k])
        count[k] = count.get(k, 0) + 1
    assert {r.id: (r.net, r.low, r["count"]) for r in got.collect()} == expected


def test_numbers_are_dense_and_ordered(spark):
    data, df = sample(spark, 7)
    out = number_documents(df.select("d", "id"), ["d", "id"], 10, 5, "N", date(2020, 1, 1), pieces=6)
    got = [(r.document_no, r.document_name) for r in out.orderBy("d", "id").collect()]
    assert got == [(10 + 5 * n, f"N{10 + 5 * n}") for n in range(len(data))]


def test_pieces_follow_row_counts(spark):
    """Sparse ids, one key with half of the rows: no window group is much larger than its share."""
    rows = spark.range(60_000).selectExpr("if(id % 2 = 0, 0, id) k", "id * 1000003 id", "date'2020-01-01' + int(id % 5) d")
    pieces = in_pieces(rows, ["k"], ["d", "id"], 30)
    groups = pieces.groupBy("k", "piece").count()
    assert groups.agg(F.max("count")).first()[0] < 6_000
    assert pieces.groupBy("piece").count().agg(F.max("count")).first()[0] < 6_000
    out = running(pieces, {"n": F.lit(1)}, "sum", ["k"], ["piece"], ["d", "id"])
    assert out.filter("k = 0").agg(F.max("n"), F.countDistinct("n")).first()[:] == (29_999, 30_000)
