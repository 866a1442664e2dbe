from __future__ import annotations

import hashlib

import duckdb
import pytest
from cases import documents, stored, texts
from compare import assert_same
from pyspark.sql import functions as F

from stockloom.llm import extendible
from stockloom.llm.queries import LLM_QUERIES, LLM_STATEMENTS


def split(rows, limit, depth=0, prefix=0):
    """{bits: (depth, prefix)} by splitting oversized buckets one bit at a time."""
    if sum(b for _, b in rows) <= limit or depth == extendible.BITS:
        return {bits: (depth, prefix) for bits, _ in rows}
    bit = lambda x: x >> (extendible.BITS - depth - 1) & 1
    out = {}
    for side in (0, 1):
        out |= split([r for r in rows if bit(r[0]) == side], limit, depth + 1, 2 * prefix + side)
    return out


@pytest.mark.parametrize("limit", [400, 5000, 10**9])
def test_against_splitting(spark, limit):
    rows = [(i, int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), 1 + i * i % 300) for i in range(500)]
    # many neighbours in one deep bucket
    rows += [(1000 + i, (5 << 40) + i, 100) for i in range(60)]
    got = extendible.assign_shards(spark.createDataFrame(rows, "doc_id bigint, bits bigint, bytes bigint"), limit).collect()
    want = split([(b, n) for _, b, n in rows], limit)
    assert {r.bits: (r.depth, r.prefix) for r in got} == want and len(got) == len(rows)
    size = {}
    for r in got:
        size[(r.depth, r.prefix)] = size.get((r.depth, r.prefix), 0) + r.bytes
    assert all(size[(r.depth, r.prefix)] == r.shard_bytes <= limit for r in got)


def test_repeated_rows_overflow(spark):
    df = spark.range(5000).selectExpr("7L doc_id", "12345L bits", "10L bytes")
    got = extendible.assign_shards(df.union(spark.createDataFrame([(1, 99, 5000)], df.schema)), 200)
    assert got.count() == 5001
    shards = got.groupBy("bits", "overflow").agg(F.sum("bytes").alias("own"), F.max("shard_bytes").alias("said")).collect()
    assert all(r.own == r.said and (r.own <= 200 or r.bits == 99) for r in shards)
    entries = extendible.directory(got.where("overflow = 0"))
    assert entries.count() == entries.select("prefix", "depth").distinct().count()


def test_query_and_files(spark, tmp_path):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    assert_same(LLM_QUERIES["op10_extendible_shards"](spark, "/root/testdata/sf0.01"), con, LLM_STATEMENTS["op10_extendible_shards"])
    folder = stored(spark, tmp_path / "a", documents=documents(spark))
    got = LLM_QUERIES["op10_extendible_shards"](spark, folder).collect()
    assert sorted(r.n_bytes for r in got) == sorted(len((t or "").encode()) for _, t in texts())
    none = stored(spark, tmp_path / "b", documents=documents(spark, []))
    assert LLM_QUERIES["op10_extendible_shards"](spark, none).count() == 0
    df = documents(spark)
    rows = df.select("doc_id", extendible.hash_bits(F.col("doc_id"), F.col("text")).alias("bits"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("bytes"))
    extendible.write_shards(df, extendible.assign_shards(rows, 1000), f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == df.count()


def test_files_of_repeated_rows(spark, tmp_path):
    """Written folders are what the assignment says, with a row repeated past the limit."""
    rows = [(7, "same text " * 5)] * 400 + [(None, "none")] * 900 + [(i, f"text {i} " * (i % 9)) for i in range(100, 300)] + [(8, "long " * 500)]
    df = documents(spark, rows).repartition(5)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    keyed = df.select("doc_id", extendible.hash_bits(F.col("doc_id"), F.col("text")).alias("bits"), size.alias("bytes"))
    assigned = extendible.assign_shards(keyed, 1000)
    name = extendible.shard_name(F.col("depth"), F.col("prefix"), F.col("overflow"))
    want = {r.shard: r.shard_bytes for r in assigned.select(name.alias("shard"), "shard_bytes").distinct().collect()}
    extendible.write_shards(df, assigned, f"{tmp_path}/shards")
    found = spark.read.schema(df.schema.add("shard", "string")).parquet(f"{tmp_path}/shards")
    got = {r.shard: (r.own, r.n) for r in found.groupBy("shard").agg(F.sum(size).alias("own"), F.count(F.lit(1)).alias("n")).collect()}
    assert {k: own for k, (own, _) in got.items()} == want and sum(n for _, n in got.values()) == len(rows)
    assert sum("+" in k for k in got) >= 20 + 4 + 1
    assert all(own <= 1000 or n == 1 for own, n in got.values())
