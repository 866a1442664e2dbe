"""Sharding by extendible hashing: a directory over hash-prefix bits in which only oversized buckets are split.

A row's bucket is the shortest prefix of its hash whose rows together fit the byte limit. That is what splitting from one
bucket on, one more bit at a time and only where a bucket is too large, ends with; here it is found from sums. Bytes
are summed once per fine prefix (combined before the shuffle, so a frequent key costs a row per task), the sums are rolled
up to all shorter prefixes, and each fine prefix takes its shortest fitting ancestor. Prefixes that are still too large
go to a next round with more bits.

The hash is the first 60 bits of an MD5 over id and text, so equal ids with different texts are told apart. Rows that
agree in all 60 bits are the same row repeated; no bit splits them. They are numbered, and each overflow shard takes the
next as many as fit, in the assignment and in the files alike. A single row above the limit has a shard of its own, with
``shard_bytes`` above the limit.

Defined results: null text has 0 bytes; null ids hash as the empty string; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.session import materialize

BITS = 60
#: Bytes of text of one shard in the registered query.
LIMIT = 1 << 20


def hash_bits(*columns: Column) -> Column:
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")


def buckets(cells: DataFrame, depth: int, least: int, limit: int) -> DataFrame:
    """cell (a prefix of ``depth`` bits) and bytes -> the shortest fitting prefix of ``least`` bits or more, if any."""
    levels = cells.select("cell", "bytes", F.explode(F.sequence(F.lit(least), F.lit(depth))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("shard_bytes"))
    fitting = levels.join(sums.where(F.col("shard_bytes") <= limit), ["depth", "prefix"])
    return fitting.groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes")).alias("b"))


def assign_shards(rows: DataFrame, limit: int = LIMIT, bits_per_round: int = 6) -> DataFrame:
    """rows: doc_id, bits (60-bit hash), bytes -> the same with depth, prefix, overflow, shard_bytes."""
    rows = materialize(rows.select("doc_id", "bits", "bytes"))
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    depth = min(BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + bits_per_round)
    least, left, done = 0, rows, []
    while True:
        cell = F.expr(f"shiftright(bits, {BITS - depth})")
        keyed = left.withColumn("cell", cell)
        found = buckets(keyed.groupBy("cell").agg(F.sum("bytes").alias("bytes")), depth, least, limit)
        placed = materialize(keyed.join(found, "cell", "left").drop("cell"))
        done.append(placed.where("b is not null").select("doc_id", "bits", "bytes", F.lit(0).cast("bigint").alias("overflow"), "b.*"))
        left = placed.where("b is null").select("doc_id", "bits", "bytes")
        if left.isEmpty():
            break
        if depth == BITS:
            done.append(_overflow(left, limit))
            break
        least, depth = depth + 1, min(BITS, depth + bits_per_round)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with ``number``, from 0 on among those of equal bits: counts per task first, so no group is gathered in one."""
    held = materialize(rows.withColumn("at", F.monotonically_increasing_id())).withColumn("task", F.expr("shiftright(at, 33)"))
    counts = held.groupBy("bits", "task").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("bits", "task", (F.sum("n").over(Window.partitionBy("bits").orderBy("task")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("bits", "task").orderBy("at"))
    numbered = held.withColumn("place", place).join(before, ["bits", "task"])
    return numbered.withColumn("number", F.col("before") + F.col("place") - 1).drop("at", "task", "place", "before")


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Rows with all bits equal: each is the same row, so a count decides how many fit a shard; dealt by number."""
    most = rows.groupBy("bits").agg(F.greatest(F.lit(1), F.max("bytes")).alias("most"))
    dealt = _numbered(rows).join(most, "bits").withColumn("fit", F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("most"))))
    dealt = materialize(dealt.select("doc_id", "bits", "bytes", _overflow_of("number", "fit").alias("overflow")))
    size = dealt.groupBy("bits", "overflow").agg(F.sum("bytes").alias("shard_bytes"))
    joined = dealt.join(size, ["bits", "overflow"])
    return joined.select(
        "doc_id", "bits", "bytes", "overflow", F.lit(BITS).alias("depth"), F.col("bits").alias("prefix"), "shard_bytes"
    )


def _overflow_of(number: str, fit: str) -> Column:
    return (1 + F.floor(F.col(number) / F.col(fit))).cast("bigint")


def shard_name(depth: Column, prefix_: Column, overflow: Column) -> Column:
    """The prefix as a bit string, with the number of the overflow shard if there is one."""
    name = F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.bin(prefix_), depth, "0"))
    return F.concat(name, F.when(overflow > 0, F.concat(F.lit("+"), overflow.cast("string"))).otherwise(F.lit("")))


def directory(assigned: DataFrame) -> DataFrame:
    """One row per shard: depth, prefix, bytes, and the range of directory entries at the global depth that point to it."""
    shards = assigned.select("depth", "prefix", "overflow", "shard_bytes").distinct()
    deepest = shards.where("overflow = 0").agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    spread = F.expr(f"shiftleft(cast(1 as bigint), greatest({deepest} - depth, 0))")
    return shards.select(
        "depth", "prefix", "overflow", "shard_bytes", (F.col("prefix") * spread).alias("first_entry"), spread.alias("entries")
    )


def write_shards(documents: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write each shard as a folder of its own; joins the texts to their shard by the hash of id and text.

    Rows that overflow are numbered here as in the assignment: all shards of equal bits but the last hold as many rows
    as the first one.
    """
    keyed = documents.withColumn("bits", hash_bits(F.col("doc_id"), F.col("text")))
    fit = F.count_if(F.col("overflow") == 1).alias("fit")
    named = assigned.groupBy("bits").agg(F.min("depth").alias("depth"), F.min("prefix").alias("prefix"), fit)
    # a stored table, so that only rows of groups that overflow are joined and numbered by it
    named = materialize(named.select("bits", shard_name(F.col("depth"), F.col("prefix"), F.lit(0)).alias("shard"), "fit"))
    written = keyed.join(named.where("fit = 0").drop("fit"), "bits")
    over = named.where("fit > 0")
    if not over.isEmpty():
        dealt = _numbered(keyed.join(over, "bits"))
        name = F.concat("shard", F.lit("+"), _overflow_of("number", "fit").cast("string"))
        written = written.unionByName(dealt.withColumn("shard", name).drop("number", "fit"))
    written.drop("bits").repartition("shard").write.partitionBy("shard").parquet(path)


def op10_extendible_shards(spark, folder: str) -> DataFrame:
    """The shard of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    rows = documents.select("doc_id", hash_bits(F.col("doc_id"), F.col("text")).alias("bits"), size.alias("bytes"))
    assigned = assign_shards(rows)
    return assigned.select(
        "doc_id",
        F.col("bytes").alias("n_bytes"),
        shard_name(F.col("depth"), F.col("prefix"), F.col("overflow")).alias("shard"),
        F.col("depth").cast("bigint").alias("depth"),
        "shard_bytes",
    )


OP10_SQL = f"""
with rows as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '') || '|' || coalesce(text, '')), 1, {BITS // 4}))::bigint as bits
  from documents
), levels as (
  select doc_id, n_bytes, bits, d as depth, bits >> ({BITS} - d) as prefix,
    sum(n_bytes) over (partition by d, bits >> ({BITS} - d)) as shard_bytes
  from rows, range(0, {BITS + 1}) r(d)
)
select doc_id, n_bytes, min(depth)::bigint as depth,
  arg_min(case when depth = 0 then '' else right(repeat('0', 60) || bin(prefix), depth::int) end, depth) as shard,
  arg_min(shard_bytes, depth)::bigint as shard_bytes
from levels where shard_bytes <= {LIMIT} group by doc_id, n_bytes, bits
"""
