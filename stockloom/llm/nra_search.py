"""Ranked lexical search by NRA: sorted lists are read from the top, documents keep score intervals, nothing is looked up.

Terms are maximal runs of digits, letters and characters beyond ASCII, with A-Z lower-cased. Corpus counts (N, L, the df of each
term of a query) come first, over all documents. The postings of the queries' terms are then dealt by document to shards of about
``SHARD`` postings, however frequent a term is. A shard holds one list per term, highest impact first, and every query
reads its lists there, ``FIRST_READ`` postings of each at first and ``GROWTH`` times what has been read with each further round.

After a round a document has a lower score (its terms seen so far) and an upper one (plus, for each term not seen, the highest gain
that the list has left). With the k-th largest lower score of the shard as border a query
* takes no new documents once the sum of what all its lists have left is below the border;
* keeps the documents whose upper score is not below the border, ties included;
* ends when none of these has an open interval. Then membership, ties and scores are exact.
Lists that are read to their end leave nothing, so every query ends. The best of each shard, k rows a query, are
merged into the best of all.

A query set too large for one task's memory is cut into blocks of about ``ASKED`` terms; a shard and a block meet in one
task. Nothing is broadcast by hand or collected but N, L and the number of shards and blocks.

Scores are 64-bit integers: a term's weight w = floor(1000 ln((2N + 2) / (2 df + 1))), its impact in a document
(10^9 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L; the score sums w * impact over the query's distinct terms.

Defined results: null texts have no terms; a document or query without terms appears nowhere. Every row is a document or
a query of its own, also with a null or repeated id; null ids come last among ties. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.session import materialize

#: Postings of a list read at first, and the factor by which what has been read grows with each round.
FIRST_READ, GROWTH = 256, 4
#: Postings of a shard and terms of a block of queries, on average.
SHARD, ASKED = 1 << 20, 1 << 16
PIECE = 1 << 20
#: Bytes that end a term become blanks, capital letters small ones.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_END = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Stands for the document itself in its list of terms and brings the corpus totals.
WHOLE = b""


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a whole text, counted piece by piece."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            gap = _END.search(text, end)
            end = gap.start() if gap else len(text)
        found.update(text[at:end].translate(_FOLD).split())
        at = end
    return found


def occurrences(rows: DataFrame) -> DataFrame:
    """id, text -> row, id, n (terms with repeats), term, tf; also the empty term once for a row that has any term.

    ``row`` tells rows apart only once the result is stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            sizes, lengths, terms, times = [], [0], [], []
            for text in batch.column("text").to_pylist():
                found = term_counts((text or "").encode())
                n = sum(found.values())
                if n:
                    terms += [WHOLE, *found]
                    times += [n, *found.values()]
                sizes.append(n)
                lengths.append(len(terms))
            at = pa.array(lengths, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(terms, pa.binary()).cast(pa.string())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(sizes, pa.int64()), *lists], ["row", "id", "n", "terms", "times"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("bigint").alias("id"), "text")
    counted = numbered.mapInArrow(run, "row bigint, id bigint, n bigint, terms array<string>, times array<bigint>")
    each = F.explode(F.arrays_zip("terms", "times")).alias("each")
    return counted.select("row", "id", "n", each).select("row", "id", "n", F.col("each.terms").alias("term"), F.col("each.times").alias("tf"))


def best_documents(lists: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, k: int, first_read: int, growth: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of the documents 0 .. len(ids) - 1 with a score above 0, and their exact scores.

    A list holds documents and their gains, highest first; ``ids`` decide between equal scores.
    """
    lower, read, depth = np.zeros(len(ids), np.int64), [0] * len(lists), first_read
    while True:
        for j, (documents, gains) in enumerate(lists):
            upto = min(depth, len(gains))
            lower[documents[read[j] : upto]] += gains[read[j] : upto]
            read[j] = upto
        left = [int(gains[at]) if at < len(gains) else 0 for at, (_, gains) in zip(read, lists, strict=True)]
        total = sum(left)
        border = int(np.partition(lower, -k)[-k]) if len(lower) >= k else 0
        if total < border or not total:
            seen = np.zeros(len(ids), np.int64)
            for at, rest, (documents, _) in zip(read, left, lists, strict=True):
                if rest:
                    seen[documents[:at]] += rest
            upper = lower + (total - seen)
            reach = np.flatnonzero((lower > 0) & (upper >= border))
            if (upper[reach] == lower[reach]).all():
                break
        depth *= growth
    reach = reach[np.lexsort((ids[reach], -lower[reach]))][:k]
    return reach, lower[reach]


def _shard_search(k: int, first_read: int, growth: int):
    def run(postings: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        postings = postings.sort_values(["t", "impact"], ascending=[True, False], ignore_index=True)
        rows, document = np.unique(postings["row"].to_numpy(), return_inverse=True)
        place = np.empty(len(rows), np.int64)
        place[document] = np.arange(len(document))
        names = postings[["unnamed", "id", "row"]].iloc[place]
        # the rank of each document among equal scores
        ids = np.empty(len(rows), np.int64)
        ids[np.lexsort((names["row"], names["id"], names["unnamed"]))] = np.arange(len(rows))
        impacts, terms = postings["impact"].to_numpy(), postings["t"].to_numpy()
        found = []
        for q, own in asked.groupby("q"):
            starts, ends = (np.searchsorted(terms, own["t"].to_numpy(), side) for side in ("left", "right"))
            lists = [(document[i:j], impacts[i:j] * w) for i, j, w in zip(starts, ends, own["w"].tolist(), strict=True) if i < j]
            if lists:
                best, scores = best_documents(lists, ids, k, first_read, growth)
                found.append(names.iloc[best].assign(q=q, score=scores))
        columns = ["q", "row", "id", "unnamed", "score"]
        return pd.concat(found)[columns] if found else pd.DataFrame(columns=columns).astype({c: "int64" for c in columns} | {"unnamed": bool})

    return run


def search(
    documents: DataFrame, queries: DataFrame, k: int = 10, first_read: int = FIRST_READ, growth: int = GROWTH, shard: int = SHARD, block: int = ASKED
) -> DataFrame:
    """documents (id, text), queries (id, text) -> item_id, rank, doc_id, score: the k best documents of each query."""
    words = materialize(occurrences(queries).where(F.col("term") != "").select(F.col("row").alias("q"), F.col("id").alias("item_id"), "term"))
    whole = F.explode(F.array(F.lit(""), F.col("term"))).alias("term")
    vocabulary = materialize(words.select(whole).distinct().select("term", F.monotonically_increasing_id().alias("t")))
    found = materialize(occurrences(documents).join(vocabulary, "term").select("t", (F.col("term") == "").alias("whole"), "row", "id", "n", "tf"))
    totals = F.count_if("whole"), F.coalesce(F.sum(F.when(F.col("whole"), F.col("n"))), F.lit(1)), F.count_if(~F.col("whole"))
    many, length, size = found.agg(*totals).first()

    impact = F.expr(f"(1000000000 * tf) div (1000 * tf + 8 * (10 + (90 * n * {many}) div {length}))").alias("impact")
    postings = found.where("not whole").select("t", "row", F.col("id").isNull().alias("unnamed"), F.coalesce("id", F.lit(0)).alias("id"), impact)
    weight = F.floor(1000 * F.log((F.lit(2.0) * many + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint")
    weights = postings.groupBy("t").agg(F.count(F.lit(1)).alias("df")).select("t", weight.alias("w")).where("w > 0")
    asked = materialize(words.join(vocabulary, "term").join(weights, "t").select("q", "t", "w"))
    blocks = F.lit(asked.count() // block + 1)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("q"), blocks).cast("int"))

    shards = size // shard + 1
    # both sides of a cogroup need keys of one type, as an int and a bigint are dealt to different partitions
    dealt = postings.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    dealt = dealt.join(asked.select("t", "block").distinct(), "t")
    everywhere = asked.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumnRenamed("block", "part")
    near = dealt.groupBy("shard", "block").cogroup(everywhere.groupBy("at", "part")).applyInPandas(
        _shard_search(k, first_read, growth), "q bigint, row bigint, id bigint, unnamed boolean, score bigint"
    )
    first = Window.partitionBy("q").orderBy(F.desc("score"), "unnamed", "id", "row")
    best = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    named = best.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("id")))
    return named.join(words.select("q", "item_id").distinct(), "q").select("item_id", "rank", "doc_id", "score")


def op13_ranked_search(spark, folder: str) -> DataFrame:
    """The ten best of all documents for each benchmark item."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").alias("id"), "text")
    return search(documents, items)


OP13_SQL = r"""
with folded as (
  select doc_id as id, 0 as kind, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as s from documents
  union all select item_id, 1, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') from benchmark
), words as (
  select kind, id, unnest(regexp_extract_all(s, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from folded where s is not null
), counts as (
  select id, term, count(*) as tf from words where kind = 0 group by id, term
), sizes as (
  select id, sum(tf)::bigint as n from counts group by id
), totals as (
  select count(*)::bigint as nn, sum(n)::bigint as ll from sizes
), weights as (
  select term, floor(1000 * ln((2.0::double * nn + 2) / (2.0::double * count(*) + 1)))::bigint as w from counts, totals group by term, nn
), impacts as (
  select c.id, term, ((1000000000 * c.tf) // (1000 * c.tf + 8 * (100 - 90 + ((90 * n * nn) // ll))))::bigint as impact
  from counts c join sizes s on s.id = c.id cross join totals
), scores as (
  select q.id as item_id, i.id as doc_id, sum(w * impact)::bigint as score
  from (select distinct id, term from words where kind = 1) q join weights using (term) join impacts i using (term) group by q.id, i.id
), ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from scores where score > 0
)
select * from ranked where rank <= 10
"""
