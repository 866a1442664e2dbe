"""Approximate nearest neighbours by largest inner product, with an inverted multi-index.

A vector is cut into two halves and each half is quantised by its own codebook; a cell is a pair of centroids. A query
sorts both codebooks by distance and walks the pairs by summed distance with a heap, until the cells it has passed hold
the wanted share of all rows. Those rows are reranked by the exact inner product in double precision.

Largest inner product becomes smallest distance by one more coordinate, the square root of (largest squared norm - own
squared norm), which is 0 for queries. The codebooks are fitted on a sample of at most ``sample`` rows, and the share is
the smallest one with which the sample's own queries find ``recall`` of their neighbours, ``margin`` added; every row is
indexed. Ranks within a sample are a cautious guide, as neighbours in the full table are nearer than those in the sample.

Work is dealt by first centroid: a piece is at most ``rows_per_piece`` rows of a centroid and about ``queries_per_piece``
of the queries that visit it, so neither a frequent centroid nor many queries gather in one task. Equal vectors are one
entry that lists its smallest ids, as no more than the wanted number of them can be among the nearest.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part, nor do null ids; of rows with the same id the least vector counts; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.session import materialize

#: Size of the sample, largest codebook, and entries a cell should hold on average. The cells' counts, at most the square of
#: the largest codebook, are what the driver gathers; from 4 million entries on cells hold more than the average.
SAMPLE, CODEBOOK, PER_CELL = 4000, 256, 64
#: Queries whose inner products with a piece are formed at once.
BLOCK = 128


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part, equal rows once."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.where("vec_id is not null and embedding is not null").select("vec_id", values.alias("vector"))
    finite = ~F.exists("vector", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return rows.where(finite & F.exists("vector", lambda x: x != 0)).distinct()


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmin((centroids**2).sum(1) - 2 * points @ centroids.T, 1)


def _lloyd(points: np.ndarray, k: int, seed: int, steps: int = 10) -> np.ndarray:
    centroids = points[np.random.default_rng(seed).choice(len(points), k, replace=False)].copy()
    for _ in range(steps):
        near = _nearest(points, centroids)
        for j in range(k):
            if (own := near == j).any():
                centroids[j] = points[own].mean(0)
    return centroids


class MultiIndex:
    """Two codebooks, the largest squared norm, and the share of rows a query passes."""

    def __init__(self, sample: np.ndarray, rows: int, largest: float, top: int, recall: float, margin: float):
        self.largest, self.half = largest, sample.shape[1] // 2
        k = max(1, min(CODEBOOK, len(sample), round((rows / PER_CELL) ** 0.5)))
        full = self.lifted(sample)
        self.books = [_lloyd(full[:, : self.half], k, 1), _lloyd(full[:, self.half :], k, 2)]
        self.share = self._calibrate(sample, top, recall, margin)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, self.largest - (vectors**2).sum(1)))
        return np.c_[vectors, rest]

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        full = self.lifted(vectors)
        return _nearest(full[:, : self.half], self.books[0]), _nearest(full[:, self.half :], self.books[1])

    def distances(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        full = np.c_[queries, np.zeros(len(queries))]
        halves = full[:, : self.half], full[:, self.half :]
        return tuple((b**2).sum(1) - 2 * h @ b.T + (h**2).sum(1)[:, None] for h, b in zip(halves, self.books, strict=True))

    def _calibrate(self, sample: np.ndarray, top: int, recall: float, margin: float) -> float:
        queries = sample[:200]
        scores = queries @ sample.T
        np.fill_diagonal(scores, -np.inf)
        wanted = np.argsort(-scores, 1, kind="stable")[:, : min(top, len(sample) - 1)]
        if not wanted.size:
            return 1.0
        one, two = self.cells(sample)
        d1, d2 = self.distances(queries)
        away = d1[:, one] + d2[:, two]
        found = np.take_along_axis(away, wanted, 1)
        passed = np.stack([np.searchsorted(np.sort(a), f, "right") for a, f in zip(away, found, strict=True)])
        return float(min(1.0, np.quantile(passed / len(sample), recall) + margin))

    def walk(self, d1: np.ndarray, d2: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Cells (k x k) a query passes: pairs by summed distance until they hold the share of all rows."""
        wanted = int(np.ceil(self.share * counts.sum()))
        o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
        s1, s2 = d1[o1].tolist(), d2[o2].tolist()
        sorted_counts = counts[np.ix_(o1, o2)].tolist()
        passed = np.zeros(counts.shape, bool)
        heap, held = [(s1[0] + s2[0], 0, 0)], 0
        front = [0] * len(s2)  # next row to be reached in each column
        front[0] = 1
        out_i, out_j = [], []
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            held += sorted_counts[i][j]
            out_i.append(i)
            out_j.append(j)
            if front[j] == i + 1 and i + 1 < len(s1):
                front[j] = i + 2
                heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
            if i == 0 and j + 1 < len(s2):
                front[j + 1] = 1
                heapq.heappush(heap, (s1[0] + s2[j + 1], 0, j + 1))
        passed[o1[out_i], o2[out_j]] = True
        return passed


def fit_index(entries: DataFrame, top: int, recall: float = 0.95, margin: float = 0.02, sample: int = SAMPLE) -> MultiIndex | None:
    """Fit on the entries with the smallest hashes of their vector; None for an empty table."""
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    n, largest = entries.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return None
    near = entries.orderBy(F.xxhash64("vector"), "vector").limit(sample)
    points = np.array([r["vector"] for r in near.select("vector").collect()], np.float64)
    return MultiIndex(points, n, largest, top, recall, margin)


def search(rows: DataFrame, queries: DataFrame, top: int = 20, rows_per_piece: int = 16384, queries_per_piece: int = 16384) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` rows of largest inner product found for each query row but itself."""
    lengths = sorted(r[0] for r in rows.select(F.size("vector").alias("n")).distinct().collect())
    if not lengths:
        return rows.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = None
    for n in lengths:
        own = (df if len(lengths) == 1 else df.where(F.size("vector") == n) for df in (rows, queries))
        part = _search(*own, top, rows_per_piece, queries_per_piece)
        found = part if found is None else found.unionByName(part)
    return found


def _search(rows: DataFrame, queries: DataFrame, top: int, rows_per_piece: int, queries_per_piece: int) -> DataFrame:
    # equal vectors: one entry with its top + 1 smallest ids (one may be the query itself)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    numbered = rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= top + 1)
    entries = materialize(numbered.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    index = fit_index(entries, top)
    k = len(index.books[0])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            one, two = index.cells(vectors) if len(vectors) else (np.zeros(0, np.int64),) * 2
            arrays = [*batch.columns, pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, ["ids", "vector", "one", "two"])

    placed = materialize(
        entries.select("ids", "vector").mapInArrow(place, "ids array<bigint>, vector array<double>, one int, two int")
    )
    counts = np.zeros((k, k), np.int64)
    for r in placed.groupBy("one", "two").count().collect():  # k x k rows at most
        counts[r["one"], r["two"]] = r["count"]
    pieces_of = {int(c): -(-int(n) // rows_per_piece) for c, n in enumerate(counts.sum(1)) if n}
    query_pieces = max(1, -(-queries.count() // queries_per_piece))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                vectors, out = _matrix(part.column("vector")), []
                for q, (d1, d2) in enumerate(zip(*index.distances(vectors), strict=True)):
                    passed = index.walk(d1, d2, counts)
                    out += [(q, int(c), p, np.packbits(passed[c]).tobytes()) for c in np.flatnonzero(passed.any(1)) for p in range(pieces_of.get(int(c), 0))]
                columns = list(zip(*out, strict=True)) if out else [[]] * 4
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
                at, one, piece, mask = (pa.array(c, t) for c, t in zip(columns, kinds, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(at) for c in ("vec_id", "key", "vector")), one, piece, mask], ["query_id", "key", "query", "one", "piece", "mask"]
                )

    routed = queries.select("vec_id", "vector", F.xxhash64("vector").alias("key")).mapInArrow(
        route, "query_id bigint, key bigint, query array<double>, one int, piece int, mask binary"
    )
    routed = routed.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(query_pieces)).cast("int"))
    piece_count = F.element_at(F.create_map(*[F.lit(int(x)) for kv in pieces_of.items() for x in kv]), F.col("one"))
    dealt = placed.withColumn("piece", F.pmod(F.xxhash64("ids"), piece_count).cast("int"))
    dealt = dealt.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(query_pieces - 1))))

    def rerank(entry: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(entry) and len(asked):
            vectors, two = np.stack(entry["vector"].to_numpy()), entry["two"].to_numpy()
            ids, lengths = np.concatenate(entry["ids"].to_numpy()), entry["ids"].map(len).to_numpy()
            first = np.cumsum(lengths) - lengths
            for start in range(0, len(asked), BLOCK):
                part = asked.iloc[start : start + BLOCK]
                queries_ = np.stack(part["query"].to_numpy())
                masks = np.unpackbits(np.stack([np.frombuffer(m, np.uint8) for m in part["mask"]]), axis=1)[:, :k].astype(bool)
                names = part["query_id"].to_numpy()
                query, vec_id, score = _best(queries_, names, masks[:, two], vectors, ids, first, lengths, top)
                found.append((names[query], part["key"].to_numpy()[query], vec_id, score))
        query_id, key, vec_id, score = (np.concatenate(c) for c in zip(*found, strict=True))
        return pd.DataFrame({"query_id": query_id, "key": key, "vec_id": vec_id, "score": score})

    keys = ("one", "piece", "turn")
    schema = "query_id bigint, key bigint, vec_id bigint, score double"
    best = dealt.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInPandas(rerank, schema)
    nearest = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _best(
    queries: np.ndarray, names: np.ndarray, passed: np.ndarray, vectors: np.ndarray, ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of a query, id and score of the top rows of each among the passed entries, itself left out.

    Entry e has the ids ``first[e]`` to ``first[e] + lengths[e]``.
    """
    scores = queries @ vectors.T
    scores[~passed] = -np.inf
    least = scores.min(1)
    if scores.shape[1] > top:
        least = np.partition(scores, -top - 1, axis=1)[:, -top - 1]
    query, entry = np.nonzero((scores >= least[:, None]) & passed)
    score, times = scores[query, entry], lengths[entry]
    at = np.repeat(np.arange(len(query)), times)
    place = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[entry], times)
    query, entry, score, found = query[at], entry[at], score[at], ids[place]
    own = found == names[query]
    own[own] = (vectors[entry[own]] == queries[query[own]]).all(1)
    query, score, found = query[~own], score[~own], found[~own]
    order = np.lexsort((found, -score, query))
    query, score, found = query[order], score[order], found[order]
    begin = np.searchsorted(query, np.arange(len(queries)))
    keep = np.arange(len(query)) - begin[query] < top
    return query[keep], found[keep], score[keep]


def op7_nearest_vectors(spark, folder: str) -> DataFrame:
    """Every twentieth id against all rows, 20 nearest."""
    rows = materialize(usable(spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding")))
    return search(rows, rows.where("vec_id % 20 = 0"), top=20)
