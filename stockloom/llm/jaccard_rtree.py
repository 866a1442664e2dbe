"""N-gram Jaccard join with a count-vector R-tree.

The shingles of a set are hashed into groups; the counts per group are a point. Two sets share at most the summed
coordinate minima of their points, and a node of an R-tree gives the same bound for all points inside its box, so the tree
is searched with "summed minima >= shingles needed" and the pairs that survive are verified on the sets themselves.

One tree over all points would be searched almost whole: unrelated texts of equal length have nearly equal group counts,
and a box over many of them excludes nothing. Points are therefore dealt to clusters first, by an exact argument. All sets
are sorted by one order of the shingles, rare ones first. Two linked sets share at least needed = t(|A| + |B|)/(1 + t)
shingles, and the first SHARED of these (all, if needed is less) lie among the first |A| - needed + SHARED of A, and of B
likewise. The smaller of the two need only look at fewer, as its partner is not smaller. So every set emits its first
shingles as keys, and two sets are tied if they share SHARED keys; a passage that two texts have in common by chance, or a
line that very many have, ties nobody. A key of more than MOST sets is first counted between each of its sets and its
smallest one only, which ties families of copies; then between a set and the others of the key that do not hang together with
it so far, family by family. So no pair is lost, and sets that have only a frequent key in common are not brought together. Which shingles are frequent is
learned from an eighth of the texts; any order is exact.

Within a cluster the R-tree finds the links. Large clusters are cut into blocks, each pair of blocks is one task's work,
and a task returns a spanning forest of the links it found, never all pairs. Equal sets are one point from the start.

Defined results: words are maximal runs of bytes other than blank and 0x09-0x0D after lower-casing A-Z; a text of fewer
words than the width is one shingle; null texts and texts without words have an empty set and link with nothing; repeated
rows and null ids are rows of their own, and a component whose ids are all null has a null id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.llm.components import components
from stockloom.llm.text_batches import LOWER, SPACE, Words, flat, mix, sliced
from stockloom.session import materialize

U64 = np.uint64
#: Keys that two sets must share, and sets of a key up to which their pairs are counted one by one.
SHARED, MOST = 4, 64
#: One text in so many tells which shingles are frequent: those of LEAST such texts or more, the first LISTED of them.
SAMPLED, LEAST, LISTED = 8, 3, 1 << 18
#: Dimensions of the points, points in a leaf or children of a node, and sets in a block.
GROUPS, FAN_OUT, BLOCK = 64, 16, 2048
_FACTOR = [int(x) | 1 for x in mix(np.arange(101, 133, dtype=U64))]


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    data, offsets = flat(column)
    words = Words(LOWER[data], offsets, ~SPACE)
    hashes = words.hashes()
    n = max(0, len(hashes) - width + 1)
    joined = np.zeros(n, U64)
    for k in range(width):
        joined += hashes[k : k + n] * U64(_FACTOR[k])
    joined = mix(joined)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= width:
            found = np.sort(joined[a : b - width + 1])
            out.append(found[np.r_[True, found[1:] != found[:-1]]])
        elif b > a:
            whole = sum((int(h) * f for h, f in zip(hashes[a:b], _FACTOR, strict=False)), start=int(b - a))
            out.append(mix(np.array([whole & (2**64 - 1)], U64)))
        else:
            out.append(np.zeros(0, U64))
    return out


def frequent_shingles(documents: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles that many of the sampled texts hold, and in how many of these each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = np.concatenate([np.zeros(0, U64), *shingle_sets(batch.column("text"), width)])
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], ["shingle"])

    sample = documents.select("text").where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    counts = sample.mapInArrow(run, "shingle bigint").groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    most = counts.where(F.col("n") >= LEAST).orderBy(F.desc("n"), "shingle").limit(LISTED).toPandas()
    hashes = most["shingle"].to_numpy(np.int64).view(U64)
    order = np.argsort(hashes)
    return hashes[order], most["n"].to_numpy(np.int64)[order]


def cluster_keys(found: np.ndarray, num: int, den: int, frequent: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Keys of one set, its first shingles, rare ones first; different sets with num/den similarity or more share SHARED of
    them, or all that they have in common."""
    n = len(found)
    first = n + (-num * n // den) + SHARED
    if first < n and frequent is not None and len(frequent[0]):
        hashes, counts = frequent
        at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
        found = found[np.argsort(np.where(hashes[at] == found, counts[at], 0), kind="stable")]
    return found[:first]


class RTree:
    """Bulk-loaded tree over count vectors, sorted by set size and then by the widest coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        spread = np.argsort(-points.var(0), kind="stable")[:2] if len(points) else np.arange(2)
        slab = np.argsort(sizes, kind="stable")
        rank = np.empty(len(slab), np.int64)
        rank[slab] = np.arange(len(slab))
        self.order = np.lexsort((points[:, spread[1]], points[:, spread[0]], rank // FAN_OUT**2))
        #: each level: boxes' highest coordinates, and smallest and largest set size; from the leaves up
        self.levels = [(points[self.order], sizes[self.order], sizes[self.order])]
        while len(self.levels[-1][1]) > 1:
            high, small, large = self.levels[-1]
            cut = np.arange(0, len(small), FAN_OUT)
            self.levels.append((np.maximum.reduceat(high, cut), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)))

    def search(self, point: np.ndarray, size: int, num: int, den: int) -> np.ndarray:
        """Indices of the points that may reach the similarity with the given one."""
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            high, small, large = (a[nodes] for a in self.levels[depth])
            # the overlap needed grows with the partner's size, which is at least num/den of this one
            partner = np.maximum(small, -(-num * size // den))
            bound = np.minimum(high, point).sum(1)
            fits = ((num + den) * bound >= num * (size + partner)) & (large * den >= num * size) & (small * num <= den * size)
            nodes = nodes[fits]
            if depth:
                nodes = (nodes[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                nodes = nodes[nodes < len(self.levels[depth - 1][1])]
        return self.order[nodes]


def forest(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets: verified pairs that joined two trees."""
    sizes = np.array([len(s) for s in sets], np.int64)
    points = np.stack([np.bincount((s & U64(GROUPS - 1)).astype(np.int64), minlength=GROUPS) for s in sets])
    tree, label, out = RTree(points, sizes), np.arange(len(sets)), []
    for i in range(len(sets)):
        near = tree.search(points[i], int(sizes[i]), num, den)
        near = near[near > i]
        while len(near := near[label[near] != label[i]]):
            j, near = int(near[0]), near[1:]
            shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if den * shared >= num * (sizes[i] + sizes[j] - shared):
                out.append((i, j))
                label[label == label[j]] = label[i]
    return out


def set_rows(documents: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """doc_id, row_key, n_shingles, sid (hash of the whole set; null if empty) and its cluster keys in their order.

    A task gives the keys of equal sets once, so a set that many documents share adds a row per task and key.
    """

    frequent = frequent_shingles(documents, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in sliced(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            sids = [_sid(s) if len(s) else None for s in sets]
            keys = []
            for s, sid in zip(sets, sids, strict=True):
                keys.append(np.zeros(0, np.int64) if sid in seen else cluster_keys(s, num, den, frequent).view(np.int64))
                seen.add(sid)
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sids, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ],
                ["doc_id", "row_key", "n_shingles", "sid", "keys"],
            )

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key().alias("row_key"), "text")
    return rows.mapInArrow(run, "doc_id bigint, row_key bigint, n_shingles bigint, sid bigint, keys array<bigint>")


def row_key() -> Column:
    """Tells rows apart, also those without an id or with a repeated one; only rows equal in id and text share it."""
    return F.xxhash64("doc_id", "text")


def _sid(found: np.ndarray) -> int:
    return int(mix(np.array([np.add.reduce(mix(found + U64(_FACTOR[2])))], U64)).view(np.int64)[0])


def _ties(stored: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of sets that may be linked, enough to connect all that are; from the rows of :func:`set_rows`."""
    both = num + den
    # of the smaller set of a pair fewer keys count, as its partner is not smaller
    head = F.col("at") < F.col("n_shingles") - F.expr(f"({2 * num} * n_shingles + {both - 1}) div {both}") + SHARED
    keys = stored.where("sid is not null").select("sid", "n_shingles", F.posexplode("keys").alias("at", "key"))
    # one number beside set and key, as most rows are shuffled for nothing
    keys = keys.select("sid", "key", (F.col("n_shingles") * 2 + head.cast("int")).alias("tag"))
    of_key = Window.partitionBy("key")
    met = keys.withColumns({"least": F.min("sid").over(of_key), "last": F.max("sid").over(of_key)}).where("least <> last")
    met = met.drop("last").dropDuplicates(["key", "sid"]).withColumn("members", F.count(F.lit(1)).over(of_key))
    met = materialize(met)
    row = F.struct(F.expr("tag div 2").alias("size"), "sid", (F.col("tag") % 2 == 1).alias("head")).alias("row")
    rows = met.where(F.col("members") <= MOST).select("key", row).groupBy("key").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    rows = rows.select("rows", F.posexplode("rows").alias("at", "a")).where("a.head")
    pairs = rows.select("a", F.explode(F.expr("slice(rows, at + 2, size(rows))")).alias("b")).where(f"{num} * b.size <= {den} * a.size")
    pairs = _shared_keys(pairs)

    needed = F.expr(f"({num} * sizes + {both - 1}) div {both}")
    enough = F.col("shared") >= F.least(F.lit(SHARED), needed)
    frequent = met.where(F.col("members") > MOST)
    if frequent.isEmpty():
        return pairs.where(enough).select("a", "b")
    pairs, frequent = materialize(pairs), frequent.select("key", "sid", "least", row)
    hubs = frequent.where("sid = least").select("key", F.col("row").alias("b"))
    with_hub = _shared_keys(frequent.where("sid <> least").select("key", F.col("row").alias("a")).join(hubs, "key"))
    ties = _summed(pairs, with_hub).where(enough).select("a", "b")
    rooted = materialize(components(ties))

    more = _strangers(frequent, pairs, rooted, num, den)
    return rooted.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more)


def _strangers(frequent: DataFrame, pairs: DataFrame, rooted: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): a set and the root of another tree of ``rooted``, which hold enough keys in common, frequent ones among them.

    Sets of one tree are compared anyway. A set of the smaller of two trees counts the frequent keys under which it meets the
    other one, and the rarer keys it shares with one set of it: at least as many as with any single set there, so no link is
    lost, and a large tree is not listed set by set.
    """
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    trees = rooted.join(sizes, "root").select(F.col("node").alias("sid"), "root", "members")
    groups = frequent.join(trees, "sid", "left").groupBy(
        "key", F.coalesce("members", F.lit(1)).alias("members"), F.coalesce("root", "sid").alias("root")
    )
    groups = groups.agg(F.collect_list("row").alias("rows"), F.min("row.size").alias("small"), F.max("row.size").alias("large"))
    groups = groups.withColumn("tree", F.struct("members", "root")).drop("members", "root")
    other = groups.select("key", *[F.col(c).alias(f"{c}_b") for c in ("tree", "small", "large")])
    fits = lambda low, high: f"{num} * {low} <= {den} * large_b and {num} * small_b <= {den} * {high}"
    apart = groups.join(other, "key").where("tree < tree_b").where(fits("small", "large"))
    loose = apart.select("key", F.explode("rows").alias("a"), "tree_b", "small_b", "large_b").where(fits("a.size", "a.size"))
    loose = loose.select("a.sid", "a.size", F.col("tree_b.root").alias("root"))

    both_ways = pairs.select(F.col("a").alias("sid"), F.col("b").alias("node"), "shared")
    both_ways = both_ways.unionByName(pairs.select(F.col("b").alias("sid"), F.col("a").alias("node"), "shared"))
    rarer = both_ways.join(rooted, "node", "left").groupBy("sid", F.coalesce("root", "node").alias("root")).agg(F.max("shared").alias("rarer"))
    needed = F.least(F.lit(SHARED), F.expr(f"({num} * size + {den - 1}) div {den}"))
    near = loose.groupBy("sid", "size", "root").agg(F.count(F.lit(1)).alias("keys")).join(rarer, ["sid", "root"], "left")
    near = near.where(F.col("keys") + F.coalesce("rarer", F.lit(0)) >= needed)
    return near.select(F.col("sid").alias("a"), F.col("root").alias("b"))


def _shared_keys(rows: DataFrame) -> DataFrame:
    """(a, b, sizes, shared): how many keys each pair of sets meets under, with the sum of their sizes."""
    ends = [F.least("a.sid", "b.sid").alias("a"), F.greatest("a.sid", "b.sid").alias("b")]
    return rows.groupBy(*ends, (F.col("a.size") + F.col("b.size")).alias("sizes")).agg(F.count(F.lit(1)).alias("shared"))


def _summed(pairs: DataFrame, others: DataFrame) -> DataFrame:
    return pairs.unionByName(others).groupBy("a", "b", "sizes").agg(F.sum("shared").alias("shared"))


def _linked_sets(documents: DataFrame, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """:func:`set_rows`, stored, and (node, root) of the sets that link with another."""
    stored = materialize(set_rows(documents, width, num, den))
    clusters = materialize(components(_ties(stored, num, den).distinct()))

    edges = materialize(_cluster_links(documents, stored, clusters, width, num, den))
    return stored, materialize(components(edges))


def link_components(documents: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id; documents link when den * shared >= num * united."""
    stored, linked = _linked_sets(documents, width, num, den)
    # back to documents: the smallest id of the sets of a component
    owners = stored.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least_id"))
    owners = materialize(owners.join(linked.withColumnRenamed("node", "sid"), "sid", "left"))
    of_root = owners.where("root is not null").groupBy("root").agg(F.min("least_id").alias("root_id"))
    owners = owners.join(of_root, "root", "left").select("sid", F.coalesce("root_id", "least_id").alias("component"))
    named = stored.select("doc_id", "n_shingles", "sid").join(owners, "sid", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(documents: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """row_key of the row of each component that stays: the one with the smallest (id, hash of the row), null ids last.

    Rows with an empty set link with nothing, so each of them stays.
    """
    stored, linked = _linked_sets(documents, width, num, den)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key"))
    own = stored.where("sid is not null").groupBy("sid").agg(first.alias("row"))
    own = own.join(linked.withColumnRenamed("node", "sid"), "sid", "left").select(F.coalesce("root", "sid").alias("root"), "row.*")
    stay = own.groupBy("root").agg(first.alias("row")).select("row.row_key")
    return stay.unionByName(stored.where("sid is null").select("row_key").distinct())


def _cluster_links(documents: DataFrame, stored: DataFrame, clusters: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Verified links between sets of one cluster, as (a, b) of set ids."""
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = clusters.join(sizes, "root").select(
        F.col("node").alias("sid"), "root", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block")
    )
    # one row of each set brings its text again
    bringer = stored.join(placed, "sid").groupBy("sid", "root", "blocks", "block").agg(F.min("row_key").alias("row_key"))
    named = documents.select("text", row_key().alias("row_key")).join(bringer, "row_key").drop("row_key")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The set of each text, with the other columns; a row whose key another row has by chance goes."""
        for batch in sliced(batches, "text"):
            found = shingle_sets(batch.column("text"), width)
            sids = [_sid(f) if len(f) else None for f in found]
            keep = [k for k, (own, want) in enumerate(zip(sids, batch.column("sid").to_pylist(), strict=True)) if own == want]
            others = [n for n in batch.schema.names if n not in ("text", "sid")]
            arrays = [pa.array([sids[k] for k in keep], pa.int64()), pa.array([found[k].tobytes() for k in keep], pa.binary())]
            arrays += [batch.column(n).take(pa.array(keep, pa.int64())) for n in others]
            yield pa.RecordBatch.from_arrays(arrays, ["sid", "items", *others])

    members = named.select("text", "sid", "root", "blocks", "block").mapInArrow(
        sets, "sid bigint, items binary, root bigint, blocks int, block int"
    )
    # each block meets every block of its cluster once
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = members.select("sid", "items", "root", "block", other.alias("other"), "blocks")
    paired = paired.where("blocks = 1 or block <> other")
    work = [F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")]

    def links(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("sid").sort_values("sid", ignore_index=True)
        ids = frame["sid"].to_numpy()
        pairs = forest([np.frombuffer(x, U64) for x in frame["items"]], num, den)
        return pd.DataFrame({"a": [ids[i] for i, _ in pairs], "b": [ids[j] for _, j in pairs]}, dtype="int64")

    return paired.select("sid", "items", "root", *work).groupBy("root", "one", "two").applyInPandas(links, "a bigint, b bigint")


def op5_jaccard_components(spark, folder: str) -> DataFrame:
    """All documents, three-word shingles, similarity 0.9 or more."""
    return link_components(spark.read.parquet(f"{folder}/documents.parquet"), width=3, num=90, den=100)


OP5_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), places as (
  select doc_id, w, unnest(range(1, 1 + greatest(len(w) - 2, 1))) as i from words where len(w) > 0
), shingles as (
  select distinct doc_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end as s from places
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), same as (
  select a.doc_id as x, b.doc_id as y, count(*) as common from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
  select x, y from same join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * common >= 90 * (p.n + q.n - common)
), reach as (
  select doc_id as x, doc_id as y from documents union select r.x, l.y from reach r join links l on l.x = r.y
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from (select x as doc_id, min(y) as component_id from reach group by x) left join sizes using (doc_id)
"""
