from __future__ import annotations

import re
from collections import Counter
from math import floor, log

import duckdb
from cases import documents, sample, stored, texts, words

from stockloom.llm.nra_search import OP13_SQL, op13_ranked_search, search, term_counts


def terms_of(text):
    small = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def plain_search(rows, queries, k=10):
    """(item_id, rank, doc_id, score) from scoring every document of every query."""
    found = [(i, Counter(terms_of(t))) for i, t in rows]
    found = [(i, c) for i, c in found if c]
    n = len(found)
    length = sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in queries:
        scores = []
        for i, c in found:
            m = 100 - 90 + 90 * sum(c.values()) * n // length
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms_of(text)) if t in c)
            if score:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string").repartition(3)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_pieces_do_not_change_counts(monkeypatch):
    text = (words(800, 3) + " ÉTÉ été x_y-Z 日本 a\x00b ½").encode()
    monkeypatch.setattr("stockloom.llm.nra_search.PIECE", 37)
    assert {k.decode(): v for k, v in term_counts(text).items()} == Counter(terms_of(text.decode()))


def test_many_rounds_equal_scoring_all(spark):
    rows = [(r["doc_id"], r["text"]) for r in sample()]
    queries = [(r["item_id"], r["text"]) for r in sample(table="benchmark")][:12]
    queries += [(900, rows[3][1][:300]), (901, "the of and"), (902, "zzzz-nowhere"), (903, ""), (904, None)]
    expected = plain_search(rows, queries)
    assert found(search(frame(spark, rows), frame(spark, queries), first_read=4, growth=3, shard=3000, block=200)) == expected


def test_rows_do_not_depend_on_how_partitions_are_dealt(spark):
    """Many partitions, none put together: shards and queries must still meet."""
    rows = [(r["doc_id"], r["text"]) for r in sample()][:120]
    queries = [(r["item_id"], r["text"]) for r in sample(table="benchmark")][:4]
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for shard in (1 << 20, 1000):
            assert found(search(frame(spark, rows), frame(spark, queries), shard=shard)) == plain_search(rows, queries)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_ties_copies_and_awkward_rows(spark):
    copies = [(100 + i, words(30, 4)) for i in range(200)]  # a third and more are equal
    rows = texts() + copies + [(500 + i, words(25, i)) for i in range(60)]
    queries = [(1, words(12, 4)), (2, words(9, 7)), (2, words(9, 7)), (None, "the river x"), (3, "ZÜRICH 日本語 endoftext"), (4, words(400, 2))]
    for k in (1, 10):
        assert found(search(frame(spark, rows), frame(spark, queries), k=k, first_read=8, growth=2, shard=500, block=40)) == plain_search(rows, queries, k)


def test_empty_tables(spark):
    some = frame(spark, [(1, "a b")])
    none = spark.createDataFrame([], "id bigint, text string")
    assert search(none, some).collect() == [] and search(some, none).collect() == []
    assert search(frame(spark, [(1, None), (2, " -- ")]), some).collect() == []
    assert found(search(some, some)) == plain_search([(1, "a b")], [(1, "a b")])


def test_query_and_its_sql(spark, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in sample()]
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").selectExpr("*", "1 as row", "'x' as term", "2 as t")
    folder = stored(spark, tmp_path, documents=documents(spark, rows), benchmark=items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet/*.parquet'")
    expected = sorted(con.execute(f"select item_id, rank, doc_id, score from ({OP13_SQL})").fetchall(), key=str)
    assert found(op13_ranked_search(spark, folder)) == expected
    assert expected == plain_search(rows, [(r["item_id"], r["text"]) for r in sample(table="benchmark")])
