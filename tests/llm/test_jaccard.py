from __future__ import annotations

import random
import re

import duckdb
import numpy as np
import pytest
from cases import documents, stored, texts
from compare import assert_same

from stockloom.llm import jaccard_rtree as rtree
from stockloom.llm.components import components
from stockloom.llm.queries import LLM_QUERIES, LLM_STATEMENTS


def brute(rows, width, num, den):
    """(doc_id, n_shingles, component) by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and den * shared >= num * (len(a) + len(sets[j]) - shared):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(rows, label, strict=True):
        if doc is not None:
            least[x] = min(doc, least.get(x, doc))
    return sorted(((d, len(s), least.get(x)) for (d, _), s, x in zip(rows, sets, label, strict=True)), key=str)


def varied(seed, n, copies):
    """Texts in families of edited copies, from short to long."""
    rng, out = random.Random(seed), []
    while len(out) < n:
        base = [rng.choice("abcdefgh") + str(rng.randrange(60)) for _ in range(int(2 ** rng.uniform(0, 8)))]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 15)):
                at = rng.randrange(len(text))
                text[at : at + rng.randrange(2)] = [f"new{rng.randrange(99)}"] * rng.randrange(2)
            out.append(" ".join(text))
    return list(enumerate(out[:n]))


def rows_of(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "width", "num", "den"), [(1, 3, 90, 100), (2, 5, 80, 100), (3, 2, 50, 100)])
def test_against_all_pairs(spark, seed, width, num, den):
    rows = varied(seed, 250, 12)
    assert rows_of(rtree.link_components(documents(spark, rows), width, num, den)) == brute(rows, width, num, den)


def test_blocks_of_a_large_cluster(spark, monkeypatch):
    """One family of near copies, worked on in pairs of small blocks."""
    monkeypatch.setattr(rtree, "BLOCK", 20)
    rng = random.Random(5)
    base = [str(i) for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(120)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(text)))
    assert rows_of(rtree.link_components(documents(spark, rows), 3, 90, 100)) == brute(rows, 3, 90, 100)


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(0)
    for num, den in ((90, 100), (80, 100), (50, 100)):
        for n in [*range(1, 60), 100, 333, 1000]:
            for _ in range(6):
                whole = np.unique(rng.integers(0, 2**63, 2 * n, dtype=np.uint64))
                drop = int(n * (den - num) / den)
                a = np.sort(whole[:n])
                b = np.sort(rng.permutation(a)[: n - rng.integers(0, drop + 1)]) if rng.random() < 0.5 else np.sort(np.r_[a[drop // 2 :], whole[n : n + drop // 2]])
                shared = len(np.intersect1d(a, b))
                if len(b) and len(a) != shared and den * shared >= num * (len(a) + len(b) - shared):
                    assert np.intersect1d(rtree.cluster_keys(a, num, den), rtree.cluster_keys(b, num, den)).size


def test_shared_passages_make_no_cluster(spark, monkeypatch):
    """Texts with a line that all have and a phrase that two have are no candidates of each other; copies still are."""
    seen = []
    links = rtree._cluster_links
    monkeypatch.setattr(rtree, "_cluster_links", lambda docs, stored, clusters, *rest: seen.append(clusters) or links(docs, stored, clusters, *rest))
    rng = random.Random(7)
    line = " ".join(f"license{i}" for i in range(12))
    rows = []
    for i in range(200):
        own = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        own[10:16] = [f"phrase{i // 2}x{k}" for k in range(6)]
        rows.append((i, " ".join([*own, line])))
    rows.append((200, rows[0][1] + " more"))
    assert rows_of(rtree.link_components(documents(spark, rows), 5, 80, 100)) == brute(rows, 5, 80, 100)
    assert seen[0].count() == 2


@pytest.mark.parametrize(("shared", "most"), [(1, 64), (4, 3), (2, 1)])
def test_ties_lose_no_link(spark, monkeypatch, shared, most):
    """Also with fewer keys asked for, and with keys too frequent to be counted pair by pair."""
    monkeypatch.setattr(rtree, "SHARED", shared)
    monkeypatch.setattr(rtree, "MOST", most)
    monkeypatch.setattr(rtree, "LEAST", 1)
    rows = varied(11, 300, 20)
    rows += [(1000 + i, text) for i, (_, text) in enumerate(rows[:40])]
    assert rows_of(rtree.link_components(documents(spark, rows), 3, 80, 100)) == brute(rows, 3, 80, 100)


def test_frequent_keys_alone_make_no_cluster(spark, monkeypatch):
    """Phrases that many texts have tie neither all of them nor, by chains of phrases, unrelated ones; families of copies hang together."""
    monkeypatch.setattr(rtree, "MOST", 8)
    monkeypatch.setattr(rtree, "LEAST", 10**9)
    seen = []
    links = rtree._cluster_links
    monkeypatch.setattr(rtree, "_cluster_links", lambda docs, stored, clusters, *rest: seen.append(clusters) or links(docs, stored, clusters, *rest))
    phrase = lambda name: " ".join(f"{name}x{k}" for k in range(6))
    rows = [(i, f"{phrase(f'p{i // 15}')} {phrase(f'own{i}')} {phrase(f'q{i % 15}')}") for i in range(225)]
    base = [f"b{k}" for k in range(60)]
    rows += [(1000 + i, " ".join([*base[:i], f"new{i}", *base[i + 1 :]])) for i in range(30)]
    assert rows_of(rtree.link_components(documents(spark, rows), 5, 80, 100)) == brute(rows, 5, 80, 100)
    assert seen[0].count() == 30


def test_tree_finds_what_the_bound_allows():
    rng = np.random.default_rng(1)
    points = rng.poisson(3, (300, 16))
    sizes = points.sum(1)
    tree = rtree.RTree(points, sizes)
    for i in range(0, 300, 7):
        bound = np.minimum(points, points[i]).sum(1)
        fits = (180 * bound >= 80 * (sizes + sizes[i])) & (sizes * 100 >= 80 * sizes[i]) & (sizes * 80 <= 100 * sizes[i])
        assert set(np.flatnonzero(fits)) <= set(tree.search(points[i], int(sizes[i]), 80, 100))


def test_awkward_rows(spark):
    rows = texts()
    got = rows_of(rtree.link_components(documents(spark), 5, 80, 100))
    assert got == brute(rows, 5, 80, 100)
    assert rtree.link_components(documents(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    root = {x: x for p in pairs for x in p}
    for a, b in pairs:
        old, new = root[a], root[b]
        root = {k: min(old, new) if v in (old, new) else v for k, v in root.items()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {x: root[x] for x in linked}


def test_query(spark, tmp_path):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    assert_same(LLM_QUERIES["op5_jaccard_components"](spark, "/root/testdata/sf0.001"), con, LLM_STATEMENTS["op5_jaccard_components"])
    folder = stored(spark, tmp_path, documents=documents(spark))
    assert rows_of(LLM_QUERIES["op5_jaccard_components"](spark, folder)) == brute(texts(), 3, 90, 100)
