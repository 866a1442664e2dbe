from __future__ import annotations

import numpy as np
from cases import sample, stored

from stockloom.llm import multi_index as index
from stockloom.llm.queries import LLM_QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, vector int, ids string, one int, piece int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 3) for i, v in rows], SCHEMA).repartition(3)


def brute(rows, top=20):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for k in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[k]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[k]][:top]
        out[int(ids[k])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        own = out.setdefault(r.query_id, [])
        own.append((r.vec_id, r.score))
        assert r.rank == len(own)
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[k]} & {i for i, _ in want[k]}) / len(want[k]) for k in want])


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in sample(table="embeddings")]
    want, got = brute(rows), result(LLM_QUERIES["op7_nearest_vectors"](spark, "/root/testdata/sf0.001"))
    assert recall(got, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20 and q not in {i for i, _ in found}
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert np.allclose([s for _, s in found], [vectors[q] @ vectors[i] for i, _ in found], atol=1e-12)


def test_unequal_norms(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).astype("float32").tolist()) for i in range(600)]
    df = index.usable(frame(spark, rows))
    assert recall(result(index.search(df, df.where("vec_id % 20 = 0"))), brute(rows)) >= 0.9


def test_awkward_rows(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    bad = [(0, None), (20, [0.0, 0.0]), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (120, [])]
    same = [(i, [0.6, 0.8]) for i in range(1000, 1050)]
    good = [*same, (1, [1.0, 0.0]), (140, [0.0, 1.0]), (140, [0.0, 1.0])]
    folder = stored(spark, tmp_path / "a", embeddings=frame(spark, bad + good))
    got = result(LLM_QUERIES["op7_nearest_vectors"](spark, folder))
    assert set(got) == {1000, 1020, 1040, 140}
    assert [i for i, _ in got[1020]] == [i for i in range(1000, 1021) if i != 1020]
    assert [i for i, _ in got[140]] == list(range(1000, 1020))
    few = stored(spark, tmp_path / "b", embeddings=frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]))
    assert result(LLM_QUERIES["op7_nearest_vectors"](spark, few)) == {0: [(1, 0.5)]}
    single = stored(spark, tmp_path / "c", embeddings=frame(spark, [(0, [1.0, 0.0])]))
    assert LLM_QUERIES["op7_nearest_vectors"](spark, single).count() == 0
    none = stored(spark, tmp_path / "d", embeddings=frame(spark, []))
    assert LLM_QUERIES["op7_nearest_vectors"](spark, none).count() == 0


def test_a_third_of_rows_equal_and_short(spark):
    rng = np.random.default_rng(5)
    unit = rng.normal(size=(2000, 32))
    unit = (unit / np.linalg.norm(unit, axis=1, keepdims=True)).astype("float32").tolist()
    short = (0.1 * np.array(unit[0])).astype("float32").tolist()
    plain = [(i, v) for i, v in enumerate(unit)]
    for rows in (plain, plain + [(5000 + i, short) for i in range(1000)]):
        df = index.usable(frame(spark, rows))
        assert recall(result(index.search(df, df.where("vec_id % 20 = 0"))), brute(rows)) >= 0.9


def test_clustered_vectors(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.1 * rng.normal(size=16)).astype("float32").tolist()) for i in range(1200)]
    df = index.usable(frame(spark, rows))
    assert recall(result(index.search(df, df.where("vec_id % 20 = 0"))), brute(rows)) >= 0.9


def test_repeated_ids_and_lengths(spark):
    """Rows of one id with different vectors are rows of their own; each length is searched by itself."""
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (7, [0.5, 0.5]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 1.0, 1.0]), (60, [1.0])]
    df = index.usable(frame(spark, rows))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in index.search(df, df.where("vec_id % 20 = 0")).collect())
    assert got == [(20, 1, 7, 0.5), (20, 1, 7, 0.5), (20, 2, 20, 0.0), (20, 2, 20, 0.0), (40, 1, 41, 6.0)]


def test_small_pieces(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).astype("float32").tolist()) for i in range(400)]
    df = index.usable(frame(spark, rows))
    got = result(index.search(df, df.where("vec_id % 20 = 0"), rows_per_piece=30, queries_per_piece=4))
    assert recall(got, brute(rows)) >= 0.9
