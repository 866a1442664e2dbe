from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from cases import documents, sample, stored, texts, words

from stockloom.llm import golay_simhash
from stockloom.llm.golay_simhash import (
    CHECKS,
    LENGTH,
    codewords,
    fingerprint_components,
    fingerprints,
    golay,
    op11_simhash_components,
    probe_keys,
    home_keys,
    simhash_components,
    simhashes,
)


def plain_fingerprint(text: str | None) -> int:
    found = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    shingles = [b" ".join(found[i : i + 3]) for i in range(len(found) - 2)] if len(found) > 2 else [b" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids: list, fps: list[int], errors: int = 3) -> dict:
    """Smallest id that can be reached, by position; every pair of different fingerprints is compared."""
    label = list(range(len(fps)))
    values = np.array(fps, np.uint64)

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= errors) + i + 1:
            a, b = top(i), top(int(j))
            label[max(a, b)] = min(a, b)
    least: dict = {}
    for i in range(len(fps)):
        known = [x for x in (least.get(top(i)), ids[i]) if x is not None]
        least[top(i)] = min(known) if known else None
    return {i: least[top(i)] for i in range(len(fps))}


def test_code_is_perfect_and_probes_find_neighbours():
    _, _, home, more = golay()
    assert len(set(home.tolist())) == 1 << CHECKS and np.bitwise_count(home).max() == 3
    assert ((more >= 0).sum(1) == 5 * (np.bitwise_count(home) == 3)).all()
    x = np.random.default_rng(1).integers(0, 1 << LENGTH, 3000)
    own, there = codewords(x)
    for bit in range(LENGTH):
        other = codewords(x ^ (1 << bit))[0][:, 0]
        assert ((own == other[:, None]) & there).any(1).all()


def test_every_pair_of_three_errors_meets():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 400, dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, 400, dtype=np.uint64)
    for n in range(4):
        flips = np.array([sum(1 << int(b) for b in rng.choice(64, n, replace=False)) for _ in x], np.uint64)
        homes = home_keys(x ^ flips)
        keys, rows = probe_keys(x)
        for i in range(len(x)):
            assert set(keys[rows == i].tolist()) & set(homes[i].tolist())


def test_components_of_fingerprints_equal_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = [int(v) for v in rng.integers(0, 1 << 62, 60)]
    fps = set(base) | {0, 1, 2**64 - 1, 2**63, 2**63 + 1}
    for b in base:  # chains and strangers at distances around the border
        at = b
        for n in (1, 2, 3, 4, 3, 5):
            at ^= sum(1 << int(k) for k in rng.choice(64, n, replace=False))
            fps.add(at)
    centre = int(rng.integers(0, 1 << 62))  # a dense group and loose members around it
    for n in (1, 2, 3, 4, 5, 6):
        fps |= {centre ^ sum(1 << int(k) for k in rng.choice(64, n, replace=False)) for _ in range(250)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {r["fp"]: r["root"] for r in fingerprint_components(spark.createDataFrame([(f,) for f in signed], "fp bigint")).collect()}
    expected = plain_components(list(range(len(fps))), fps)
    assert len(found) == len(fps)
    groups: dict = {}
    for i, f in enumerate(signed):
        groups.setdefault(found[f], set()).add(expected[i])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(expected.values()))


def test_keys_are_never_broadcast(spark, monkeypatch):
    """Planning takes the up to 60 keys of a fingerprint for one row, so a limit of broadcasts by size does not hold for them."""
    plans = []
    found = golay_simhash.components
    monkeypatch.setattr(golay_simhash, "components", lambda edges: plans.append(edges._jdf.queryExecution().toString()) or found(edges))
    fingerprint_components(spark.createDataFrame([(i * 3,) for i in range(50)], "fp bigint"))
    kept = golay_simhash.materialize
    monkeypatch.setattr(golay_simhash, "materialize", lambda df: plans.append(df._jdf.queryExecution().toString()) or kept(df))
    fingerprint_components(spark.createDataFrame([(i * 3,) for i in range(50)], "fp bigint"))
    dealt = [p for p in plans if "MapInArrow" in p]
    assert len(dealt) >= 3 and not any("BroadcastHashJoin" in p for p in dealt)


def test_fewer_errors(spark):
    fps = [0, 0b11, 0b111 << 30, 1 << 50]
    for errors in range(4):
        found = {r["fp"]: r["root"] for r in fingerprint_components(spark.createDataFrame([(f,) for f in fps], "fp bigint"), errors).collect()}
        for a, b in combinations(range(4), 2):
            expected = plain_components(list(range(4)), fps, errors)
            assert (found[fps[a]] == found[fps[b]]) == (expected[a] == expected[b])


def test_pieces_do_not_change_a_fingerprint(monkeypatch):
    long = [words(3000, 4), "a b", "one", None, "", " \n\t", words(700, 8) + " x\x00y Ä É"]
    whole = simhashes(long, 3).tolist()
    assert whole == [plain_fingerprint(t) for t in long]
    monkeypatch.setattr("stockloom.llm.golay_simhash.PIECE", 100)
    monkeypatch.setattr("stockloom.llm.golay_simhash.BLOCK", 50)
    assert simhashes(long, 3).tolist() == whole


def test_awkward_rows(spark):
    rows = texts()
    fps = [plain_fingerprint(t) for _, t in rows]
    parts = plain_components([i for i, _ in rows], fps)
    expected = sorted(((i, f"{f:016x}", parts[k]) for k, ((i, _), f) in enumerate(zip(rows, fps, strict=True))), key=str)
    assert sorted((tuple(r) for r in simhash_components(documents(spark)).collect()), key=str) == expected
    assert simhash_components(documents(spark, [])).collect() == []
    lonely = simhash_components(documents(spark, [(None, "a b c"), (None, "a b c")])).collect()
    assert [r["component_id"] for r in lonely] == [None, None]


def test_a_third_of_rows_near_copies(spark):
    base = words(400, 5).split()
    rows = [(i, " ".join([*base[: 3 + i % 390], f"x{i}", *base[4 + i % 390 :]])) for i in range(600)]
    rows += [(1000 + i, words(60, 11 + i)) for i in range(1200)]
    fps = [plain_fingerprint(t) for _, t in rows]
    expected = plain_components([i for i, _ in rows], fps)
    found = {r["doc_id"]: r["component_id"] for r in simhash_components(documents(spark, rows)).collect()}
    assert found == {i: expected[k] for k, (i, _) in enumerate(rows)}


def test_query_equals_brute_force(spark, tmp_path):
    rows = sample()
    folder = stored(spark, tmp_path, documents=documents(spark, [(r["doc_id"], r["text"]) for r in rows]))
    fps = [plain_fingerprint(r["text"]) for r in rows]
    expected = plain_components([r["doc_id"] for r in rows], fps)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op11_simhash_components(spark, folder).collect()}
    assert found == {r["doc_id"]: (f"{f:016x}", expected[k]) for k, (r, f) in enumerate(zip(rows, fps, strict=True))}
    assert fingerprints(spark.read.parquet(f"{folder}/documents.parquet")).count() == len(rows)
