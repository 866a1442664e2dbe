from __future__ import annotations

import hashlib
from statistics import median

from cases import documents, sample, stored, words
from hypothesis import given, settings, strategies as st

from stockloom.llm import quartile_digest as q
from stockloom.llm.queries import LLM_QUERIES


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=300), st.binary(max_size=300))
def test_likeness_is_bounded_and_symmetric(a, b):
    x, y = q.digest(a), q.digest(b)
    assert 0 <= q.likeness(x, y) <= 1 and q.likeness(x, y) == q.likeness(y, x) and q.likeness(x, x) == 1


def test_edits_stay_near():
    text = words(400, 1)
    own = q.digest(text.encode())
    near = q.likeness(own, q.digest((text[:1500] + "changed" + text[1500:]).encode()))
    far = q.likeness(own, q.digest(" ".join(str(i * i) for i in range(400)).encode()))
    assert near > 0.9 and far < 0.4


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        prints = [q.digest(t.encode()) for t in (text, changed, following)]
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1], q.likeness(prints[0], prints[1]), q.likeness(prints[0], prints[2])))
    return sorted(out, key=str)


def test_query(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    got = LLM_QUERIES["op6_fingerprints"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == expected([(r["doc_id"], r["text"]) for r in sample()])
    assert median(r.near_edited for r in got) > 2 * median(r.near_next for r in got)
    awkward = [(i, t) for i, t in enumerate([None, "", "a", "abé\U0001f600", "abc" * 9000, words(30), words(30), "x y"])] + [(None, "null id")]
    folder = stored(spark, tmp_path / "a", documents=documents(spark, awkward))
    assert sorted(map(tuple, LLM_QUERIES["op6_fingerprints"](spark, folder).collect()), key=str) == expected(awkward)
    one = stored(spark, tmp_path / "b", documents=documents(spark, [(1, "alone here")]))
    assert list(map(tuple, LLM_QUERIES["op6_fingerprints"](spark, one).collect())) == expected([(1, "alone here")])
    none = stored(spark, tmp_path / "c", documents=documents(spark, []))
    assert LLM_QUERIES["op6_fingerprints"](spark, none).count() == 0
    assert q.fingerprint_documents(documents(spark, awkward)).count() == len(awkward)
