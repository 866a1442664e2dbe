from __future__ import annotations

import corpus_pipeline
from cases import documents, stored, texts, words
from test_jaccard import brute

from stockloom.session import materialize

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    columns, seen = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, FOLDER))
        seen.append(docs)
    assert all(d.columns == columns for d in seen[:-1])
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen]
    assert set(ids[1]) == set(ids[0])  # every text has words of one language
    clean = {i for i, r in labels.items() if r.quality == 1 and r.toxic == 0}
    assert len(clean & set(ids[2])) >= 0.97 * len(clean & set(ids[1]))
    before = [(r.doc_id, r.text) for r in seen[2].collect()]
    assert set(ids[3]) == {c for _, _, c in brute(before, 5, 80, 100)} and len(ids[3]) == len(set(ids[3]))
    assert set(ids[4]) == set(ids[3])  # mixing repeats, and leaves none out
    assert set(ids[5]) == set(ids[4])


def test_run_on_awkward_rows(spark, tmp_path):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (9, 1, 0)], "doc_id bigint, quality int, toxic int")
    folder = stored(spark, tmp_path / "a", documents=documents(spark), labels=labels)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {p.doc_id for p in pieces} <= {i for i, _ in texts()} and {1, 9} <= {p.doc_id for p in pieces}
    none = stored(spark, tmp_path / "b", documents=documents(spark, []), labels=labels)
    assert corpus_pipeline.run(spark, none).count() == 0


def groups(rows, width, num, den):
    """Component of each row by comparing all pairs, whatever its id."""
    numbered = brute([(k, t) for k, (_, t) in enumerate(rows)], width, num, den)
    return {k: (size, component) for k, size, component in numbered}


def test_one_row_of_each_group_stays(spark, tmp_path):
    """Null and repeated ids: near and exact copies go whatever their ids, and of each group one row stays."""
    near = [words(60, s) + tail for s in (1, 4) for tail in ("", " tail", " other end")]
    alone = [words(50, s) for s in range(20, 32)]
    rows = [(None, t) for t in near] + [(5, near[0] + " more"), (5, near[1]), (5, near[0]), (5, near[0]), (3, near[2])]
    rows += [(7, t) for t in alone[:8]] + [(12, near[3] + " x"), (12, alone[8]), (11, near[4]), (None, alone[0])]
    rows += [(None, alone[9]), (None, alone[9]), (None, alone[9] + " y"), (None, alone[10]), (None, None), (None, ""), (4, None), (4, None)]
    by_row = groups(rows, 5, 80, 100)
    of_text = {t: by_row[k] for k, (_, t) in enumerate(rows)}
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), "").collect()]
    assert set(kept) <= set(rows) and len(kept) == len(set(kept))
    found = [of_text[t][1] for _, t in kept if of_text[t][0]]
    assert len(found) == len(set(found)) and set(found) == {c for n, c in of_text.values() if n}
    assert {r for r in kept if not of_text[r[1]][0]} == {r for r in rows if not of_text[r[1]][0]}
    for i, t in kept:
        ids = {j for j, u in rows if of_text[u] == of_text[t] and j is not None}
        assert not of_text[t][0] or i == (min(ids) if ids else None)
