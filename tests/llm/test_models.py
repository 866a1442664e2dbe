from __future__ import annotations

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from cases import documents, sample, stored, texts
from pyspark.sql import functions as F

from stockloom.llm import crf_language as crf, ordinal_quality as quality, soft_mixing as mixing
from stockloom.llm.queries import LLM_QUERIES
from stockloom.llm.training import labelled_sample, text_features, word_counts

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def awkward(spark, tmp_path):
    labels = [(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, None, None), (None, 1, 0), (9, 1, 1), (11, 1, 0)]
    return stored(spark, tmp_path, documents=documents(spark), labels=spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


@pytest.fixture
def empty(spark, tmp_path):
    return stored(spark, tmp_path, documents=documents(spark, []), labels=spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))


def test_features_do_not_depend_on_the_batch():
    column = pa.array([t for _, t in texts()])
    first, columns, values = text_features(column)
    for k in range(len(column)):
        f, c, v = text_features(column.slice(k, 1))
        assert c.tolist() == columns[first[k] : first[k + 1]].tolist() and np.allclose(v, values[first[k] : first[k + 1]])
    assert word_counts(column).tolist() == [len([w for w in (t or "").replace(" ", "_").split()]) for _, t in texts()]


def test_labelled_sample_takes_the_lowest_hashes(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(3000)] + [(5000 + i, "c") for i in range(3)] + [(None, "a"), (6000, None)]
    labels = spark.createDataFrame(rows, "doc_id bigint, label string").repartition(7)
    docs = spark.createDataFrame([(i, f"t{i}") for i, _ in rows], "doc_id bigint, text string")
    hashed = labels.where("doc_id is not null and label is not null").select("label", F.xxhash64("doc_id").alias("h"), "doc_id").collect()
    for per_label in (1, 20, 900):
        got = sorted((r.label, r.doc_id) for r in labelled_sample(labels, docs, per_label, 2).collect())
        want = [(label, r.doc_id) for label in "abc" for r in sorted((r for r in hashed if r.label == label), key=lambda r: (r.h, r.doc_id))[:per_label]]
        assert got == sorted(want)


# -- quality ----------------------------------------------------------------------------------------------------------


def test_ordinal_gradient():
    rng = np.random.default_rng(0)
    score, grade, raw = rng.normal(size=30), rng.integers(0, 4, 30), np.array([-1.0, 0.2, -0.3])
    value, by_score, by_raw = quality.log_likelihood_gradient(score, grade, raw)
    for k in range(3):
        moved = raw.copy()
        moved[k] += 1e-6
        assert np.isclose((quality.log_likelihood_gradient(score, grade, moved)[0] - value) / 1e-6, by_raw[k], atol=1e-4)
    moved = score.copy()
    moved[4] += 1e-6
    assert np.isclose((quality.log_likelihood_gradient(moved, grade, raw)[0] - value) / 1e-6, by_score[4], atol=1e-4)


def test_quality_of_rows_not_learned_from(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    graded = quality.grades_of(spark.read.parquet(f"{folder}/labels.parquet"))
    model = quality.fit_quality(graded.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 <> 0"))
    assert (np.diff(quality.thresholds(model.raw)) > 0).all()
    scored = quality.score_documents(docs, model).join(graded.where("doc_id % 3 = 0"), "doc_id").collect()
    good = [r.tails[0] >= quality.CUT for r in scored if r.label > 0]
    poor = [r.tails[0] < quality.CUT for r in scored if r.label == 0]
    assert np.mean(good) > 0.98 and np.mean(poor) > 0.95
    assert all(r.tails[0] >= r.tails[1] and np.isclose(r.expected_grade, sum(r.tails)) for r in scored)


def test_quality_of_awkward_rows(spark, awkward):
    got = LLM_QUERIES["op4_quality"](spark, awkward).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in texts())
    assert all(0 <= r.p_grade_2 <= r.p_grade_1 <= 1 for r in got)


def test_quality_without_rows(spark, empty):
    assert LLM_QUERIES["op4_quality"](spark, empty).count() == 0
    model = quality.fit_quality(spark.createDataFrame([], "doc_id bigint, label int"), documents(spark, []))
    assert np.allclose(model.tails(pa.array(["any text"])), [[2 / 3, 1 / 3]])


def ungraded(spark, case):
    rows = {"none": [], "null": [(1, None, None), (9, None, 1)], "elsewhere": [(i, i % 2, 0) for i in range(100, 140)]}[case]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("case", ["none", "null", "elsewhere"])
def test_nothing_is_rejected_without_grades(spark, tmp_path, case):
    folder = stored(spark, tmp_path, documents=documents(spark), labels=ungraded(spark, case))
    got = LLM_QUERIES["op4_quality"](spark, folder).collect()
    assert len(got) == len(texts()) and all(r.kept for r in got)
    assert corpus_pipeline.quality(spark, documents(spark), folder).count() == len(texts())


def test_grades_of_missing_texts_take_no_place(spark):
    here = [(i, f"good text {i}" if i % 2 else f"poor thing {i}") for i in range(40)]
    graded = [(i, i % 2) for i in range(40)] + [(i, i % 2) for i in range(100, 3000)]
    model = quality.fit_quality(spark.createDataFrame(graded, "doc_id bigint, label int"), documents(spark, here), per_grade=20)
    tails = model.tails(pa.array(["good text 3", "poor thing 4"]))[:, 0]
    assert model.fitted and tails[0] > tails[1] + 0.2


# -- language ---------------------------------------------------------------------------------------------------------


def by_hand(field, scores):
    n, k = scores.shape
    ahead, back = [field.start + scores[0]], [np.zeros(k)]
    for t in range(1, n):
        ahead.append(np.logaddexp.reduce(ahead[-1][:, None] + field.moves, axis=0) + scores[t])
    for t in range(n - 1, 0, -1):
        back.append(np.logaddexp.reduce(field.moves + scores[t] + back[-1], axis=1))
    out = np.array(ahead) + np.array(back[::-1])
    return np.exp(out - np.logaddexp.reduce(out, axis=1)[:, None])


def test_posteriors_of_chained_texts():
    rng = np.random.default_rng(1)
    field = crf.Field(list("abc"), np.zeros((2, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    for n, first in ((1, [0]), (700, [0, 5, 5, 130, 131, 400]), (256, [0, 128]), (129, [0])):
        scores = rng.normal(size=(n, 3)) * 3
        cuts = [*dict.fromkeys(first), n]
        want = np.concatenate([by_hand(field, scores[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
        assert np.allclose(field.posteriors(scores, np.array(first)), want)


def test_crf_gradient():
    rng = np.random.default_rng(2)
    scores, gold, moves, start = rng.normal(size=(2, 5, 3)), rng.integers(0, 3, (2, 5)), rng.normal(size=(3, 3)), rng.normal(size=3)
    value, by_score, by_move, by_start = crf.log_likelihood_gradient(scores, gold, moves, start)
    for array, gradient, at in ((scores, by_score, (1, 2, 0)), (moves, by_move, (1, 2)), (start, by_start, (1,))):
        array[at] += 1e-6
        assert np.isclose((crf.log_likelihood_gradient(scores, gold, moves, start)[0] - value) / 1e-6, gradient[at], atol=1e-4)
        array[at] -= 1e-6


def test_language_of_held_out_rows(spark):
    got = {r.doc_id: r for r in LLM_QUERIES["op9_language"](spark, FOLDER).collect()}
    truth = {r["doc_id"]: r["lang"] for r in sample(FOLDER)}
    assert got.keys() == truth.keys()
    right = [got[i].lang_pred == truth[i] for i in truth if got[i].held_out]
    assert len(right) > 250 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_code_switched_words(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    field = crf.fit_field(crf.learnable(docs), docs)
    by_lang = {}
    for r in sample(FOLDER):
        words = [w for w in r["text"].split() if w.isalpha()]
        if len(words) > 200:
            by_lang.setdefault(r["lang"], words)
    mixed = " ".join(by_lang["de"][:60] + by_lang["es"][:60])
    _, _, counts = field.predict(pa.array([mixed]))
    found = dict(zip(field.labels, counts[0], strict=True))
    assert found["de"] > 50 and found["es"] > 50


def test_language_of_awkward_rows(spark, awkward):
    got = LLM_QUERIES["op9_language"](spark, awkward).collect()
    assert len(got) == len(texts())
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert {i for i, r in by_id.items() if r.lang_pred == "und"} == {4, 5, 6, 8}
    assert by_id[4].score == 0 and by_id[1].lang_pred == "en"


def test_language_without_rows(spark, empty):
    assert LLM_QUERIES["op9_language"](spark, empty).count() == 0
    field = crf.fit_field(spark.createDataFrame([], "doc_id bigint, label string"), documents(spark))
    assert {r.lang_pred for r in crf.label_documents(documents(spark), field).collect()} == {"und"}


# -- mixing -----------------------------------------------------------------------------------------------------------


def reference_rates(p, tokens, share, least):
    """The same least squares by many small projected steps on one machine."""
    g = (p * tokens[:, None]).T @ p
    natural = (p * tokens[:, None]).sum(0)
    targets = share * (natural / share).max()
    inverse, r = np.linalg.inv(g), np.ones(len(p))
    for _ in range(4000):
        r = np.maximum(least, r - 0.5 * p @ (inverse @ ((p * (tokens * r)[:, None]).sum(0) - targets)))
    return r, targets


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_rates_solve_the_least_squares(spark, least):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    tokens = rng.integers(1, 500, 400).astype(float)
    share = np.array([0.6, 0.3, 0.1]) if least == 0 else np.array([0.38, 0.33, 0.29])
    rows = [(i, int(t), x.tolist()) for i, (t, x) in enumerate(zip(tokens, p, strict=True))]
    members = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, posteriors array<double>")
    model = mixing.DomainModel(["a", "b", "c"], np.zeros((3, 1)))
    mix = mixing.solve(members, model, dict(zip("abc", share, strict=True)), least=least, most_steps=200)
    want, targets = reference_rates(p, tokens, share, least)
    assert np.allclose(mix.targets, targets)
    missed = [np.abs((p * (tokens * r)[:, None]).sum(0) - targets).max() / targets.sum() for r in (mix.rates(p), want)]
    assert missed[0] <= missed[1] + 5e-3 and (least or np.allclose(mix.rates(p), want, atol=1e-2))
    got = [r.rate for r in members.select("doc_id", mixing.rate_column(mix).alias("rate")).orderBy("doc_id").collect()]
    assert np.allclose(got, mix.rates(p)) and min(got) >= least


def test_mix_reaches_its_targets(spark):
    rows = LLM_QUERIES["op2_mixing"](spark, FOLDER).collect()
    assert len(rows) == 1000 and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    totals = {d: sum(r.tokens * r.rate * r[f"p_{d}"] for r in rows) for d in mixing.TARGETS}
    for d, share in mixing.TARGETS.items():
        assert abs(totals[d] / sum(totals.values()) - share) < 1e-4


def test_other_languages_join_the_rest(spark):
    docs = spark.createDataFrame([(i, lang, "x") for i, lang in enumerate(["en", "it", None, "de", "en"])], "doc_id bigint, lang string, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 0), (2, 1, 0), (3, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r.label for r in mixing.domain_labels(labels, docs).collect()}
    assert got == {0: "en", 1: "rest", 2: "rest", 3: "de", 4: "rest"}


def posteriors(spark, rows):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "doc_id bigint, tokens bigint, posteriors array<double>").cache()


def test_steps_cut_short_are_reported(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.2, 0.8]), (50, [0.5, 0.5]), (900, [0.9, 0.1])]
    model = mixing.DomainModel(list("ab"), np.zeros((2, 1)))
    whole = mixing.solve(posteriors(spark, rows), model, {"a": 0.4, "b": 0.6})
    assert max(map(abs, whole.missed.values())) < 1e-4
    with pytest.warns(UserWarning, match="misses its target"):
        short = mixing.solve(posteriors(spark, rows), model, {"a": 0.4, "b": 0.6}, most_steps=1)
    assert len(short.steps) == 1 and max(map(abs, short.missed.values())) > 1e-4


def test_a_domain_out_of_reach_is_reported(spark):
    rows = [(100, [0.9, 0.1, 0.0]), (100, [0.2, 0.8, 0.0]), (50, [0.5, 0.5, 0.0])]
    model = mixing.DomainModel(list("abc"), np.zeros((3, 1)))
    with pytest.warns(UserWarning, match="domain c misses"):
        mix = mixing.solve(posteriors(spark, rows), model, {"a": 0.4, "b": 0.4, "c": 0.2}, most=8.0, most_steps=6)
    assert mix.missed["c"] > 0.19
    with pytest.warns(UserWarning, match="misses its target"):
        capped = mixing.solve(posteriors(spark, rows), model, {"a": 0.05, "b": 0.95}, least=1.0, most=3.0, most_steps=6)
    rates = capped.rates(np.array([p for _, p in rows]))
    assert rates.min() >= 1 and rates.max() <= 3


def test_mixing_of_awkward_rows(spark, awkward):
    got = LLM_QUERIES["op2_mixing"](spark, awkward).collect()
    assert len(got) == len(texts()) and all(np.isfinite(r.rate) for r in got)


def test_mixing_without_rows(spark, empty):
    assert LLM_QUERIES["op2_mixing"](spark, empty).count() == 0


def test_copies_follow_the_rate(spark):
    df = spark.range(20_000).select("id", F.lit(2.25).alias("rate")).select(mixing.copies_column(F.col("rate"), "id").alias("n"))
    assert {r.n for r in df.distinct().collect()} == {2, 3} and abs(df.agg(F.avg("n")).first()[0] - 2.25) < 0.02
