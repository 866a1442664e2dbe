"""Quality classifier: cumulative-link regression on graded ratings.

All grades share one weight vector over hashed text features; ordered thresholds cut the score into grades:
P(grade >= k) = logistic(score - threshold k). The thresholds are kept in order as a first one and positive gaps. Texts are
selected by the tail probability of a wanted grade; the expected grade ranks them.

The model is fitted on a bounded sample (``per_grade`` rows of each grade) and scores every whole text in one pass.

Defined results: null texts score like empty ones; without graded texts every grade is equally likely and nothing is
rejected (a threshold cannot be learned); repeated rows are scored each; other columns are ignored. Ratings of ids
that the documents lack, or have without a text, take no place in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.llm.training import COLUMNS, Adam, SparseRows, average_rounds, labelled_sample, row_products, text_features

#: Graded rows a fit takes of each grade, the groups they are fitted in, and rounds of averaging. So few rows fit one task.
PER_GRADE, SLOTS, ROUNDS = 1000, 1, 1
#: Steps in a round, rows that must share a column, and the weight of the squared weights.
STEPS, SHARED, DECAY = 300, 8, 1e-3
#: The registered selection: at least this probability of a grade above the lowest.
WANTED, CUT = 1, 0.7


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def thresholds(raw: np.ndarray) -> np.ndarray:
    """Ordered thresholds from a first one and logarithms of gaps."""
    return raw[0] + np.r_[0.0, np.cumsum(np.exp(raw[1:]))]


def log_likelihood_gradient(score: np.ndarray, grade: np.ndarray, raw: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean log likelihood, its derivative by each score, and by the raw thresholds."""
    cuts = np.r_[-np.inf, thresholds(raw), np.inf]
    above, beyond = logistic(score - cuts[grade]), logistic(score - cuts[grade + 1])
    above[grade == 0], beyond[grade == len(raw)] = 1.0, 0.0
    chance = np.maximum(above - beyond, 1e-12)
    by_cut = np.zeros(len(raw) + 2)
    np.add.at(by_cut, grade, -above * (1 - above) / chance)
    np.add.at(by_cut, grade + 1, beyond * (1 - beyond) / chance)
    by_cut = by_cut[1:-1]
    by_raw = np.r_[by_cut.sum(), np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(raw[1:])]
    n = max(1, len(score))
    return float(np.log(chance).mean()), (1 - above - beyond) / n, by_raw / n


class OrdinalModel:
    """Weights of the hashed columns and raw thresholds; grades run from 0 to ``grades`` - 1; fitted if any text was graded."""

    def __init__(self, weights: np.ndarray, grades: int, fitted: bool = True):
        self.fitted = fitted
        self.weights, self.raw = weights[: -(grades - 1)].astype(np.float64), weights[-(grades - 1) :].astype(np.float64)

    def tails(self, column: pa.Array) -> np.ndarray:
        """P(grade >= k) for k from 1, one row per text."""
        score = row_products(*text_features(column), self.weights)
        return logistic(score[:, None] - thresholds(self.raw)[None, :])


def fit_quality(graded: DataFrame, documents: DataFrame, grades: int = 3, per_grade: int = PER_GRADE) -> OrdinalModel:
    """graded: doc_id, label (grade as int)."""
    present = documents.where("text is not null").select("doc_id").distinct()
    sample = labelled_sample(graded.distinct().join(present, "doc_id", "left_semi"), documents, per_grade, SLOTS)

    def fit(frame: pd.DataFrame, start: np.ndarray) -> np.ndarray:
        rows, grade = SparseRows(frame["text"], SHARED), frame["label"].to_numpy(np.int64)
        weights, raw = start[:COLUMNS][rows.active].astype(np.float64), start[COLUMNS:].astype(np.float64)
        ascent = Adam(len(weights) + len(raw), 0.05)
        for _ in range(STEPS):
            _, by_score, by_raw = log_likelihood_gradient(rows.times(weights), grade, raw)
            step = ascent.step(np.r_[rows.back(by_score) - DECAY * weights, by_raw])
            weights, raw = weights + step[: len(weights)], raw + step[len(weights) :]
        out = np.zeros(COLUMNS + len(raw))
        out[rows.active], out[COLUMNS:] = weights, raw
        return out

    start = np.zeros(COLUMNS + grades - 1, np.float32)
    # even odds of all grades to begin with
    even = np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
    start[COLUMNS], start[COLUMNS + 1 :] = even[0], np.log(np.diff(even))
    return OrdinalModel(average_rounds(sample, fit, start, ROUNDS), grades, not sample.isEmpty())


def score_documents(documents: DataFrame, model: OrdinalModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns with expected_grade and tails (P(grade >= 1), P(grade >= 2), ...)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = list(dict.fromkeys([*keep, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            tails = shared.value.tails(batch.column("text"))
            found = pa.array(list(tails), pa.list_(pa.float64()))
            arrays = [*(batch.column(c) for c in keep), pa.array(tails.sum(1)), found]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "expected_grade", "tails"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)
    return documents.select(*columns).mapInArrow(run, f"{schema}, expected_grade double, tails array<double>")


def kept(model: OrdinalModel) -> Column:
    """The selection from the tails of :func:`score_documents`; a model without graded texts rejects nothing."""
    return F.col("tails")[WANTED - 1] >= CUT if model.fitted else F.lit(True)


def grades_of(labels: DataFrame) -> DataFrame:
    """2: good and not toxic; 1: good but toxic; 0: poor. Rows with a null rating have no grade."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1)
    grade = grade.when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("label"))


def op4_quality(spark, folder: str) -> DataFrame:
    """Expected grade, tail probabilities and the decision for every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    model = fit_quality(grades_of(spark.read.parquet(f"{folder}/labels.parquet")), documents)
    scored = score_documents(documents, model)
    return scored.select(
        "doc_id",
        "expected_grade",
        F.col("tails")[0].alias("p_grade_1"),
        F.col("tails")[1].alias("p_grade_2"),
        kept(model).alias("kept"),
    )
