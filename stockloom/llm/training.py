"""Bounded samples of labelled texts, hashed text features, and training by averaging the slots of a sample.

A sample holds at most ``per_label`` rows of each label, those with the smallest hash of their id, so it does not depend on
how the tables are cut. It is dealt to ``slots`` groups by another hash; each group is fitted in one task from the current
weights, and the mean of the groups is the next start (parameter mixing). Only weights pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.llm.text_batches import LETTER, LOWER, SPACE, Words, flat
from stockloom.session import materialize

#: Hashed columns; the last STATS of them hold shape statistics instead.
BITS, STATS = 18, 8
COLUMNS = 1 << BITS
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_SYMBOL = ~LETTER & ~SPACE
_SYMBOL[ord("0") : ord("9") + 1] = False


def labelled_sample(labels: DataFrame, documents: DataFrame, per_label: int, slots: int) -> DataFrame:
    """labels (doc_id, label) and documents (doc_id, text) -> stored slot, label, text; rows with nulls are left out.

    Labels are counted first. Of a label with n rows only those whose hash lies in about the lowest (per_label + slack) / n of all
    hashes are ordered, however many tasks they come from; should these be too few, all rows of the label are.
    The chosen ids, labels x per_label at most, are small enough to broadcast.
    """
    known = labels.where("doc_id is not null and label is not null").select("doc_id", "label")
    counts = known.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    place = F.xxhash64("doc_id") / F.lit(2.0**64) + 0.5
    enough = per_label + 10 * per_label**0.5 + 100
    low = known.join(counts, "label").where(place * F.col("rows") <= enough).select("doc_id", "label")
    short = counts.join(low.groupBy("label").agg(F.count(F.lit(1)).alias("low")), "label", "left")
    short = short.where(F.coalesce("low", F.lit(0)) < F.least(F.lit(per_label), "rows")).select("label")
    low = low.join(short, "label", "left_anti").unionByName(known.join(short, "label", "left_semi"))
    first = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = low.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_label).drop("n")
    chosen = chosen.groupBy("doc_id").agg(F.min("label").alias("label"))
    texts = documents.where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    slot = F.pmod(F.xxhash64(F.lit("slot"), "doc_id"), F.lit(slots)).cast("int")
    return materialize(texts.select(slot.alias("slot"), "doc_id", "label", "text"))


def average_rounds(sample: DataFrame, fit: Callable[[pd.DataFrame, np.ndarray], np.ndarray], start: np.ndarray, rounds: int) -> np.ndarray:
    """Repeat: fit every slot from the current weights, then take the mean. ``fit`` gets a slot's rows in a fixed order."""
    context = sample.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(start)
        run = _slot_fitter(fit, shared)
        rows = sample.groupBy("slot").applyInPandas(run, "slot int, weights binary").collect()  # a row per slot
        if not rows:
            shared.destroy()
            return start
        found = [np.frombuffer(r["weights"], np.float32) for r in sorted(rows, key=lambda r: r["slot"])]
        start = np.mean(found, axis=0, dtype=np.float64).astype(np.float32)
        shared.destroy()
    return start


def _slot_fitter(fit: Callable, shared) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("doc_id", ignore_index=True)
        weights = fit(frame, shared.value.copy())
        return pd.DataFrame({"slot": [frame["slot"].iloc[0]], "weights": [weights.astype(np.float32).tobytes()]})

    return run


class Adam:
    """Full-batch ascent with per-weight steps."""

    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.01 * (gradient**2 - self.v)
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows (first, columns, values) of whole texts: presence of hashed words and symbol runs, and statistics."""
    data, offsets = flat(column)
    lower = LOWER[data]
    words, symbols, parts = Words(lower, offsets, LETTER), Words(lower, offsets, _SYMBOL), Words(lower, offsets, ~SPACE)
    open_columns = COLUMNS - STATS
    word_ids = (words.hashes() >> np.uint64(64 - BITS)).astype(np.int64) % open_columns
    symbol_ids = (symbols.span_hash(symbols.starts, symbols.ends, 7) >> np.uint64(64 - BITS)).astype(np.int64) % open_columns
    at = lambda flags: np.r_[0, np.cumsum(flags[data])][offsets]
    totals = [np.diff(at(f)).astype(float) for f in (_SYMBOL, _UPPER, LETTER)]
    columns, values, first = [], [], [0]
    for i in range(len(offsets) - 1):
        own = word_ids[words.first[i] : words.first[i + 1]]
        ids = np.unique(own)
        found = np.unique(np.r_[ids, symbol_ids[symbols.first[i] : symbols.first[i + 1]]])
        size, n, tokens = max(1, offsets[i + 1] - offsets[i]), len(own), parts.first[i + 1] - parts.first[i]
        stats = (
            totals[0][i] / size * 5,
            totals[1][i] / max(1.0, totals[2][i]) * 3,
            len(ids) / max(1, n),
            np.log1p(n) / 5,
            totals[2][i] / size,
            totals[2][i] / max(1, n) / 10,
            float(n == 0),
            n / max(1, tokens) / 2,
        )
        columns += [found, np.arange(open_columns, COLUMNS)]
        values += [np.ones(len(found)), np.array(stats)]
        first.append(first[-1] + len(found) + STATS)
    if not columns:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.array(first), np.concatenate(columns), np.concatenate(values)


def word_counts(column: pa.Array) -> np.ndarray:
    """Blank-separated words of each text."""
    data, offsets = flat(column)
    return np.diff(Words(data, offsets, ~SPACE).first)


class SparseRows:
    """Feature rows restricted to columns that ``least`` rows share; products with dense weights."""

    def __init__(self, texts: pd.Series, least: int):
        first, columns, values = text_features(pa.array(texts, pa.string()))
        self.rows = np.repeat(np.arange(len(texts)), np.diff(first))
        seen = np.bincount(columns, minlength=COLUMNS)
        keep = seen[columns] >= least
        self.active = np.flatnonzero(seen >= least)
        self.rows, self.values = self.rows[keep], values[keep]
        self.columns = np.searchsorted(self.active, columns[keep])
        self.n = len(texts)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.columns], self.n)

    def back(self, residual: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, self.values * residual[self.rows], len(self.active))


def row_products(first: np.ndarray, columns: np.ndarray, values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return np.bincount(rows, values * weights[columns], len(first) - 1)
