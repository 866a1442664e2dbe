"""Language identification with a linear-chain conditional random field over the words of a text.

Each word has hashed features: the word itself (lexicon), its first and last one to three bytes (affixes) and its byte
triplets. Their weights give a score per language, a learned matrix scores the passage from one word's language to the
next, and forward-backward gives each word's posterior, so words of a code-switched text get labels of their own. A
text's language is the one with the largest mean posterior, which is also its score.

Training texts carry one label each. Their words are cut into runs, the runs of all languages are shuffled together, and
sequences of several runs are what the field is fitted on, so that passages between languages are seen. The sample is
bounded: ``per_language`` texts of each language.

Long chains are computed in blocks: the product of the step matrices of every block first, then the messages between
blocks one after the other, then all blocks at once again. Texts follow each other in one chain; at a text's first word
the step forgets what was before.

Defined results: null texts and texts without a letter are ``und`` with score 0; without labelled rows every text is ``und``;
letters are ASCII letters and all longer UTF-8 sequences for the words, and Unicode letters for the ``und`` rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockloom.llm.text_batches import LETTER, LOWER, Words, flat, sliced
from stockloom.llm.training import Adam, average_rounds, labelled_sample

#: Labelled texts of each language, groups they are fitted in, rounds of averaging, steps in a round.
PER_LANGUAGE, SLOTS, ROUNDS, STEPS = 200, 4, 2, 20
#: Hashed features; words in a run and in a training sequence; words in a block of a long chain.
BITS, RUN, SEQUENCE, CHAIN = 15, 12, 48, 128
UNKNOWN = "und"


class Features:
    """Hashed features of the words of flat texts: seven per word, and triplets with the word they belong to."""

    def __init__(self, column: pa.Array):
        data, offsets = flat(column)
        words = Words(LOWER[data], offsets, LETTER)
        self.first, self.n = words.first, len(words)
        top = np.uint64(64 - BITS)
        starts, ends = words.starts, words.ends
        spans = [(starts, ends)]
        spans += [(starts, np.minimum(starts + k, ends)) for k in (1, 2, 3)]
        spans += [(np.maximum(ends - k, starts), ends) for k in (1, 2, 3)]
        self.fixed = np.stack([(words.span_hash(a, b, tag) >> top).astype(np.int32) for tag, (a, b) in enumerate(spans)], 1)
        code, self.owner = words.trigrams()
        self.triplets = ((code.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int32)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the feature weights of each word, per label."""
        out = weights[self.fixed[:, 0]].astype(np.float64)
        for k in range(1, self.fixed.shape[1]):
            out += weights[self.fixed[:, k]]
        for label in range(weights.shape[1]):
            out[:, label] += np.bincount(self.owner, weights[self.triplets, label], self.n)
        return out

    def gradient(self, by_score: np.ndarray) -> np.ndarray:
        out = np.empty((1 << BITS, by_score.shape[1]))
        for label in range(by_score.shape[1]):
            of = by_score[:, label]
            out[:, label] = np.bincount(self.triplets, of[self.owner], 1 << BITS)
            out[:, label] += np.bincount(self.fixed.ravel(), np.repeat(of, self.fixed.shape[1]), 1 << BITS)
        return out


@dataclass
class Field:
    """Labels, feature weights (2**BITS x labels), transition scores and start scores."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    @classmethod
    def unpacked(cls, labels: list[str], vector: np.ndarray) -> Field:
        k = len(labels)
        w, m = k << BITS, k * k
        return cls(labels, vector[:w].reshape(1 << BITS, k), vector[w : w + m].reshape(k, k), vector[w + m :])

    def posteriors(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Label posteriors of each word; ``first`` are the places where texts begin."""
        n, k = scores.shape
        if not n:
            return scores
        blocks = -(-n // CHAIN)
        emit = np.ones((blocks * CHAIN, k))
        emit[:n] = np.exp(scores - scores.max(1, keepdims=True))
        fresh = np.zeros(blocks * CHAIN, bool)
        fresh[first[first < n]] = True
        fresh[0] = True
        if n < len(fresh):
            fresh[n] = True
        emit, fresh = emit.reshape(blocks, CHAIN, k), fresh.reshape(blocks, CHAIN)
        step, begin = np.exp(self.moves.astype(np.float64)), np.exp(self.start.astype(np.float64))

        def forward(state: np.ndarray, t: int) -> np.ndarray:
            """state: blocks x ... x labels."""
            reset = fresh[:, t].reshape(-1, *[1] * (state.ndim - 1))
            moved = np.where(reset, state.sum(-1, keepdims=True) * begin, state @ step)
            return moved * emit[:, t].reshape(blocks, *[1] * (state.ndim - 2), k)

        product = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
        for t in range(CHAIN):
            product = forward(product, t)
            if t % 8 == 7:
                product /= product.max((1, 2), keepdims=True)
        entry, leave = np.empty((blocks, k)), np.empty((blocks, k))
        entry[0], leave[-1] = 1.0 / k, 1.0
        for b in range(blocks - 1):
            moved = entry[b] @ product[b]
            entry[b + 1] = moved / moved.sum()
        for b in range(blocks - 1, 0, -1):
            moved = product[b] @ leave[b]
            leave[b - 1] = moved / moved.sum()
        out = np.empty((blocks, CHAIN, k))
        state = entry
        for t in range(CHAIN):
            state = forward(state, t)
            state = state / state.sum(-1, keepdims=True)
            out[:, t] = state
        back = leave
        for t in range(CHAIN - 1, -1, -1):
            out[:, t] *= back
            weighted = emit[:, t] * back
            back = np.where(fresh[:, t, None], (weighted @ begin)[:, None], weighted @ step.T)
            back = back / back.sum(-1, keepdims=True)
        out = out.reshape(-1, k)[:n]
        return out / out.sum(1, keepdims=True)

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(label number or -1, score, number of words by label) of each text."""
        features, k = Features(column), len(self.labels)
        n = len(column)
        if not k or not features.n:
            return np.full(n, -1), np.zeros(n), np.zeros((n, k), np.int64)
        found = self.posteriors(features.scores(self.weights), features.first[:-1])
        totals = np.zeros((features.n + 1, k))
        np.cumsum(found, axis=0, out=totals[1:])
        sums = totals[features.first[1:]] - totals[features.first[:-1]]
        words = np.diff(features.first)
        owner = np.repeat(np.arange(n), words)
        counts = np.bincount(owner * k + found.argmax(1), minlength=n * k).reshape(n, k)
        best = np.where(words > 0, sums.argmax(1), -1)
        return best, np.clip(np.where(words > 0, sums.max(1) / np.maximum(1, words), 0.0), 0, 1), counts


def log_likelihood_gradient(scores: np.ndarray, gold: np.ndarray, moves: np.ndarray, start: np.ndarray):
    """Of sequences of one length: scores (S x L x K), gold (S x L). Log likelihood and gradients, summed over sequences."""
    s, length, k = scores.shape
    step, begin = np.exp(moves), np.exp(start)
    top = scores.max(2, keepdims=True)
    emit = np.exp(scores - top)
    alpha, scale = np.empty_like(emit), np.empty((s, length))
    for t in range(length):
        state = (begin if t == 0 else alpha[:, t - 1] @ step) * emit[:, t]
        scale[:, t] = state.sum(1)
        alpha[:, t] = state / scale[:, t, None]
    beta = np.ones((s, k))
    marginal, expected = np.empty_like(emit), np.zeros((k, k))
    for t in range(length - 1, -1, -1):
        marginal[:, t] = alpha[:, t] * beta
        if t:
            weighted = emit[:, t] * beta / scale[:, t, None]
            expected += (alpha[:, t - 1].T @ weighted) * step
            beta = weighted @ step.T
    at, of = np.arange(s)[:, None], np.arange(length)
    observed = np.zeros((k, k))
    np.add.at(observed, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    value = scores[at, of, gold].sum() + start[gold[:, 0]].sum() + (observed * moves).sum()
    value -= np.log(scale).sum() + top.sum()
    by_score = -marginal
    by_score[at, of, gold] += 1
    by_start = np.bincount(gold[:, 0], minlength=k) - marginal[:, 0].sum(0)
    return value, by_score, observed - expected, by_start


def training_order(first: np.ndarray, slot: int) -> np.ndarray:
    """Word positions in the order of training: runs of a text's words, all runs shuffled, cut to whole sequences."""
    cuts = np.concatenate([np.arange(a, b, RUN) for a, b in zip(first[:-1], first[1:], strict=True)] or [np.zeros(0, int)])
    ends = np.r_[cuts[1:], first[-1]] if len(cuts) else cuts
    order = np.random.default_rng(slot).permutation(len(cuts))
    words = np.concatenate([np.arange(cuts[i], ends[i]) for i in order] or [np.zeros(0, int)])
    return words[: len(words) // SEQUENCE * SEQUENCE]


def fit_field(labelled: DataFrame, documents: DataFrame, per_language: int = PER_LANGUAGE) -> Field:
    """labelled: doc_id, label (language)."""
    labels = [r["label"] for r in labelled.where("label is not null").select("label").distinct().orderBy("label").collect()]
    k = len(labels)
    start = np.zeros((k << BITS) + k * k + k, np.float32)
    if not k:
        return Field.unpacked(labels, start)
    sample = labelled_sample(labelled, documents, per_language, SLOTS)
    number = {name: i for i, name in enumerate(labels)}

    def fit(frame: pd.DataFrame, vector: np.ndarray) -> np.ndarray:
        features = Features(pa.array(frame["text"], pa.string()))
        words = training_order(features.first, int(frame["slot"].iloc[0]))
        gold = np.repeat(frame["label"].map(number).to_numpy(), np.diff(features.first))[words].reshape(-1, SEQUENCE)
        vector = vector.astype(np.float64)
        if not len(gold):
            return vector
        ascent = Adam(len(vector), 0.1)
        for _ in range(STEPS):
            field = Field.unpacked(labels, vector)
            scores = features.scores(field.weights)[words].reshape(*gold.shape, k)
            _, by_score, by_move, by_start = log_likelihood_gradient(scores, gold, field.moves, field.start)
            full = np.zeros((features.n, k))
            full[words] = by_score.reshape(-1, k)
            gradient = np.r_[features.gradient(full).ravel(), by_move.ravel(), by_start] / gold.size
            vector = vector + ascent.step(gradient - 1e-6 * vector)
        return vector

    return Field.unpacked(labels, average_rounds(sample, fit, start, ROUNDS))


def label_documents(documents: DataFrame, field: Field, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The named columns with lang_pred, score, and word_labels (words of each label)."""
    shared = documents.sparkSession.sparkContext.broadcast(field)
    names = pa.array([*field.labels, UNKNOWN], pa.string())
    columns = list(dict.fromkeys([*keep, "text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            best, score, counts = shared.value.predict(batch.column("text"))
            has = batch.column("has_letter").to_numpy(zero_copy_only=False)
            best, score = np.where(has, best, -1), np.where(has & (best >= 0), score, 0.0)
            arrays = [*(batch.column(c) for c in keep), names.take(pa.array(best % len(names))), pa.array(score)]
            arrays.append(pa.array(list(counts), pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "lang_pred", "score", "word_labels"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)
    source = documents.select(*columns, letter)
    return source.mapInArrow(run, f"{schema}, lang_pred string, score double, word_labels array<bigint>")


def held_out() -> Column:
    """Every third document by the checksum of its id is never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(documents: DataFrame) -> DataFrame:
    return documents.where(~held_out()).select("doc_id", F.col("lang").alias("label"))


def op9_language(spark, folder: str) -> DataFrame:
    """The language of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    field = fit_field(learnable(documents), documents.where(~held_out()))
    named = label_documents(documents, field)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
