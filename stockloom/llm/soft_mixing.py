"""Mixing to target weights with soft membership.

A softmax classifier, fitted on a bounded sample of a labelled table, gives every document posteriors over the domains. A
document of t tokens with posteriors p adds p * t expected tokens to the domains each time it is used, so the wanted mix is
a least-squares problem in the documents' rates r >= least: bring A r near the target token totals T, where column i of A
is t_i p_i. It is solved by projected gradient: in the metric that weighs documents by tokens and domains by the inverse of
G = sum t_i p_i p_i', a step is r_i <- max(least, r_i - p_i . G^-1 (A r - T)), and steps of length one never overshoot.

Every step needs only the domain totals of A r, one distributed sum. A rate depends on the document's own posteriors and
on the steps' vectors so far, so rates are recomputed from those few vectors whenever they are needed: there is no state
to keep per document, and a lost executor repeats a scan.

Steps go on until the totals are within 1e-6 of their targets, or hardly move because the bounds on the rates are in the
way, or ``most_steps`` are taken. :attr:`Mix.missed` says how far each domain stays from its target, and :func:`solve` warns of domains that stay away, those
without any tokens among them.

Defined results: null texts count as empty, have no tokens and the posteriors of an empty text; without labelled rows all
domains are equally likely; repeated rows are documents of their own; an empty table gives an empty result and no steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.llm.training import COLUMNS, Adam, SparseRows, average_rounds, labelled_sample, row_products, text_features, word_counts
from stockloom.session import materialize

#: Labelled rows of each domain, groups they are fitted in, rounds of averaging.
PER_DOMAIN, SLOTS, ROUNDS = 500, 1, 1
#: Steps in a round, rows that must share a column, weight of the squared weights.
STEPS, SHARED, DECAY = 160, 8, 1e-3
#: Share of tokens each domain is to have in the registered mix.
TARGETS = {"en": 0.50, "de": 0.14, "es": 0.10, "fr": 0.14, "rest": 0.12}


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray  # domains x COLUMNS

    def posteriors(self, column: pa.Array) -> np.ndarray:
        rows = text_features(column)
        return _softmax(np.stack([row_products(*rows, w) for w in self.weights], 1))


def _softmax(scores: np.ndarray) -> np.ndarray:
    out = np.exp(scores - scores.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def fit_domains(labelled: DataFrame, documents: DataFrame, domains: list[str], per_domain: int = PER_DOMAIN) -> DomainModel:
    """labelled: doc_id, label (a domain's name)."""
    k, number = len(domains), {name: i for i, name in enumerate(domains)}
    sample = labelled_sample(labelled.where(F.col("label").isin(domains)), documents, per_domain, SLOTS)

    def fit(frame: pd.DataFrame, start: np.ndarray) -> np.ndarray:
        rows, gold = SparseRows(frame["text"], SHARED), np.eye(k)[frame["label"].map(number).to_numpy()]
        weights = start.reshape(k, COLUMNS)[:, rows.active].astype(np.float64)
        ascent = Adam(weights.shape, 0.05)
        for _ in range(STEPS):
            missed = gold - _softmax(np.stack([rows.times(w) for w in weights], 1))
            weights += ascent.step(np.stack([rows.back(m) for m in missed.T]) / rows.n - DECAY * weights)
        out = np.zeros((k, COLUMNS))
        out[:, rows.active] = weights
        return out.ravel()

    fitted = average_rounds(sample, fit, np.zeros(k * COLUMNS, np.float32), ROUNDS)
    return DomainModel(domains, fitted.reshape(k, COLUMNS))


@dataclass
class Mix:
    """The classifier, the steps taken, and what they reached."""

    model: DomainModel
    least: float
    most: float = np.inf
    steps: list[np.ndarray] = field(default_factory=list)
    targets: np.ndarray | None = None
    reached: np.ndarray | None = None

    @property
    def missed(self) -> dict[str, float]:
        """What each domain lacks of its target (or has too much, below 0), as a share of all tokens."""
        total = self.targets.sum() or 1.0
        return dict(zip(self.model.domains, ((self.targets - self.reached) / total).tolist(), strict=True))

    def rates(self, posteriors: np.ndarray) -> np.ndarray:
        out = np.ones(len(posteriors))
        for step in self.steps:
            out = np.clip(out - posteriors @ step, self.least, self.most)
        return out


def membership(documents: DataFrame, model: DomainModel) -> DataFrame:
    """doc_id, tokens (blank-separated words) and posteriors of every whole text."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            text = batch.column("text")
            found = pa.array(list(shared.value.posteriors(text)), pa.list_(pa.float64()))
            arrays = [batch.column("doc_id"), pa.array(word_counts(text), pa.int64()), found]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tokens", "posteriors"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, tokens bigint, posteriors array<double>")


def solve(
    members: DataFrame, model: DomainModel, targets: dict[str, float], least: float = 0.0, most: float = np.inf, most_steps: int = 60
) -> Mix:
    """Fit the rates, between least and most. The total is the smallest one at which no domain has to shrink; members must be stored.

    What is missed when the steps end is in the result, and a domain that misses more than 1e-4 of all tokens is warned of.
    """
    mix, k = Mix(model, least, most), len(model.domains)
    p = [F.col("posteriors")[i] for i in range(k)]
    gram = [F.sum(F.col("tokens") * p[i] * p[j]) for i in range(k) for j in range(i, k)]
    first = members.agg(*[F.sum(F.col("tokens") * x) for x in p], *gram).first()
    natural = np.array([x or 0.0 for x in first[:k]])
    g = np.zeros((k, k))
    g[np.triu_indices(k)] = [x or 0.0 for x in first[k:]]
    g = g + np.triu(g, 1).T
    share = np.array([targets.get(d, 0.0) for d in model.domains])
    share = share / share.sum()
    wanted = share > 0
    total = (natural[wanted] / share[wanted]).max() if natural.sum() else 0.0
    mix.targets, mix.reached = share * total, natural
    inverse = np.linalg.pinv(g + np.eye(k) * 1e-9 * max(1.0, np.trace(g)))
    while total and len(mix.steps) < most_steps:
        if np.abs(mix.reached - mix.targets).max() <= 1e-6 * total:
            break
        mix.steps.append(inverse @ (mix.reached - mix.targets))
        used = F.col("tokens") * rate_column(mix)
        reached = np.array(list(members.agg(*[F.sum(used * x) for x in p]).first()))
        moved = np.abs(reached - mix.reached).max()
        mix.reached = reached
        if moved <= 1e-6 * total:
            break
    for domain, lack in mix.missed.items():
        if abs(lack) > 1e-4:
            warnings.warn(f"domain {domain} misses its target by {lack:.2%} of all tokens", stacklevel=2)
    return mix


def rate_column(mix: Mix) -> Column:
    """The rate as an expression of ``posteriors``: the steps, one after the other."""
    if not mix.steps:
        return F.lit(1.0)
    steps = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in mix.steps])

    def apply(rate: Column, step: Column) -> Column:
        dot = F.aggregate(F.zip_with("posteriors", step, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return F.least(F.lit(float(mix.most)), F.greatest(F.lit(float(mix.least)), rate - dot))

    return F.aggregate(steps, F.lit(1.0), apply)


def copies_column(rate: Column, *identity: Column | str) -> Column:
    """Whole uses of a document: the rate rounded up with the probability of its fraction, by a hash of the row."""
    chance = F.pmod(F.xxhash64(F.lit("mix"), *identity), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("int")).cast("int")


def domain_labels(labels: DataFrame, documents: DataFrame, domains: Collection[str] = tuple(TARGETS)) -> DataFrame:
    """Rated documents by language where they are good, not toxic and in a language that is a domain; all others as ``rest``."""
    rated = labels.where("quality is not null").select("doc_id", ((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    joined = documents.select("doc_id", "lang").join(rated, "doc_id")
    return joined.select("doc_id", F.when(F.col("good") & F.col("lang").isin(*domains), F.col("lang")).otherwise(F.lit("rest")).alias("label"))


def mixed_documents(documents: DataFrame, mix: Mix) -> DataFrame:
    """The documents, each as often as its rate says; columns unchanged. Rates are recomputed in the same scan."""
    shared = documents.sparkSession.sparkContext.broadcast(mix)
    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            rates = shared.value.rates(shared.value.model.posteriors(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates)], [*names, "mix_rate"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    rated = documents.mapInArrow(run, f"{schema}, mix_rate double")
    times = F.explode(F.array_repeat(F.lit(1), copies_column(F.col("mix_rate"), "doc_id", F.xxhash64("text"))))
    return rated.select(*names, times.alias("mix_copy")).select(*names)


def op2_mixing(spark, folder: str) -> DataFrame:
    """Domain, rate and uses of every document under the registered targets."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    labelled = domain_labels(spark.read.parquet(f"{folder}/labels.parquet"), documents)
    model = fit_domains(labelled, documents, sorted(TARGETS))
    members = materialize(membership(documents, model))
    mix = solve(members, model, TARGETS)
    rate = rate_column(mix)
    best = F.array_position("posteriors", F.array_max("posteriors")).cast("int")
    return members.select(
        "doc_id",
        "tokens",
        F.element_at(F.array(*[F.lit(d) for d in model.domains]), best).alias("domain"),
        F.array_max("posteriors").alias("p_domain"),
        rate.alias("rate"),
        copies_column(rate, "doc_id", "tokens").cast("bigint").alias("copies"),
        *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(model.domains)],
    )
