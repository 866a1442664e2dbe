"""From raw documents to packed sequences: five stages, each of which works on all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; the first four keep the columns of ``documents``. The result of
each is written as Parquet and read again as the next one's input. Models are fitted on bounded samples of the
labelled rows among the stage's own input; every decision is made over whole texts of all rows.

Rows with null ids or texts pass through the stages like others: a null text has no language and is rejected by the
first stage. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockloom.llm.bounded_packing import pack_documents
from stockloom.llm.crf_language import UNKNOWN, fit_field, held_out, label_documents, learnable
from stockloom.llm.jaccard_rtree import one_of_each, row_key
from stockloom.llm.ordinal_quality import fit_quality, grades_of, kept, score_documents
from stockloom.llm.soft_mixing import TARGETS, domain_labels, fit_domains, membership, mixed_documents, solve
from stockloom.llm.text_batches import small_batches
from stockloom.session import materialize

#: A text stays if its words agree on one language to this degree.
LEAST_AGREEMENT = 0.5
#: Mixing uses a document so many times at most; a domain too small for its share is warned of.
MOST_USES = 16.0
#: Encoded parts that a worker keeps after a task of packing, as it goes on to other stages.
KEPT_PARTS = 20_000


def _aside(docs: DataFrame) -> tuple[DataFrame, list]:
    """docs with all columns but doc_id and text renamed, so that none clashes with what an operator adds; and the way back."""
    names = {c: f"column_{i}_" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters and texts in which no language prevails go."""
    small_batches(spark)
    field = fit_field(learnable(docs), docs.where(~held_out()))
    renamed, back = _aside(docs)
    named = label_documents(renamed, field, tuple(renamed.columns))
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_AGREEMENT)
    return named.where(known).select(*back)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are likely of the lowest grade go; without graded texts none does."""
    small_batches(spark)
    model = fit_quality(grades_of(spark.read.parquet(f"{sf_dir}/labels.parquet")), docs)
    renamed, back = _aside(docs)
    scored = score_documents(renamed, model, tuple(renamed.columns))
    return scored.where(kept(model)).select(*back)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by five-word shingles at similarity 0.8 or more, one row stays: that with the smallest id.

    Rows without an id come after those with one, and rows of one id are told apart by a hash of id and text. Texts
    without words link with nothing; of them, rows equal in id and text count once.
    """
    small_batches(spark)
    stay = one_of_each(docs, width=5, num=80, den=100).withColumnRenamed("row_key", "row_key_")
    renamed, back = _aside(docs)
    # equal rows go before the join: each task leaves one of them, so many copies do not meet in one task
    rows = renamed.withColumn("row_key_", row_key()).dropDuplicates(["row_key_"])
    return rows.join(stay, "row_key_", "left_semi").select(*back)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, up to MOST_USES times, until expected tokens per domain have the wanted shares; none is left out."""
    small_batches(spark)
    labelled = domain_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"), docs)
    model = fit_domains(labelled, docs, sorted(TARGETS))
    mix = solve(materialize(membership(docs, model)), model, TARGETS, least=1.0, most=MOST_USES)
    renamed, back = _aside(docs)
    return mixed_documents(renamed, mix).select(*back)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kept_parts=KEPT_PARTS)


STAGES = [
    ("language ID", language),
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the trained stages and the packing; tests hold them against brute force instead.
ORACLE_SQL = None
PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_STATEMENTS: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
