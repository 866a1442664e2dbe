"""Document fingerprints: a quartile bucket digest of hashed byte triplets, and a bounded difference score.

Six triplets of every five-byte window are hashed into buckets. The digest keeps, for each bucket, the quartile its count
lies in (two bits), the spread of the quartiles, and the length on a logarithmic scale. Two digests differ by the sum of
their bucket steps, weighted so that unrelated texts reach about the bound, plus small terms for spread and length;
the likeness is one minus that difference, held between 0 and 1.

A digest is a string: ``Q1``, two hex digits of length, two of quartile ratios, then two bits per bucket in base 64.

Defined results: a null or empty text has the digest of no triplets; texts of fewer than five bytes have their length
and one hashed triplet of the padded bytes, so equal texts always have equal digests; two empty digests have likeness 1.
"""

from __future__ import annotations

import hashlib
import math
from base64 import b64decode, b64encode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.llm.text_batches import mix, sliced
from stockloom.session import materialize

BUCKETS = 512
#: Offsets of the triplets inside a window; each kind is hashed with its own number.
KINDS = ((0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4), (0, 3, 4))
#: Mean step between the quartile codes of unrelated texts.
UNRELATED_STEP = 1.25
_BITS = int(math.log2(BUCKETS))


def _bucket(codes: np.ndarray, kind: int) -> np.ndarray:
    """Multiplicative hash of 24-bit codes, salted by the kind of triplet."""
    factor = np.uint32(int(mix(np.array([kind + 1], np.uint64))[0]) & 0xFFFFFFFF | 1)
    x = codes * factor
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return x >> np.uint32(32 - _BITS)


def counts(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(BUCKETS, np.int64)
    d = np.frombuffer(data.ljust(5, b"\0"), np.uint8).astype(np.uint32)
    n = len(d) - 4
    out = np.zeros(BUCKETS, np.int64)
    for kind, (a, b, c) in enumerate(KINDS):
        codes = (d[a : a + n] << np.uint32(16)) | (d[b : b + n] << np.uint32(8)) | d[c : c + n]
        out += np.bincount(_bucket(codes, kind).astype(np.int64), minlength=BUCKETS)
    return out


def digest(data: bytes) -> str:
    found = counts(data)
    ordered = np.sort(found)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = (found > q1).astype(np.uint8) + (found > q2) + (found > q3)
    length = min(255, int(round(16 * math.log2(1 + len(data))))) if data else 0
    ratios = (q1 * 15 // q3 if q3 else 0) << 4 | (q2 * 15 // q3 if q3 else 0)
    four = codes.reshape(-1, 4)
    packed = four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]
    return f"Q1{length:02x}{ratios:02x}{b64encode(packed.astype(np.uint8).tobytes()).decode()}"


def _parsed(fingerprint: str) -> tuple[int, int, int, np.ndarray]:
    packed = np.frombuffer(b64decode(fingerprint[6:]), np.uint8)
    codes = np.stack([packed >> 6, packed >> 4 & 3, packed >> 2 & 3, packed & 3], 1).ravel().astype(np.int16)
    ratios = int(fingerprint[4:6], 16)
    return int(fingerprint[2:4], 16), ratios >> 4, ratios & 15, codes


def likeness(a: str, b: str) -> float:
    """1 for equal digests, about 0 for unrelated texts; symmetric, never outside 0 to 1."""
    if a == b:
        return 1.0
    (la, pa_, ra, ca), (lb, pb, rb, cb) = _parsed(a), _parsed(b)
    steps = float(np.abs(ca - cb).sum()) / (UNRELATED_STEP * len(ca))
    extra = (abs(pa_ - pb) + abs(ra - rb)) / 300 + max(0, abs(la - lb) - 4) / 256
    return max(0.0, 1.0 - steps - extra)


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = [digest((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fingerprint string")


PAIRED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [c.split()[0] for c in PAIRED.split(", ")]


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the front of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(doc, text: str, own: str, following: str, next_own: str) -> tuple:
    changed = edited(text, following)
    data = changed.encode()
    other = digest(data)
    return doc, len(text), hashlib.sha256(data).hexdigest(), own, other, likeness(own, other), likeness(own, next_own)


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Each text against its edited text and the text that follows in ascending (doc_id, text) order, nulls first.

    The table is sorted by ranges of that order and each partition is walked once. A partition's last text needs the
    first one of the next partition; only those edge texts, two per partition, meet in a second small step.
    """
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), tie.alias("tie"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text", F.spark_partition_id().alias("part"))
    schema = f"{PAIRED}, part int, first_text string, last_text string"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(records: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*records, strict=True))
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
            names = [*_NAMES, "part", "first_text", "last_text"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        before, part, first = None, 0, None
        for batch in sliced(batches, "text"):
            part = batch.column("part")[0].as_py()
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = digest(text.encode())
                if before is None:
                    first = text
                else:
                    out.append((*_compared(*before, text, own), part, None, None))
                before = (doc, text, own)
            if out:
                yield rows_of(out)
        if before is not None:
            doc, text, own = before
            yield rows_of([(doc, len(text), None, own, None, None, None, part, first, text)])

    stored = materialize(ordered.mapInArrow(walk, schema))
    edges = stored.where("first_text is not null").select("doc_id", "part", "fingerprint", "first_text", "last_text")
    by_part = Window.orderBy("part")
    following = F.coalesce(F.lead("first_text").over(by_part), F.first("first_text").over(by_part))
    edges = edges.select("doc_id", "last_text", "fingerprint", following.alias("following"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                _compared(r["doc_id"], r["last_text"], r["fingerprint"], r["following"], digest(r["following"].encode()))
                for r in batch.to_pylist()
            ]
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _NAMES)

    return stored.where("first_text is null").select(*_NAMES).unionByName(edges.mapInArrow(finish, PAIRED))


def op6_fingerprints(spark, folder: str) -> DataFrame:
    """All documents, their edited texts and their neighbours."""
    return compare_with_next(spark.read.parquet(f"{folder}/documents.parquet"))
