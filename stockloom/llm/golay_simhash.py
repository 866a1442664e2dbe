"""SimHash near-duplicates, found by fuzzy hashing with the binary Golay code.

A fingerprint has 64 bits; bit b is 1 if over half of the text's shingle hashes (repeats included) have it. Fingerprints that
differ in at most three bits link, and all documents that links connect are one component.

The fingerprint is cut into segments of 22, 21 and 21 bits, each a word of the [23, 12, 7] Golay code once filled up
with zeros. The code is perfect: every word has exactly one codeword within three bits, its home. A word that differs in
one bit from x has its home within four bits of x, and there is one such codeword, or six if x is three bits from its own
home; their numbers are the probes of x. So x finds every word at a distance of one or less by looking for homes.

Pigeonhole on three errors in three segments leaves two cases, and a fingerprint looks for both:

* one segment is equal and another differs in a bit at most: keys of a whole segment and a codeword number, six in all;
* every segment differs in exactly one bit: a key of two codeword numbers and the three parities, which must all differ.

A fingerprint is entered under seven home keys and looks under about 60 probe keys; keys have 34 and 27 bits, so unrelated
fingerprints seldom meet. Candidates are verified by counting bits.

Groups of thousands of near copies would meet under many keys in all pairs. Links inside a key are therefore first made to
the smallest fingerprint at home there, an aggregate and a join. Probes then only look for homes that belong to another component
so far, and a larger one: either of two linked fingerprints finds the other, so the one in the smaller component may do it.
The pairs of a group that hangs together are never listed, its members do not look for the loose ones around it, and no
link between components is lost.

Defined results: words are maximal runs of bytes other than blank and 0x09-0x0D after lower-casing A-Z; a text of fewer words
than the width is hashed as one shingle; null texts and texts without words have fingerprint zero and link like any other.
Texts are hashed in pieces of about a megabyte, cut between words, so a long one needs no memory beyond its own. Repeated rows
and null ids are rows of their own; a component whose ids are all null has a null id. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, permutations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_digest

from stockloom.llm.components import components
from stockloom.llm.text_batches import sliced
from stockloom.session import materialize

SEED = 42
#: Bytes of text hashed at a time, and hashes whose bits are counted at a time.
PIECE, BLOCK = 1 << 20, 1 << 18
#: Generator polynomial of the Golay code, and the code's lengths.
GENERATOR, LENGTH, CHECKS = 0b101011100011, 23, 11
#: First bit and number of bits of each segment.
SEGMENTS = ((42, 22), (21, 21), (0, 21))
MOST_ERRORS = 3
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def shingle_digests(text: bytes, width: int) -> Iterator[bytes]:
    """The big-endian XXH64 digests of all shingles of a text, piece by piece."""
    carry, at, found = [], 0, False
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            blank = _BLANK.search(text, end)
            end = blank.start() if blank else len(text)
        words, at = carry + text[at:end].lower().split(), end
        if len(words) >= width:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False))
            yield b"".join(map(xxh64_digest, shingles, repeat(SEED)))
            found = True
        carry = words[max(0, len(words) - width + 1) :] if len(words) >= width else words
    if carry and not found:
        yield xxh64_digest(b" ".join(carry), SEED)


def simhashes(texts: list[str | None], width: int) -> np.ndarray:
    """Fingerprints of whole texts."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[tuple[int, bytes]] = []

    def count() -> None:
        if held:
            bits = np.unpackbits(np.frombuffer(b"".join([d for _, d in held]), ">u8").astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            sizes = np.array([len(d) // 8 for _, d in held])
            rows = np.array([i for i, _ in held])
            np.add.at(ones, rows, np.add.reduceat(bits, np.r_[0, np.cumsum(sizes)[:-1]], axis=0, dtype=np.int64))
            np.add.at(total, rows, sizes)
            held.clear()

    size = 0
    for i, text in enumerate(texts):
        for digests in shingle_digests((text or "").encode(), width):
            held.append((i, digests))
            size += len(digests) // 8
            if size >= BLOCK:
                count()
                size = 0
    count()
    most = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
    return most.reshape(-1, 8).copy().view("<u8").ravel().astype(np.uint64)


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            found = simhashes(batch.column("text").to_pylist(), width).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "fp"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


@lru_cache
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the high and low halves of a word; per syndrome the error of the home and those of five more codewords.

    A syndrome without further codewords at a distance of four has -1 there.
    """
    syndrome = np.zeros(1 << 12, np.int64)
    high = np.zeros(1 << CHECKS, np.int64)

    def remainder(word: int) -> int:
        for bit in range(LENGTH - 1, CHECKS - 1, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - CHECKS)
        return word

    for bit in range(12):
        syndrome[1 << bit : 2 << bit] = syndrome[: 1 << bit] ^ remainder(1 << bit)
    for bit in range(CHECKS):
        high[1 << bit : 2 << bit] = high[: 1 << bit] ^ remainder(1 << (12 + bit))
    home, more = np.zeros(1 << CHECKS, np.int64), np.full((1 << CHECKS, 5), -1, np.int64)
    filled = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3, 4):
        for bits in combinations(range(LENGTH), weight):
            error = sum(1 << b for b in bits)
            at = int(syndrome[error & 4095] ^ high[error >> 12])
            if weight < 4:
                home[at] = error
            else:
                more[at, filled[at]] = error
                filled[at] += 1
    return high, syndrome, home, more


def codewords(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word the numbers of the codewords within four bits, home first, in six columns; and which columns hold one."""
    high, low, home, more = golay()
    at = high[words >> 12] ^ low[words & 4095]
    errors = np.column_stack([home[at], more[at]])
    return (words[:, None] ^ np.maximum(errors, 0)) >> CHECKS, errors >= 0


def _segments(fps: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The segments as words, and their three parities as one number."""
    cut = [((fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64) for first, bits in SEGMENTS]
    odd = [np.bitwise_count(x).astype(np.int64) & 1 for x in cut]
    return cut, odd[0] << 2 | odd[1] << 1 | odd[2]


def home_keys(fps: np.ndarray) -> np.ndarray:
    """Seven keys of each fingerprint, a row of the array each."""
    cut, odd = _segments(fps)
    home = [codewords(x)[0][:, 0] for x in cut]
    keys = [k << 40 | cut[i] << 12 | home[j] for k, (i, j) in enumerate(permutations(range(3), 2))]
    return np.column_stack([*keys, 6 << 40 | odd << 24 | home[0] << 12 | home[1]])


def probe_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys under which fingerprints at a distance of three or less are at home, and the row each belongs to."""
    cut, odd = _segments(fps)
    near = [codewords(x) for x in cut]
    keys, rows = [], []
    for k, (i, j) in enumerate(permutations(range(3), 2)):
        found, there = near[j]
        keys.append((k << 40 | cut[i][:, None] << 12 | found)[there])
        rows.append(np.nonzero(there)[0])
    there = near[0][1][:, :, None] & near[1][1][:, None, :]
    both = near[0][0][:, :, None] << 12 | near[1][0][:, None, :]
    keys.append((6 << 40 | (odd ^ 7)[:, None, None] << 24 | both)[there])
    rows.append(np.nonzero(there)[0])
    return np.concatenate(keys), np.concatenate(rows)


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = home_keys(batch.column("fp").to_numpy().view(np.uint64))
        row = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *(c.take(row) for c in batch.columns)], ["key", *batch.schema.names])


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            part = batch.slice(start, 4096)
            keys, rows = probe_keys(part.column("fp").to_numpy().view(np.uint64))
            row = pa.array(rows)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *(c.take(row) for c in part.columns)], ["key", *part.schema.names])


def fingerprint_components(fps: DataFrame, errors: int = MOST_ERRORS) -> DataFrame:
    """Distinct fp -> stored (fp, root); root is one fingerprint of the component."""
    if not 0 <= errors <= MOST_ERRORS:
        raise ValueError(f"the keys find up to {MOST_ERRORS} errors")
    alone = fps.select("fp", F.col("fp").alias("root"))
    # planning takes the keys of a fingerprint for one row; what holds them is merged, as a broadcast may exceed the driver
    homes = alone.select("fp").mapInArrow(_homes, "key bigint, fp bigint").hint("merge")
    hubs = homes.groupBy("key").agg(F.min("fp").alias("hub"))
    near = homes.join(hubs, "key").where(f"fp <> hub and bit_count(fp ^ hub) <= {errors}")
    first = components(near.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct())
    rooted = materialize(_renamed(alone, first, "fp"))

    # components by size; a probe looks at larger ones than its own
    sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = materialize(rooted.join(sizes, "root").select("fp", "root", "size"))
    schema = "key bigint, fp bigint, root bigint, size bigint"
    homes = sized.mapInArrow(_homes, schema).select("key", F.col("fp").alias("home"), F.col("root").alias("other"), F.col("size").alias("others"))
    groups = homes.select("key", "other", "others").distinct()
    strangers = sized.mapInArrow(_probes, schema).hint("merge").join(groups, "key").where("size < others or (size = others and root < other)")
    met = strangers.select("key", "fp", "root", "other").join(homes.drop("others").hint("merge"), ["key", "other"]).where(f"bit_count(fp ^ home) <= {errors}")
    links = materialize(met.select(F.col("root").alias("a"), F.col("other").alias("b")).distinct())
    return materialize(_renamed(rooted, components(links), "root"))


def _renamed(rooted: DataFrame, found: DataFrame, by: str) -> DataFrame:
    """fp and root, replaced by the root found for the column ``by`` where there is one."""
    found = found.select(F.col("node").alias(by), F.col("root").alias("found"))
    return rooted.join(found, by, "left").select("fp", F.coalesce("found", "root").alias("root"))


def simhash_components(documents: DataFrame, width: int = 3, errors: int = MOST_ERRORS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id that links reach)."""
    stored = materialize(fingerprints(documents, width))
    owners = materialize(stored.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    rooted = fingerprint_components(owners.select("fp"), errors).join(owners, "fp")
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return stored.join(named, "fp").select("doc_id", digits, "component_id")


def op11_simhash_components(spark, folder: str) -> DataFrame:
    """All documents, three-word shingles, three bits at most."""
    return simhash_components(spark.read.parquet(f"{folder}/documents.parquet"))
