"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both sides cut the same bytes, a blank and the text: side A a byte-level BPE of the tokenizers library, side B a sentencepiece model
that adds the blank itself. Control strings inside a text are plain text. Per batch the tokens of each side are rows of
(document, start, token); one ``merge_asof`` finds for each start of A the token of B that covers it, another one for each start
of B the token of A. An overlap begins where one of its tokens does, so the two directions together hold every overlapping pair
once, equal starts being taken from the first only. Ends that both sides share close a group.

Both sides cut a text at a blank or line feed after a character other than white space (no entry of either vocabulary reaches
over that place), so the parts between are encoded once per worker and kept, in two generations of ``KEPT`` parts at most. A long text is
aligned in stretches that end where both sides do.

Counts over the corpus: a task writes its documents in chunks and, for each chunk, the distinct id pairs with their links. The pairs are
summed, the highest count of each B id is taken, and a chunk gets back the counts of its own pairs only. Nothing is broadcast,
and what meets in one task is bounded by the size of a chunk, or of one text if that is larger.

Defined results: a text that is null or empty, or whose bytes one side does not give back (U+2581 inside, say), has no tokens:
zeros and an empty ``groups_sha256``. Every row is a document of its own, also with a null or repeated id. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.llm.tokens import ALPHABET, TextEncoder
from stockloom.session import materialize

#: Tokens aligned at a time; tokens and documents that make a chunk.
STRETCH, CHUNK, MOST_DOCUMENTS = 1 << 19, 1 << 21, 1 << 16
#: Parts of a generation, and the length from which a part is not kept.
KEPT, LONGEST_KEPT = 400_000, 64
#: An id of side B takes so many bits of a pair's code, and a code so many of a key with the document's number.
B_BITS, CODE_BITS = 20, 40
_CUT = re.compile(r"([ \n])(?<!\s[ \n])")
_BYTE_OF = {c: b for b, c in ALPHABET.items()}


class Side:
    """One vocabulary: the bytes of its tokens, and its ids in decimal."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.sizes = np.array([len(b) for b in token_bytes], np.int64)
        digits = [str(i).encode() for i in range(len(token_bytes))]
        #: each id's digits, with room for a separator after them
        self.digits = np.frombuffer(b"".join([d.ljust(8, b"\0") for d in digits]), np.uint8).reshape(-1, 8)
        self.widths = np.array([len(d) for d in digits])

    def joined(self, ids: bytes) -> bytes:
        return b"".join([self.token_bytes[i] for i in np.frombuffer(ids, np.uint32).tolist()])


class TwoTokenizers:
    """Ids of both sides, part by part. Use :meth:`of` inside tasks: one per worker and pair of vocabularies."""

    _loaded: dict[tuple[str, str], TwoTokenizers] = {}

    def __init__(self, a_path: str, b_path: str):
        self.a_encoder = TextEncoder(a_path)
        self.a_encoder.tokenizer.encode_special_tokens = True
        self.b_model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        tokenizer = self.a_encoder.tokenizer
        names = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]
        self.a = Side([bytes(_BYTE_OF[c] for c in n) if set(n) <= _BYTE_OF.keys() else n.encode() for n in names])
        pieces = [self.b_model.id_to_piece(i) for i in range(self.b_model.vocab_size())]
        self.b = Side([bytes([int(p[3:5], 16)]) if self.b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        if len(names) > 1 << (CODE_BITS - B_BITS) or len(pieces) > 1 << B_BITS:
            raise ValueError("vocabularies are too large for the pair codes")
        #: every byte has an entry of its own, so without a normalizer side A gives any text back
        self.lossless = tokenizer.normalizer is None and len({t for t in self.a.token_bytes if len(t) == 1}) == 256
        self.blank = [self.b_model.piece_to_id("▁")]
        self.parts: dict[str, tuple[bytes, bytes, bool]] = {}
        self.older: dict[str, tuple[bytes, bytes, bool]] = {}

    @classmethod
    def of(cls, a_path: str, b_path: str) -> TwoTokenizers:
        if (a_path, b_path) not in cls._loaded:
            cls._loaded[a_path, b_path] = cls(a_path, b_path)
        return cls._loaded[a_path, b_path]

    def _encoded(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Per part, its ids on both sides and whether both give its bytes back."""
        found = list(map(self.parts.get, parts))
        if all(found):
            return found
        older, new = self.older.get, {}
        for part in {p for p, f in zip(parts, found, strict=True) if f is None}:
            if kept := older(part):
                self.parts[part] = kept
            else:
                new[part] = None
        own = dict(zip(new, self._encode(list(new)), strict=True))
        if len(self.parts) + len(own) > KEPT:
            self.parts, self.older = {}, self.parts
        self.parts.update((p, f) for p, f in own.items() if len(p) <= LONGEST_KEPT)
        return [f or own.get(p) or self.parts.get(p) or older(p) or self.older[p] for p, f in zip(parts, found, strict=True)]

    def _encode(self, parts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        bare = [p[1:] if p[0] == " " else p for p in parts]
        out = []
        for part, b in zip(parts, self.b_model.encode(bare, num_threads=1), strict=True):
            if part == " ":
                b = self.blank
            elif part[0] == "\n":
                b = b[1:]  # without the blank that the model adds
            a, b, whole = self.a_encoder.piece(part), array("I", b), part.encode()
            same = whole == b"".join([self.b.token_bytes[i] for i in b]) and (self.lossless or whole == self.a.joined(a))
            out.append((a, b.tobytes(), same))
        return out

    def rest(self) -> None:
        """At the end of a task: one generation of parts stays for the worker's next one."""
        self.parts, self.older = max(self.parts, self.older, key=len), {}

    def stretches(self, text: str | None) -> Iterator[tuple[bytes, bytes]]:
        """Ids of both sides, in stretches that end where both do; nothing if a side does not give the text back."""
        if not text:
            return
        cut = _CUT.split(" " + text)
        found = self._encoded([mark + rest for mark, rest in zip(cut[1::2], cut[2::2], strict=True)])
        a, b, whole = zip(*found, strict=True)
        if not all(whole):
            a, b = [b"".join(a)], [b"".join(b)]
            if not self.a.joined(a[0]) == (" " + text).encode() == self.b.joined(b[0]):
                return
        if len(a) <= STRETCH // 8 and max(map(len, a)) < STRETCH:
            yield b"".join(a), b"".join(b)
            return
        held_a, held_b, size = [], [], 0
        for x, y in zip(a, b, strict=True):
            if size and size + len(x) > 2 * STRETCH:
                yield b"".join(held_a), b"".join(held_b)
                held_a, held_b, size = [], [], 0
            if len(x) > 2 * STRETCH:
                yield from self._cut(x, y)
                continue
            held_a.append(x)
            held_b.append(y)
            size += len(x)
        if size:
            yield b"".join(held_a), b"".join(held_b)

    def _cut(self, a: bytes, b: bytes) -> Iterator[tuple[bytes, bytes]]:
        """A long part, cut at ends that both sides share."""
        ends = [np.cumsum(side.sizes[np.frombuffer(ids, np.uint32)]) for side, ids in ((self.a, a), (self.b, b))]
        shared = np.intersect1d(*ends, assume_unique=True)
        past = np.unique(shared // STRETCH, return_index=True)[1][1:]
        before = [0, 0]
        for end in [*shared[past], shared[-1]]:
            upto = [int(np.searchsorted(e, end, "right")) for e in ends]
            if upto != before:
                yield a[4 * before[0] : 4 * upto[0]], b[4 * before[1] : 4 * upto[1]]
            before = upto


class Aligned:
    """What is known of a document, stretch after stretch."""

    __slots__ = ("n_a", "n_b", "n_groups", "n_links", "digest")

    def __init__(self) -> None:
        self.n_a = self.n_b = self.n_groups = self.n_links = 0
        self.digest = sha256()


def align(stretches: list[tuple[int, bytes, bytes]], both: TwoTokenizers, documents: list[Aligned]) -> np.ndarray:
    """Align (document, ids of A, ids of B) and add to the documents; a key per link, of the document's number and the pair's code."""
    many = len(stretches)
    a_ids, b_ids = (np.frombuffer(b"".join([s[k] for s in stretches]), np.uint32).astype(np.int64) for k in (1, 2))
    a_of, b_of = (np.repeat(np.arange(many), [len(s[k]) // 4 for s in stretches]) for k in (1, 2))
    a_end, b_end = np.cumsum(both.a.sizes[a_ids]), np.cumsum(both.b.sizes[b_ids])
    a_start, b_start = a_end - both.a.sizes[a_ids], b_end - both.b.sizes[b_ids]

    # each token start finds the other side's covering token
    left = pd.DataFrame({"document": a_of, "start": a_start, "a": np.arange(len(a_ids))})
    right = pd.DataFrame({"document": b_of, "start": b_start, "b": np.arange(len(b_ids))})
    covering_b = pd.merge_asof(left, right, on="start", by="document")["b"].to_numpy()
    covering_a = pd.merge_asof(right, left, on="start", by="document")["a"].to_numpy()
    new = b_start != a_start[covering_a]
    link_of = np.r_[a_of, b_of[new]]
    codes = np.r_[a_ids, a_ids[covering_a[new]]] << B_BITS | np.r_[b_ids[covering_b], b_ids[new]]

    # ends that both sides share close a group; written in order, a group's A ids stand before its B ids
    shared = np.intersect1d(a_end, b_end, assume_unique=True)
    a_group, b_group = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
    a_upto, b_upto = (np.cumsum(np.bincount(g, minlength=len(shared))) for g in (a_group, b_group))
    b_before = np.r_[0, b_upto[:-1]]
    place = np.r_[np.arange(len(a_ids)) + b_before[a_group], np.arange(len(b_ids)) + a_upto[b_group]]
    a_last, b_last = a_end == shared[a_group], b_end == shared[b_group]
    widths = np.r_[both.a.widths[a_ids], both.b.widths[b_ids]]
    written = np.empty((len(place), 8), np.uint8)
    written[place] = np.concatenate([both.a.digits[a_ids], both.b.digits[b_ids]])
    written[place, widths] = np.r_[np.where(a_last, ord("|"), ord(",")), np.where(b_last, ord(";"), ord(","))]
    taken = np.empty(len(place) + 1, np.int64)
    taken[0] = 0
    taken[1:][place] = widths + 1
    text = written[written > 0].tobytes()

    n_a, n_b, n_links, n_groups = (np.bincount(x, minlength=many).tolist() for x in (a_of, b_of, link_of, a_of[a_last]))
    cut = np.cumsum(taken)[np.r_[0, np.cumsum(n_a) + np.cumsum(n_b)]].tolist()
    for k, (number, _, _) in enumerate(stretches):
        own = documents[number]
        if own.n_a:
            own.digest.update(b";")
        own.digest.update(text[cut[k] : cut[k + 1] - 1])
        own.n_a, own.n_b = own.n_a + n_a[k], own.n_b + n_b[k]
        own.n_groups, own.n_links = own.n_groups + n_groups[k], own.n_links + n_links[k]
    return np.array([s[0] for s in stretches], np.int64)[link_of] << CODE_BITS | codes


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


class _Chunk:
    """Documents whose pairs are counted together."""

    def __init__(self) -> None:
        self.ids: list = []
        self.documents: list[Aligned] = []
        self.waiting: list[tuple[int, bytes, bytes]] = []
        self.waits = self.tokens = 0
        self.keys, self.counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, doc_id: int | None, text: str | None, both: TwoTokenizers) -> None:
        number = len(self.documents)
        self.ids.append(doc_id)
        self.documents.append(Aligned())
        for a, b in both.stretches(text):
            self.waiting.append((number, a, b))
            self.waits += len(a) // 4
            if self.waits >= STRETCH:
                self.flush(both)

    def flush(self, both: TwoTokenizers) -> None:
        if self.waiting:
            keys, counts = np.unique(align(self.waiting, both, self.documents), return_counts=True)
            self.keys.append(keys)
            self.counts.append(counts)
            self.tokens, self.waiting, self.waits = self.tokens + self.waits, [], 0

    def full(self) -> bool:
        return self.tokens + self.waits >= CHUNK or len(self.documents) >= MOST_DOCUMENTS

    def batch(self, number: int, both: TwoTokenizers) -> pa.RecordBatch:
        """A row per document; the first also has the pairs of the chunk and their links."""
        self.flush(both)
        keys, links = _summed(self.keys, self.counts)
        codes, times = _summed([keys & ((1 << CODE_BITS) - 1)], [links])
        at = np.searchsorted(codes, keys & ((1 << CODE_BITS) - 1)).astype("<i4")
        first = np.searchsorted(keys >> CODE_BITS, np.arange(len(self.ids) + 1))
        part = lambda x: [x[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
        once = lambda x: pa.array([x.tolist()] + [None] * (len(self.ids) - 1), pa.list_(pa.int64()))
        numbers = [pa.array([getattr(d, n) for d in self.documents], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
        texts = pa.array([d.digest.hexdigest() if d.n_a else "" for d in self.documents])
        arrays = [pa.array([number] * len(self.ids), pa.int64()), pa.array(self.ids, pa.int64()), *numbers, texts]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(part(at)), pa.array(part(links.astype("<i8"))), once(codes), once(times)], _ALIGNED)


_ALIGNED = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "links", "codes", "times"]
_SCHEMA = "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, at binary, links binary, codes array<bigint>, times array<bigint>"


def aligned(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, text -> a row per document with its counts and pairs, in chunks; chunk numbers hold once the result is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, chunk, number = TwoTokenizers.of(a_path, b_path), _Chunk(), TaskContext.get().partitionId() << 32
        for batch in sliced(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                chunk.add(doc_id, text, both)
                if chunk.full():
                    yield chunk.batch(number, both)
                    chunk, number = _Chunk(), number + 1
        if chunk.ids:
            yield chunk.batch(number, both)
        both.rest()

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, _SCHEMA)


def align_documents(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    stored = materialize(aligned(documents, a_path, b_path))
    pair = F.posexplode(F.arrays_zip("codes", "times")).alias("at", "pair")
    pairs = stored.where("codes is not null").select("chunk", pair).select("chunk", "at", F.col("pair.codes").alias("code"), F.col("pair.times").alias("times"))
    totals = materialize(pairs.groupBy("code").agg(F.sum("times").alias("total")).withColumn("b", F.col("code").bitwiseAND((1 << B_BITS) - 1)))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    marked = totals.join(highest, "b").select("code", "total", (F.col("total") == F.col("highest")).alias("best"))
    counts = pairs.join(materialize(marked), "code").select(F.col("chunk").alias("of"), "at", "total", "best")

    def digest(own: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        total, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
        total[counts["at"].to_numpy()] = counts["total"].to_numpy()
        best[counts["at"].to_numpy()] = counts["best"].to_numpy()
        sums, bests = [], []
        for at, links in zip(own["at"], own["links"], strict=True):
            at, links = np.frombuffer(at, "<i4"), np.frombuffer(links, "<i8")
            sums.append(int((total[at] * links).sum()))
            bests.append(int((best[at] * links).sum()))
        out = own[["doc_id", "n_a", "n_b", "n_groups", "n_links"]].assign(n_best=bests, count_sum=sums, groups_sha256=own["groups_sha256"])
        return out.astype({"doc_id": "Int64", "n_best": "int64", "count_sum": "int64"})

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return stored.drop("codes", "times").groupBy("chunk").cogroup(counts.groupBy("of")).applyInPandas(digest, schema)


def op12_token_alignment(spark, folder: str) -> DataFrame:
    """All documents: byte-level BPE of 50k entries against sentencepiece of 32k."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return align_documents(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
