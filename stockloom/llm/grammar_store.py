"""Token-id files compressed by Re-Pair: frequent neighbouring ids are replaced by new symbols, shard by shard.

A file set is a table of shards, written through Spark so that commits, retries and remote stores are Spark's business.
Each row is one shard: ``ordinal`` (its place in document order), ``tokens``, ``documents`` and ``body``, the binary
format below, little-endian throughout. A shard closes at the first document end after ``shard_tokens`` ids.

    bytes 0-3    b"RPG1"
    then 5 u32   number of documents D, of rules R, of symbols S, the first rule's symbol (the terminal count T), and
                 the bytes W of a symbol: 2 if all symbols fit, else 4
    R x 2 u32    left and right symbol of each rule; rule k is symbol T + k and uses smaller symbols only
    R     u32    expansion length of each rule
    D     i64    document ids, then D bytes telling which are null
    D + 1 u32    first symbol of each document
    S     uW     symbols

Expansion lengths make random access cheap: a range of a document's ids is found by adding lengths, and only the
symbols that overlap it are expanded (:func:`token_range`).

Each round counts neighbouring pairs of the whole shard, takes the most frequent ones (``pairs_per_round``, each at least
``least`` times), and replaces their occurrences from left to right; pairs never span two documents. Rounds end
when no pair is frequent enough, or after ``rounds`` if that is given.

Defined results: null text has no ids but the end id; documents are ordered by (doc_id, hash of the text), null ids
first, so equal ids stay in a fixed order and a frequent id is spread over partitions; an empty table writes no shard.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.llm.tokens import TextEncoder
from stockloom.session import new_folder

MAGIC = b"RPG1"
END_ID = 2
SHARD_SCHEMA = "part int, within int, first_id bigint, tokens bigint, documents bigint, body binary"


#: Encoded parts of a generation that a worker keeps; new ones take most of the time, and nothing else here needs memory.
KEPT_PARTS = 600_000
#: Places are counted in a table of 2**SLOTS before their pairs are; see :func:`_round`.
SLOTS = 18


def _slot(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS)).astype(np.int32)


def _round(symbols: np.ndarray, same: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round's pairs (codes, most frequent first), the places of their occurrences, and the pair at each place.

    ``same`` tells whether the next symbol is of the same document. Places are counted by a hash of their pair first; a
    pair is at most as frequent as its slot, so only places in full slots are sorted, and their pairs counted exactly. Of
    chosen pairs with one slot the most frequent has it and the others wait for the next round. No pair is found only
    if none is of the least frequency.
    """
    code = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
    slot = _slot(code)
    filled = np.bincount(slot[same], minlength=1 << SLOTS)
    for enough in dict.fromkeys((max(least, int(np.partition(filled, -most)[-most])), least)):
        at = np.flatnonzero((filled >= enough)[slot] & same)
        pairs, counts = np.unique(code[at], return_counts=True)
        pairs, counts = pairs[counts >= least], counts[counts >= least]
        if len(pairs):
            break
    first = np.lexsort((pairs, -counts))[:most]
    pairs = pairs[first]
    pairs = pairs[np.sort(np.unique(_slot(pairs), return_index=True)[1])]
    rule = np.full(1 << SLOTS, -1, np.int32)
    rule[_slot(pairs)] = np.arange(len(pairs), dtype=np.int32)
    of = rule[slot[at]]
    at, of = at[of >= 0], of[of >= 0]
    own = pairs[of] == code[at]
    return pairs, at[own], of[own]


def compress(ids: np.ndarray, starts: np.ndarray, terminals: int, least: int = 64, pairs_per_round: int = 4096, rounds: int | None = None):
    """(rules R x 2, lengths R, symbols, first symbol of each document) for ids whose documents begin at ``starts``."""
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols) + 1, bool)
    last[starts] = True  # marks the first symbol of each document
    rules: list[np.ndarray] = []
    lengths = np.ones(terminals, np.uint32)
    made = terminals
    while rounds is None or len(rules) < rounds:
        if len(symbols) < 2:
            break
        chosen, at, rule = _round(symbols, ~last[1 : len(symbols)], least, pairs_per_round)
        if not len(chosen):
            break
        # overlapping occurrences: every second one of a run, from the left
        run = np.r_[True, np.diff(at) > 1]
        begin = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        keep = (np.arange(len(at)) - begin) % 2 == 0
        at, rule = at[keep], rule[keep]
        symbols[at] = made + rule
        gone = np.ones(len(symbols), bool)
        gone[at + 1] = False
        symbols, last = symbols[gone], np.r_[last[:-1][gone], last[-1]]
        pair = np.stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
        rules.append(pair)
        lengths = np.r_[lengths, lengths[pair[:, 0]] + lengths[pair[:, 1]]]
        made += len(chosen)
    rule_table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    return rule_table, lengths[terminals:], symbols, np.r_[np.flatnonzero(last[:-1]), len(symbols)].astype(np.uint32)


def pack_shard(doc_ids: list, ids: list[bytes], terminals: int, **limits) -> bytes:
    flat_ids = np.frombuffer(b"".join(ids), "<u4")
    starts = np.cumsum([0, *(len(x) // 4 for x in ids[:-1])]).astype(np.int64)
    rules, lengths, symbols, first = compress(flat_ids, starts, terminals, **limits)
    width = 2 if terminals + len(rules) <= 1 << 16 else 4
    head = MAGIC + struct.pack("<5I", len(ids), len(rules), len(symbols), terminals, width)
    null = bytes(x is None for x in doc_ids)
    known = np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes()
    arrays = (rules, lengths, known, null, first, symbols.astype(f"<u{width}").tobytes())
    return head + b"".join(a if isinstance(a, bytes) else a.astype("<u4").tobytes() for a in arrays)


class Shard:
    """A shard's body, parsed; nothing is expanded until it is asked for."""

    def __init__(self, body: bytes):
        if body[:4] != MAGIC:
            raise ValueError("not a token shard")
        documents, rules, symbols, self.terminals, width = struct.unpack_from("<5I", body, 4)
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(body, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = take("<u4", rules)
        ids, null = take("<i8", documents), take("u1", documents)
        self.doc_ids = [None if n else int(i) for i, n in zip(ids, null, strict=True)]
        self.first = take("<u4", documents + 1)
        self.symbols = take(f"<u{width}", symbols)

    def length_of(self, symbols: np.ndarray) -> np.ndarray:
        return self._sizes[symbols]

    @cached_property
    def _sizes(self) -> np.ndarray:
        return np.r_[np.ones(self.terminals, np.int64), self.lengths]

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """All symbols' expansions one after the other, and where each begins."""
        begin = np.r_[0, np.cumsum(self._sizes)[:-1]]
        flat = np.empty(int(self._sizes.sum()), np.uint32)
        flat[: self.terminals] = np.arange(self.terminals)
        for k, (left, right) in enumerate(self.rules.tolist(), self.terminals):
            at, half = begin[k], self._sizes[left]
            flat[at : at + half] = flat[begin[left] : begin[left] + half]
            flat[at + half : at + self._sizes[k]] = flat[begin[right] : begin[right] + self._sizes[right]]
        return flat, begin

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that the symbols stand for."""
        flat, begin = self._table
        sizes = self._sizes[symbols]
        shift = begin[symbols] - np.r_[0, np.cumsum(sizes)[:-1]] if len(symbols) else sizes
        return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

    def document(self, k: int) -> np.ndarray:
        symbols = self.symbols[self.first[k] : self.first[k + 1]]
        return self._walk(symbols, 0, int(self.length_of(symbols).sum()))

    def token_range(self, k: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of document k; expands only the symbols that overlap them, and of their rules only those."""
        symbols = self.symbols[self.first[k] : self.first[k + 1]]
        ends = np.cumsum(self.length_of(symbols))
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return self._walk(symbols[a:b], start - before, stop - before)

    def _walk(self, symbols: np.ndarray, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of what the symbols stand for: down the rules, passing over those whose length ends before start."""
        out, waiting, at = [], symbols[::-1].tolist(), 0
        while waiting and at < stop:
            symbol = waiting.pop()
            if at + (size := int(self._sizes[symbol])) <= start:
                at += size
            elif symbol < self.terminals:
                out.append(symbol)
                at += 1
            else:
                waiting += self.rules[symbol - self.terminals, ::-1].tolist()
        return np.array(out, np.uint32)


def write_token_files(documents: DataFrame, path: str, vocabulary: str, end_id: int = END_ID, shard_tokens: int = 1 << 20) -> None:
    """Encode, order by document id, compress and store. The text is shuffled once, by ranges of the order."""
    width = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = documents.select("doc_id", "text", width.alias("tie"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "tie"
    )
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder.of(vocabulary, KEPT_PARTS)
        terminals = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        end = np.array([end_id], "<u4").tobytes()
        ids, docs, size, number, part = [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            body = pack_shard(docs, ids, terminals)
            values = ([part], [number], [docs[0]], [size], [len(docs)], [body])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            names = ("part", "within", "first_id", "tokens", "documents", "body")
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], list(names))

        for batch in sliced(batches, "text"):
            part = batch.column("part")[0].as_py()
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got = encoder.encode(text) + end
                docs.append(doc)
                ids.append(got)
                size += len(got) // 4
                if size >= shard_tokens:
                    yield close()
                    ids, docs, size, number = [], [], 0, number + 1
        if docs:
            yield close()
        encoder.rest()

    ordered.mapInArrow(shards, SHARD_SCHEMA).write.parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32, compressed symbols."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    # the ids before each shard: those of earlier partitions, one narrow row each, and those before it in its own
    sizes = shards.select("part", "within", "tokens")
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("earlier"))
    inside = F.sum("tokens").over(Window.partitionBy("part").orderBy("within")) - F.col("tokens")
    starts = sizes.withColumn("inside", inside).join(parts, "part")
    starts = starts.select("part", "within", (F.col("earlier") + F.col("inside")).alias("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard = Shard(batch.column("body")[k].as_py())
                lengths = shard.length_of(shard.symbols)
                whole = shard.expand(shard.symbols).astype("<u4", copy=False)
                ends = np.r_[0, np.cumsum(lengths)][shard.first].astype(np.int64)
                crc = [zlib.crc32(whole[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                arrays = [np.full(len(crc), batch.column(c)[k].as_py(), np.int32) for c in ("part", "within")]
                arrays += [pa.array(shard.doc_ids, pa.int64()), ends[:-1], np.diff(ends), np.array(crc, np.int64)]
                arrays.append(np.diff(shard.first.astype(np.int64)))
                names = ["part", "within", "doc_id", "local", "n_tokens", "ids_crc32", "n_symbols"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names)

    schema = "part int, within int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint, n_symbols bigint"
    decoded = shards.select("part", "within", "body").mapInArrow(decode, schema).join(starts, ["part", "within"])
    return decoded.select("doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")


def op3_token_files(spark, folder: str) -> DataFrame:
    """All documents, encoded, written in the shared folder, and read back."""
    import public_tokenizers

    path = new_folder(spark, "token-files")
    write_token_files(spark.read.parquet(f"{folder}/documents.parquet"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)
