"""Bounded-space online packing of token sequences.

Every partition keeps at most ``windows`` open windows. A document is cut into full windows, which are emitted at once,
and a rest. The rest goes to the open window that it fills best. If none has room, a new window is opened; if all are
open already, the fullest one is filled with the front of the rest (unless the gap is under ``least_cut``) and emitted.
What is left open when a partition ends is merged afterwards: windows of up to ``fan_in`` partitions are packed together,
whole, best fit first, and the emptiest go on to the next round, until one group is left.

No text is shuffled; only narrow rows of open windows move. The work of a partition is stored once in the shared folder,
so the merge reads it from there and a lost executor repeats only its own partition.

Defined results: a null or empty text is its end id alone; repeated rows and rows with null ids are packed like any
other; an empty table gives no piece; a text of any length is cut. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockloom.llm.text_batches import sliced
from stockloom.llm.tokens import TextEncoder
from stockloom.session import materialize

SIZE, END_ID = 1024, 0
#: Sequence ids: closed windows of a partition count from part << 32; merged ones have the bit MERGED set.
MERGED = 1 << 62
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_NAMES = [c.split()[0] for c in PIECE.split(", ")] + ["part", "open"]
_KINDS = [pa.int64()] * 7 + [pa.int32(), pa.bool_()]


class Packer:
    """The open windows of one partition. Emitted pieces are (doc, start, length, crc, doc_tokens, sequence, offset)."""

    def __init__(self, part: int, size: int, windows: int, least_cut: int):
        self.size, self.windows, self.least_cut = size, windows, least_cut
        self.next_id, self.out = part << 32, []
        self.gaps: list[tuple[int, int]] = []  # (free, window), sorted
        self.held: dict[int, list[tuple]] = {}

    def _open(self) -> int:
        self.next_id += 1
        self.held[self.next_id] = []
        return self.next_id

    def _put(self, window: int, free: int, piece: tuple) -> None:
        self.held[window].append((*piece, window, self.size - free))
        if free == piece[2]:
            self.out += self.held.pop(window)
        else:
            insort(self.gaps, (free - piece[2], window))

    def add(self, doc, ids: bytes) -> None:
        total, at = len(ids) // 4, 0

        def piece(length: int) -> tuple:
            nonlocal at
            made = (doc, at, length, zlib.crc32(ids[4 * at : 4 * (at + length)]), total)
            at += length
            return made

        while total - at >= self.size:
            self._put(self._open(), self.size, piece(self.size))
        if at == total:
            return
        k = bisect_left(self.gaps, (total - at, 0))
        if k == len(self.gaps) and len(self.gaps) >= self.windows:
            free, window = self.gaps.pop(0)
            if free >= self.least_cut:
                self._put(window, free, piece(free))
            else:
                self.out += self.held.pop(window)
            k = bisect_left(self.gaps, (total - at, 0))
        free, window = self.gaps.pop(k) if k < len(self.gaps) else (self.size, self._open())
        self._put(window, free, piece(total - at))


def best_fit(used: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, largest items first, each into the fullest bin that has room."""
    bins, offsets = np.zeros(len(used), np.int64), np.zeros(len(used), np.int64)
    gaps: list[tuple[int, int]] = []
    opened = 0
    for i in np.argsort(-used, kind="stable"):
        k = bisect_left(gaps, (int(used[i]), -1))
        free, b = gaps.pop(k) if k < len(gaps) else (size, opened)
        opened += free == size
        bins[i], offsets[i] = b, size - free
        insort(gaps, (free - int(used[i]), int(b)))
    return bins, offsets


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    size: int = SIZE,
    end_id: int = END_ID,
    windows: int = 64,
    least_cut: int = 32,
    fan_in: int = 64,
    kept_parts: int | None = None,
) -> DataFrame:
    """One row per piece, as in :data:`PIECE`. ``kept_parts`` is for :meth:`~stockloom.llm.tokens.TextEncoder.rest`."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, packer, part = TextEncoder.of(vocabulary), np.array([end_id], "<u4").tobytes(), None, 0

        def rows(pieces: list[tuple], is_open: bool) -> pa.RecordBatch:
            columns = list(zip(*pieces, strict=True)) if pieces else [[]] * 7
            columns += [[part] * len(pieces), [is_open] * len(pieces)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)

        for batch in sliced(batches, "text"):
            part = batch.column("part")[0].as_py()
            packer = packer or Packer(part, size, windows, least_cut)
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                packer.add(doc, encoder.encode(text) + end)
            yield rows(packer.out, False)
            packer.out = []
        if packer:
            yield rows([p for pieces in packer.held.values() for p in pieces], True)
        encoder.rest(kept_parts)

    source = documents.select("doc_id", "text", F.spark_partition_id().alias("part"))
    pieces = materialize(source.mapInArrow(pack, f"{PIECE}, part int, open boolean"))
    placed = merge_open(pieces, size, windows, fan_in)
    closed = pieces.where(~F.col("open")).drop("part", "open")
    moved = pieces.where("open").join(placed, "sequence_id")
    moved = moved.withColumn("offset", F.col("offset") + F.col("shift")).withColumn("sequence_id", F.col("target"))
    return closed.unionByName(moved.select(*closed.columns))


def _merger(size: int, windows: int, last: bool, stamp: int):
    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("bin", ignore_index=True)
        bins, offsets = best_fit(frame["used"].to_numpy(), size)
        total = np.bincount(bins, frame["used"]).astype(np.int64)
        carried = np.zeros(len(total), bool)
        if not last:
            carried[np.argsort(total, kind="stable")[:windows]] = True
        target = stamp + (int(frame["group"].iloc[0]) << 24) + bins
        out = {"bin": frame["bin"], "target": target, "at": offsets, "total": total[bins], "carried": carried[bins]}
        return pd.DataFrame(out)

    return merge


def merge_open(pieces: DataFrame, size: int, windows: int, fan_in: int) -> DataFrame:
    """sequence_id of each open window -> target and shift, by rounds over ever larger groups of partitions."""
    state = pieces.where("open").groupBy("sequence_id").agg(F.sum("length").alias("used"), F.first("part").alias("group"))
    state = state.select("sequence_id", "used", F.col("group").cast("bigint"), F.lit(0).cast("bigint").alias("shift"))
    state = state.select("*", F.col("sequence_id").alias("bin"))
    groups, level, done = 1 + (pieces.agg(F.max("part")).first()[0] or 0), 0, []
    schema = "bin bigint, target bigint, at bigint, total bigint, carried boolean"
    while True:
        groups, level = -(-groups // fan_in), level + 1
        last = groups == 1
        state = state.withColumn("group", F.floor(F.col("group") / fan_in).cast("bigint"))
        items = state.select("bin", "used", "group").distinct()
        moves = materialize(items.groupBy("group").applyInPandas(_merger(size, windows, last, MERGED + (level << 56)), schema))
        state = state.join(moves, "bin").withColumn("shift", F.col("shift") + F.col("at"))
        done.append(state.where(~F.col("carried")).select("sequence_id", "target", "shift"))
        if last:
            break
        state = state.where("carried").select("sequence_id", F.col("total").alias("used"), "group", "shift", F.col("target").alias("bin"))
        state = materialize(state)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def padded_length(used: Column) -> Column:
    """What a sequence takes once padded: a power of two stays, all else becomes a whole window."""
    return F.when(used.bitwiseAND(used - 1) == 0, used).otherwise(F.lit(SIZE))


def op8_packing(spark, folder: str) -> DataFrame:
    """All documents, packed."""
    import public_tokenizers

    documents = spark.read.parquet(f"{folder}/documents.parquet")
    return pack_documents(documents, public_tokenizers.path("byte_bpe_50k.json"))
