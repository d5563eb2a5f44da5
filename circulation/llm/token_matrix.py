"""Packed token-id matrices: best-fit-decreasing with a segment tree over free capacities.

Each task cuts its documents into pieces of at most ``capacity`` tokens (nothing is lost), gathers
a block of them (bounded by tokens, not by the data), packs the block by falling length and emits
one row per packed sequence: the padded id row, the cumulative segment lengths, the positions that
restart at every segment, and the documents and starts of the segments. Blocks follow the input's
partitions, so the job needs no shuffle; each block wastes at most its last sequences.

Defined results: a null or empty text is one segment of the end token alone; an empty table writes
an empty table; repeated rows are packed once each; ties in length keep the order of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.llm.common import bound_memory
from circulation.llm.packing import CAPACITY, cuts
from circulation.llm.tokens import END_ID, encoder, vocabulary_path
from circulation.session import scratch_path

# Tokens packed together by one task: 16 MB of ids.
BLOCK_TOKENS = 4 << 20
PAD_ID = 0

PACKED = T.StructType([
    T.StructField("matrix", T.LongType()),  # the block: its rows make up one id matrix
    T.StructField("row", T.IntegerType()),
    T.StructField("n_tokens", T.IntegerType()),
    T.StructField("ids", T.BinaryType()),  # capacity little-endian uint32, padded
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),  # 0, then the end of every segment
    T.StructField("positions", T.BinaryType()),  # capacity little-endian uint16, 0 at every segment's start
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType())),  # of every segment in its document's ids
])


class FreeSpace:
    """Bins by free capacity under a segment tree: the smallest gap that fits, in log(capacity) steps."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, gap: int, bin_id: int) -> None:
        self.bins[gap].append(bin_id)
        at = gap + self.width
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (gap, bin) of the smallest gap of at least ``need``; None if none fits."""
        at = need + self.width
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.width:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        gap = at - self.width
        bin_id = self.bins[gap].pop()
        while at:
            self.count[at] -= 1
            at >>= 1
        return gap, bin_id


def pack_block(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: for every bin the places of its pieces in ``lengths``."""
    space, bins = FreeSpace(capacity), []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = space.take(lengths[i])
        gap, b = found if found else (capacity, len(bins))
        if not found:
            bins.append([])
        bins[b].append(i)
        if gap > lengths[i]:
            space.add(gap - lengths[i], b)
    return bins


def pack_matrices(docs: DataFrame, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY,
                  vocabulary: str | None = None, end_id: int = END_ID, pad_id: int = PAD_ID,
                  block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per packed sequence of every whole text, as ``PACKED`` says. capacity: at most 65,535."""
    if not 0 < capacity < 1 << 16:
        raise ValueError("positions are stored in 16 bits: capacity must lie in 1 .. 65535")
    bound_memory(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, block = encoder(path), TaskContext.get().partitionId(), 0
        pieces: list[tuple[int, int, bytes]] = []
        held = 0
        for b in batches:
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode(t.as_py() or "") + end
                for start, n in cuts(len(ids) // 4, capacity):
                    pieces.append((key, start, ids[4 * start:4 * (start + n)]))
                    held += n
                    if held >= block_tokens:
                        yield from _rows(pieces, (part << 32) + block, capacity, pad_id)
                        pieces, held, block = [], 0, block + 1
        if pieces:
            yield from _rows(pieces, (part << 32) + block, capacity, pad_id)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(pack, PACKED)


def _rows(pieces: list[tuple[int, int, bytes]], matrix: int, capacity: int, pad_id: int) -> Iterator[pa.RecordBatch]:
    bins = pack_block([len(p[2]) // 4 for p in pieces], capacity)
    pad = np.array([pad_id], "<u4").tobytes()
    counting = np.arange(capacity, dtype="<u2")
    for lo in range(0, len(bins), 512):
        out = []
        for row, members in enumerate(bins[lo:lo + 512], lo):
            ids = b"".join(pieces[i][2] for i in members)
            ends = np.cumsum([0] + [len(pieces[i][2]) // 4 for i in members])
            n = int(ends[-1])
            places = counting.copy()
            for a, z in zip(ends[:-1], ends[1:]):
                places[a:z] = counting[:z - a]
            places[n:] = 0
            out.append((matrix, row, n, ids + pad * (capacity - n), ends.tolist(), places.tobytes(),
                        [pieces[i][0] for i in members], [pieces[i][1] for i in members]))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(),
                 pa.list_(pa.int64()), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=PACKED.names)


def write_matrices(packed: DataFrame, path: str | None = None) -> str:
    """Write packed rows as Parquet under ``path`` (by default the shared scratch folder); the path."""
    path = path or scratch_path(packed.sparkSession, "matrices")
    packed.write.option("compression", "zstd").parquet(path)
    return path


def read_matrices(spark, path: str) -> DataFrame:
    return spark.read.schema(PACKED).parquet(path)


def segments(packed: DataFrame) -> DataFrame:
    """One row per segment: matrix, row, doc_id, start, length, offset, ids; the exact way back to the texts' ids."""
    at = F.posexplode("doc_ids").alias("k", "doc_id")
    offset, stop = F.col("cu_seqlens")[F.col("k")], F.col("cu_seqlens")[F.col("k") + 1]
    return packed.select("matrix", "row", "ids", "cu_seqlens", "starts", at).select(
        "matrix", "row", "doc_id", F.col("starts")[F.col("k")].alias("start"), (stop - offset).alias("length"),
        offset.alias("offset"), F.substring(F.col("ids"), offset * 4 + 1, (stop - offset) * 4).alias("ids"))
