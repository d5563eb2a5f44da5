"""Best-fit packing of token pieces into sequences of a fixed capacity, in bulk-synchronous sweeps.

Documents are cut into pieces of at most ``capacity`` tokens and range-sorted by length. Pieces
of one length are interchangeable, and so are sequences with one gap, so the sorted pieces and
gaps are held as runs (a length and how many, a gap and which sequences): at most ``capacity``
document runs, however many rows. A superstep sweeps a document run over the gap runs from its
length upwards (the successor search of best fit); the k-th piece of the run takes the k-th gap
(conflicts fall to rank), the gaps are updated, unmatched pieces open new sequences, and the next
superstep starts. Rows look up their run by their global rank on the executors.

Defined results: a null or empty text is one piece holding the end token alone; an empty table
gives no rows; repeated rows are packed once each; ties in length follow the order columns and
then the place in the input.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.llm.common import bound_memory, global_prefix, without
from circulation.llm.tokens import END_ID, encoder, vocabulary_path

CAPACITY = 1024
PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all of ``capacity`` tokens but the first."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)] if n else []


def token_pieces(docs: DataFrame, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY,
                 vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids (little-endian uint32)."""
    bound_memory(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            out: list[tuple] = []
            held = 0
            for key, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode(t.as_py() or "") + end
                for k, (start, n) in enumerate(cuts(len(ids) // 4, capacity)):
                    out.append((key, k, start, n, ids[4 * start:4 * (start + n)]))
                held += len(ids)
                if held > 8 << 20:
                    yield _pieces(out)
                    out, held = [], 0
            if out:
                yield _pieces(out)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES)


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=PIECES.names)


def sweep_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs of placements for ``counts`` pieces of each length, longest first.

    Row: first rank, first sequence, offset; the i-th piece from the first rank on goes to the
    i-th sequence from the first sequence on. Ranks number all pieces by falling length.
    """
    runs: list[tuple[int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences: (first, how many)
    sizes: list[int] = []  # the gaps that have runs, rising
    rank = opened = 0

    def give(gap: int, first: int, n: int) -> None:
        if gap > 0:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                # No gap is large enough: the rest open sequences, as few as they can share.
                n = -(-left // max(1, capacity // length)) if length else left
                give(capacity, opened, n)
                opened += n
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            take = min(n, left)
            runs.append((rank, first, capacity - gap))
            if take < n:
                give(gap, first + take, n - take)
            give(gap - length, first, take)
            rank += take
            left -= take
    return np.array(runs, dtype=np.int64).reshape(-1, 3)


def best_fit_pack(pieces: DataFrame, order: Sequence[str], length: str = "length",
                  capacity: int = CAPACITY) -> DataFrame:
    """All rows and columns of ``pieces`` with ``sequence_id`` and ``offset`` (gapless from 0).

    ``length`` must lie in 1 .. capacity; a length outside fails the job.
    """
    spark = pieces.sparkSession
    pieces = without(pieces, ["sequence_id", "offset"])
    # The row goes along as one value, so that no column of its can clash with those that are added on the way.
    slim = pieces.select(F.struct(*[pieces[f"`{c}`"] for c in pieces.columns]).alias("row"), F.col(f"`{length}`").cast("long").alias("length"),
                         *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)])
    keys = [F.col("length").desc(), *[F.col(f"k{i}").asc_nulls_first() for i in range(len(order))]]
    ranked = global_prefix(slim, keys, [], "packing").select("row", "length", "rank")
    # One row per length, so at most ``capacity`` rows.
    counted = ranked.groupBy(F.col("length").alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["l"]: r["n"] for r in counted}
    if any(c is None or not 0 < c <= capacity for c in counts):
        raise ValueError(f"piece lengths must lie in 1 .. {capacity}")
    plan = spark.sparkContext.broadcast(sweep_plan(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = plan.value
        for b in batches:
            r = b.column("rank").to_numpy()
            run = runs[np.searchsorted(runs[:, 0], r, side="right") - 1] if len(runs) else runs
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(run[:, 1] + r - run[:, 0]), pa.array(run[:, 2])],
                                             names=["row", "sequence_id", "offset"])

    schema = T.StructType([ranked.schema["row"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select("row", "rank").mapInArrow(place, schema).select("row.*", "sequence_id", "offset")
