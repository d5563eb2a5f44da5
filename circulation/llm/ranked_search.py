"""Exact ranked search of all documents for every item, by norm buckets of impact vectors (LEMP).

1. One pass over the texts keeps, of each document, its length in terms and the counts of those terms that
   occur in an item: a sparse vector. Global counts (documents, terms, documents a term) follow from it.
2. A document's coordinate at a term is the term's weight times its saturated count, an integer; its length
   is sqrt(sum weight * count part squared). Vectors are ordered by length over all partitions and cut into
   buckets of ``BUCKET``. With item coordinates sqrt(weight) the inner product is the score.
3. Every partition searches its first bucket alone. Each item's k-th best score there, over all partitions, is
   a score that at least k rows reach: its floor.
4. All buckets are searched. An item skips a bucket whose longest vector cannot reach its floor (Cauchy-
   Schwarz). In the bucket its terms are taken by falling bounds until the rest cannot reach the floor; rows without
   any of these are left out. For the others the part seen plus the bound of the rest (the lesser of the coordinates'
   maxima and Cauchy-Schwarz on what is left of both lengths) decides who survives. Survivors are scored in
   64-bit integers. The floor rises with what is found.
5. Each partition's best k are merged. Floors only rise to scores that k rows reach and a bound equal to
   the floor survives, so the result is exact, ties included.

Items are taken in blocks of ``BLOCK_BYTES`` of text, so that what every task holds of them is bounded.

Defined results: null and empty texts and items without a term give no rows; every item row is a query of its
own, also with a repeated id; repeated documents each have a rank; equal scores rank by ascending id,
null ids last; empty tables give no rows. Whole texts of any length are read. Only the id and text columns of
both tables are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from circulation.llm.common import global_prefix, shuffle_partitions, written

# Fixed values of the ranking: terms are runs of ASCII letters, digits and anything beyond ASCII.
SCALE, HALF, TF_FACTOR, M_FACTOR, M_BASE = 1_000_000_000, 50, 1000, 20, 50
BUCKET = 4096
BLOCK_BYTES = 8 << 20

_IS_TERM = [c >= 0x80 or chr(c).isalnum() for c in range(256)]
# One byte to one: A-Z lower-cased, all that separates terms to a blank. Bytes beyond ASCII stay.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c) if _IS_TERM[c] else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return text.translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass(frozen=True)
class Queries:
    """A block of items: the distinct terms, and per item the numbers of its terms."""

    items: list[tuple[int, int | None]]  # (place in the table, id)
    terms: list[list[int]]
    vocabulary: dict[bytes, int]


def _queries(rows: list[tuple[int, int | None, str | None]]) -> Queries:
    vocabulary: dict[bytes, int] = {}
    items, numbers = [], []
    for place, item, text in rows:
        found = dict.fromkeys(terms_of(text.encode() if text is not None else None))
        if found:
            items.append((place, item))
            numbers.append([vocabulary.setdefault(t, len(vocabulary)) for t in found])
    return Queries(items, numbers, vocabulary)


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with at least one term: n counts all their terms with repeats, the
    arrays hold those of the vocabulary. The vocabulary, of one block of items, is broadcast."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = known.value
        for b in batches:
            ids, keep, ns, terms, counts, ends = b.column(0), [], [], [], [], [0]
            for i, t in enumerate(b.column(1).cast(pa.binary())):
                words = terms_of(t.as_py())
                if words:
                    keep.append(i)
                    ns.append(len(words))
                    for w, c in Counter(words).items():
                        k = numbers.get(w)
                        if k is not None:
                            terms.append(k)
                            counts.append(c)
                    ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())), pa.array(ns, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    slim = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return slim.mapInArrow(read, "doc_id long, n long, terms array<int>, counts array<long>")


@dataclass(frozen=True)
class Collection:
    """Global counts: documents with a term, all their terms, and the weight of each vocabulary term."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


def _collection(vectors: DataFrame, size: int) -> Collection:
    n_docs, n_terms = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.full(size, weight(n_docs, 0) if n_docs else 0, np.int64)
    # One row per vocabulary term at most: bounded by a block of items.
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toLocalIterator():
        weights[r["t"]] = weight(n_docs, r["df"])
    return Collection(int(n_docs), int(n_terms), weights)


def _lengths(n: np.ndarray, c: Collection) -> np.ndarray:
    """Each document's m. Products beyond 64 bits are taken in Python's integers."""
    if len(n) and int(n.max()) * HALF * c.n_docs < 2**63:
        return M_BASE + (HALF * n * c.n_docs) // c.n_terms
    return np.array([M_BASE + (HALF * int(v) * c.n_docs) // c.n_terms for v in n], np.int64)


def _parts(b: pa.RecordBatch, c: Collection) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of vectors: row, term and the integer part (SCALE * tf) div (TF_FACTOR * tf + M_FACTOR * m)."""
    m = _lengths(b.column("n").to_numpy(), c)
    sizes = np.diff(b.column("terms").offsets.to_numpy())
    row = np.repeat(np.arange(b.num_rows), sizes)
    tf = b.column("counts").flatten().to_numpy()
    return row, b.column("terms").flatten().to_numpy(), (SCALE * tf) // (TF_FACTOR * tf + M_FACTOR * m[row])


def _ordered(vectors: DataFrame, c: Collection, label: str) -> DataFrame:
    """The vectors as (doc_id, length, terms, parts), longest first over all partitions, those of length 0 left out."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, term, part = _parts(b, c)
            # Rounded up, so that a length is never below the true one.
            square = np.bincount(row, weights=c.weights[term] * part.astype(np.float64) ** 2, minlength=b.num_rows)
            some = c.weights[term] > 0
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(row[some], minlength=b.num_rows))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.sqrt(square) * (1 + 1e-9)),
                 pa.ListArray.from_arrays(offsets, pa.array(term[some], pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(part[some], pa.int64()))], names=["doc_id", "length", "terms", "parts"])

    done = vectors.where("size(terms) > 0").mapInArrow(measure, "doc_id long, length double, terms array<int>, parts array<long>")
    # Copies have one length: their ids, and for repeated rows chance, deal them over the partitions.
    keys = [F.col("length").desc(), F.col("doc_id"), F.col("tie")]
    done = written(done.where("length > 0").withColumn("tie", F.monotonically_increasing_id()), label + "-measured")
    return written(done.repartitionByRange(shuffle_partitions(vectors.sparkSession), *keys).sortWithinPartitions(*keys).drop("tie"), label)


class _Search:
    """The items of a block against bucket after bucket: each item's floor and best k so far."""

    def __init__(self, terms: list[list[int]], weights: np.ndarray, k: int, floors: np.ndarray):
        self.terms = [np.array(t, np.int64)[weights[t] > 0] for t in terms]
        self.weights, self.k, self.floors = weights, k, floors.copy()
        self.norms = np.array([math.sqrt(float(weights[t].sum())) for t in self.terms])
        self.best: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in terms]
        self.held = np.zeros(len(terms), np.int64)

    def bucket(self, ids: np.ndarray, no_id: np.ndarray, length: np.ndarray, row: np.ndarray, term: np.ndarray, part: np.ndarray) -> None:
        order = np.argsort(term, kind="stable")
        row, term, gain = row[order], term[order], (self.weights[term] * part)[order]
        heads = np.flatnonzero(np.diff(term, prepend=-1))
        start = np.zeros(len(self.weights) + 1, np.int64)
        np.add.at(start, term + 1, 1)
        start = np.cumsum(start)
        most = np.zeros(len(self.weights), np.int64)
        if len(heads):
            most[term[heads]] = np.maximum.reduceat(gain, heads)
        square = gain.astype(np.float64) * part[order]
        reach = self.norms * length[0] * (1 + 1e-9)
        for q in np.flatnonzero(reach >= self.floors):
            self._item(int(q), ids, no_id, length, row, gain, square, start, most)

    def _item(self, q, ids, no_id, length, row, gain, square, start, most) -> None:
        terms = self.terms[q]
        terms = terms[most[terms] > 0]
        if not len(terms):
            return
        terms = terms[np.argsort(-most[terms], kind="stable")]
        floor = max(int(self.floors[q]), 1)
        bounds = most[terms]
        rest = bounds.sum() - np.cumsum(bounds)  # the coordinates' maxima after each term
        if int(bounds.sum()) < floor:
            return
        focus = int(np.argmax(rest < floor)) + 1
        at = np.concatenate([np.arange(start[t], start[t + 1]) for t in terms[:focus]])
        seen = np.bincount(row[at], weights=gain[at], minlength=len(ids))
        spent = np.bincount(row[at], weights=square[at], minlength=len(ids))
        some = np.flatnonzero(seen > 0)
        left = float(self.weights[terms[focus:]].sum())
        others = np.minimum(float(rest[focus - 1]), np.sqrt(left) * np.sqrt(np.maximum(length[some] ** 2 - spent[some], 0)) * (1 + 1e-9) + 1)
        some = some[seen[some] * (1 + 1e-9) + others + 1 >= floor]
        if not len(some):
            return
        # The exact score of the survivors: whole integers, all of the item's terms.
        place = np.full(len(ids), -1, np.int64)
        place[some] = np.arange(len(some))
        score = np.zeros(len(some), np.int64)
        for t in terms:
            where = place[row[start[t]:start[t + 1]]]
            score[where[where >= 0]] += gain[start[t]:start[t + 1]][where >= 0]  # a document holds a term once
        good = score >= floor
        self.best[q].append((score[good], no_id[some][good], ids[some][good]))
        self.held[q] += good.sum()
        if self.held[q] >= 4 * self.k or (self.floors[q] <= 1 and self.held[q] >= self.k):
            self._cut(q)

    def _cut(self, q: int) -> None:
        score, no_id, ids = (np.concatenate(x) for x in zip(*self.best[q]))
        top = np.lexsort((ids, no_id, -score))[:self.k]
        self.best[q] = [(score[top], no_id[top], ids[top])]
        self.held[q] = len(top)
        if len(top) == self.k:
            self.floors[q] = max(self.floors[q], score[top[-1]])

    def results(self) -> pa.RecordBatch:
        items, ids, none, scores = [np.empty(0, np.int32)], [np.empty(0, np.int64)], [np.empty(0, bool)], [np.empty(0, np.int64)]
        for q, found in enumerate(self.best):
            if found:
                self._cut(q)
                score, no_id, doc = self.best[q][0]
                items.append(np.full(len(doc), q, np.int32))
                ids.append(doc)
                none.append(no_id)
                scores.append(score)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(items)), pa.array(np.concatenate(ids), mask=np.concatenate(none)),
                                           pa.array(np.concatenate(scores))], names=["q", "doc_id", "score"])


def _search(ordered: DataFrame, queries: Queries, c: Collection, k: int, floors: np.ndarray, first_only: bool) -> DataFrame:
    """Each partition's best k of every item, (q, doc_id, score); of its first bucket alone if ``first_only``."""
    held = ordered.sparkSession.sparkContext.broadcast((queries.terms, c.weights, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, low = held.value
        search = _Search(terms, weights, k, low)
        for whole in batches:
            for at in range(0, whole.num_rows, BUCKET):
                b = whole.slice(at, BUCKET)
                sizes = np.diff(b.column("terms").offsets.to_numpy())
                ids = b.column("doc_id")
                length = b.column("length").to_numpy()
                down = np.argsort(-length, kind="stable")  # files of several partitions may follow each other
                back = np.empty_like(down)
                back[down] = np.arange(len(down))
                search.bucket(ids.fill_null(0).to_numpy()[down], ids.is_null().to_numpy(zero_copy_only=False)[down], length[down],
                              back[np.repeat(np.arange(b.num_rows), sizes)], b.column("terms").flatten().to_numpy(), b.column("parts").flatten().to_numpy())
                if first_only:
                    break
            if first_only:
                break
        yield search.results()

    return ordered.mapInArrow(run, "q int, doc_id long, score long")


def _search_block(docs: DataFrame, queries: Queries, k: int, doc_id: str, text: str) -> DataFrame:
    vectors = written(term_vectors(docs, queries.vocabulary, doc_id, text), "search-vectors")
    c = _collection(vectors, len(queries.vocabulary))
    ordered = _ordered(vectors, c, "search-ordered")
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    seeds = _search(ordered, queries, c, k, np.ones(len(queries.items), np.int64), True)
    floors = np.ones(len(queries.items), np.int64)
    for r in seeds.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).collect():  # one row an item
        floors[r["q"]] = r["score"]
    found = _search(ordered, queries, c, k, floors, False)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(i, item) for i, (_, item) in enumerate(queries.items)], "q int, item_id long")
    return ranked.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0, ranks from 1."""
    slim = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"),
                        F.coalesce(F.octet_length(F.col(f"`{item_text}`")), F.lit(0)).cast("long").alias("bytes"))
    placed = written(global_prefix(slim, [F.col("item_id")], ["bytes"], "search-items", rank="place"), "search-placed")
    placed = placed.withColumn("block", F.expr(f"bytes_before div {BLOCK_BYTES}"))
    blocks = sorted(r["block"] for r in placed.select("block").distinct().collect())  # one row per BLOCK_BYTES of items
    out = docs.sparkSession.createDataFrame([], T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in blocks:
        rows = placed.where(F.col("block") == block).orderBy("place").select("place", "item_id", "text").collect()
        queries = _queries([tuple(r) for r in rows])
        if queries.items:
            out = out.unionByName(_search_block(docs, queries, k, doc_id, text))
    return out
