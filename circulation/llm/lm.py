"""Deleted interpolation: n-gram maximum-likelihood estimates mixed by context-frequency buckets.

Training documents are split into a counting part and a held-out part. The weights of each bucket of
context frequency are learned by expectation-maximisation on the held-out part's events against the
counting part's estimates; scores then use the counts of all training documents.

No table of n-grams is joined token by token. Tasks gather whole documents into chunks of bounded
bytes and send each chunk's distinct n-grams (64-bit hashes), with the chunk's own counts, as sorted
arrays to key-range buckets. A bucket sums the counts and answers every chunk with the totals in the
chunk's key order, and the chunk's documents are scored beside the answers. A frequent word is one key
per chunk, however often it occurs. Shuffled bytes follow the corpus, and so does the number of
buckets, taken from the texts' bytes: the one bucket a task holds at a time stays of one size, but for 16
bytes a chunk of each of its frequent keys. Nothing but the bucketed histogram of held-out events
(bounded by its quantisation) and the weights reach the driver.

Chunks are cut alike each time the table is scanned; answers whose number or checksum does not fit a
chunk's keys fail the job. ``docs`` must therefore be a table read from files (or written first).

Defined results: a null or empty text is the end token alone; a null id falls into the fold of the empty
id text; without training documents every token has probability 1; repeated rows each count and each get
a row; an empty table gives no rows. Only the id and text columns are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import bound_memory, shuffle_partitions, written
from circulation.llm.minhash import word_hashes, words

ORDER = 3
FOLDS, TEST_FOLD, HELD_FOLD = 5, 1, 0
CHUNK_BYTES = 6 << 20
# Requests take up to some 4 bytes a byte of text and order. A task holds one bucket of them, and reads its
# buckets one after another.
REQUEST_RATIO = 4
BUCKET_BYTES, TASK_BYTES, MOST_TASKS = 32 << 20, 64 << 20, 100_000
STEPS_PER_OCTAVE = 8
EM_ROUNDS = 60

_END = np.uint64(0xE4D0E4D0E4D0E4D1)
_START = np.uint64(0x57A7757A7757A771)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def fold_of(doc_id: str = "doc_id"):
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(FOLDS)).cast("int")


# --- chunks ----------------------------------------------------------------------------------

CHUNKED = "chunk long, doc_id long, fold int, text string"


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Deal (doc_id, fold, text) rows to chunks: held-out documents to chunks of their own."""
    part = TaskContext.get().partitionId()
    held, ordinal = [0, 0], [0, 0]
    for b in batches:
        texts = b.column(2).fill_null("")
        sizes = pc.binary_length(texts).to_pylist()
        chunks = []
        for fold, n in zip(b.column(1).to_pylist(), sizes):
            g = int(fold == HELD_FOLD)
            if held[g] and held[g] + n > CHUNK_BYTES:
                held[g], ordinal[g] = 0, ordinal[g] + 1
            held[g] += n + 1
            chunks.append((part << 24 | ordinal[g]) << 1 | g)
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), b.column(0), b.column(1), texts],
                                         names=["chunk", "doc_id", "fold", "text"])


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    bound_memory(docs.sparkSession)
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")
                       ).select("doc_id", fold_of().alias("fold"), "text")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _M2
    return h ^ (h >> np.uint64(29))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then the end, and the number of each text."""
    flat, ends = words(texts)
    return np.insert(word_hashes(flat), ends[1:], _END), np.diff(ends) + 1


def grams(flat: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For 1 .. order the key of the n-gram that ends at each token; starts are padded."""
    firsts = np.cumsum(lengths) - lengths
    place = np.arange(len(flat)) - np.repeat(firsts, lengths)
    keys = [_mixed(flat * _M1 + np.uint64(1))]
    past = flat
    for k in range(2, order + 1):
        past = np.concatenate([[_START], past[:-1]]) if len(past) else past
        past = np.where(place >= k - 1, past, _START)
        keys.append(_mixed(keys[-1] * _M1 + past + np.uint64(k)))
    return keys


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``np.unique`` with the inverse, sorting high bits and places together where that tells keys apart."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[order]
    if (ordered[1:] < ordered[:-1]).any():
        order = np.argsort(keys)
        ordered = keys[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    inverse = np.empty(len(keys), np.int64)
    inverse[order] = np.cumsum(first) - 1
    return ordered[first], inverse


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers as their first bytes, then their second ones, and so on: high bytes of small numbers compress away."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()


def _numbers(planes: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted distinct keys as planes of their steps."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _keys(packed: bytes) -> np.ndarray:
    return np.cumsum(_numbers(packed, "<u8"), dtype=np.uint64)


def _bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where in sorted keys each of the buckets, equal ranges of keys, begins; and the end."""
    bucket = ((keys >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


_REQUEST = pa.schema([("chunk", pa.int64()), ("level", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()),
                      ("n", pa.binary())])


def _chunk_requests(chunk: int, parts: list, order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    flat, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    folds = np.concatenate([p[2] for p in parts])
    weight = np.repeat(folds != TEST_FOLD, lengths)
    rows = []
    for level, keys in enumerate(grams(flat, lengths, order), 1):
        distinct, inverse = _distinct(keys)
        n = np.bincount(inverse, weights=weight, minlength=len(distinct)).astype("<u4")
        edges = _bucket_edges(distinct, buckets)
        for b in np.flatnonzero(np.diff(edges)).tolist():
            s = slice(edges[b], edges[b + 1])
            rows.append((chunk, level, b, _packed_keys(distinct[s]), _planes(n[s])))
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _REQUEST.types)], schema=_REQUEST)


def _requests(source: DataFrame, order: int, buckets: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, tuple[int, list]] = {}
        for b in _assign(batches):
            flat, lengths = tokens(b.column(3))
            chunks, folds = b.column(0).to_numpy(), b.column(2).to_numpy()
            for c in np.unique(chunks).tolist():
                mine = chunks == c
                g = c & 1
                if g in open_ and open_[g][0] != c:
                    yield from _chunk_requests(*open_.pop(g), order, buckets)
                    pa.default_memory_pool().release_unused()
                open_.setdefault(g, (c, []))[1].append((flat[np.repeat(mine, lengths)], lengths[mine], folds[mine]))
        for c, parts in open_.values():
            yield from _chunk_requests(c, parts, order, buckets)

    return source.mapInArrow(ask, "chunk long, level int, bucket int, keys binary, n binary")


ANSWER = ("chunk long, level int, bucket int, counted binary, total binary, wide boolean, checksum long, "
          "sum_counted long, sum_held long, seen_counted long, seen long")


def _checksum(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys).astype(np.int64)) if len(keys) else 0


def _answers(requests: DataFrame, tasks: int) -> DataFrame:
    """Totals for every request, and of the counting part alone for held-out chunks (odd), which learn the
    weights; numbers of 32 bits, or of 64 (``wide``) if need be; and a checksum of the request's keys. For
    every bucket one row of sums with chunk -1."""
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.bool_(), *[pa.int64()] * 5]
    names = [x.split()[0] for x in ANSWER.split(", ")]

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def summed(level: int, bucket: int, rows: list) -> Iterator[pa.RecordBatch]:
        keys = [_keys(r[3]) for r in rows]
        distinct, inverse = _distinct(np.concatenate(keys))
        n = np.concatenate([_numbers(r[4], "<u4") for r in rows])
        odd = np.repeat([r[0] & 1 for r in rows], [len(k) for k in keys])  # held-out documents
        counted, held = (np.bincount(inverse, weights=n * (odd == x), minlength=len(distinct)).astype(np.int64) for x in (0, 1))
        total = counted + held
        yield batch([(-1, level, bucket, None, None, None, None, int(counted.sum()), int(held.sum()), int((counted > 0).sum()),
                      int((total > 0).sum()))])
        wide = bool(total.max(initial=0) >= 1 << 32)
        kind = "<u8" if wide else "<u4"
        counted, total = counted.astype(kind), total.astype(kind)
        at, out, size = 0, [], 0
        for r, k in zip(rows, keys):
            mine = inverse[at:at + len(k)]
            at += len(k)
            out.append((r[0], level, bucket, _planes(counted[mine]) if r[0] & 1 else None, _planes(total[mine]), wide,
                        _checksum(k), None, None, None, None))
            size += 8 * len(k)
            if size > 8 << 20:
                yield batch(out)
                out, size = [], 0
        if out:
            yield batch(out)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if now is not None and row[1:3] != now:
                    yield from summed(*now, rows)
                    rows = []
                now = row[1:3]
                rows.append(row)
        if rows:
            yield from summed(*now, rows)

    dealt = requests.repartition(tasks, "level", "bucket")
    return dealt.sortWithinPartitions("level", "bucket").mapInArrow(answer, ANSWER)


# --- a chunk beside its answers --------------------------------------------------------------

def _counts(texts: pa.Table, answers: pa.Table, order: int, n_docs: int):
    """Of a chunk's tokens: lengths of the texts, counts of each n-gram and of its context, by order."""
    flat, lengths = tokens(texts["text"].combine_chunks())
    rows = sorted(zip(*(answers[c].to_pylist() for c in ("level", "bucket", "n", "wide", "checksum"))), key=lambda r: r[:2])
    by_level: dict[int, list[np.ndarray]] = {}
    checksums: dict[int, int] = {}
    for level, _, n, wide, checksum in rows:
        by_level.setdefault(level, []).append(_numbers(n, "<u8" if wide else "<u4"))
        checksums[level] = checksums.get(level, 0) ^ checksum
    firsts = np.cumsum(lengths) - lengths
    before = np.full(len(flat), float(n_docs))  # the padded context: as often as there are documents
    found = []
    for level, keys in enumerate(grams(flat, lengths, order), 1):
        distinct, inverse = _distinct(keys)
        totals = np.concatenate(by_level.get(level, [np.zeros(0)]))
        if len(totals) != len(distinct) or checksums.get(level, 0) != _checksum(distinct):
            raise RuntimeError("the answers do not fit the chunk: the input was not scanned alike twice")
        c = totals[inverse].astype(np.float64)
        found.append((c, before))
        start = before[firsts[0]] if len(firsts) else 0.0
        before = np.concatenate([[start], c[:-1]])
        before[firsts] = start
    return lengths, found


def _estimates(found: list, n_tokens: float) -> tuple[np.ndarray, np.ndarray]:
    """The maximum-likelihood estimates (rows: orders 1, 2, ...) and the bucket of the longest context."""
    probs = [found[0][0] / max(n_tokens, 1.0)]
    probs += [np.divide(c, ctx, out=np.zeros_like(c), where=ctx > 0) for c, ctx in found[1:]]
    context = found[-1][1] if len(found) > 1 else np.zeros_like(found[0][0])
    return np.array(probs), np.floor(np.log2(context + 1)).astype(np.int64)


def _quantised(p: np.ndarray, octave: int) -> np.ndarray:
    """Steps of log2, ``octave`` to one, -1 for a probability of 0."""
    return np.where(p > 0, np.round(-octave * np.log2(np.where(p > 0, p, 1.0))), -1).astype(np.int64)


def _beside(source: DataFrame, answers: DataFrame, fn, schema: str) -> DataFrame:
    return source.mapInArrow(_assign, CHUNKED).groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(fn, schema)


def held_out_events(source: DataFrame, answers: DataFrame, order: int, n_tokens: int, n_docs: int,
                    octave: int = STEPS_PER_OCTAVE) -> DataFrame:
    """(bucket, steps, n): how many held-out tokens have that context bucket and those estimates."""
    schema = pa.schema([("bucket", pa.int32()), ("steps", pa.list_(pa.int16())), ("n", pa.int64())])

    def events(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return schema.empty_table()
        _, found = _counts(texts, replies, order, n_docs)
        probs, bucket = _estimates(found, n_tokens)
        rows, n = np.unique(np.column_stack([bucket, _quantised(probs, octave).T]), axis=0, return_counts=True)
        steps = pa.ListArray.from_arrays(pa.array(np.arange(0, rows[:, 1:].size + 1, order, dtype=np.int32)),
                                         pa.array(rows[:, 1:].ravel(), pa.int16()))
        return pa.table([pa.array(rows[:, 0], pa.int32()), steps, pa.array(n, pa.int64())], schema=schema)

    mine = source.where(F.col("fold") == HELD_FOLD)
    # Odd chunks hold the held-out documents.
    asked = answers.where("chunk % 2 = 1 AND chunk >= 0").select(
        "chunk", "level", "bucket", F.col("counted").alias("n"), "wide", "checksum")
    return _beside(mine, asked, events, "bucket int, steps array<smallint>, n long").groupBy("bucket", "steps").agg(F.sum("n").alias("n"))


def learn_weights(events: list[tuple[int, list[int], int]], order: int, uniform: float) -> dict[int, np.ndarray]:
    """``weights_of`` for events as rows."""
    bucket, steps, n = zip(*events) if events else ((), (), ())
    return weights_of(np.array(bucket, np.int64), np.array(steps, np.int64).reshape(-1, order), np.array(n), uniform)


def weights_of(bucket: np.ndarray, steps: np.ndarray, n: np.ndarray, uniform: float,
               octave: int = STEPS_PER_OCTAVE) -> dict[int, np.ndarray]:
    """Weights (uniform, order 1, 2, ...) of each bucket, and of all together under -1, by expectation-maximisation.

    Each bucket starts from, and is held by ten events to, the weights of all buckets together."""
    def run(mine: np.ndarray | slice, prior: np.ndarray, strength: float) -> np.ndarray:
        at, counts, w = steps[mine], n[mine].astype(np.float64), prior
        probs = np.column_stack([np.full(len(at), uniform), np.where(at < 0, 0.0, 2.0 ** (-at / octave))])
        for _ in range(EM_ROUNDS):
            # Each event's share falls to the components as their weighted probabilities.
            w = w * (probs.T @ (counts / (probs @ w))) + prior * strength
            w = w / w.sum()
        return w

    order = steps.shape[1]
    even = np.full(order + 1, 1.0 / (order + 1))
    weights = {-1: run(slice(None), even, 1.0) if len(n) else even}
    for b in np.unique(bucket).tolist():
        weights[b] = run(bucket == b, weights[-1], 10.0)
    return weights


SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def interpolated_scores(docs: DataFrame, order: int = ORDER, doc_id: str = "doc_id", text: str = "text",
                        octave: int = STEPS_PER_OCTAVE) -> DataFrame:
    """Per row of ``docs`` its fold, known tokens, the unigram base score and the mixture's log10 probability.

    Documents of fold 1 of 5 (CRC-32 of the id) teach the model nothing. The weights are learned from estimates
    rounded to ``octave`` steps an octave; fewer steps bound what the driver gets more tightly: at most
    (40 * octave) ** order cells a context bucket, of which those that occur are sent."""
    spark = docs.sparkSession
    source = _source(docs, doc_id, text)
    trains, counts = F.col("fold") != TEST_FOLD, ~F.col("fold").isin(TEST_FOLD, HELD_FOLD)
    size, docs_counted, docs_all = (int(x or 0) for x in source.agg(
        F.sum(F.octet_length("text")), F.count_if(counts), F.count_if(trains)).first())
    asked_bytes = REQUEST_RATIO * size
    buckets = min(1 << 24, max(shuffle_partitions(spark), asked_bytes // BUCKET_BYTES))
    tasks = max(shuffle_partitions(spark), min(MOST_TASKS, order * asked_bytes // TASK_BYTES))
    answers = written(_answers(_requests(source, order, buckets), tasks), "lm-answers")
    # One row per bucket and order, of numbers only, summed to one.
    sums = answers.where("chunk = -1 AND level = 1").agg(*[F.sum(c) for c in ("sum_counted", "sum_held", "seen_counted", "seen")])
    counted, held, seen_counted, seen = (int(x or 0) for x in sums.first())
    events = held_out_events(source, answers, order, counted, docs_counted, octave).toArrow().combine_chunks()
    steps = pc.list_flatten(events["steps"]).to_numpy().reshape(-1, order)
    weights = weights_of(events["bucket"].to_numpy(), steps, events["n"].to_numpy(), 1.0 / (seen_counted + 1), octave)
    top = max(weights)
    table = np.array([weights.get(b, weights[-1]) for b in range(max(top, 0) + 1)] + [weights[-1]])
    n_all, v_all = float(counted + held), float(seen)
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return out.empty_table()
        lengths, found = _counts(texts, replies, order, docs_all)
        probs, bucket = _estimates(found, n_all)
        w = table[np.minimum(bucket, len(table) - 1)]
        p = w[:, 0] / (v_all + 1) + (w[:, 1:] * probs.T).sum(axis=1) if n_all else np.ones(len(bucket))
        c = found[0][0]
        base = np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1)))
        firsts = np.cumsum(lengths) - lengths
        total = lambda x: pa.array(np.add.reduceat(x, firsts))
        return pa.table([texts["doc_id"], pa.array(texts["fold"].to_numpy() == TEST_FOLD), pa.array(lengths),
                         total((c > 0).astype(np.int64)), pa.array(np.full(len(lengths), int(n_all))), total(base),
                         total(np.log10(p))], schema=out)

    asked = answers.where("chunk >= 0").select("chunk", "level", "bucket", F.col("total").alias("n"), "wide", "checksum")
    return _beside(source, asked, score, SCORES)
