"""Benchmark decontamination by latent semantic retrieval.

1. Documents become word ids of the benchmark's vocabulary (words that no item has match nothing).
   Items and documents are cut alike, at any white space; free-standing punctuation is no word.
   Passages are windows of ``WINDOW`` words, one every half window.
2. The passages' TF-IDF matrix is factored by a randomised SVD: each pass multiplies a thin matrix by
   A and A transposed, task by task; the sums over tasks, (terms x ``RANK`` + some) numbers, go to the driver.
   One such pass and the singular vectors of what it gives (a Nystroem step) make the latent space.
3. Passages are compared with the passages of every item by cosine in that space; those above
   ``LEAST_COSINE`` are candidates, without a limit on their number. Items of up to ``SHORT_ITEM``
   words, which a window would dilute, are compared with windows of half the length. Candidates are
   also all places where an item's answer stands, so that no paraphrase is lost that rests on it,
   and all where ``SEED`` words of an item stand in a row: of 0.8 of an item's words so many always do,
   unless words were put between them.
4. A candidate is confirmed on words: the longest common subsequence of the item and its place in
   the document covers ``VERBATIM`` of the item, or ``PARAPHRASE`` of it and the item's answer, its
   last ``ANSWER`` words, stands there in one run. Items of under ``SHORT`` words need all words in one run, and are
   sought as such, without the latent space.

Counts, idf and the factorisation cover all documents; the benchmark is a stated query set, at most
``MAX_WORDS`` distinct words, compared in blocks of ``ITEMS_AT_ONCE`` passages.

Defined results: null, empty and blank texts and items leak nothing; an item that is there twice is found
under both ids; each of repeated rows is marked; an empty benchmark marks nothing and an empty table gives no
rows; all columns are carried, and one named like an added one is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.llm.common import bound_memory, free_name, shuffle_partitions, without, written

HALF = 16
WINDOW = 2 * HALF
# Items of up to SHORT_ITEM words are sought in windows of 2 CELLs, one every CELL.
CELL = HALF // 2
SHORT_ITEM = 3 * CELL
RANK, EXTRA = 64, 16
LEAST_COSINE, LEAST_COSINE_SHORT = 0.4, 0.35
VERBATIM, PARAPHRASE = 0.8, 0.6
ANSWER, SHORT, SEED = 5, 8, 3
MAX_TERMS = 32_768
MAX_WORDS = 2_000_000
ITEMS_AT_ONCE = 8192
TOKENS_AT_ONCE = 100_000
# Words counted together for a bound on what an item has in a place, and items counted at once.
BLOCK, ITEMS_IN_BLOCKS = 8, 256
# Bits of a run's key that are looked up first.
LOW_BITS = (1 << 20) - 1
NO_WORD = -2
# Punctuation that does not belong to a word.
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_/\\«»„“”‘’¿¡…"

LEAK = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("lcs_words", T.IntegerType()),
    T.StructField("item_words", T.IntegerType()), T.StructField("answer_found", T.BooleanType()),
    T.StructField("cosine", T.DoubleType()), T.StructField("word_offset", T.LongType())]))


def clean(word: str) -> str:
    return word.strip(PUNCTUATION).lower()


def _lowered(found: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
    """The words without punctuation around them, ASCII in lower case, and of those with other letters the places and their
    ``clean`` forms: these follow Python's rules of case."""
    bare = pc.utf8_trim(found, characters=PUNCTUATION)
    other = pc.invert(pc.string_is_ascii(bare))
    return pc.ascii_lower(bare), np.flatnonzero(other.to_numpy(zero_copy_only=False)), [w.lower() for w in bare.filter(other).to_pylist()]


def cleaned_words(found: pa.Array) -> list[str]:
    """``clean`` of every word."""
    low, places, words_there = _lowered(found)
    out = low.to_pylist()
    for k, word in zip(places.tolist(), words_there):
        out[k] = word
    return out


def ids_of(found: pa.Array, vocabulary: dict[str, int]) -> np.ndarray:
    """The vocabulary's id of every word once it is clean, -1 if it has none, NO_WORD for mere punctuation. Words of ASCII alone
    are looked up at once, without a Python string of each."""
    low, places, words_there = _lowered(found)
    numbers = np.fromiter([*vocabulary.values(), -1], np.int32)
    at = pc.index_in(low, value_set=pa.array(list(vocabulary), low.type)).fill_null(len(vocabulary))
    out = numbers[at.to_numpy()]
    out[pc.equal(pc.binary_length(low), 0).to_numpy(zero_copy_only=False)] = NO_WORD
    out[places] = [vocabulary.get(w, -1) for w in words_there]
    return out


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, cut at white space, and where each text's begin and end."""
    parts = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), before[ends - ends[0]]


def word_ids(texts: pa.Array, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The vocabulary's id (-1 if it has none, NO_WORD for mere punctuation) of every word of the texts, and where each
    text begins and ends."""
    flat, ends = words(texts)
    coded = flat.dictionary_encode()
    return ids_of(coded.dictionary, vocabulary)[coded.indices.to_numpy()], ends


# --- passages --------------------------------------------------------------------------------

def halves(lengths: np.ndarray, size: int = HALF) -> tuple[np.ndarray, np.ndarray]:
    """Where each half window (of ``size`` words) begins among all words, and its number in its text."""
    n = -(-lengths // size)
    of = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.cumsum(lengths) - lengths, n) + of * size, of


def known_words(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words in the vocabulary, and the half window of each."""
    half = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
    known = ids >= 0
    return ids[known], half[known]


def half_sums(known: np.ndarray, half: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """For each of n half windows the sum of its known words' rows."""
    # Word by word of all halves together, the fullest first, so that each step adds to a slice; in the order in which
    # np.add.reduceat adds up to HALF rows (the first to the rest, a rest of 8 or more in pairs), so to the same last digit.
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    counts = np.bincount(half, minlength=n)
    fullest = np.argsort(-counts, kind="stable")
    first, left = (np.cumsum(counts) - counts)[fullest], -counts[fullest]
    holding = np.searchsorted(left, -np.arange(HALF + 2)).tolist()  # of so many words or more, in turn from more than 0
    paired = holding[8]

    def word(k: int, lo: int, hi: int) -> np.ndarray:
        return rows[known[first[lo:hi] + k]]

    if paired:
        pairs = [word(k, 0, paired) + word(k + 1, 0, paired) for k in (1, 3, 5, 7)]
        out[:paired] = (pairs[0] + pairs[1]) + (pairs[2] + pairs[3])
    for k in range(1, HALF):
        lo = paired if k < 8 else 0
        if k != 8 and holding[k] > lo:
            out[lo:holding[k]] += word(k, lo, holding[k])
    out[:holding[0]] += word(0, 0, holding[0])
    back = np.empty_like(fullest)
    back[fullest] = np.arange(n)
    return out[back]


def windows(sums: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each half window the sum of the window that it begins: itself and the next of its text."""
    out = sums.copy()
    follows = np.flatnonzero(number[1:] > 0)
    out[follows] += sums[follows + 1]
    return out


def _portions(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(ids, lengths, place of each word in its text, number of the first text in its batch) of whole texts, about
    TOKENS_AT_ONCE words at a time. Mere punctuation is left out of the ids and lengths; it counts in the places."""
    for b in batches:
        texts = b.column(column)
        flat, ends = texts.flatten().to_numpy(), texts.offsets.to_numpy() - texts.offsets[0].as_py()
        lo = 0
        while lo < len(texts):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + TOKENS_AT_ONCE, side="right")) - 1)
            ids = flat[ends[lo]:ends[hi]]
            at = np.flatnonzero(ids != NO_WORD)
            if len(at):
                lengths = np.diff(np.searchsorted(at, ends[lo:hi + 1] - ends[lo]))
                yield ids[at], lengths, at - np.repeat(ends[lo:hi] - ends[lo], lengths), lo
            lo = hi


PARTIAL = "part int, block int, data binary"
FAN_IN = 64


def _summed(parts: DataFrame, shape: tuple[int, ...], n_parts: int) -> np.ndarray:
    """The sum of all tasks' arrays (``PARTIAL``), FAN_IN of them at a time and block by block on the
    executors, until the sum of all is left; ``shape`` does not grow with the corpus."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for part, block, data in zip(*(c.to_pylist() for c in b.columns)):
                a, key = np.frombuffer(data), (part, block)
                total[key] = total[key] + a if key in total else a
        if total:
            yield _blocks(total)

    while True:
        n_parts = -(-n_parts // FAN_IN)
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int"))
        parts = parts.repartition(min(8 * n_parts, shuffle_partitions(parts.sparkSession)), "part", "block").mapInArrow(add, PARTIAL)
        if n_parts == 1:
            break
    got = parts.collect()
    out = np.zeros(math.prod(shape))
    step = -(-out.size // 8)
    for r in got:
        out[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["data"])
    return out.reshape(shape)


def _blocks(total: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([p for p, _ in total], pa.int32()), pa.array([b for _, b in total], pa.int32()),
        pa.array([a.tobytes() for a in total.values()], pa.binary())], names=["part", "block", "data"])


def _cut(total: np.ndarray) -> pa.RecordBatch:
    flat, part = total.ravel(), TaskContext.get().partitionId()
    step = -(-flat.size // 8)
    return _blocks({(part, i): flat[i * step:(i + 1) * step] for i in range(8) if i * step < flat.size})


def half_frequencies(passages: DataFrame, terms: int) -> tuple[np.ndarray, float]:
    """In how many half windows each term stands, and how many there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms + 1)
        for ids, lengths, _, _ in _portions(batches, 0):
            starts, _ = halves(lengths)
            known, half = known_words(ids, starts)
            pairs = np.unique(half * terms + known % terms)
            total[:terms] += np.bincount(pairs % terms, minlength=terms)
            total[terms] += len(starts)
        yield _cut(total)

    total = _summed(passages.mapInArrow(count, PARTIAL), (terms + 1,), passages.rdd.getNumPartitions())
    return total[:terms], total[terms]


def _by_word(rows: np.ndarray, n_words: int) -> np.ndarray:
    """Rows by word id; beyond MAX_TERMS several words share a row."""
    terms = len(rows)
    return (rows if n_words <= terms else rows[np.arange(n_words) % terms]).astype(np.float32)


def gram_product(passages: DataFrame, idf: np.ndarray, thin: np.ndarray, n_words: int) -> np.ndarray:
    """A^T (A thin) for the TF-IDF matrix A of all passages: one pass."""
    terms, width = thin.shape
    held = passages.sparkSession.sparkContext.broadcast(_by_word(idf[:, None] * thin, n_words))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, total = held.value, np.zeros((terms, width))
        for ids, lengths, _, _ in _portions(batches, 0):
            starts, number = halves(lengths)
            known, half = known_words(ids, starts)
            p = windows(half_sums(known, half, len(starts), rows), number)
            # A half belongs to the window it begins and to the one before.
            back = p.copy()
            follows = np.flatnonzero(number[1:] > 0) + 1
            back[follows] += p[follows - 1]
            term = (known % terms).astype(np.uint16)
            order = np.argsort(term, kind="stable")
            heads = np.flatnonzero(np.diff(term[order].astype(np.int32), prepend=-1))
            if len(heads):
                total[term[order][heads]] += np.add.reduceat(back[half[order]], heads, axis=0)
        yield _cut(total)

    return idf[:, None] * _summed(passages.mapInArrow(multiply, PARTIAL), (terms, width), passages.rdd.getNumPartitions())


def latent_rows(passages: DataFrame, n_words: int, rank: int = RANK) -> np.ndarray:
    """By word id: the word's idf-weighted coordinates in the whitened latent space."""
    terms = min(n_words, MAX_TERMS)
    df, n = half_frequencies(passages, terms)
    idf = np.log((n + 1) / (df + 1)) + 0.1  # a word of every passage still counts a little
    width = min(rank + EXTRA, terms)
    thin = np.random.default_rng(7).standard_normal((terms, width))
    image = gram_product(passages, idf, thin, n_words)
    # Of the Gram matrix G: G thin (thin' G thin)^-1 thin' G = B B', whose singular vectors are those sought.
    values, vectors = np.linalg.eigh((thin.T @ image + image.T @ thin) / 2)
    good = values > max(values.max(), 0) * 1e-12
    left, singular, _ = np.linalg.svd(image @ (vectors[:, good] / np.sqrt(values[good])), full_matrices=False)
    top = singular[:rank] > (singular[0] * 1e-6 if len(singular) else 0)
    return _by_word(idf[:, None] * (left[:, :rank][:, top] / singular[:rank][top]), n_words)


# --- confirmation ----------------------------------------------------------------------------

def lcs_length(a: list[int], places: dict[int, int], n: int) -> int:
    """The longest common subsequence of ``a`` and an item of n words (bit k of places[w]: word k is w)."""
    row = (1 << n) - 1
    for w in a:
        m = places.get(w)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & ((1 << n) - 1)
    return n - row.bit_count()


def _has_run(a: list[int], run: list[int]) -> bool:
    n = len(run)
    return any(a[k:k + n] == run for k in range(len(a) - n + 1) if a[k] == run[0])


class Runs:
    """Runs of words of the items, and where they stand in texts."""

    def __init__(self, runs: list[tuple[tuple[int, ...], int, int]], n_words: int):
        """``runs``: words, item, and the run's place in the item."""
        # By length: which words begin a run, and the runs' sorted keys, items and places.
        self.by_length = []
        for n in sorted({len(words) for words, _, _ in runs}):
            words, of, start = (np.array(x) for x in zip(*(r for r in runs if len(r[0]) == n)))
            begins = np.zeros(n_words + 1, bool)  # the last is for unknown words
            begins[words[:, 0]] = True
            keys = self._keys(words.T)
            order = np.argsort(keys, kind="stable")
            # Each key once, with its first run and how many it has, and the low bits that some key has: most places end there.
            once, first, count = np.unique(keys[order], return_index=True, return_counts=True)
            low = np.zeros(LOW_BITS + 1, bool)
            low[once & np.uint64(LOW_BITS)] = True
            self.by_length.append((n, begins, low, once, first, count, of[order], start[order]))

    @staticmethod
    def _keys(words: np.ndarray) -> np.ndarray:
        """A 64-bit key of each column of words; confirmation tells runs of one key apart."""
        out = np.zeros(words.shape[1], np.uint64)
        for w in words:
            out = (out + w.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def places(self, ids: np.ndarray, text: np.ndarray) -> np.ndarray:
        """(word, item, word where the item would begin) of all runs in the texts; ``text``: each word's text."""
        found = [np.zeros((3, 0), np.int64)]
        for n, begins, low, once, first, count, of, start in self.by_length:
            at = np.flatnonzero(begins[ids[:len(ids) - n + 1]]) if len(ids) >= n else np.zeros(0, np.int64)
            at = at[text[at] == text[at + n - 1]]
            sought = self._keys(np.stack([ids[at + k] for k in range(n)]))
            maybe = np.flatnonzero(low[sought & np.uint64(LOW_BITS)])
            at, sought = at[maybe], sought[maybe]
            key = np.minimum(np.searchsorted(once, sought), len(once) - 1)
            n_runs = np.where(once[key] == sought, count[key], 0)
            at, run = np.repeat(at, n_runs), np.repeat(first[key] - np.cumsum(n_runs) + n_runs, n_runs) + np.arange(n_runs.sum())
            found.append(np.stack([at, of[run], at - start[run]]))
        return np.concatenate(found, axis=1)


class Items:
    """The benchmark by word ids, and its passages in the latent space."""

    def __init__(self, items: list[tuple[int, list[int]]], rows: np.ndarray):
        self.items = items
        self.places = []
        for _, ids in items:
            at: dict[int, int] = {}
            for k, w in enumerate(ids):
                at[w] = at.get(w, 0) | 1 << k
            self.places.append(at)
        # For windows and for short windows: the passages' vectors, items and starts.
        self.passages = []
        for short in (False, True):
            found = [(rows[ids[s:s + WINDOW]].sum(axis=0), i, s) for i, (_, ids) in enumerate(items)
                     if (len(ids) <= SHORT_ITEM) == short and len(ids) >= SHORT
                     for s in sorted({*range(0, max(1, len(ids) - WINDOW + 1), HALF), max(0, len(ids) - WINDOW)})]
            if found:
                vectors, of, start = zip(*found)
                self.passages.append((short, _unit(np.array(vectors, np.float32)), np.array(of), np.array(start)))
        full = [(i, tuple(ids)) for i, (_, ids) in enumerate(items) if len(ids) >= SHORT]
        whole = [(tuple(ids), i, 0) for i, (_, ids) in enumerate(items) if len(ids) < SHORT]
        self.answers = Runs([(ids[-ANSWER:], i, len(ids) - ANSWER) for i, ids in full], len(rows))
        self.seeds = Runs(whole + [(ids[k:k + SEED], i, k) for i, ids in full for k in range(len(ids) - SEED + 1)], len(rows))
        self.lengths = np.array([len(ids) for _, ids in items])
        # Which words an item has: a table (its last row is for unknown words), or beyond 64 MB sorted pairs.
        n = len(items)
        self.member = np.unique(np.concatenate([np.array(ids, np.int64) * n + i for i, (_, ids) in enumerate(items)]))
        self.table = None
        if (len(rows) + 1) * n <= 64 << 20:
            self.table = np.zeros((len(rows) + 1, n), bool)
            self.table[self.member // n, self.member % n] = True

    def possible(self, ids: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The numbers of the candidates that ``likely`` may keep, by the item's words in all BLOCKs of words that the
        place touches: sums over blocks are made once for all candidates of an item, so most go without their words being read."""
        if self.table is None or not len(of):
            return np.arange(len(of))
        padded = np.full(-(-len(ids) // BLOCK) * BLOCK, -1, ids.dtype)
        padded[:len(ids)] = ids
        blocks, n = padded.reshape(-1, BLOCK), np.zeros(len(of), np.int32)
        for a in range(0, len(self.items), ITEMS_IN_BLOCKS):
            mine = np.flatnonzero((of >= a) & (of < a + ITEMS_IN_BLOCKS))
            if len(mine):
                table = np.ascontiguousarray(self.table[:, a:a + ITEMS_IN_BLOCKS]).view(np.uint8)
                held = table[blocks[:, 0]]
                for k in range(1, BLOCK):
                    held += table[blocks[:, k]]
                before = np.zeros((table.shape[1], len(blocks) + 1), np.int32)
                np.cumsum(np.ascontiguousarray(held.T), axis=1, out=before[:, 1:])
                n[mine] = before[of[mine] - a, -(-hi[mine] // BLOCK)] - before[of[mine] - a, lo[mine] // BLOCK]
        return np.flatnonzero(n >= PARAPHRASE * self.lengths[of])

    def likely(self, ids: np.ndarray, of: np.ndarray, lo: np.ndarray, hi: np.ndarray, answers: np.ndarray) -> np.ndarray:
        """For which of the candidates (item, place ``lo`` to ``hi`` among ``ids``) enough words are the item's at all.

        A common subsequence is no longer than the number of such words, so no candidate is lost. ``PARAPHRASE`` is
        enough where the item's answer stands; ``answers``: item * len(ids) + word of all answers, rising."""
        out = np.zeros(len(of), bool)
        for a in range(0, len(of), 20_000):
            s = slice(a, a + 20_000)
            width = hi[s] - lo[s]
            firsts = np.cumsum(width) - width
            item = np.repeat(of[s], width)
            words = ids[np.arange(width.sum()) + np.repeat(lo[s] - firsts, width)]
            if self.table is not None:
                hit = self.table[words, item]
            else:
                hit = np.isin(words.astype(np.int64) * len(self.items) + item, self.member) & (words >= 0)
            full = np.flatnonzero(width)
            n = np.zeros(len(width), np.int64)
            if len(full):
                n[full] = np.add.reduceat(hit, firsts[full], dtype=np.int64)
            answer = np.searchsorted(answers, of[s] * len(ids) + hi[s] - ANSWER, side="right") > np.searchsorted(answers, of[s] * len(ids) + lo[s])
            out[s] = n >= np.where(answer, PARAPHRASE, VERBATIM) * self.lengths[of[s]]
        return out

    def confirm(self, i: int, region: np.ndarray) -> tuple[int, bool] | None:
        """(common words, answer found) if item i stands in the region."""
        _, item = self.items[i]
        n, places = len(item), self.places[i]
        known = region[region >= 0].tolist()
        # No more words are common than the item has of those that stand here: most candidates end with that.
        if sum(places[w].bit_count() for w in places.keys() & set(known)) < PARAPHRASE * n:
            return None
        common = lcs_length(known, places, n)
        if common < PARAPHRASE * n:
            return None
        answer = _has_run(region.tolist(), item[-ANSWER:])
        if n < SHORT:
            good = _has_run(region.tolist(), item)
        else:
            good = common >= VERBATIM * n or (common >= PARAPHRASE * n and answer)
        return (common, answer) if good else None


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _leaks(ids: np.ndarray, lengths: np.ndarray, places: np.ndarray, rows: np.ndarray, items: Items) -> dict[int, list[dict]]:
    """Confirmed leaks by the text's number in this portion."""
    starts, number = halves(lengths, CELL)
    cells = half_sums(*known_words(ids, starts), len(starts), rows)
    text = np.repeat(np.arange(len(lengths)), -(-lengths // CELL))
    even = np.flatnonzero(number % 2 == 0)
    pairs = windows(cells, number)  # 2 cells from each cell on: short windows, and from even cells on half windows
    firsts = np.cumsum(lengths) - lengths
    best: dict[tuple[int, int], dict] = {}
    of_word = np.repeat(np.arange(len(lengths)), lengths)
    ended, seeded = items.answers.places(ids, of_word), items.seeds.places(ids, of_word)
    answers = np.sort(ended[1] * len(ids) + ended[0])
    found = [(short, *passages, block) for short, *passages in items.passages for block in range(0, len(passages[1]), ITEMS_AT_ONCE)]

    def confirmed(t: np.ndarray, item: np.ndarray, begin: np.ndarray, cosine: np.ndarray) -> None:
        """Looks through the candidates: an item and where it would begin in a text, with room on both sides."""
        slack = HALF + items.lengths[item] // 4
        lo = firsts[t] + np.clip(begin - slack, 0, lengths[t])
        hi = firsts[t] + np.clip(begin + items.lengths[item] + slack, 0, lengths[t])
        good = items.possible(ids, item, lo, hi)
        for k in good[items.likely(ids, item[good], lo[good], hi[good], answers)].tolist():
            i, pair = int(item[k]), (int(t[k]), int(item[k]))
            leak = items.confirm(i, ids[lo[k]:hi[k]])
            if leak and leak[0] > best.get(pair, {"lcs_words": -1})["lcs_words"]:
                near = best.get(pair, {"cosine": None})["cosine"] if np.isnan(cosine[k]) else float(cosine[k])
                best[pair] = {"item_id": items.items[i][0], "lcs_words": leak[0], "item_words": len(items.items[i][1]),
                              "answer_found": leak[1], "cosine": near, "word_offset": int(places[lo[k]])}

    candidates = []
    for short, targets, of_item, in_item, block in found:
        mine = np.arange(len(number)) if short else even
        vectors = _unit(pairs if short else windows(pairs[even], number[even] // 2))
        cosines = vectors @ targets[block:block + ITEMS_AT_ONCE].T
        near = np.flatnonzero((cosines >= (LEAST_COSINE_SHORT if short else LEAST_COSINE)).ravel())  # faster than by two axes
        at, of = np.divmod(near, cosines.shape[1])
        candidates.append((text[mine[at]], of_item[block + of], number[mine[at]] * CELL - in_item[block + of], cosines[at, of]))
    at, item, begin = np.concatenate([ended, seeded], axis=1)
    order = np.lexsort((begin, item, of_word[at]))
    t, item, begin = of_word[at][order], item[order], begin[order] - firsts[of_word[at][order]]
    once = np.ones(len(t), bool)  # of runs that place an item within one CELL, the first
    once[1:] = (np.diff(t) != 0) | (np.diff(item) != 0) | (np.diff(begin // CELL) != 0)
    candidates.append((t[once], item[once], begin[once], np.full(once.sum(), np.nan, np.float32)))  # found without a cosine
    confirmed(*map(np.concatenate, zip(*candidates)))
    out: dict[int, list[dict]] = {}
    for (t_, _), leak in sorted(best.items()):
        out.setdefault(t_, []).append(leak)
    return out


def marked(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           out: str = "leaks", rank: int = RANK, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``out``: the confirmed benchmark items of each row, its best place for each. ``keep`` names the columns
    that go along (default: all); texts that do not are neither written nor read again."""
    spark = docs.sparkSession
    bound_memory(spark)
    docs = without(docs, [out])
    # The stated query set: its size is bounded by MAX_WORDS below.
    stated = benchmark.select(F.col(item_id).cast("long"), F.col(item_text).cast("string")).collect()
    flat, ends = words(pa.array([r[1] for r in stated], pa.large_string()))
    flat = cleaned_words(flat)
    cleaned = [(r[0], [w for w in flat[a:b] if w]) for r, a, b in zip(stated, ends, ends[1:])]
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws in cleaned for w in ws}))}
    if len(vocabulary) > MAX_WORDS:
        raise ValueError(f"the benchmark has over {MAX_WORDS} distinct words: mark the documents part by part")
    coded = sorted(((k, [vocabulary[w] for w in ws]) for k, ws in cleaned if ws), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    kept = docs if keep is None else docs.select(*[docs[f"`{c}`"] for c in keep])
    if not coded:
        return kept.withColumn(out, F.array().cast(LEAK))
    held_words = spark.sparkContext.broadcast(vocabulary)
    ids_name = free_name(docs.columns, "word_ids")
    names, place = kept.columns, docs.columns.index(text)
    of_kept = [docs.columns.index(c) for c in names]
    schema = T.StructType(list(kept.schema) + [T.StructField(ids_name, T.ArrayType(T.IntegerType()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ends = word_ids(b.column(place), held_words.value)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in of_kept], lists], names=[*names, ids_name])

    passages = written(docs.mapInArrow(code, schema), "decontam-words")
    rows = latent_rows(passages.select(ids_name), len(vocabulary), rank)
    held = spark.sparkContext.broadcast((rows, Items(coded, rows)))
    out_schema = T.StructType(list(kept.schema) + [T.StructField(out, LEAK)])
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("lcs_words", pa.int32()), ("item_words", pa.int32()),
                               ("answer_found", pa.bool_()), ("cosine", pa.float64()), ("word_offset", pa.int64())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, items = held.value
        for b in batches:
            found: list[list[dict]] = [[] for _ in range(b.num_rows)]
            for ids, lengths, places, first in _portions([b], len(names)):
                for t, leaks in _leaks(ids, lengths, places, rows, items).items():
                    found[first + t] = leaks
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, kind)], names=[*names, out])

    return passages.mapInArrow(search, out_schema)


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item stands."""
    leaks = free_name(docs.columns, "leaks")
    return marked(docs, benchmark, text, out=leaks).where(F.size(leaks) == 0).drop(leaks)
