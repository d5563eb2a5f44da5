"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text's words (runs of letters, digits and anything beyond ASCII, A-Z lower-cased) are read in overlapping windows of
``WINDOW`` words, a new one every ``STRIDE``. A word's input joins two embeddings: of the word itself, if the sample
knows it, and of its characters, the mean over its byte 3- and 4-grams with marked ends. Two gated recurrent units read
the window forwards and backwards, attention pools their states, a logistic unit scores the window; a text's score is
its highest window's.

Training takes a bounded sample of labelled rows: per class the ``SAMPLE`` rows of least hashed id, of texts of up to
``SAMPLE_BYTES``. It begins with random windows under their text's label and goes on with each text's highest window
(multiple instances: one toxic window makes a toxic text) beside random windows of clean ones. Scoring reads every
window of every text of any length on the executors, the trained model broadcast (a few MB: its tables are
bounded by the sample).

Defined results: a text without words (null, empty, punctuation) scores the share of label 1 among all labels learned
from; if a class is missing from the sample, every text does; without labels the score is 0. Null labels and labels
of null ids teach nothing; repeated rows each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.llm.ranked_search import terms_of

WINDOW, STRIDE = 32, 24
SAMPLE, SAMPLE_BYTES = 2048, 32 << 10
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 8, 12, 8, 8
CHAR_ROWS, KNOWN_IN, UNKNOWN = 1 << 14, 3, 0
HELD_OUT_OF = 5
# Words of one piece of a long text, and distinct words whose gates a worker holds.
PIECE, CACHE = 60_000, 150_000


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in lists that follow each other: a very long text never is one list."""
    text, at = text or b"", 0
    while at < len(text):
        end = min(len(text), at + (1 << 20))
        while end < len(text) and (text[end] >= 0x80 or chr(text[end]).isalnum()):
            end += 1
        yield terms_of(text[at:end])
        at = end


def pieces_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The words in pieces that overlap as windows do, so that the pieces' windows are the text's."""
    step, kept, held, first = PIECE // STRIDE * STRIDE, WINDOW - STRIDE, [], True
    for words in words_of(text):
        held += words
        while len(held) > step + kept:
            yield held[:step + kept]
            held, first = held[step:], False
    if held and (first or len(held) > kept):
        yield held


def window_starts(n: int) -> np.ndarray:
    """Where a piece's windows begin: the last one ends with the piece."""
    return np.arange(0, max(1, n - (WINDOW - STRIDE)), STRIDE)


def char_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the hashed byte 3- and 4-grams of all words, with marked ends, and the first gram of each word."""
    joined = np.frombuffer(b"".join(b"\x02" + w + b"\x03" for w in words), np.uint8).astype(np.uint32)
    sizes = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(sizes)
    grams, owner = [], []
    for n in (3, 4):
        if len(joined) < n:
            continue
        mixed = np.full(len(joined) - n + 1, 2166136261 + n, np.uint32)
        for k in range(n):
            mixed = (mixed ^ joined[k:len(joined) - n + 1 + k]) * np.uint32(16777619)
        word = np.repeat(np.arange(len(words)), sizes)[:len(mixed)]
        inside = np.arange(len(mixed)) + n <= ends[word]
        grams.append(((mixed ^ (mixed >> np.uint32(15))) % np.uint32(CHAR_ROWS))[inside])
        owner.append(word[inside])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")  # every word has two marks and a byte, so a 3-gram
    return np.concatenate(grams)[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(words)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """The network's numbers, the words it knows and the share of label 1."""

    known: dict[bytes, int]
    prior: float
    trained: bool = False
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, known: dict[bytes, int], prior: float, seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def some(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        return cls(known, prior, False, {
            "word": some(len(known) + 1, WORD_DIM, scale=0.05), "char": some(CHAR_ROWS, CHAR_DIM, scale=0.1),
            "W": some(2, d, 3 * h, scale=d ** -0.5), "b": np.zeros((2, 3 * h), np.float32), "U": some(2, h, 3 * h, scale=h ** -0.5),
            "Wa": some(2 * h, ATTENTION, scale=(2 * h) ** -0.5), "ba": np.zeros(ATTENTION, np.float32),
            "v": some(ATTENTION, scale=ATTENTION ** -0.5), "w": some(2 * h, scale=(2 * h) ** -0.5), "c": np.zeros(1, np.float32)})

    def inputs(self, word_rows: np.ndarray, grams: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Each distinct word's input: its word row beside the mean of its character rows."""
        sizes = np.diff(np.append(firsts, len(grams)))
        chars = np.add.reduceat(self.p["char"][grams], firsts, axis=0) / sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][word_rows], chars], axis=1)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What an input adds to the gates of both directions: (2, words, 3 * HIDDEN)."""
        return np.matmul(x[None], self.p["W"]) + self.p["b"][:, None]

    def forward(self, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """The logit of each window. ``ids`` and ``mask`` (word there) are (WINDOW, windows)."""
        steps, n = ids.shape
        h, u = HIDDEN, self.p["U"]
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((steps, n, 2 * h), np.float32)
        tape, full = [], mask.all(axis=1)
        g = np.empty((2, n, 3 * h), np.float32)
        for t in range(steps):
            back = steps - 1 - t
            np.take(gates[0], ids[t], axis=0, out=g[0])
            np.take(gates[1], ids[back], axis=0, out=g[1])
            a = np.matmul(state, u)
            zr = _sigmoid(g[..., :2 * h] + a[..., :2 * h])
            z, r = zr[..., :h], zr[..., h:]
            new = 2 * _sigmoid(2 * (g[..., 2 * h:] + r * a[..., 2 * h:])) - 1
            there = None
            if not (full[t] and full[back]):
                there = np.stack([mask[t], mask[back]])[..., None].astype(np.float32)
            after = new + z * (state - new)
            if there is not None:
                after = there * after + (1 - there) * state
            if keep:
                tape.append((state, a[..., 2 * h:], z, r, new, there))
            state = after
            states[t, :, :h], states[back, :, h:] = state[0], state[1]
        hidden = np.tanh(states @ self.p["Wa"] + self.p["ba"])
        scores = np.where(mask, hidden @ self.p["v"], np.float32(-1e9))
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weights, states)
        return pooled @ self.p["w"] + self.p["c"][0], {"tape": tape, "states": states, "hidden": hidden, "weights": weights, "pooled": pooled}

    def backward(self, d_logit: np.ndarray, kept: dict, ids: np.ndarray, mask: np.ndarray, n_words: int) -> tuple[dict, np.ndarray]:
        """Gradients of the numbers behind the gates, and of the gates of each distinct word."""
        p, h = self.p, HIDDEN
        states, hidden, weights = kept["states"], kept["hidden"], kept["weights"]
        grad = {"w": kept["pooled"].T @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["w"]
        d_weights = np.einsum("nh,tnh->tn", d_pooled, states)
        d_scores = weights * (d_weights - (weights * d_weights).sum(axis=0))
        grad["v"] = np.einsum("tn,tna->a", d_scores, hidden)
        d_hidden = d_scores[..., None] * p["v"] * (1 - hidden ** 2)
        grad["Wa"], grad["ba"] = np.einsum("tnh,tna->ha", states, d_hidden), d_hidden.sum(axis=(0, 1))
        d_states = weights[..., None] * d_pooled + d_hidden @ p["Wa"].T
        grad["U"], d_gates = np.zeros_like(p["U"]), np.zeros((2, n_words, 3 * h), np.float32)
        steps, carry = len(ids), np.zeros((2, ids.shape[1], h), np.float32)
        places, spent = np.empty((2, *ids.shape), np.int64), np.empty((2, *ids.shape, 3 * h), np.float32)
        for t in range(steps - 1, -1, -1):
            state, a_new, z, r, new, there = kept["tape"][t]
            back = steps - 1 - t
            carry = carry + np.stack([d_states[t, :, :h], d_states[back, :, h:]])
            passed = carry if there is None else there * carry
            d_new = passed * (1 - z) * (1 - new ** 2)
            d_z = passed * (state - new) * z * (1 - z)
            d_r = d_new * a_new * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_new * r], axis=2)
            grad["U"] += np.matmul(state.transpose(0, 2, 1), d_a)
            before = passed * z + np.matmul(d_a, p["U"].transpose(0, 2, 1))
            carry = before if there is None else before + (1 - there) * carry
            d_g = np.concatenate([d_z, d_r, d_new], axis=2)
            places[:, t], spent[:, t] = (ids[t], ids[back]), d_g
        for side in (0, 1):
            d_gates[side] = _summed(places[side].ravel(), spent[side].reshape(-1, 3 * h), n_words)
        return grad, d_gates


@dataclass
class _Sample:
    """The sample's distinct words with their rows, and the windows of its texts as places in one array of words."""

    word_rows: np.ndarray
    grams: list[np.ndarray]
    text: np.ndarray  # of each window
    ids: np.ndarray  # (windows, WINDOW)
    mask: np.ndarray


def _windows(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text's word numbers: the text, the numbers and the mask of every window."""
    text, ids, mask = [], [], []
    for i, row in enumerate(numbers):
        starts = window_starts(len(row))
        at = starts[:, None] + np.arange(WINDOW)
        inside = at < len(row)
        text.append(np.full(len(starts), i))
        ids.append(row[np.where(inside, at, 0)])
        mask.append(inside)
    return np.concatenate(text), np.concatenate(ids), np.concatenate(mask)


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.step = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def apply(self, grad: dict[str, np.ndarray]) -> None:
        """One step; of the embedding tables only rows with a gradient move."""
        self.step += 1
        size = np.sqrt(sum(float((g ** 2).sum()) for g in grad.values()))
        for k, g in grad.items():
            rows = np.flatnonzero(g.any(axis=1)) if k in ("word", "char") else slice(None)
            g = g[rows] * np.float32(min(1.0, 5.0 / (size + 1e-9)))
            m = self.m[k][rows] = self.m[k][rows] + 0.1 * (g - self.m[k][rows])
            v = self.s[k][rows] = self.s[k][rows] + 0.001 * (g * g - self.s[k][rows])
            mean, square = m / (1 - 0.9 ** self.step), v / (1 - 0.999 ** self.step)
            self.p[k][rows] -= (self.rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)


def _step(model: Model, adam: _Adam, sample: _Sample, rows: np.ndarray, labels: np.ndarray, rng: np.random.Generator) -> None:
    """One step on some windows; a third of the known words is taken as unknown, so that characters are learned."""
    used, ids = np.unique(sample.ids[rows], return_inverse=True)
    ids, mask = ids.reshape(len(rows), WINDOW).T, sample.mask[rows].T
    word_rows = np.where(rng.random(len(used)) < 0.33, UNKNOWN, sample.word_rows[used])
    grams = [sample.grams[k] for k in used]
    sizes = np.array([len(g) for g in grams])
    flat, firsts = np.concatenate(grams), np.append(0, np.cumsum(sizes)[:-1])
    x = model.inputs(word_rows, flat, firsts)
    logit, kept = model.forward(model.gates(x), ids, mask, keep=True)
    d_logit = ((_sigmoid(logit) - labels) / len(rows)).astype(np.float32)
    grad, d_gates = model.backward(d_logit, kept, ids, mask, len(used))
    grad |= input_gradients(model, x, d_gates, word_rows, flat, sizes)
    adam.apply(grad)


def input_gradients(model: Model, x: np.ndarray, d_gates: np.ndarray, word_rows: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> dict:
    grad = {"W": np.matmul(x.T[None], d_gates), "b": d_gates.sum(axis=1)}
    d_x = np.matmul(d_gates, model.p["W"].transpose(0, 2, 1)).sum(axis=0)
    grad["word"] = _summed(word_rows, d_x[:, :WORD_DIM], len(model.p["word"]))
    grad["char"] = _summed(flat, np.repeat(d_x[:, WORD_DIM:] / sizes[:, None], sizes, axis=0), CHAR_ROWS)
    return grad


def _summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The values added up by row: (n, columns)."""
    return np.stack([np.bincount(rows, values[:, k], n) for k in range(values.shape[1])], axis=1).astype(np.float32)


def _highest(model: Model, sample: _Sample) -> np.ndarray:
    """The window of each text that the model scores highest."""
    gates = np.empty((2, len(sample.grams), 3 * HIDDEN), np.float32)
    for at in range(0, len(sample.grams), 1 << 15):
        grams = sample.grams[at:at + (1 << 15)]
        firsts = np.append(0, np.cumsum([len(g) for g in grams])[:-1])
        gates[:, at:at + len(grams)] = model.gates(model.inputs(sample.word_rows[at:at + len(grams)], np.concatenate(grams), firsts))
    logit = np.empty(len(sample.text))
    order = np.argsort(~sample.mask[:, -1], kind="stable")
    for at in range(0, len(order), 2048):
        some = order[at:at + 2048]
        logit[some] = model.forward(gates, np.ascontiguousarray(sample.ids[some].T), np.ascontiguousarray(sample.mask[some].T))[0]
    best = np.lexsort((-logit, sample.text))
    return best[np.flatnonzero(np.diff(sample.text[best], prepend=-1))]


def fit(texts: list[bytes], labels: np.ndarray, prior: float, seed: int = 7, warm: int = 2, rounds: int = 4) -> Model:
    """The model of a sample held in memory: ``warm`` rounds of random windows, then ``rounds`` of highest windows."""
    rng = np.random.default_rng(seed)
    cut = [[w for part in words_of(t) for w in part] for t in texts]
    some = [i for i, words in enumerate(cut) if words]
    cut, labels = [cut[i] for i in some], np.asarray(labels)[some]
    texts_with = Counter(w for words in cut for w in set(words))
    known = {w: i + 1 for i, w in enumerate(sorted(w for w, n in texts_with.items() if n >= KNOWN_IN))}
    model = Model.fresh(known, prior, seed)
    if not (labels == 1).any() or not (labels == 0).any():
        return model
    number = {w: i for i, w in enumerate(texts_with)}
    flat, firsts = char_grams(list(number))
    sample = _Sample(np.array([known.get(w, UNKNOWN) for w in number]), np.split(flat, firsts[1:]),
                     *_windows([np.array([number[w] for w in words]) for words in cut]))
    by_text = np.split(np.arange(len(sample.text)), np.flatnonzero(np.diff(sample.text)) + 1)
    toxic, clean = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    adam, half = _Adam(model.p, 0.01), 32
    turns = max(60, -(-max(len(toxic), len(clean)) // half))
    for _ in range(warm * turns):
        rows = np.concatenate([rng.choice(by_text[i], 2) for i in (*rng.choice(toxic, half), *rng.choice(clean, half))])
        _step(model, adam, sample, rows, labels[sample.text[rows]], rng)
    for turn in range(rounds):
        adam.rate = 0.005 if turn < rounds - 1 else 0.002
        highest = _highest(model, sample)
        for _ in range(turns):
            docs = [*rng.choice(toxic, half), *rng.choice(clean, half)]
            rows = np.array([*highest[docs], *[rng.choice(by_text[i]) for i in docs[half:]]])
            _step(model, adam, sample, rows, labels[sample.text[rows]], rng)
    model.trained = True
    return model


class Scorer:
    """A trained model with the gates of the words it has met, a bounded number."""

    def __init__(self, model: Model, at_once: int = 2048):
        self.model, self.at_once = model, at_once
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.gates = np.zeros((2, 1 << 12, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[bytes]) -> None:
        flat, firsts = char_grams(words)
        rows = np.array([self.model.known.get(w, UNKNOWN) for w in words])
        n = len(self.place)
        while n + len(words) > self.gates.shape[1]:
            self.gates = np.concatenate([self.gates, np.zeros_like(self.gates)], axis=1)
        self.gates[:, n:n + len(words)] = self.model.gates(self.model.inputs(rows, flat, firsts))
        self.place.update(zip(words, range(n, n + len(words))))

    def pieces(self, pieces: list[list[bytes]]) -> list[tuple[float, int]]:
        """Of each piece: the highest window's score and its first word."""
        fresh = {w for words in pieces for w in words if w not in self.place}
        if len(self.place) + len(fresh) > CACHE:
            self._clear()
            fresh = {w for words in pieces for w in words}
        if fresh:
            self._learn(sorted(fresh))
        text, ids, mask = _windows([np.fromiter(map(self.place.__getitem__, words), np.int64, len(words)) for words in pieces])
        logit = np.empty(len(text))
        # Windows shorter than the others together, so that the rest need no masks.
        order = np.argsort(~mask[:, -1], kind="stable")
        for at in range(0, len(order), self.at_once):
            some = order[at:at + self.at_once]
            logit[some] = self.model.forward(self.gates, np.ascontiguousarray(ids[some].T), np.ascontiguousarray(mask[some].T))[0]
        ends = np.searchsorted(text, np.arange(len(pieces) + 1))
        out = []
        for a, b in zip(ends, ends[1:]):
            k = int(np.argmax(logit[a:b]))
            out.append((float(_sigmoid(logit[a + k])), k * STRIDE))
        return out

    def texts(self, texts: Iterator[bytes | None]) -> Iterator[tuple[float, int | None]]:
        """(score, first word of the highest window) of each text, in order; pieces are scored in groups of like size."""
        done: list[tuple[float, int | None]] = []
        held: list[tuple[int, int, list[bytes]]] = []
        size = 0

        def settle() -> None:
            nonlocal held, size
            for (i, offset, _), (score, word) in zip(held, self.pieces([x[2] for x in held]) if held else []):
                if done[i][1] is None or score > done[i][0]:
                    done[i] = (score, offset + word)
            held, size = [], 0

        for i, t in enumerate(texts):
            done.append((self.model.prior, None))
            if self.model.trained:
                for k, words in enumerate(pieces_of(t)):
                    held.append((i, k * (PIECE // STRIDE * STRIDE), words))
                    size += len(words)
                    if size >= PIECE:
                        settle()
        settle()
        return iter(done)


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = 7) -> Model:
    """The model of labels whose id's remainder is not 0. ``sample`` bounds the rows of each class that are read."""
    taught = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "toxic IN (0, 1)").where(remainder(F.col("doc_id")) != 0)
    n, ones = taught.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = ones / n if n else 0.0
    order = [F.xxhash64(F.lit(seed), F.col("doc_id")), F.col("doc_id")]
    # Some ids more than rows are wanted, as not every text is short enough or there.
    ids = [taught.where(F.col("toxic") == y).distinct().orderBy(*order).limit(2 * sample) for y in (0, 1)]
    chosen = F.broadcast(ids[0].unionByName(ids[1]))  # at most 4 * sample ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text").between(1, SAMPLE_BYTES))
    rows: list = []
    found = texts.join(chosen, "doc_id").withColumn("order", order[0])
    for y in (0, 1):  # at most ``sample`` rows of SAMPLE_BYTES
        rows += found.where(F.col("toxic") == y).orderBy("order", "doc_id", "text").limit(sample).collect()
    return fit([r["text"].encode() for r in rows], np.array([r["toxic"] for r in rows]), prior, seed)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, window_start): the highest window's score of every whole text and that window's first word."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for b in batches:
            found = list(scorer.texts(t.as_py() for t in b.column(1).cast(pa.binary())))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in found], pa.float64()),
                                              pa.array([x[1] for x in found], pa.int64())], names=["doc_id", "score", "window_start"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double, window_start long")
