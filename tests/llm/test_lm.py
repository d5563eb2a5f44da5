"""Deleted interpolation against a brute-force model, and held-out likelihood."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from circulation.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def corpus():
    rng = random.Random(8)
    follow = {i: [rng.randrange(120) for _ in range(4)] for i in range(120)}
    rows = []
    for i in range(250):
        w = [rng.randrange(120)]
        for _ in range(rng.randrange(80)):
            w.append(rng.choice(follow[w[-1]]) if rng.random() < 0.8 else rng.randrange(120))
        rows.append((i, " ".join(f"T{x}" if rng.random() < 0.1 else f"t{x}" for x in w)))
    return rows + [(500, None), (501, ""), (502, "unseen"), (503, "a\x0bb  c\n"), (3, rows[3][1]), (504, "t1 " * 30_000)]


def brute(rows, order, octave=8):
    texts = [WORD.findall((t or "").translate(LOWER)) + [None] for _, t in rows]
    folds = [zlib.crc32(str(k).encode()) % 5 for k, _ in rows]

    def counted(chosen):
        grams, contexts = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
        for t, f in zip(texts, folds):
            if chosen(f):
                padded = ["<s>"] * (order - 1) + t
                for i in range(len(t)):
                    for k in range(1, order + 1):
                        g = tuple(padded[i + order - k:i + order])
                        grams[k][g] += 1
                        contexts[k][g[:-1]] += 1
        return grams, contexts

    def estimates(model, t, i):
        grams, contexts = model
        padded = ["<s>"] * (order - 1) + t
        probs, bucket = [], 0
        for k in range(1, order + 1):
            g = tuple(padded[i + order - k:i + order])
            c = contexts[k][g[:-1]]
            probs.append(grams[k][g] / c if c else 0.0)
            bucket = int(math.log2(c + 1)) if k == order and order > 1 else 0
        return bucket, probs

    part, full = counted(lambda f: f not in (0, 1)), counted(lambda f: f != 1)
    events = Counter()
    for t, f in zip(texts, folds):
        if f == 0:
            for i in range(len(t)):
                bucket, probs = estimates(part, t, i)
                events[bucket, tuple(-1 if p == 0 else round(-octave * math.log2(p)) for p in probs)] += 1
    steps = np.array([s for _, s in events]).reshape(-1, order)
    weights = lm.weights_of(np.array([b for b, _ in events]), steps, np.array(list(events.values())),
                            1 / (len(part[0][1]) + 1), octave)
    n, v = sum(full[0][1].values()), len(full[0][1])
    out = []
    for (key, _), t, f in zip(rows, texts, folds):
        score = base = 0.0
        for i, w in enumerate(t):
            bucket, probs = estimates(full, t, i)
            mix = weights.get(bucket, weights[-1])
            score += math.log10(mix[0] / (v + 1) + sum(a * b for a, b in zip(mix[1:], probs)))
            base += math.log10((full[0][1][(w,)] + 0.5) / (n + 0.5 * (v + 1)))
        out.append((key, f == 1, len(t), sum(full[0][1][(w,)] > 0 for w in t), n, base, score))
    return sorted(out)


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(documents, order, monkeypatch):
    rows = corpus()
    got = sorted(tuple(r) for r in lm.interpolated_scores(documents(rows), order).collect())
    for a, b in zip(got, brute(rows, order), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-6, abs_tol=1e-9), (a, b)
    held = [r for r in got if r[1] and 5 < r[2] < 1000]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # the mixture beats the unigrams on unseen texts


def test_nothing_to_learn_from(documents):
    assert lm.interpolated_scores(documents([])).collect() == []
    only_test = [(k, "a b") for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1]
    got = lm.interpolated_scores(documents(only_test)).collect()
    assert len(got) == len(only_test) and all(r["score"] == 0 and r["n_known"] == 0 and r["held_out"] for r in got)


def test_weights_are_learned_from_events():
    # Bucket 3 always finds its bigram likely, bucket 0 never has one.
    events = [(3, [40, 2], 1000), (0, [16, -1], 500)]
    w = lm.learn_weights(events, 2, 1e-4)
    assert w[3][2] > 0.9 and w[0][1] > 0.9 and all(abs(sum(x) - 1) < 1e-9 for x in w.values())


def test_grams_do_not_cross_texts():
    flat = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    keys = lm.grams(flat, np.array([3, 3]), 3)
    assert all((k[:3] == k[3:]).all() for k in keys)
    assert len({int(x) for k in keys for x in k[:3]}) == 9
    seen = defaultdict(set)
    for b, edges in ((5, lm._bucket_edges(np.sort(keys[0]), 5)),):
        seen[b] = set(edges.tolist())
        assert edges[0] == 0 and edges[-1] == 6


def test_no_group_gathers_all_chunks_and_buckets_follow_the_bytes(documents, monkeypatch):
    # Many small chunks and buckets: the scores are the same, and every bucket is a range of keys of one order.
    rows = corpus()
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 4_000)
    kept = []
    real = lm.written
    monkeypatch.setattr(lm, "written", lambda df, label: kept.append(real(df, label)) or kept[-1])
    got = sorted(tuple(r) for r in lm.interpolated_scores(documents(rows), 3).collect())
    for a, b in zip(got, brute(rows, 3), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[6], b[6], rel_tol=1e-6, abs_tol=1e-9), (a, b)
    per_level = {r["level"]: r["n"] for r in kept[0].where("chunk = -1").groupBy("level").agg({"*": "count"})
                 .withColumnRenamed("count(1)", "n").collect()}
    assert set(per_level) == {1, 2, 3} and per_level[3] > 8


def test_answers_of_other_keys_are_refused():
    import pyarrow as pa

    texts = pa.table({"text": pa.array(["a b"])})
    flat, lengths = lm.tokens(texts["text"].combine_chunks())
    keys = np.unique(flat * 0 + lm.grams(flat, lengths, 1)[0])
    n = lm._planes(np.ones(len(keys), "<u4"))

    def answer(checksum):
        return pa.table({"level": [1], "bucket": [0], "n": [n], "wide": [False], "checksum": [checksum]})

    lengths, found = lm._counts(texts, answer(lm._checksum(keys)), 1, 5)
    assert lengths.tolist() == [3] and found[0][0].tolist() == [1.0, 1.0, 1.0]
    with pytest.raises(RuntimeError, match="scanned alike"):
        lm._counts(texts, answer(lm._checksum(keys) ^ 1), 1, 5)


def test_packed_numbers_and_distinct_keys_round_trip():
    rng = np.random.default_rng(3)
    near = np.uint64(7 << 50) + rng.integers(0, 40, 500).astype(np.uint64)  # keys that only their low bits tell apart
    for keys in (rng.integers(0, 2**64, 3000, dtype=np.uint64), near, np.repeat(near[:3], 50), np.zeros(0, np.uint64),
                 np.array([2**64 - 1, 0, 2**64 - 1], np.uint64)):
        distinct, inverse = lm._distinct(keys)
        assert (distinct == np.unique(keys)).all() and (distinct[inverse] == keys).all()
        assert (lm._keys(lm._packed_keys(distinct)) == distinct).all()
    for kind in ("<u4", "<u8"):
        n = rng.integers(0, 2**31, 100).astype(kind)
        assert (lm._numbers(lm._planes(n), kind) == n).all()
    assert len(lm._numbers(lm._planes(np.zeros(0, "<u4")), "<u4")) == 0


def test_coarse_steps_equal_brute_force_and_cost_little(documents):
    rows = corpus()
    coarse = sorted(tuple(r) for r in lm.interpolated_scores(documents(rows), 3, octave=2).collect())
    for a, b in zip(coarse, brute(rows, 3, 2), strict=True):
        assert a[:5] == b[:5] and math.isclose(a[6], b[6], rel_tol=1e-6, abs_tol=1e-9), (a, b)
    held = [sum(r[6] for r in x if r[1] and r[2] < 1000) for x in (coarse, brute(rows, 3))]
    assert abs(held[0] - held[1]) < 0.005 * abs(held[1])  # likelihood of unseen texts, against eight steps an octave
