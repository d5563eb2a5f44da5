"""Ranked search against brute force over all pairs: order, ties, nulls, blocks of items and pruned buckets."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from circulation.llm import ranked_search as rs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text):
    return [re.sub("[A-Z]", lambda x: x[0].lower(), w) for w in TERM.findall(text or "")]


def brute(docs, items, k):
    """Rows (item row, item id, rank, doc id, score) as the ranking defines them, in Python's integers."""
    terms = [(i, cut(t)) for i, t in docs]
    terms = [(i, Counter(w), len(w)) for i, w in terms if w]
    n, total = len(terms), sum(x[2] for x in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for row, (item, text) in enumerate(items):
        found = []
        for i, c, size in terms:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(cut(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def corpus(seed, n_docs, n_items):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Ünï", "A1", "über", "the", "THE"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rng.choice([" ", ", ", "\n\t"]).join(rng.choices(words, odds, k=rng.choice([1, 3, 20, 200])))) for i in range(n_docs)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 8, 30])))) for i in range(n_items)]
    return docs, items


def search(cluster, documents, docs, items, k, **extra):
    table = documents(docs, **extra).repartition(5)
    bench = cluster.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in rs.ranked_search(table, bench, k=k).collect()), key=repr)


@pytest.mark.parametrize("bucket,block", [(4096, 8 << 20), (16, 600)])
def test_equals_brute_force(cluster, documents, monkeypatch, bucket, block):
    monkeypatch.setattr(rs, "BUCKET", bucket)
    monkeypatch.setattr(rs, "BLOCK_BYTES", block)
    docs, items = corpus(3, 700, 25)
    docs += [(10_000 + i, docs[5][1]) for i in range(150)]  # copies: ties at every cut
    assert search(cluster, documents, docs, items, 7) == brute(docs, items, 7)


def test_nulls_empties_repeats_ties_and_clashing_columns(cluster, documents):
    docs = [(1, None), (2, ""), (3, " .,-\x7f"), (4, "alpha beta"), (4, "alpha beta"), (None, "alpha beta"), (5, "Alpha" * 1),
            (6, "x " * 30_000 + "alpha"), (7, "Äpfel a_b"), (8, "äpfel")]
    items = [(1, "ALPHA gamma"), (1, "alpha"), (2, None), (None, "b äpfel"), (3, "... !"), (4, "Äpfel beta beta")]
    from pyspark.sql import functions as F

    extra = {c: F.lit("z") for c in ("q", "score", "terms", "n", "length", "rank", "tie", "place", "bytes")}
    got = search(cluster, documents, docs, items, 50, extra=extra)
    assert got == brute(docs, items, 50) and {r[0] for r in got} == {1, 4, None}


def test_empty_tables(cluster, documents):
    assert search(cluster, documents, [], [(1, "a")], 5) == []
    assert search(cluster, documents, [(1, "a b")], [], 5) == []
    assert search(cluster, documents, [(1, None)], [(1, "a")], 5) == []


def test_lengths_beyond_64_bits():
    import numpy as np

    c = rs.Collection(10**11, 10**14, np.ones(1, np.int64))
    n = np.array([1, 20_000_000], np.int64)
    assert rs._lengths(n, c).tolist() == [50 + 50 * int(v) * c.n_docs // c.n_terms for v in n]


def test_terms_are_those_of_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(128), rng.randrange(128, 0x2000), 0x1F600])) for _ in range(60))
        assert [w.decode() for w in rs.terms_of(text.encode())] == cut(text)


def test_buckets_are_pruned():
    """A search whose floors stand high reads few rows exactly: short vectors' buckets are skipped whole."""
    import numpy as np

    weights = np.array([1000, 10], np.int64)
    search = rs._Search([[0, 1]], weights, 2, np.array([500_000_000], np.int64))
    calls = []
    search._item = lambda *a: calls.append(a)
    one = np.array([0], np.int64)
    for length in (1e9, 1.0):
        search.bucket(one, one.astype(bool), np.array([length]), one, one, np.array([900_000], np.int64))
    assert len(calls) == 1
