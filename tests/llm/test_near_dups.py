"""Near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from circulation.llm import minhash
from circulation.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, threshold=80):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    out = []
    for i, (k, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else k
        out.append((k, len(sets[i]), c, k == c))
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 80, 200]))]
        for _ in range(rng.choice([1, 3, 9])):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows) * 7 % 101, " ".join(w)))
    shared = " ".join(rng.choice(vocabulary) for _ in range(40))
    rows += [(200 + i, shared + " " + " ".join(rng.choice(vocabulary) for _ in range(25 + i))) for i in range(15)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "One  two\x0bTHREE"), (304, "one two three"), (305, "É é"),
             (306, "é é"), (307, "x " * 30_000), (308, "x " * 30_001), (None, shared), (309, shared), (309, shared)]
    return rows


def test_components_equal_brute_force(documents):
    rows = corpus()
    for n in (4, 5):
        got = minhash.near_duplicates(documents(rows, {"node": F.lit("x"), "bits": F.lit(1)}), n=n).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, n)


def test_small_blocks_lose_no_link(documents):
    rows = corpus()
    got = minhash.near_duplicates(documents(rows), n=4, block=2).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 4)


def test_empty_table_and_dedupe(documents):
    assert minhash.near_duplicates(documents([])).collect() == []
    rows = [(3, "a b c d e f g"), (1, "A b c d e f g"), (2, "z"), (2, "z"), (4, None), (None, "q r s")]
    kept = minhash.dedupe(documents(rows)).select("doc_id", "text").collect()
    assert sorted((tuple(r) for r in kept), key=repr) == sorted(
        [(1, "A b c d e f g"), (2, "z"), (4, None), (None, "q r s")], key=repr)


def test_estimate_is_corrected_for_chance(cluster):
    rng = np.random.default_rng(1)
    rows, truth = [], []
    for j in (0.0, 0.3, 0.6, 0.8, 0.95):
        common = rng.integers(0, 1 << 63, int(2000 * j), dtype=np.uint64)
        own = (2000 - len(common)) // 2
        sides = [np.concatenate([common, rng.integers(0, 1 << 63, own, dtype=np.uint64)]) for _ in range(2)]
        rows.append(tuple(minhash.packed_bits(minhash.minima(s), 2).tolist() for s in sides))
        truth.append(len(common) / (len(common) + 2 * own))
    df = cluster.createDataFrame(rows, "a array<long>, b array<long>").select(minhash.estimate("a", "b").alias("e"))
    for e, j in zip((r["e"] for r in df.collect()), truth):
        assert abs(e - j) < 0.2


def test_words_split_at_the_six_ascii_spaces():
    flat, ends = minhash.words(pa.array(["  A b\x0b\x0cC\r\n", None, "x y z\x1f"]))
    assert flat.to_pylist() == ["a", "b", "c", "x y", "z\x1f"] and ends.tolist() == [0, 3, 3, 5]


def test_components_of_chains_and_stars(cluster):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = components(cluster.createDataFrame(edges, "a long, b long"), "test-cc").collect()
    assert {(r["node"], r["root"]) for r in got} == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 160)}


def test_a_group_of_near_copies_yields_no_pair_that_is_no_link(documents, monkeypatch):
    """Near copies just under the threshold: what the rest's joins put out grows with the group, not with its square."""
    plain, seen = minhash.written, {}

    def counted(df, label, *rest):
        out = plain(df, label, *rest)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(minhash, "written", counted)
    sizes = []
    for n_docs in (150, 300):
        rng = random.Random(11)
        base = [f"b{i}" for i in range(120)]
        rows = []
        for i in range(n_docs):
            words = list(base)
            for at in rng.sample(range(120), 4):
                words[at] = f"own{i}x{at}"
            rows.append((i, " ".join(words)))
        seen.clear()
        got = minhash.near_duplicates(documents(rows), n=4).collect()
        assert sorted((tuple(r) for r in got), key=repr) == brute(rows, 4)
        links = sum(1 for i in range(n_docs) for j in range(i) if similar(rows[i][1], rows[j][1], 4))
        assert seen.get("minhash-more", 0) <= links
        sizes.append(seen.get("minhash-live", 0))
    assert sizes[1] <= 3 * max(sizes[0], 1) + 300


def similar(a, b, n):
    a, b = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} for w in (a.split(), b.split()))
    return 100 * len(a & b) >= 80 * len(a | b)
