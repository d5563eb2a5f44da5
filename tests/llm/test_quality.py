"""Quality rules: base statistics and the robust estimates against plain Python and numpy."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from circulation.llm import quality

WORD, SYMBOL = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[#*$%&|<>]")


def statistics(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {p for k in range(len(w) - 2) if grams[w[k], w[k + 1], w[k + 2]] > 1 for p in (k, k + 1, k + 2)}
    return (len(w), sum(map(len, w)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)), len(covered), len(lines))


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(360):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.choice([2, 4, 5, 6, 8]))) for _ in range(rng.choice([55, 90, 200]))]
        if i % 12 == 0:
            words = [w.upper() + "!!###" for w in words]
        if i % 15 == 0:
            words = words[:20] * 5
        sep = "\n" if i % 4 == 0 else " "
        rows.append((i, sep.join(words), ["en", "de", None][i % 3], "hot" if i % 5 else "cold"))
    return rows + [(900, None, "en", "hot"), (901, "", "en", "hot"), (902, " \n\t", "xx", None), (903, "a b c a b c", "en", "hot"),
                   (904, "é ÉÉ\x0bz|w\u00a0q\n\né ÉÉ\x0bz|w\u00a0q", "fr", "x"), (905, "w " * 20_000, "en", "hot"), (5, rows[5][1], "de", "hot")]


def robust(rows):
    """The same estimates in numpy: {row: (d2, kept)} of the rows that pass the base rules."""
    d = len(quality.VECTOR)
    floor = np.diag(np.square(quality.LEAST_SPREAD))
    groups = {}
    for i, (_, text, lang, source) in enumerate(rows):
        n, chars, symbols, dup, rep, lines = statistics(text)
        if n < 50 or 100 * rep > 50 * n:
            continue
        v = [math.log(max(chars / n, 1)), math.log1p(symbols / n), dup / max(lines, 1), rep / n]
        groups.setdefault((lang, source), []).append((i, [math.floor(x * 4096 + 0.5) / 4096 for x in v]))
    out = {}
    for members in groups.values():
        x = np.array([v for _, v in members])
        low, mid, high = ([np.sort(x[:, j])[math.ceil(len(x) * q) - 1] for j in range(d)] for q in (0.25, 0.5, 0.75))
        mean, cov = np.array(mid), np.diag(((np.array(high) - low) / 1.349) ** 2) + floor
        far = lambda: np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)  # noqa: E731, B023
        for step in range(quality.STEPS + 1):
            d2 = far()
            if step < quality.STEPS:
                classes = np.floor(np.log1p(d2) * 64)
                share, cut = quality.SUBSET, np.sort(classes)[math.ceil(len(x) * quality.SUBSET) - 1]
                inside = classes <= cut
            else:
                share, inside = 0.975, d2 <= quality.chi_square_quantile(0.975, d)
            if not inside.any():
                break
            mean = x[inside].mean(axis=0)
            cov = np.cov(x[inside].T, bias=True) * quality.consistency(share, d) + floor
        for (i, _), z in zip(members, far()):
            out[i] = (z, z <= quality.chi_square_quantile(quality.QUANTILE, d))
    return out


def test_statistics_and_verdicts(documents):
    rows = corpus()
    docs = documents(rows, {"N_Words": F.lit(7), "d2": F.lit("x")}).withColumn("place", F.monotonically_increasing_id())
    got = quality.verdicts(quality.with_statistics(docs)).collect()
    assert len(got) == len(rows)
    wanted = robust(rows)
    by_text = {}
    for i, (key, text, lang, source) in enumerate(rows):
        by_text[key, text, lang, source] = (statistics(text), wanted.get(i))
    rejected = 0
    for r in got:
        stats, verdict = by_text[r["doc_id"], r["text"], r["lang"], r["source"]]
        assert tuple(r[c] for c in quality.STATISTICS) == stats
        assert r["base_failed"] == (verdict is None)
        assert r["kept"] == bool(verdict and verdict[1])
        if verdict:
            assert math.isclose(r["d2"], verdict[0], rel_tol=1e-6, abs_tol=1e-9)
            rejected += not verdict[1]
    assert rejected >= 20


def test_kept_rows_keep_their_columns(documents):
    docs = documents(corpus(), {"n_words": F.lit("mine")})
    kept = quality.keep_quality(docs)
    assert kept.columns == docs.columns and kept.first()["n_words"] == "mine"
    assert quality.keep_quality(documents([])).collect() == []


def test_chi_square_values():
    assert abs(quality.chi_square_quantile(0.975, 4) - 11.1433) < 1e-3
    assert abs(quality.chi_square_quantile(0.95, 2) - 5.9915) < 1e-3
