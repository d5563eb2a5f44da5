"""The toxicity network: gradients against differences, windows against a plain reading, held-out accuracy, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from circulation.llm import queries
from circulation.llm import toxicity as tx


def small_model(seed=3):
    model = tx.Model.fresh({b"aa": 1, b"bc": 2}, 0.1, seed)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    return model


def test_gradients_equal_differences():
    model, rng = small_model(), np.random.default_rng(1)
    words = [b"aa", b"bc", b"long-word".replace(b"-", b""), "é".encode()]
    word_rows, (flat, firsts) = np.array([1, 2, 0, 0]), tx.char_grams(words)
    sizes = np.diff(np.append(firsts, len(flat)))
    ids, mask = rng.integers(0, 4, (6, 5)), np.ones((6, 5), bool)
    mask[4:, 0] = mask[1:, 1] = False
    labels = np.array([1, 0, 1, 0, 1])

    def loss():
        logit, _ = model.forward(model.gates(model.inputs(word_rows, flat, firsts)), ids, mask)
        return float(np.mean(np.logaddexp(0, logit) - labels * logit))

    x = model.inputs(word_rows, flat, firsts)
    logit, kept = model.forward(model.gates(x), ids, mask, keep=True)
    grad, d_gates = model.backward((tx._sigmoid(logit) - labels) / 5, kept, ids, mask, 4)
    grad |= tx.input_gradients(model, x, d_gates, word_rows, flat, sizes)
    for name, values in model.p.items():
        touched = np.flatnonzero(grad[name])
        for k in rng.choice(touched, min(6, len(touched)), replace=False):
            at, kept_value = np.unravel_index(k, values.shape), values.flat[k]
            values.flat[k] = kept_value + 1e-3
            up = loss()
            values.flat[k] = kept_value - 1e-3
            down = loss()
            values.flat[k] = kept_value
            assert abs((up - down) / 2e-3 - grad[name][at]) < 3e-4, (name, at)


def plain_score(model, words):
    """The highest window, each read on its own, word by word."""
    starts = [0] if len(words) <= tx.WINDOW else list(range(0, len(words) - (tx.WINDOW - tx.STRIDE), tx.STRIDE))
    best = None
    for s in starts:
        part = words[s:s + tx.WINDOW]
        flat, firsts = tx.char_grams(part)
        rows = np.array([model.known.get(w, 0) for w in part])
        logit, _ = model.forward(model.gates(model.inputs(rows, flat, firsts)), np.arange(len(part))[:, None], np.ones((len(part), 1), bool))
        p = 1 / (1 + np.exp(-float(logit[0])))
        best = max(best or (-1, 0), (p, -s))
    return best[0], -best[1]


@pytest.mark.parametrize("piece,cache", [(60_000, 150_000), (48, 40)])
def test_scores_equal_windows_read_one_by_one(monkeypatch, piece, cache):
    monkeypatch.setattr(tx, "PIECE", piece)
    monkeypatch.setattr(tx, "CACHE", cache)
    model, rng = small_model(), random.Random(2)
    model.trained = True
    texts = [" ".join(rng.choice(["aa", "bc", f"w{rng.randrange(60)}", "Ünï"]) for _ in range(n)) for n in
             [1, 2, 31, 32, 33, 40, 41, 55, 56, 57, 80, 200, 500, 1000]] + ["", " .!", "aa"]
    got = list(tx.Scorer(model, at_once=7).texts(t.encode() for t in texts))
    for text, (score, start) in zip(texts, got):
        words = [w for part in tx.words_of(text.encode()) for w in part]
        if not words:
            assert (score, start) == (0.1, None)
            continue
        want, _ = plain_score(model, words)
        assert abs(score - want) < 1e-5
        assert abs(plain_score(model, words[start:start + tx.WINDOW])[0] - want) < 1e-5


def test_every_word_lies_in_a_window():
    for n in range(1, 400):
        starts = tx.window_starts(n)
        covered = {i for s in starts for i in range(s, min(s + tx.WINDOW, n))}
        assert covered == set(range(n)) and all(np.diff(starts) == tx.STRIDE) and max(starts) < n


def test_long_texts_are_cut_between_words(monkeypatch):
    words = [b"w%d" % (i % 977) for i in range(400_000)]
    got = [w for part in tx.words_of(b" ".join(words)) for w in part]
    assert got == words
    assert len(list(tx.pieces_of(b" ".join(words)))) > 1


def test_held_out_accuracy(cluster):
    """All of sf0.1: labels of held-out rows are met, and clean rows left alone."""
    got = queries.op13_gated_toxicity(cluster, "/root/testdata/sf0.1")
    labels = queries.table(cluster, "/root/testdata/sf0.1", "labels").select("doc_id", "toxic")
    rows = got.where("held_out").join(labels, "doc_id").select("doc_id", "score", "predicted", "toxic").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.04 * len(clean)
    assert got.count() == queries.table(cluster, "/root/testdata/sf0.1", "documents").count()


def test_edge_cases(cluster, documents):
    rng = random.Random(6)

    def sentence(*inside):
        words = rng.choices("a river runs past the garden and you sing of stones in spring".split(), k=rng.randrange(1, 60))
        words[rng.randrange(len(words)):0] = inside
        return " ".join(words)

    clean, bad = [(i, sentence()) for i in range(90)], [(100 + i, sentence("zounds")) for i in range(90)]
    toxic = sentence("zounds")
    odd = [(None, toxic), (1000, None), (1001, ""), (1002, "..."), (1003, toxic), (1003, toxic), (1004, "river stones " * 50_000 + toxic)]
    docs = documents(clean + bad + odd, extra={"score": F.lit("x"), "order": F.lit(1), "toxic": F.lit(9)})
    marks = [(i, 0) for i, _ in clean] + [(i, 1) for i, _ in bad] + [(7, None), (None, 1), (1001, 0)]
    labels = cluster.createDataFrame(marks, "doc_id long, toxic int").withColumn("text", F.lit("mine"))
    model = tx.train(docs, labels)
    rows = tx.score(docs, model).collect()
    assert len(rows) == len(clean + bad + odd)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[1000] == by_id[1001] == by_id[1002] == model.prior and 0.4 < model.prior < 0.55
    assert min(by_id[i] for i in (None, 1003, 1004)) >= 0.5 and max(by_id[i] for i, _ in clean) < 0.5
    assert tx.score(docs.where("false"), model).collect() == []
    untaught = tx.train(docs, labels.where("false"))
    assert {r["score"] for r in tx.score(docs, untaught).collect()} == {0.0}
    one = tx.train(docs, labels.where("toxic = 1"))
    assert {r["score"] for r in tx.score(docs, one).collect()} == {1.0}
