"""Decontamination: planted items are found, verbatim and reworded; clean documents stay."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from circulation.llm import decontam


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=25), st.lists(st.integers(0, 5), min_size=1, max_size=15))
def test_bit_parallel_lcs(a, item):
    table = [[0] * (len(item) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(item):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    places = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << k
    assert decontam.lcs_length(a, places, len(item)) == table[-1][-1]


def corpus():
    rng = random.Random(12)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ta", "si", "vo", "pe", "du", "gi", "ha", "zo")]
    words = words + [w + v for w in words for v in ("n", "r", "st", "lle")]
    weights = [1 / (i + 3) for i in range(len(words))]
    text = lambda n: rng.choices(words, weights, k=n)
    items = [(i, text(n)) for i, n in enumerate([15, 16, 20, 31, 32, 33, 47, 59, 59, 40])]
    docs, want = [], set()
    for i in range(160):
        w = text(rng.choice([3, 40, 300]))
        if i % 4 == 0:
            k, item = items[(i // 4) % len(items)]
            at = rng.randrange(len(w) + 1)
            new = list(item)
            if i % 8 == 0:  # reworded, but for the answer
                for _ in range(len(item) // 6):
                    new[rng.randrange(len(item) - decontam.ANSWER)] = "quux"
            w[at:at] = new
            want.add((i, k))
        docs.append((i, " ".join(x.capitalize() + "," if rng.random() < 0.1 else x for x in w)))
    return docs, [(k, " ".join(w)) for k, w in items], want


def test_planted_items_are_found_and_clean_ones_stay(documents, cluster):
    docs, items, want = corpus()
    docs += [(900, None), (901, ""), (902, " \n"), (903, "?? !!"), (0, docs[0][1]), (905, "ka " * 40_000)]
    benchmark = cluster.createDataFrame(items + [(50, None), (51, ""), (60, items[3][1])], "item_id long, text string")
    table = documents(docs, {"leaks": F.lit(3), "word_ids": F.lit("w")})
    got = decontam.marked(table, benchmark)
    assert got.columns == [c for c in table.columns if c != "leaks"] + ["leaks"]
    rows = got.select("doc_id", "word_ids", F.col("leaks.item_id").alias("items")).collect()
    assert len(rows) == len(docs) and rows[0]["word_ids"] == "w"
    found = {(r["doc_id"], k) for r in rows for k in r["items"]}
    want |= {(d, 60) for d, k in want if k == 3}
    assert found == want
    kept = {r["doc_id"] for r in decontam.decontaminated(table, benchmark).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_paraphrases_of_every_share_that_the_rule_accepts_are_found(documents, cluster):
    rng = random.Random(4)
    words = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ne", "ru") for b in ("ta", "si", "vo", "pe") for c in ("du", "gi", "ha", "zo", "x")]
    weights = [1 / (i + 3) for i in range(len(words))]
    text = lambda n: rng.choices(words, weights, k=n)
    items = [text(n) for n in (9, 12, 20, 25, 28, 30, 32, 40, 55)]
    docs, want = [], set()
    for i in range(270):
        k, share = i % len(items), (0.62, 0.7, 0.85)[i % 27 // 9]
        new = list(items[k])
        body = len(new) if share >= decontam.VERBATIM else len(new) - decontam.ANSWER  # the answer stays in a paraphrase
        for at in rng.sample(range(body), min(body, int((1 - share) * len(new)))):
            new[at] = "quux" if i % 2 else text(1)[0]
        docs.append((i, " ".join(text(60) + new + text(60))))
        want.add((i, k))
    benchmark = cluster.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows = decontam.marked(documents(docs), benchmark).select("doc_id", F.col("leaks.item_id").alias("items")).collect()
    assert not want - {(r["doc_id"], k) for r in rows for k in r["items"]}


def test_short_items_need_all_words_in_a_run(documents, cluster):
    benchmark = cluster.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = documents([(1, "x Alpha beta, gamma y"), (2, "alpha x beta gamma"), (3, "gamma beta alpha")])
    assert [r["doc_id"] for r in decontam.decontaminated(docs, benchmark).orderBy("doc_id").collect()] == [2, 3]


def test_copies_of_short_items_are_found_through_punctuation_and_any_space(documents, cluster):
    rng = random.Random(9)
    common = ["the", "of", "what", "is", "a", "in", "and", "to"]
    short = [rng.choices(common + [f"w{n}"], k=n - 1) + [f"w{n}"] for n in range(1, 9)]
    items = [(n, " ".join(w)) for n, w in enumerate(short, 1)] + [
        (20, "What is 3 * 4 ?"), (21, "one / two - three & four | five six seven eight nine ten eleven"),
        (22, "le\u00a0chat dort\u3000ici"), (23, "quel est son nom ?"), (24, "* ?")]
    noise = lambda n: rng.choices(common, k=n)
    docs = [(k, " ".join([*noise(40), *t.split(), *noise(40)])) for k, t in items]
    docs += [(120, "so What is 3 * 4 ? then"), (121, "x one two quux quux quux quux seven eight * nine ten / eleven"),
             (122, "x le chat dort ici"), (123, "Quel est son\u00a0nom\u00a0?"), (220, "what is 3 times 4"), (221, "- ?")]
    benchmark = cluster.createDataFrame(items, "item_id long, text string")
    rows = decontam.marked(documents(docs), benchmark).select("doc_id", "leaks").collect()
    found = {(r["doc_id"], x["item_id"]): x for r in rows for x in r["leaks"]}
    assert {(k, k) for k, _ in items if k != 24} | {(k + 100, k) for k in range(20, 24)} <= set(found)
    assert not {(220, 20)} & set(found) and not any(24 in pair for pair in found) and not any(d == 221 for d, _ in found)
    far = decontam.marked(documents([(1, "- * " * 30 + "Quel est son nom")]), benchmark).first()["leaks"]
    assert [(x["item_id"], x["word_offset"]) for x in far] == [(23, 60)]


def test_empty_sides(documents, cluster):
    none = cluster.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminated(documents([(1, "a b")]), none).count() == 1
    some = cluster.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontam.marked(documents([]), some).collect() == []


def test_windows_add_adjacent_halves_of_one_text():
    lengths = np.array([40, 0, 5])
    starts, number = decontam.halves(lengths)
    assert starts.tolist() == [0, 16, 32, 40] and number.tolist() == [0, 1, 2, 0]
    sums = np.arange(4, dtype=np.float32)[:, None]
    assert decontam.windows(sums, number)[:, 0].tolist() == [1, 3, 2, 3]
