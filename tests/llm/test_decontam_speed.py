"""op9's shorter ways give what the plain ones give, and leave out what they say."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from circulation.llm import decontam


def test_words_are_cleaned_as_one_by_one():
    found = ["Word", "(Word).", "…ÉTÉ»", "ΣΊΣΥΦΟΣ", "İstanbul", "--", "", "a-b", "«x", "日本", "\x00Q", "'IT'S'", "ẞ."]
    assert decontam.cleaned_words(pa.array(found, pa.large_string())) == [decontam.clean(w) for w in found]
    assert decontam.cleaned_words(pa.array([], pa.large_string())) == []


def test_half_sums_are_those_of_every_half():
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((50, 7)).astype(np.float32)
    half = np.repeat(np.arange(42), rng.integers(0, decontam.HALF + 1, 42))
    known = rng.integers(0, 50, len(half))
    heads = np.flatnonzero(np.diff(half, prepend=-1))
    want = np.zeros((42, 7), np.float32)
    want[half[heads]] = np.add.reduceat(rows[known], heads, axis=0)
    assert (decontam.half_sums(known, half, 42, rows) == want).all()
    assert decontam.half_sums(known[:0], half[:0], 3, rows).tolist() == [[0.0] * 7] * 3
    assert decontam.half_sums(known[:0], half[:0], 0, rows).shape == (0, 7)


def test_bound_over_blocks_loses_no_likely_candidate_and_drops_most():
    rng = np.random.default_rng(5)
    listed = [(i, rng.integers(0, 400, 30).tolist()) for i in range(300)]  # more items than are counted at once
    items = decontam.Items(listed, rng.standard_normal((400, 8)).astype(np.float32))
    ids = rng.integers(-1, 400, 1003).astype(np.int32)
    for i in range(0, 300, 20):
        ids[3 * i:3 * i + 30] = listed[i][1]
    lo = rng.integers(0, 960, 3000)
    of, hi = rng.integers(0, 300, 3000), np.minimum(lo + rng.integers(0, 90, 3000), len(ids))
    for i in range(0, 300, 20):
        of[i], lo[i], hi[i] = i, 3 * i, 3 * i + 30
    none = np.zeros(0, np.int64)
    likely = set(np.flatnonzero(items.likely(ids, of, lo, hi, none)).tolist())
    kept = items.possible(ids, of, lo, hi)
    assert likely and likely <= set(kept.tolist()) and len(kept) < 600
    assert items.possible(ids, none, none, none).tolist() == []
    items.table = None
    assert len(items.possible(ids, of, lo, hi)) == 3000


def test_longest_common_run_is_not_sought_where_words_are_missing(monkeypatch):
    items = decontam.Items([(1, list(range(20)))], np.ones((40, 4), np.float32))
    monkeypatch.setattr(decontam, "lcs_length", lambda *_: 1 / 0)
    assert items.confirm(0, np.array([*range(8), *[0] * 30, -1], np.int32)) is None


def test_ids_are_those_of_clean_words():
    found = ["Word", "(Word).", "…ÉTÉ»", "été", "ΣΊΣΥΦΟΣ", "İstanbul", "--", "", "«»", "a-b", "Kelvin", "kelvin", "unknown", "日本"]
    vocabulary = {decontam.clean(w): 7 * k for k, w in enumerate(["WORD", "été", "ΣΊΣΥΦΟΣ", "İstanbul", "kelvin", "a-b"])}
    want = [vocabulary.get(decontam.clean(w), -1) if decontam.clean(w) else decontam.NO_WORD for w in found]
    assert decontam.ids_of(pa.array(found, pa.large_string()), vocabulary).tolist() == want
    assert decontam.ids_of(pa.array([], pa.large_string()), vocabulary).tolist() == []
    assert decontam.ids_of(pa.array(["a", "."], pa.large_string()), {}).tolist() == [-1, decontam.NO_WORD]


def test_runs_are_found_as_by_looking_at_every_place():
    rng = np.random.default_rng(8)
    runs = [(tuple(rng.integers(0, 12, n).tolist()), i, k) for n in (1, 2, 3, 3, 5) for i in range(9) for k in range(3)]
    ids, text = rng.integers(-1, 12, 900), np.sort(rng.integers(0, 30, 900))
    want = sorted((at, item, at - start) for words, item, start in runs for at in range(len(ids) - len(words) + 1)
                  if tuple(ids[at:at + len(words)]) == words and text[at] == text[at + len(words) - 1])
    got = decontam.Runs(runs, 12).places(ids, text)
    assert want and sorted(zip(*got.tolist())) == want
    assert decontam.Runs(runs, 12).places(ids[:0], text[:0]).shape == (3, 0)
    assert decontam.Runs([], 12).places(ids, text).shape == (3, 0)


def test_only_kept_columns_go_through_the_search(spark, monkeypatch):
    item = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, f"x y {item} z", "a"), (2, "nothing here", "b"), (3, None, "c")], "doc_id long, text string, source string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    kept, plain = [], decontam.written
    monkeypatch.setattr(decontam, "written", lambda df, label: kept.append(df.columns) or plain(df, label))
    some = decontam.marked(docs, bench, keep=["doc_id"])
    full = decontam.marked(docs, bench)
    assert some.columns == ["doc_id", "leaks"] and full.columns == ["doc_id", "text", "source", "leaks"]
    assert kept == [["doc_id", "word_ids"], ["doc_id", "text", "source", "word_ids"]]
    assert sorted(some.collect()) == sorted(full.select("doc_id", "leaks").collect())
    assert [r["doc_id"] for r in some.where("size(leaks) = 1").collect()] == [1]
    assert decontam.marked(docs, bench.where("false"), keep=["doc_id"]).columns == ["doc_id", "leaks"]
