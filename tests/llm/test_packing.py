"""Packing, matrices and shards: exact round trips and bounds."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from circulation.llm import packing, sharding, token_matrix
from circulation.llm.tokens import Encoder, vocabulary_path

TEXTS = ["", "one", "Hello  world", "tabs\there ", " lead", "trail ", "a b\nc d", "été naïve 12,345.67!", "it's we'll x's",
         "<|endoftext|> is a token", "alpha <|endoftext|> beta", "a  <|endoftext|><|endoftext|>\n b<|endoftext|>", "<|endoftext", " odd spaces 　 here", "word " * 3000, "x" * 5000]


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def rows_of(n=60):
    rng = random.Random(3)
    words = ["the", "and", "circulation", "of", "Bücher", "x7", "—"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 40, 400, 2500])))) for i in range(n)]
    return rows + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200, None), (7, "the same"), (7, "the same"), (None, "no id")]


def test_ids_equal_the_published_tokenizer(reference):
    enc = Encoder(vocabulary_path())
    rng = random.Random(1)
    alphabet = "ab cD,.'\n\t  é1 -"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    for t in texts + texts:  # the second time from the cache
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == reference(t), t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_sweeps_place_each_piece_once(lengths):
    counts = defaultdict(int)
    for x in lengths:
        counts[x] += 1
    plan = packing.sweep_plan(dict(counts), 64)
    used = defaultdict(list)
    for rank, length in enumerate(sorted(lengths, reverse=True)):
        run = plan[np.searchsorted(plan[:, 0], rank, side="right") - 1]
        used[int(run[1] + rank - run[0])].append((int(run[2]), length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(lengths)
    assert len(used) <= max(-(-total // 64), 11 * -(-total // 64) / 9 + 1) or len(used) <= sum(x > 32 for x in lengths) + 1 + 11 * total // (64 * 9)


def check_packed(rows, pieces, reference, capacity):
    sequences = defaultdict(list)
    seen = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        seen[p["doc_id"]].append((p["piece"], p["start"], bytes(p["ids"])))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = defaultdict(list)
    for key, text in rows:
        ids = np.array(reference(text) + [2], "<u4").tobytes()
        want[key].append(ids)
    for key, texts in want.items():
        whole = b"".join(ids for _, _, ids in sorted(seen[key], key=lambda x: x[1])) if len(texts) == 1 else None
        assert whole is None or whole == texts[0]
        assert sum(len(x[2]) for x in seen[key]) == sum(map(len, texts))
        assert len(texts) > 1 or all(len(x[2]) == 4 * capacity for x in seen[key] if x[0])
    return len(sequences)


def test_best_fit_round_trip(documents, reference):
    rows = rows_of()
    docs = documents(rows, {"sequence_id": F.lit(1), "offset": F.lit("x")})
    packed = packing.best_fit_pack(packing.token_pieces(docs), ["doc_id", "piece"]).collect()
    got = check_packed(rows, packed, reference, 1024)
    assert got == len(token_matrix.pack_block([p["length"] for p in packed], 1024))


def test_packing_of_nothing_and_wrong_lengths(documents, cluster):
    assert packing.best_fit_pack(packing.token_pieces(documents([])), ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        packing.best_fit_pack(cluster.createDataFrame([(1, 2000)], "doc_id long, length long"), ["doc_id"])


def test_matrices_round_trip(documents, reference, cluster):
    rows = rows_of()
    packed = token_matrix.pack_matrices(documents(rows), capacity=256, block_tokens=20_000)
    stored = token_matrix.read_matrices(cluster, token_matrix.write_matrices(packed))
    back = defaultdict(list)
    for s in token_matrix.segments(stored).collect():
        back[s["doc_id"]].append((s["start"], bytes(s["ids"])))
    for key, text in rows:
        if key != 7:
            assert b"".join(x for _, x in sorted(back[key])) == np.array(reference(text) + [2], "<u4").tobytes()
    same = np.array(reference("the same") + [2], "<u4").tobytes()
    assert sum(x == same for _, x in back[7]) == 2
    for r in stored.collect():
        places = np.frombuffer(bytes(r["positions"]), "<u2")
        assert len(bytes(r["ids"])) == 4 * 256 and len(places) == 256 and r["cu_seqlens"][-1] == r["n_tokens"]
        for a, z in zip(r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert places[a:z].tolist() == list(range(z - a))
    assert token_matrix.pack_matrices(documents([])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80))
def test_segment_tree_is_best_fit_decreasing(lengths):
    free, want = [], []
    for i in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [f for f in free if f >= lengths[i]]
        gap = min(fits) if fits else 50
        if fits:
            free.remove(gap)
        free.append(gap - lengths[i])
        want.append(gap)
    bins = token_matrix.pack_block(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert sorted(50 - sum(lengths[i] for i in b) for b in bins) == sorted(free)


def test_shards_are_contiguous_and_balanced(documents):
    rng = random.Random(2)
    rows = [(rng.randrange(400), "é" * rng.randrange(200)) for _ in range(900)] + [(5, "z" * 9000), (None, None), (5, ""), (5, "")]
    docs = documents(rows, {"Shard": F.lit(1), "rank": F.lit(2)}).withColumn("size", sharding.row_size("text"))
    got = sharding.shard_by_bytes(docs, "size", ["doc_id", "text"], 7).collect()
    assert len(got) == len(rows) and got[0]["rank"] == 2
    shards = defaultdict(list)
    for r in got:
        shards[r["shard"]].append((r["slot"], r["doc_id"] if r["doc_id"] is not None else -1, r["size"]))
        assert r["size"] == len((r["text"] or "").encode()) + 16
    total = sum(r["size"] for r in got)
    last = -2
    for k in range(7):
        placed = sorted(shards[k])
        assert [s for s, _, _ in placed] == list(range(len(placed)))
        assert placed[0][1] >= last
        last = max(d for _, d, _ in placed)
        assert abs(sum(x for _, _, x in placed) - total / 7) <= 9016
    assert sharding.shard_by_bytes(documents([]).withColumn("size", F.lit(1)), "size", ["doc_id"], 3).collect() == []


def test_columns_of_any_name_are_kept(cluster):
    names = ["rows_total", "size_before", "size_total", "gp_n", "gp_t0", "gp_first", "gp_part", "rank", "row", "k0", "length_before"]
    from circulation.llm import sharding

    df = cluster.createDataFrame([(i, 10 + i % 3, 5, *range(i, i + len(names))) for i in range(40)],
                                 f"id long, size long, length int, {', '.join(n + ' long' for n in names)}")
    dealt = sharding.shard_by_bytes(df, "size", ["id"], 4)
    assert dealt.columns == [*df.columns, "shard", "slot"]
    packed = packing.best_fit_pack(df, ["id"], capacity=16)
    assert packed.columns == [*df.columns, "sequence_id", "offset"]
    for out in (dealt, packed):
        assert sorted(tuple(r)[:len(df.columns)] for r in out.collect()) == sorted(map(tuple, df.collect()))
    assert {r["shard"] for r in dealt.collect()} == {0, 1, 2, 3} and {r["offset"] for r in packed.collect()} == {0, 5, 10}
