"""URL verdicts: longest matching rule, else exact list membership by a Bloom filter cascade.

The cascade knows the corpus's complete key universe. Level 0 encodes the listed keys; level 1 the
unlisted keys that pass level 0; level 2 the listed keys that pass level 1; and so on until no key
passes wrongly. A key's membership follows from the first level it fails, exactly for every key of
the universe, and pages are judged without joining them to the list.

A level's bits lie in blocks of ``BLOCK_BITS``; a key's hash picks its block. Every level mixes its own
number into the hashes: two keys that share all their bits at one level part at the next, so the levels
shrink until none is left. At most
``BROADCAST_BLOCKS`` blocks are broadcast at once; a larger level is tested in several passes, each
over the keys of its blocks. Bits are gathered by a distributed OR per 64-bit word.

Defined results: a null url or one without ``://`` has an empty host and path and is judged by the
list like any other key (the empty one); an empty list blocks nothing; repeated rows each get a
verdict; an empty table gives no rows; input columns named host, path, rule or verdict are replaced, all
others kept, whatever their names. A url's length is not bounded: only its hashes are held.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from circulation.llm.common import free_name, without, written
from circulation.llm.urls import host_of, path_of

BITS_PER_KEY, HASHES = 10, 7
BLOCK_BITS = 1 << 23  # 1 MB
BROADCAST_BLOCKS = 32
MAX_LEVELS = 64


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name of the longest rule that fits the host or a parent domain and the path's start; else null."""
    found = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.lit(r.name)).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """A filter's size, and its rows (block, word, bits) of the 64-bit words that are not zero."""

    blocks: int
    block_bits: int
    number: int = 0
    words: DataFrame | None = None

    def places(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each key and, one column a hash, its bits there."""
        h1, h2 = _mixed(h1, 2 * self.number + 1), _mixed(h2, 2 * self.number + 2) | np.uint64(1)
        block = ((h1 >> np.uint64(33)) % np.uint64(self.blocks)).astype(np.int32)
        each = h1[:, None] + h2[:, None] * np.arange(HASHES, dtype=np.uint64)
        return block, ((each * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) % self.block_bits


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """The hashes scrambled by ``salt``: xor, multiply, shift, each of which loses nothing."""
    h = h.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for odd in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(odd)
    return h ^ (h >> np.uint64(31))


def _size(n: int, number: int) -> Level:
    need = max(64, n * BITS_PER_KEY)
    if need <= BLOCK_BITS:
        return Level(1, 1 << (need - 1).bit_length(), number)
    return Level(-(-need // BLOCK_BITS), BLOCK_BITS, number)


def build_level(hashed: DataFrame, label: str, number: int = 0) -> Level:
    """The filter of the keys (h1, h2): each batch's bits are gathered, then OR-ed by word."""
    size = _size(hashed.count(), number)

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            block, spots = size.places(b.column(0).to_numpy(), b.column(1).to_numpy())
            words = block[:, None].astype(np.int64) * (size.block_bits // 64) + (spots >> 6)
            order = np.argsort(words, axis=None, kind="stable")
            flat, bit = words.ravel()[order], (np.int64(1) << (spots & 63)).ravel()[order]
            heads = np.flatnonzero(np.diff(flat, prepend=-1))
            ored = np.bitwise_or.reduceat(bit, heads) if len(heads) else bit
            yield pa.RecordBatch.from_arrays([pa.array(flat[heads]), pa.array(ored)], names=["word", "bits"])

    words = hashed.select("h1", "h2").mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return Level(size.blocks, size.block_bits, number, written(words, label))


def _probe(df: DataFrame, tests: list[tuple[int, Level, int, int]], state: str) -> DataFrame:
    """One pass: ``tests`` holds (index, level, first block, blocks), in the order of the levels, under the bound."""
    spark, names = df.sparkSession, df.columns
    loaded = []
    for index, level, first, n in tests:
        per = level.block_bits // 64
        rows = level.words.where(F.col("word").between(first * per, (first + n) * per - 1)).toPandas()
        words = np.zeros(n * per, np.int64)
        words[rows["word"].to_numpy() - first * per] = rows["bits"].to_numpy()
        # Together at most BROADCAST_BLOCKS blocks of BLOCK_BITS: 32 MB.
        loaded.append((index, Level(level.blocks, level.block_bits, level.number), first, n, spark.sparkContext.broadcast(words)))
    at = [names.index(c) for c in (state, state + "_h1", state + "_h2")]

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            now, h1, h2 = (b.column(i).to_numpy() for i in at)
            now = now.copy()
            for index, level, first, n, filled in loaded:
                block, spots = level.places(h1, h2)
                here = (now < 0) & (block >= first) & (block < first + n)
                word = (block[:, None] - first).astype(np.int64) * (level.block_bits // 64) + (spots >> 6)
                word[~here] = 0
                hit = ((filled.value[word] >> (spots & 63)) & 1).all(axis=1)
                now[here & ~hit] = index % 2
            cols = list(b.columns)
            cols[at[0]] = pa.array(now)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(test, df.schema)


def is_listed(df: DataFrame, key: str, levels: list[Level], out: str = "listed", hashed: bool = False) -> DataFrame:
    """``df`` with boolean ``out``: whether the key is listed, exactly for keys of the cascade's universe.

    ``hashed``: the columns h1 and h2 hold the key's hashes already.
    A key is listed if the first level it fails is odd, or if it fails none and the last level is even.
    """
    if out.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {out} already: name another with out=")
    state = free_name([*df.columns, *[c[:-3] for c in df.columns]], "state")
    h1, h2 = (F.col("h1"), F.col("h2")) if hashed else (F.xxhash64(F.lit(1), F.col(key)), F.xxhash64(F.lit(2), F.col(key)))
    work = df.withColumns({state: F.lit(-1).cast("int"), state + "_h1": h1, state + "_h2": h2})
    groups: list[list[tuple[int, Level, int, int]]] = [[]]
    held = 0
    for index, level in enumerate(levels):
        for first in range(0, level.blocks, BROADCAST_BLOCKS):
            n = min(BROADCAST_BLOCKS, level.blocks - first)
            if groups[-1] and held + n > BROADCAST_BLOCKS:
                groups.append([])
                held = 0
            groups[-1].append((index, level, first, n))
            held += n
    for k, tests in enumerate(groups):
        work = _probe(work, tests, state)
        if k < len(groups) - 1:
            work = written(work, "cascade-pass")  # so that no task holds the bits of two passes
    last = len(levels) % 2 == 1
    decided = F.when(F.col(state) < 0, F.lit(last)).otherwise(F.col(state) == 1)
    return work.select(*df.columns, decided.alias(out))


def build_cascade(universe: DataFrame, key: str, listed: str) -> list[Level]:
    """The levels for ``universe``: its distinct keys (null counts as one) and whether each is listed."""
    hashed = universe.select(F.xxhash64(F.lit(1), F.col(key)).alias("h1"), F.xxhash64(F.lit(2), F.col(key)).alias("h2"),
                             F.col(listed).alias("listed"))
    hashed = written(hashed.distinct(), "cascade-keys")
    inside, outside = hashed.where("listed"), hashed.where("NOT listed")
    levels: list[Level] = []
    while not inside.isEmpty():
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("the cascade did not settle")
        level = build_level(inside, f"cascade-{len(levels)}", len(levels))
        wrong = is_listed(outside.drop("listed"), "h1", [level], "passes", hashed=True).where("passes").drop("passes")
        levels.append(level)
        inside, outside = written(wrong, "cascade-wrong"), inside
    return levels


def judge_urls(pages: DataFrame, rules: Sequence[Rule], levels: list[Level], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (name of the longest that fits, else null) and verdict.

    The verdict is the rule's; without a rule, ``block`` if host and path together are listed, else ``allow``."""
    added = ["host", "path", "rule", "verdict"]
    key, listed = free_name([*pages.columns, *added], "url_key"), free_name([*pages.columns, *added], "listed")
    df = is_listed(with_url_key(without(pages, added), url, key), key, levels, listed)
    df = df.withColumn("rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col(listed), "block").otherwise("allow")
    for r in rules:
        verdict = F.when(F.col("rule") == r.name, r.verdict).otherwise(verdict)
    return df.withColumn("verdict", verdict).drop(listed, key)


def with_url_key(pages: DataFrame, url: str = "url", key: str = "url_key") -> DataFrame:
    """``pages`` with host, path and, as ``key``, both together; columns of these names are replaced."""
    if url.lower() in ("host", "path", key.lower()):
        raise ValueError(f"the url's column is named {url} like one that is added")
    df = without(pages, ["host", "path", key])
    return df.withColumns({"host": host_of(F.col(f"`{url}`")), "path": path_of(F.col(f"`{url}`"))}).withColumn(
        key, F.concat("host", "path"))


def marked_universe(universe: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The distinct keys of both tables with boolean ``listed``: one aggregate, no join. Keys that only the
    list has are members of the universe too."""
    both = universe.select(key, F.lit(False).alias("listed")).unionByName(listed.select(key, F.lit(True).alias("listed")))
    return both.groupBy(key).agg(F.max("listed").alias("listed"))
