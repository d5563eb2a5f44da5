"""Near-duplicates by b-bit MinHash: band candidates, bit-count estimates, exact confirmation.

1. Every whole text becomes its set of distinct word shingles (64-bit hashes) and ``K`` minima.
   Rows with equal sets form one node, known by a 128-bit digest; only nodes are compared.
2. ``BANDS`` bands of the minima give buckets. Of each minimum only ``BITS`` low bits are retained,
   packed into longs; two nodes' similarity is estimated from the bit count of their difference,
   corrected for low bits that agree by chance.
3. Every node of a bucket is paired with the bucket's least and greatest node. Of the pairs that could be
   links by their estimate each node's best one is confirmed on the full sets and components are formed,
   then those that lie across components.
4. Nodes that still share a bucket with a node of another component to which they may be linked, by the
   estimate, are joined among themselves by exact bounds, the full sets decided inside the join: no link
   that shares a bucket is lost, and no pair comes out that is none, however large a group of copies is.

A pair at the threshold of 0.8 shares no band of 4 in 32 with probability 5e-8; an estimate is cut
six standard deviations below the threshold.

Defined results: null, empty and blank texts have no shingles and are linked with nothing; texts
with fewer words than a shingle count as one shingle of all their words; repeated rows each get a
row; a null id is never the least id unless the whole component has none; an empty table gives
no rows. Only the id and text columns are read, whatever else the table holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from circulation.llm.common import bound_memory, written
from circulation.llm.components import components

K, BANDS, BITS = 128, 32, 2
# The percentage of similarity from which two sets are linked.
THRESHOLD = 80
# Buckets are compared in square blocks of so many nodes.
BLOCK = 2048
# Ids of so many texts may be broadcast to find the texts again: about 100 bytes each in memory, 20 MB.
BROADCAST_IDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)


# --- shingles ------------------------------------------------------------------------------

def words(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and where each text's begin and end.

    A word is a run of anything but the six ASCII spaces; only A to Z are lower-cased."""
    texts = texts.cast(pa.large_string()).fill_null("")
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, ends = parts.flatten(), parts.offsets.to_numpy()
    full = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), before[ends - ends[0]]


def word_hashes(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of every word, each distinct word hashed once."""
    import xxhash

    coded = flat.dictionary_encode()
    hashed = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64,
                         len(coded.dictionary))
    return hashed[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX2
    return h ^ (h >> np.uint64(29))


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    flat, ends = words(texts)
    w = word_hashes(flat)
    grams = np.full(max(0, len(w) - n + 1), np.uint64(n), np.uint64)
    for k in range(n):
        grams = _mixed(grams * _MIX + w[k:k + len(grams)])
    for a, z in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if z - a >= n:
            yield np.unique(grams[a:z - n + 1])
        elif z > a:
            h = np.array([z - a], np.uint64)
            for k in range(a, z):
                h = _mixed(h * _MIX + w[k:k + 1])
            yield h
        else:
            yield np.zeros(0, np.uint64)


# --- signatures ----------------------------------------------------------------------------

@lru_cache(maxsize=4)
def _masks(k: int) -> np.ndarray:
    return np.random.default_rng(20_240_607).integers(0, 1 << 32, k, dtype=np.uint32)


def minima(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """k minima of a non-empty set: over its hashes folded to 32 bits, masked and multiplied."""
    x = (hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)
    low = np.full(k, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        block = x[at:at + 512, None] ^ _masks(k)[None, :]
        block *= np.uint32(0x9E3779B1)
        np.minimum(low, block.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    rows = low.reshape(bands, -1).astype(np.uint64)
    h = np.arange(1, bands + 1, dtype=np.uint64) * _MIX
    for r in range(rows.shape[1]):
        h = _mixed(h * _MIX + rows[:, r])
    return h.astype(np.int64)


def packed_bits(low: np.ndarray, bits: int) -> np.ndarray:
    """The low ``bits`` of every minimum, packed into 64-bit words."""
    low = (low & np.uint32((1 << bits) - 1)).astype(np.uint64).reshape(-1, 64 // bits)
    shifts = np.arange(0, 64, bits, dtype=np.uint64)
    return np.bitwise_or.reduce(low << shifts, axis=1).view(np.int64)


def signatures(docs: DataFrame, n: int, text: str = "text", id_col: str = "doc_id", k: int = K,
               bands: int = BANDS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, node (digest of the set, null if empty), n_shingles, bits (longs), bands (longs)."""
    import xxhash

    bound_memory(docs.sparkSession)
    schema = "doc_id long, node binary, n_shingles long, bits array<long>, bands array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, size, packed, keys = [], [], [], []
            for s in shingle_sets(b.column(1), n):
                size.append(len(s))
                if len(s):
                    low = minima(s, k)
                    node.append(xxhash.xxh3_128_digest(s))
                    packed.append(packed_bits(low, bits))
                    keys.append(band_keys(low, bands))
                else:
                    node.append(None)
                    packed.append(None)
                    keys.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(node, pa.binary()), pa.array(size, pa.int64()), pa.array(packed, longs),
                 pa.array(keys, longs)], names=["doc_id", "node", "n_shingles", "bits", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text")).mapInArrow(sign, schema)


def estimate(a: str, b: str, k: int = K, bits: int = BITS) -> Column:
    """Similarity of two packed signatures (arrays of longs), corrected for chance agreement of low bits."""
    mask = sum(1 << i for i in range(0, 64, bits))
    mask -= (1 << 64) if mask >> 63 else 0
    differing = F.lit(0)
    for i in range(k * bits // 64):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        folded = x
        for s in range(1, bits):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        differing = differing + F.bit_count(folded.bitwiseAND(F.lit(mask).cast("long")))
    chance = 2.0 ** -bits
    return (1 - differing / F.lit(float(k)) - chance) / (1 - chance)


def least_estimate(threshold: int, k: int = K, bits: int = BITS, deviations: float = 6.0) -> float:
    j, chance = threshold / 100, 2.0 ** -bits
    p = j + (1 - j) * chance
    return j - deviations * (p * (1 - p) / k) ** 0.5 / (1 - chance)


# --- links ---------------------------------------------------------------------------------

def _near_size(threshold: int) -> Column:
    """Sets of such sizes can reach the threshold at all."""
    return (F.col("na") * 100 >= F.col("nb") * threshold) & (F.col("nb") * 100 >= F.col("na") * threshold)


def _hub_pairs(buckets: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """(a, b, est): every node with the least and the greatest node of each of its buckets, if they may be a link."""
    hubs = buckets.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo != hi")
    met = buckets.join(hubs, "key").select(F.col("node").alias("a"), F.explode(F.array("lo", "hi")).alias("b"))
    pairs = met.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return _estimated(pairs, nodes, threshold)


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    of = lambda s: nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("bits").alias(f"bits_{s}"))
    return (pairs.join(of("a"), "a").join(of("b"), "b").where(_near_size(threshold))
            .withColumn("est", estimate("bits_a", "bits_b")).where(F.col("est") >= least_estimate(threshold))
            .select("a", "b", "est"))


def _blocked(rows: DataFrame, key: str, block: int) -> DataFrame:
    """``rows`` with the number of square blocks of their key's group, and the block of each row's node."""
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    counted = rows.join(sizes, key).withColumn("blocks", F.ceil(F.col("c") / block).cast("int"))
    return counted.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("c")


def _suspects(buckets: DataFrame, nodes: DataFrame, roots: DataFrame, threshold: int, block: int) -> DataFrame:
    """(node, root): nodes that share a bucket with a node of another component to which they may be linked.

    A semi join: a node comes out once, however many such nodes there are; large buckets are met block by block."""
    placed = buckets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key")
    members = _blocked(placed.join(open_, "key"), "key", block).join(nodes.select("node", "n_shingles", "bits"), "node")
    members = written(members.select("key", "node", "root", "n_shingles", "bits", "blocks", "own"), "minhash-open")
    side = lambda s, mine, others: members.select(
        "key", F.col("node").alias(s), F.col("root").alias(f"root_{s}"), F.col("n_shingles").alias(f"n{s}"),
        F.col("bits").alias(f"bits_{s}"), F.col("own").alias(mine),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(others))
    left, right = side("a", "i", "j").alias("l"), side("b", "j", "i").alias("r")
    fits = (F.col("root_a") != F.col("root_b")) & _near_size(threshold) & (
        estimate("bits_a", "bits_b") >= least_estimate(threshold))
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.i") == F.col("r.i")) & (F.col("l.j") == F.col("r.j"))
    return left.join(right, on & fits, "left_semi").select(F.col("a").alias("node"), F.col("root_a").alias("root")).distinct()


def _rest_links(suspects: DataFrame, sets: DataFrame, threshold: int, block: int) -> DataFrame:
    """(a, b): the links among suspects of different components. No other pair comes out of any join.

    Each set is ordered by how rare its shingles are among the suspects. Two sets at the threshold share a
    shingle among their first 1 - threshold (prefix), and after the first shared one enough shingles are left
    in both (position). A semi join by these exact bounds keeps the prefix rows that have a partner at all; those
    take their node's set along, and the join that pairs them decides by the full sets in its own condition."""
    each = sets.join(suspects, "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("g"))
    rare = each.groupBy("g").agg(F.count(F.lit(1)).alias("f"))
    ordered = each.join(rare, "g").groupBy("node", "root", "n").agg(F.sort_array(F.collect_list(F.struct("f", "g"))).alias("by"))
    first = F.col("n") - F.ceil(F.col("n") * threshold / 100).cast("int") + 1
    prefix = ordered.select("node", "root", "n", F.posexplode(F.slice("by", F.lit(1), first)).alias("place", "x")).where("x.f > 1")
    rows = written(_blocked(prefix.select(F.col("x.g").alias("key"), "node", "root", "n", "place"), "key", block), "minhash-prefix")

    def side(df: DataFrame, s: str, lo: Column, hi: Column, mine: str, others: str) -> DataFrame:
        carried = [F.col("shingles").alias(f"set_{s}")] if "shingles" in df.columns else []
        return df.select("key", F.col("node").alias(s), F.col("root").alias(f"root_{s}"), F.col("n").alias(f"n{s}"),
                         F.col("place").alias(f"place_{s}"), F.col("own").alias(mine), F.explode(F.sequence(lo, hi)).alias(others), *carried).alias(s)

    left_in = F.least(F.col("na") - F.col("place_a"), F.col("nb") - F.col("place_b"))
    enough = left_in * (100 + threshold) >= (F.col("na") + F.col("nb")) * threshold
    may = (F.col("root_a") != F.col("root_b")) & _near_size(threshold) & enough
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.i") == F.col("b.i")) & (F.col("a.j") == F.col("b.j"))
    last = F.col("blocks") - 1
    met = side(rows, "a", F.lit(0), last, "i", "j").join(
        side(rows, "b", F.lit(0), last, "j", "i"), on & may, "left_semi").select("key", F.col("a").alias("node")).distinct()
    live = rows.join(met, ["key", "node"], "left_semi").join(sets, "node")
    live = written(live.select("key", "node", "root", "n", "place", "blocks", "own", "shingles"), "minhash-live")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    linked = shared * (100 + threshold) >= (F.col("na") + F.col("nb")) * threshold
    once = (F.col("a.i") < F.col("a.j")) | (F.col("a.a") < F.col("b.b"))
    pairs = side(live, "a", F.col("own"), last, "i", "j").join(side(live, "b", F.lit(0), F.col("own"), "j", "i"), on & (may & once & linked))
    return pairs.select(F.least("a.a", "b.b").alias("a"), F.greatest("a.a", "b.b").alias("b")).distinct()


def _sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, from the text of one document of each."""
    ids = written(nodes.join(wanted, "node", "left_semi").select(F.col("min_doc").alias("doc_id"), "node"), "minhash-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    import xxhash

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(node, s) for node, s in zip(b.column(0).to_pylist(), shingle_sets(b.column(1), n))
                     if len(s) and xxhash.xxh3_128_digest(s) == node]  # another text may bear the same id
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()),
                                              pa.array([s.view(np.int64) for _, s in found], pa.list_(pa.int64()))],
                                             names=["node", "shingles"])

    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"])).select("node", "text")
    # One row per node; a repeated id may have brought the same text more than once.
    return written(texts.mapInArrow(sets, "node binary, shingles array<long>").dropDuplicates(["node"]), "minhash-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, threshold: int, label: str) -> DataFrame:
    """Of the pairs (a, b) those whose full sets reach the threshold."""
    of = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
    both = pairs.select("a", "b").join(of("a"), "a").join(of("b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    united = F.size("set_a") + F.size("set_b")
    return written(both.where(shared * 100 >= (united - shared) * threshold).select("a", "b"), label)


def near_duplicates(docs: DataFrame, n: int = 5, threshold: int = THRESHOLD, text: str = "text",
                    id_col: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (least id reachable), kept (it is its own)."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    signed = written(signatures(docs, n), "minhash-signatures")
    full = signed.where("node IS NOT NULL")
    nodes = written(full.groupBy("node").agg(
        F.min("doc_id").alias("min_doc"), F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"),
        F.first("bands").alias("bands")), "minhash-nodes")
    buckets = nodes.select(F.explode("bands").alias("key"), "node")
    pairs = written(_hub_pairs(buckets, nodes, threshold), "minhash-pairs")
    best = written(pairs.groupBy("a").agg(F.max(F.struct("est", "b")).alias("m")).select("a", F.col("m.b").alias("b")), "minhash-best")
    both = best.select(F.col("a").alias("node")).union(best.select("b")).distinct()
    first = _confirmed(best, _sets_of(both, docs, nodes, n), threshold, "minhash-links")
    roots = components(first, "minhash-cc")
    root_of = lambda s: roots.select(F.col("node").alias(s), F.col("root").alias(f"root_{s}"))
    across = (pairs.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left")
              .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
              .join(best, ["a", "b"], "left_anti"))
    across = written(across, "minhash-across")
    if not across.isEmpty():
        both = across.select(F.col("a").alias("node")).union(across.select("b")).distinct()
        first = first.union(_confirmed(across, _sets_of(both, docs, nodes, n), threshold, "minhash-hubs"))
        roots = components(first, "minhash-cc1")
    suspects = written(_suspects(buckets, nodes, roots, threshold, block), "minhash-suspects")
    if not suspects.isEmpty():
        sets = _sets_of(suspects.select("node"), docs, nodes, n)
        more = written(_rest_links(suspects, sets, threshold, block), "minhash-more")
        if not more.isEmpty():
            roots = components(first.union(more), "minhash-cc2")
    named = nodes.select("node", "min_doc").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("min_doc").alias("component"))
    classes = written(named.join(ids, "root").select("node", "component"), "minhash-classes")
    out = signed.select("doc_id", "n_shingles", "node").join(classes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def dedupe(docs: DataFrame, n: int = 5, threshold: int = THRESHOLD, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one with the least id.

    Texts without words all stay. Rows that share an id are taken for one document: they go together, unless
    one of them is its group's least, and of those with equal texts one stays. Rows without an id stay."""
    found = written(near_duplicates(docs, n, threshold, text, id_col), "dedupe-classes")
    ids = written(found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")).where("NOT kept OR rows > 1"), "dedupe-ids")
    same = docs[f"`{id_col}`"].cast("long") == F.col("__id")
    small = ids.count() <= BROADCAST_IDS
    of = lambda condition: F.broadcast(ids.where(condition)) if small else ids.where(condition)
    out = docs.join(of("NOT kept"), same, "left_anti")
    if ids.where("kept").isEmpty():
        return out
    once = out.join(of("kept"), same, "left_semi").dropDuplicates([id_col, text])
    return out.join(of("kept"), same, "left_anti").unionByName(once)
