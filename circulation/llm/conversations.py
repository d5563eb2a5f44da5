"""Conversation structure repair: the cheapest edits that make the roles a legal exchange, by branch and bound.

A conversation is its rows by turn (nulls first), then role and text. Each row's first fault counts: blank (nothing but
white space), duplicate (its role and text stood earlier), truncated (its last character that is no white space ends no
sentence). Edits: Keep costs 0, Rerole 2, Delete 3 (required for blank and duplicate rows), Insert of an empty row 2; a
truncated row that stays adds 1. The initials of the roles that stay must be ``(s?(ua)+)?``; of the cheapest
edits those whose initials are ASCII-least are taken.

The search is depth first with an explicit stack, over nodes (rows taken, role state) in ASCII order of the edits, so
prefixes come in the order of their audits. A suffix lower bound (the cheapest way through the remaining rows if any last
role would do) cuts what cannot reach the incumbent (cost, audit); a dive along the bound gives the first incumbent.
A per-node dominance table drops a prefix that reaches a node no cheaper than an earlier, and so ASCII-smaller,
one: two prefixes of equal cost at one node are never one another's beginnings, as only inserts lie between. When
the stack is empty the incumbent is proved.

Conversations of up to ``BLOCK`` rows and ``BLOCK_BYTES`` of text are solved whole, streamed from partitions sorted by
conversation. Longer ones are numbered without bringing them together, cut into blocks of ``BLOCK`` rows and every
block is searched for each role state it may begin and end with; a layered least path over these few answers joins
them, which is exact because every block's audit ends with a row's edit. Of such a conversation one task sees only the
blocks' answers and, as SHA-256 is one pass by definition, its rows as a sorted stream.

Defined results: null roles and texts count as one space; a null id is a conversation of its own; turns that repeat are
ordered by role and text; a conversation without rows has zeros, an empty audit and the hash of nothing; an empty table
gives no rows; texts of any length are hashed whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from circulation.llm.common import free_name, global_prefix, shuffle_partitions, written

# Edit costs, white space and the ends of sentences.
KEEP, REROLE, DELETE, INSERT, TRUNCATED_STAYS = 0, 2, 3, 2, 1
BLANKS, ENDS = " \t\n\x0b\x0c\r", ".!?"
OK, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3

# Role states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
TAKES = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
# What makes an end legal: (cost, edits) by state.
LEGAL_ENDS = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

BLOCK, BLOCK_BYTES = 1 << 16, 64 << 20
BROADCAST_LONG = 100_000  # ids of long conversations that are broadcast at most
_NEVER = 1 << 60


def fault_of(text: str, seen: bool) -> int:
    last = text.rstrip(BLANKS)[-1:]
    return BLANK if not last else DUPLICATE if seen else OK if last in ENDS else TRUNCATED


def _edits(i: int, state: int, initials: Sequence[str], faults: Sequence[int]) -> Iterator[tuple[str, int, int, int]]:
    """(edit, cost, rows taken, state) of the edits at a node with rows left, in ASCII order."""
    yield "D", DELETE, i + 1, state
    yield "I", INSERT, i, NEXT[state]
    if faults[i] <= TRUNCATED:
        stays = TRUNCATED_STAYS * faults[i]
        kept = TAKES[state].get(initials[i])
        if kept is not None:
            yield "K", KEEP + stays, i + 1, kept
        yield "R", REROLE + stays, i + 1, NEXT[state]


def _suffix_bounds(initials: Sequence[str], faults: Sequence[int], ends: Sequence[int]) -> list[list[int]]:
    """The least cost from each node if ending in a state costs ``ends``. One insert before a row is enough: after two,
    only edits remain that were possible before them."""
    bounds = [list(ends)]
    for i in range(len(initials) - 1, -1, -1):
        after = bounds[-1]
        taken = [min((c + after[s] for e, c, _, s in _edits(i, state, initials, faults) if e != "I"), default=_NEVER) for state in range(4)]
        bounds.append([min(taken[s], INSERT + taken[NEXT[s]]) for s in range(4)])
    return bounds[::-1]


def search(initials: Sequence[str], faults: Sequence[int], start: int = START, ends: dict[int, tuple[int, str]] = LEGAL_ENDS,
           exact_end: bool = False) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest edits from ``start`` to one of ``ends``, ASCII-least among equals; None if there are none.

    The bound lets any end do, unless ``exact_end``, which sees at once that an end cannot be reached."""
    n = len(initials)
    bounds = _suffix_bounds(initials, faults, [ends[s][0] if s in ends else _NEVER for s in range(4)] if exact_end else [0] * 4)
    limit, audit = _dive(initials, faults, start, ends, bounds) or (_NEVER, None)
    proven_order = False  # whether the incumbent came in the order of the audits, so that equals are no better
    reached: dict[tuple[int, int], int] = {}  # the dominance table: the cheapest prefix that has come to a node
    trail: list[tuple[int, str]] = []  # (parent, edit): audits are spelled out for incumbents only
    stack = [(0, start, 0, -1)]
    while stack:
        i, state, cost, at = stack.pop()
        bound = cost + bounds[i][state]
        if bound > limit or (bound == limit and proven_order) or bound >= _NEVER:
            continue
        if reached.get((i, state), _NEVER) <= cost:
            continue
        reached[i, state] = cost
        if i == n:
            if state in ends and (cost + ends[state][0] < limit or (cost + ends[state][0] == limit and not proven_order)):
                limit, audit, proven_order = cost + ends[state][0], _spelled(trail, at) + ends[state][1], True
            continue
        for edit, c, j, s in reversed(list(_edits(i, state, initials, faults))):
            trail.append((at, edit))
            stack.append((j, s, cost + c, len(trail) - 1))
    return None if audit is None else (limit, audit)


def _dive(initials, faults, state, ends, bounds) -> tuple[int, str] | None:
    """The edits that follow the least bound at every node: the first incumbent."""
    i, cost, audit = 0, 0, []
    while i < len(initials):
        if bounds[i][state] >= _NEVER:
            return None
        edit, c, i, state = min(_edits(i, state, initials, faults), key=lambda e: (e[1] + bounds[e[2]][e[3]], e[0] == "I", e[0]))
        cost += c
        audit.append(edit)
    return (cost + ends[state][0], "".join(audit) + ends[state][1]) if state in ends else None


def _spelled(trail: list[tuple[int, str]], at: int) -> str:
    letters = []
    while at >= 0:
        at, letter = trail[at]
        letters.append(letter)
    return "".join(reversed(letters))


def applied(audit: str, rows: Iterable[tuple[str, str]], state: int = START) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the edits leave."""
    rows = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = TAKES[state][role[:1]]
        elif edit != "D":
            state = NEXT[state]
            role = ROLE[state]
        if edit != "D":
            yield edit, role, text


def _illegal(initials: Sequence[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


RESULT = T.StructType(
    [T.StructField("conv_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
       T.StructField("repaired", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("edit", "role", "text")])))])
_TURN = "conv_id long, turn long, role string, text string, present boolean"


def _whole(conv_id: int | None, rows: list[tuple[int | None, str, str]]) -> dict:
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in rows:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = search(initials, faults)
    left = [dict(zip(("edit", "role", "text"), x)) for x in applied(audit, ((r, t) for _, r, t in rows))]
    digest = hashlib.sha256("\n".join(f"{x['role']}:{x['text']}" for x in left).encode())
    return {"conv_id": conv_id, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": faults.count(BLANK),
            "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED), "illegal": _illegal(initials),
            "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest(), "repaired": left}


def _solve_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation, one conversation held at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema, rows, now, out, held = to_arrow_schema(RESULT), None, None, [], 0
    for b in batches:
        for conv_id, turn, role, text, present in zip(*(b.column(i).to_pylist() for i in range(5))):
            if rows is None or conv_id != now:
                if rows is not None:
                    out.append(_whole(now, rows))
                    if held > 4 << 20 or len(out) >= 2000:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)
                        out, held = [], 0
                rows, now = [], conv_id
            if present:
                rows.append((turn, role, text))
                held += len(text)
    if rows is not None:
        out.append(_whole(now, rows))
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def repair(turns: DataFrame, present: str | None = None) -> DataFrame:
    """One row per conversation: counts of faults, cost, audit, hash and, for those solved whole, the repaired rows.

    ``turns`` has conv_id, turn, role and text; a row whose ``present`` is false only names its conversation. ``repaired``
    (edit, role, text) is null for conversations beyond ``BLOCK`` rows or ``BLOCK_BYTES``."""
    there = F.lit(True) if present is None else F.coalesce(F.col(f"`{present}`"), F.lit(False))
    slim = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"), there.alias("present"))
    slim = slim.withColumn("text", F.when(F.col("present"), F.col("text")).otherwise(""))
    sizes = slim.groupBy("conv_id").agg(F.count_if("present").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    long = written(sizes.where((F.col("n") > BLOCK) | (F.col("bytes") > BLOCK_BYTES)).select("conv_id"), "conv-long")
    n_long = long.count()
    if n_long:
        ids = F.broadcast(long) if n_long <= BROADCAST_LONG else long
        same = slim.conv_id.eqNullSafe(ids.conv_id)
        slim, beyond = slim.join(ids, same, "left_anti"), slim.join(ids, same, "left_semi")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    dealt = slim.repartition(shuffle_partitions(slim.sparkSession), "conv_id").sortWithinPartitions(*order)
    out = dealt.mapInArrow(_solve_sorted, RESULT)
    return out.unionByName(_repair_long(beyond.where("present").drop("present"))) if n_long else out


# --- conversations in blocks ---------------------------------------------------------------

_ANSWERS = ("conv_id long, block long, first string, last string, illegal long, blank long, duplicate long, truncated long, "
            "entry int, exit int, cost long, audit string")


def _solve_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The cheapest edits of one block for every state it may begin and end with."""
    rows = rows.sort_values("pos")
    initials, faults = rows["initial"].tolist(), rows["fault"].tolist()
    out = []
    for entry in range(4):
        for leave in range(4):
            found = search(initials, faults, entry, {leave: (0, "")}, exact_end=True)
            if found is not None:
                out.append((entry, leave, *found))
    done = pd.DataFrame(out, columns=["entry", "exit", "cost", "audit"])
    head = rows.iloc[0]
    facts = {"conv_id": head["conv_id"], "block": head["block"], "first": initials[0], "last": initials[-1], "illegal": _illegal(initials),
             "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED)}
    for c, v in facts.items():
        done[c] = v
    done["conv_id"] = done["conv_id"].astype("Int64")
    return done[["conv_id", "block", "first", "last", "illegal", "blank", "duplicate", "truncated", "entry", "exit", "cost", "audit"]]


def _choose_path(answers: pd.DataFrame) -> pd.DataFrame:
    """The blocks' answers of one conversation, joined to its cheapest and then ASCII-least edits: for each block the chosen
    entry and exit. Audits of one entry are ordered by their rank, as none of them begins another."""
    edges: dict[int, dict[int, list[tuple[int, int, int]]]] = {}
    for block, entry, leave, cost, order in zip(answers["block"], answers["entry"], answers["exit"], answers["cost"], answers["order"]):
        edges.setdefault(int(block), {}).setdefault(int(entry), []).append((int(order), int(leave), int(cost)))
    blocks = sorted(edges)
    togo = {s: LEGAL_ENDS[s][0] for s in range(4)}
    after = []
    for b in reversed(blocks):
        after.append(togo)
        togo = {s: min((c + togo[e] for _, e, c in edges[b].get(s, [])), default=_NEVER) for s in range(4)}
    state, out, total = START, [], 0
    for b, rest in zip(blocks, reversed(after)):
        least = min(c + rest[e] for _, e, c in edges[b][state])
        _, leave, cost = min(x for x in edges[b][state] if x[2] + rest[x[1]] == least)
        out.append((b, state, leave, cost))
        state = leave
    chosen = pd.DataFrame(out, columns=["block", "entry", "exit", "cost"])
    chosen["tail"] = LEGAL_ENDS[state][1]
    chosen["tail_cost"] = LEGAL_ENDS[state][0]
    chosen["conv_id"] = answers["conv_id"].iloc[0]
    chosen["conv_id"] = chosen["conv_id"].astype("Int64")
    return chosen[["conv_id", "block", "entry", "exit", "cost", "tail", "tail_cost"]]


def _hash_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place; a block's first row carries its edits, the last row the tail."""
    now, digest, empty, state, edits = None, None, True, START, iter(())

    def add(edit: str, role: str, text: str) -> None:
        nonlocal state, empty
        for _, r, t in applied(edit, [(role, text)] if edit != "I" else [], state):
            digest.update((("" if empty else "\n") + f"{r}:{t}").encode())
            empty = False
        if edit == "K":
            state = TAKES[state][role[:1]]
        elif edit != "D":
            state = NEXT[state]

    for b in batches:
        done = []
        for conv_id, pos, role, text, audit, tail in zip(*(b.column(i).to_pylist() for i in range(6))):
            if pos == 0:
                now, digest, empty, state = conv_id, hashlib.sha256(), True, START
            if audit is not None:
                edits = iter(audit)
            for edit in edits:
                add(edit, role, text)
                if edit != "I":
                    break
            if tail is not None:
                for edit in tail:
                    add(edit, "", "")
                done.append((now, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())],
                                         names=["conv_id", "repaired_sha256"])


def _beside(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi join in which null ids are equal."""
    renamed = other.select(*[F.col(c).alias(f"r_{c}") if c in keys else F.col(c) for c in other.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & df[k].eqNullSafe(renamed[f"r_{k}"])
    return df.join(renamed, cond, how).drop(*[f"r_{k}" for k in keys])


def _repair_long(rows: DataFrame) -> DataFrame:
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    placed = global_prefix(rows, order, [], "conv-placed", rank="at").select("conv_id", "turn", "role", "text", "at")
    spans = written(placed.groupBy("conv_id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"),
                                                  F.max("turn").alias("hi"), F.min("turn").alias("lo")), "conv-spans")
    turns = placed.where("turn IS NOT NULL").select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    placed = _beside(placed, spans.select("conv_id", "first_at", "last_at"), ["conv_id"])
    placed = placed.select("conv_id", "role", "text", F.expr("at - first_at").alias("pos"), F.expr("at = last_at").alias("ends"),
                           F.expr(f"(at - first_at) div {BLOCK}").alias("block"),
                           F.sha2(F.concat("role", F.lit("\x00"), "text"), 256).alias("same"))
    placed = written(placed, "conv-rows")
    firsts = placed.groupBy("conv_id", "same").agg(F.min("pos").alias("first_pos"))
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(F.col("pos") > F.col("first_pos"), DUPLICATE).when(last.isin(*ENDS), OK).otherwise(TRUNCATED)
    codes = _beside(placed, firsts, ["conv_id", "same"]).select(
        "conv_id", "block", "pos", F.substring("role", 1, 1).alias("initial"), fault.cast("int").alias("fault"))
    answers = written(codes.groupBy("conv_id", "block").applyInPandas(_solve_block, _ANSWERS), "conv-blocks")
    ranked = answers.withColumn("order", F.row_number().over(Window.partitionBy("conv_id", "block", "entry").orderBy("audit")))
    chosen = written(ranked.select("conv_id", "block", "entry", "exit", "cost", "order").groupBy("conv_id").applyInPandas(
        _choose_path, "conv_id long, block long, entry int, exit int, cost long, tail string, tail_cost long"), "conv-chosen")
    edits = written(_beside(chosen, answers.drop("cost"), ["conv_id", "block", "entry", "exit"]), "conv-edits")
    # One row per block: the row before a block's first is its predecessor's last.
    by_block = Window.partitionBy("conv_id").orderBy("block")
    joined = edits.withColumn("seam", F.concat(F.lag("last").over(by_block), "first"))
    summed = joined.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.count_if(~F.col("seam").isin("su", "ua", "au"))).alias("illegal"),
        (F.sum("cost") + F.max("tail_cost")).alias("cost"), F.max("tail").alias("tail"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audits"))
    begins = F.col("pos") == F.col("block") * BLOCK
    stream = _beside(placed.select("conv_id", "pos", "role", "text", "ends", "block"), edits.select("conv_id", "block", "audit", "tail"),
                     ["conv_id", "block"]).select("conv_id", "pos", "role", "text", F.when(begins, F.col("audit")).alias("audit"),
                                                  F.when(F.col("ends"), F.col("tail")).alias("tail"))
    sorted_rows = stream.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "pos")
    hashes = sorted_rows.mapInArrow(_hash_sorted, "conv_id long, repaired_sha256 string")
    gaps = _beside(spans.select("conv_id", "hi", "lo"), turns, ["conv_id"], "left").select(
        "conv_id", F.coalesce(F.expr("hi - lo + 1 - turns"), F.lit(0)).alias("gaps"))
    whole = _beside(_beside(summed, gaps, ["conv_id"]), hashes, ["conv_id"])
    return whole.select(*[F.col(c).cast("long").alias(c) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        F.concat("audits", "tail").alias("audit"), "repaired_sha256",
                        F.lit(None).cast(RESULT["repaired"].dataType).alias("repaired"))


# --- damage for the registered query -----------------------------------------------------------

def damaged(conversations: DataFrame, present: str) -> DataFrame:
    """Rows damaged by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row (it stays with ``present`` false), 1 empties its
    text, 2 removes what ends sentences, 3 repeats it, 4 makes its role user. Nulls count as one space."""
    def shown(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = free_name([*conversations.columns, present], "kind")
    key = F.concat(shown("conv_id"), F.lit(":"), shown("turn"))
    rows = conversations.withColumn(kind, F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col(kind) == 1, "").when(F.col(kind) == 2, F.regexp_replace(shown("text"), "[.!?]", "")).otherwise(shown("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col(kind) == 4, "user").otherwise(shown("role")).alias("role"), text.alias("text"),
                       (F.col(kind) != 0).alias(present), F.explode(F.expr(f"IF(`{kind}` = 3, array(1, 2), array(1))")).alias(kind))
    return rows.drop(kind)
