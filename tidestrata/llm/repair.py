"""Conversations brought into shape by the cheapest edits, of equal ones those least in ASCII order.

Turns that are blank, repeated or break off are found first. The roles of what stays must be a system
turn at most, then users and assistants in turn. A conversation of n turns is a graph of 4 (n + 1)
nodes: the turns done and the state of that pattern. Every arc is one edit, written as its initial.
After costs are known from the back, arcs on cheapest ways remain. Their nodes are ranked by the edits
that follow, one of them first, then two, four and so on: the rank for twice as many is the rank of two
ranks, the node's own and that of the node so many edits on. Ranks choose each node's arc, and the
doubled pointers then give the node at every place of the least way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import staged
from tidestrata.operators.rank import with_rank

#: What edits cost, and what a turn that breaks off adds if it stays.
REROLE, DELETE, INSERT, BROKEN = 1, 2, 5, 5
#: Characters that do not make a text, and those that end one.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Turns gathered into one string at a time, and turns that are repaired in one go.
CHUNK = 4096
GROUP = 200_000

# A turn as a letter: its role's initial, then its fault.
INITIALS, FAULTS = "sua", ("none", "blank", "duplicate", "truncated")
FIRST_LETTER = ord("A")
# States of the pattern: nothing yet, system seen, assistant due, user due.
START, SYSTEM, ASSISTANT_DUE, DONE = range(4)
# The state after the role that is due, and after keeping a role by initial (-1: not allowed).
NEXT = np.array([ASSISTANT_DUE, ASSISTANT_DUE, DONE, ASSISTANT_DUE])
KEPT = np.array([[SYSTEM, ASSISTANT_DUE, -1, -1], [-1, ASSISTANT_DUE, -1, -1], [-1, -1, DONE, -1], [-1, ASSISTANT_DUE, -1, -1]])
FINAL = np.array([0, 2 * INSERT, INSERT, 0])
EDITS = "DIKR"
FAR = 1 << 60


def _row_costs(initial: np.ndarray, fault: np.ndarray, later: np.ndarray) -> np.ndarray:
    """(turns, states, D K R): what each edit of a turn costs in all, given costs after it."""
    must = (fault == 1) | (fault == 2)
    extra = np.where(fault == 3, BROKEN, 0)
    costs = np.full((len(initial), 4, 3), FAR, np.int64)
    costs[:, :, 0] = DELETE + later
    target = KEPT[:, initial].T
    kept = np.take_along_axis(later, np.maximum(target, 0), axis=1) + extra[:, None]
    costs[:, :, 1] = np.where((target < 0) | must[:, None], FAR, kept)
    costs[:, :, 2] = np.where(must[:, None], FAR, later[:, NEXT] + (REROLE + extra)[:, None])
    return costs


def _with_inserts(costs: np.ndarray) -> np.ndarray:
    """Costs per state where up to two turns may be inserted first; more never pay."""
    once = costs[:, NEXT] + INSERT
    return np.minimum(costs, np.minimum(once, costs[:, NEXT[NEXT]] + 2 * INSERT))


def cost_to_go(initial: np.ndarray, fault: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """(nodes, states): the least cost from each node to its conversation's end.

    Conversation c has turns ``first[c]`` to ``first[c] + size[c] - 1`` and, as it has one node more
    than turns, nodes from ``first[c] + c`` on. All conversations are worked on together, a turn of each
    at a time from the back.
    """
    own = np.arange(len(size))
    costs = np.empty((len(initial) + len(size), 4), np.int64)
    costs[first + own + size] = FINAL
    longest = np.argsort(-size, kind="stable")
    live = np.searchsorted(-size[longest], -np.arange(size.max(initial=0)), side="left")
    for back, n in enumerate(live):
        those = longest[:n]
        row = first[those] + size[those] - 1 - back
        node = row + those
        found = _row_costs(initial[row], fault[row], costs[node + 1]).min(axis=2)
        costs[node] = _with_inserts(found)
    return costs


def _doubled(
    jump: np.ndarray, onward: np.ndarray, starts: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pointers over 1, 2, 4, ... edits, each with the edits up to twice as far, until ``starts`` end."""
    steps = onward.astype(np.int64)
    while steps[starts].any():
        further = steps[jump]
        steps = steps + further
        yield jump, steps
        if not further[starts].any():
            return
        jump = jump[jump]


def least_ways(initial: np.ndarray, fault: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(cost per conversation, its least way): a way is its (node, edit) pairs, the nodes counted from 0.

    ``initial`` and ``fault`` are those of the conversations' turns, one conversation after another.
    """
    first = np.cumsum(size) - size
    costs = cost_to_go(initial, fault, first, size)
    nodes = len(costs)
    owner = np.repeat(np.arange(len(size)), size + 1)
    row = np.arange(nodes) - owner
    ended = np.zeros(nodes, bool)
    ended[first + np.arange(len(size)) + size] = True
    # Arcs in the order of EDITS: the node they lead to, or -1 off the cheapest ways. The last node is
    # where every way ends.
    sink = 4 * nodes
    arcs = np.full((nodes, 4, 4), -1, np.int64)
    turns = np.flatnonzero(~ended)
    edits = _row_costs(initial[row[turns]], fault[row[turns]], costs[turns + 1])
    below = 4 * (turns + 1)[:, None]
    kept = KEPT[:, initial[row[turns]]].T
    targets = np.stack([below + np.arange(4), below + kept, below + NEXT], axis=2)
    cheap = edits == costs[turns][:, :, None]
    arcs[turns[:, None], :, np.array([0, 2, 3])] = np.where(cheap, targets, -1).transpose(0, 2, 1)
    inserts = costs == costs[:, NEXT] + INSERT
    arcs[:, :, 1] = np.where(inserts, 4 * np.arange(nodes)[:, None] + NEXT, -1)
    arcs = np.vstack([arcs.reshape(sink, 4), np.full((1, 4), -1)])
    over = np.r_[(ended[:, None] & (FINAL == 0)).ravel(), True]

    usable = (arcs >= 0) & ~over[:, None]
    onward = usable.any(axis=1)
    starts = 4 * (first + np.arange(len(size)))
    # Arcs of one node differ in their initials, so the least initial says which way the ranks go.
    initials = usable.argmax(axis=1)
    rank = np.where(onward, initials + 1, 0)
    for jump, _ in _doubled(np.where(onward, arcs[np.arange(sink + 1), initials], sink), onward, starts):
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
    # Ranks are of all that follows now: an arc is chosen by its initial, then by the rank it leads to.
    order = np.where(usable, np.arange(4) * (rank.max() + 1) + rank[arcs], FAR)
    edit = order.argmin(axis=1)
    pointers, length = [], onward[starts].astype(np.int64)
    for jump, steps in _doubled(np.where(onward, arcs[np.arange(sink + 1), edit], sink), onward, starts):
        pointers.append(jump)
        length = steps[starts]
    # The node at each place of each way, by the bits of the place.
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    at = np.repeat(starts, length)
    for bit, jump in enumerate(pointers):
        moved = (place >> bit & 1).astype(bool)
        at[moved] = jump[at[moved]]
    ways = np.column_stack([at, edit[at]])
    return costs[first + np.arange(len(size)), START], np.split(ways, np.cumsum(length)[:-1])


def repaired_rows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of (key, letters) rows, those of `_REPAIRS`: a conversation's numbers and its edits in order."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters = [np.frombuffer(v.as_py().encode(), np.uint8) - FIRST_LETTER for v in batch.column(1)]
            start, turns = 0, 0
            for i, own in enumerate(letters):
                turns += len(own)
                if turns >= size or i == len(letters) - 1:
                    yield _repairs(batch.column(0).slice(start, i + 1 - start), letters[start : i + 1])
                    start, turns = i + 1, 0

    return repair


def _repairs(keys: pa.Array, letters: list[np.ndarray]) -> pa.RecordBatch:
    count = np.array([len(x) for x in letters])
    every = np.concatenate(letters)
    initial, fault = every >> 2, every & 3
    cost, ways = least_ways(initial, fault, count)
    first = np.cumsum(count) - count
    rows = []
    for c, way in enumerate(ways):
        own_initial, own_fault = initial[first[c] : first[c] + count[c]], fault[first[c] : first[c] + count[c]]
        pairs = own_initial[:-1] * 4 + own_initial[1:]
        # su, ua and au are the pairs that may follow one another.
        illegal = int((~np.isin(pairs, (1, 6, 9))).sum())
        found = [int((own_fault == f).sum()) for f in (1, 2, 3)]
        node, edit = way[:, 0], way[:, 1]
        place = node // 4 - (first[c] + c)
        # The role a turn gets, by the state it is put into; none where it is kept or goes.
        given = np.where((edit == 1) | (edit == 3), np.where(node % 4 == ASSISTANT_DUE, 2, 1), 0)
        audit = "".join(EDITS[e] for e in edit.tolist())
        rows.append((*found, illegal, int(cost[c]), audit, place + 1, given))
    *numbers, audits, places, given = zip(*rows)
    columns = [keys, *(pa.array(n, pa.int64()) for n in numbers), pa.array(audits, pa.string())]
    columns += [pa.array(places, pa.list_(pa.int64())), pa.array(given, pa.list_(pa.int64()))]
    names = ["key", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "places", "given"]
    return pa.RecordBatch.from_arrays(columns, names=names)


_REPAIRS = (
    "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "places array<long>, given array<long>"
)


def conversation_key(conv: Column) -> Column:
    """A text that tells conversations apart, a missing id among them."""
    return F.when(conv.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def damaged(turns: DataFrame) -> DataFrame:
    """(key, turn, role, text): turns spoilt by a fixed rule; nulls are one space, but for the turn."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = named
    kind = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    spoilt = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ENDS, "")).otherwise(text)
    times = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.where(kind != 0).select(
        conversation_key(F.col("conv_id")).alias("key"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        spoilt.alias("text"),
        F.explode(times).alias("_time"),
    ).drop("_time")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``turns`` (key, turn, role, text) with their place in their conversation, from 1, and their letter.

    Turns come by number, missing numbers first, then by role and text. Rows equal in all four are
    counted before they are numbered, and places come from a range partitioning, so neither a
    conversation nor a row with a third of all copies is one task's.
    """
    same = turns.groupBy("key", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
    same = staged(same, "turns")
    earliest = same.groupBy("key", "role", "text").agg(F.min(F.struct("turn")).alias("earliest"))
    told = same.join(earliest, ["key", "role", "text"])
    copies = told.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
    again = (F.col("copy") > 1) | ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    ended = F.substring(trimmed, -1, 1).isin(list(ENDS))
    fault = F.when(trimmed == "", 1).when(again, 2).when(~ended, 3).otherwise(0)
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    number = F.when((F.col("role") == "") | (initial == 0), 3).otherwise(initial - 1) * 4 + fault
    letter = F.char(number + FIRST_LETTER)
    rows = copies.select("key", "turn", "role", "text", "copy", letter.alias("letter"))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc(), F.col("copy").asc()]
    return with_rank(rows, ["key"], order, "place").drop("copy")


def conversation_letters(turns: DataFrame) -> DataFrame:
    """(key, letters): the letters of a conversation's turns in order, as one text."""

    def joined(frame: DataFrame, by: list, place: str, value: str) -> DataFrame:
        pairs = F.array_sort(F.collect_list(F.struct(place, value)))
        return frame.groupBy(*by).agg(F.array_join(F.transform(pairs, lambda p: p[value]), "").alias("letters"))

    chunk = F.expr(f"place div {CHUNK}").alias("chunk")
    parts = joined(turns.select("key", chunk, "place", "letter"), ["key", "chunk"], "place", "letter")
    return joined(parts, ["key"], "chunk", "letters")


def repaired(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) after repair of ``turns`` (key, turn, role, text).

    Conversations: key, blank, duplicate, truncated, illegal, cost, audit. Turns: key, place, part, edit,
    role, text, in the order of (place, part); inserted ones come before the turn whose place they have.
    What a conversation has in one row is a letter a turn; texts are joined to edits by conversation
    and place and never gathered.
    """
    placed = ordered_turns(turns)
    repairs = conversation_letters(placed).mapInArrow(repaired_rows(GROUP), _REPAIRS)
    repairs = staged(repairs, "repairs")
    steps = repairs.select(
        "key", F.posexplode(F.arrays_zip("places", "given")).alias("part", "step"), "audit"
    ).select(
        "key",
        F.col("step.places").alias("place"),
        "part",
        F.expr("substring(audit, part + 1, 1)").alias("edit"),
        F.element_at(F.array(F.lit(None), F.lit("user"), F.lit("assistant")), (F.col("step.given") + 1).cast("int")).alias("given"),
    )
    own = placed.select("key", "place", "role", "text")
    inserted = steps.where("edit = 'I'").select("key", "place", "part", "edit", F.col("given").alias("role"), F.lit("").alias("text"))
    edited = steps.where("edit IN ('K', 'R')").join(own, ["key", "place"])
    edited = edited.select("key", "place", "part", "edit", F.coalesce("given", "role").alias("role"), "text")
    return repairs.drop("places", "given"), edited.unionByName(inserted)


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's lines, which come in order; no conversation is held as a whole."""
    key, digest = None, None
    for batch in batches:
        done = []
        for own, line in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own != key:
                if digest is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = own, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.as_py())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)], names=["key", "digest"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "digest"])


def text_digests(turns: DataFrame) -> DataFrame:
    """(key, digest): SHA-256 of the ``role:text`` lines of each conversation in ``turns`` as repaired."""
    line = F.concat(F.col("role"), F.lit(":"), F.col("text")).cast("binary").alias("line")
    lines = turns.repartition("key").sortWithinPartitions("key", "place", "part").select("key", line)
    return lines.mapInArrow(_digest_rows, "key string, digest string")


def turn_gaps(turns: DataFrame) -> DataFrame:
    """(key, gaps): how many numbers between the first turn and the last are missing."""
    spread = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return turns.groupBy("key").agg(F.coalesce(spread, F.lit(0).cast("bigint")).alias("gaps"))


def repair_report(turns: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    ``turns`` (conv_id, turn, role, text) are damaged by a rule of their numbers first (`damaged`), then
    repaired. Rows with a null conversation id are one conversation; null roles and texts are one
    space, null turns come first. Rows that share a turn are ordered by role and text, equal rows are
    duplicates of one another, texts may have any length. A conversation that has no turn left has
    zeros, an empty audit and the digest of the empty text. Other columns are not read, and an empty
    table gives no rows.
    """
    key = conversation_key(F.col("conv_id"))
    every = turns.groupBy(key.alias("key")).agg(F.first("conv_id").alias("conv_id"))
    spoilt = damaged(turns)
    conversations, rows = repaired(spoilt)
    found = (
        every.join(turn_gaps(spoilt), "key", "left")
        .join(conversations, "key", "left")
        .join(text_digests(rows), "key", "left")
    )
    zeros = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "conv_id",
        *zeros,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
