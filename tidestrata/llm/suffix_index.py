"""Removal of byte strings that also start elsewhere, through a logarithmic family of suffix arrays.

A string of `LENGTH` bytes holds a byte sequence of `GRAM` bytes whose hash is least in it: its anchor.
Equal strings have their anchors at the same place, so suffix arrays over anchors alone (sparse ones)
find every repeat. An anchor owns the strings it is least in, a run of up to 128 starts, and stands in
an array with the bytes of all strings it owns.

Documents come in batches. A batch gets suffix arrays, one per owner of a range of hashes, which are
merged with the sorted arrays of the levels that exist. Neighbours in the order of the bytes after the
anchor, and in the order of those before it, give the common lengths that tell which strings repeat.
Then the batch becomes a level, and levels of equal size are merged, so that a text takes part in as
many merges as the number of batches has binary digits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import dropped, staged, unused
from tidestrata.operators.bounds import broadcast_if_small

#: Bytes of a string that counts as repeated.
LENGTH = 200
#: Bytes of an anchor's sequence; a string has 128 of them.
GRAM = 73
SPREAD = LENGTH - GRAM + 1
#: Batches that documents are dealt into, and distinct anchor contexts an owner holds.
BATCHES = 4
OWNED = 10_000
#: Distinct contexts of one sequence beyond which its strings are dealt out one by one.
HOT_CONTEXTS = 50_000
#: Texts that Python gets at a time.
TEXTS = 128
#: Strings looked at in one go.
STRIDE = 1 << 16

_LOW = np.uint64(2 * STRIDE - 1)
_FACTOR = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base % 2**64, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_POWER = _powers(_FACTOR, STRIDE + LENGTH + 1)
_BACK = _powers(pow(_FACTOR, -1, 2**64), STRIDE + LENGTH + 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the `GRAM` bytes from each place: a polynomial modulo 2^64, its bits mixed."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _POWER[:n], out=sums[1:])
    hashes = (sums[GRAM:] - sums[:-GRAM]) * _BACK[: n - GRAM + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every ``width`` in a row."""
    blocks = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: len(values) - width + 1], ahead[width - 1 : len(values)])


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) per anchor of a text and the strings it owns.

    A place is the anchor's start, then how far before it the first string starts (8 bits), and how
    many strings there are less one (8 bits). Of equal hashes in a string the first is its anchor.
    """
    hashes, places = [], []
    data = np.frombuffer(text, np.uint8)
    for begin in range(0, len(data) - LENGTH + 1, STRIDE):
        own = gram_hashes(data[begin : begin + STRIDE + LENGTH - 1])
        spots = (own & ~_LOW) | np.arange(len(own), dtype=np.uint64)
        chosen = (_least(spots, SPREAD) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        count = np.diff(np.r_[first, len(chosen)])
        at = chosen[first]
        hashes.append(own[at])
        places.append(((at + begin) << 16) | ((at - first) << 8) | (count - 1))
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes).view(np.int64), np.concatenate(places)


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(k1, k2, data): two hashes that tell a row by id and text, and the text's bytes."""
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))
    return docs.select(
        F.xxhash64(F.col(id).cast("string"), data).alias("k1"),
        F.xxhash64(data, F.col(id).cast("string"), F.lit(1)).alias("k2"),
        data.alias("data"),
    )


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["k1", "k2", "gram", "place"]
    for batch in batches:
        found = [anchors(value.as_py()) for value in batch.column(2)]
        rows = pa.array(np.repeat(np.arange(len(found)), [len(h) for h, _ in found]))
        if len(rows):
            columns = [batch.column(i).take(rows) for i in (0, 1)]
            columns += [pa.array(np.concatenate(part)) for part in zip(*found)]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the strings each listed anchor owns, with their digest."""
    names = ["k1", "k2", "gram", "start", "digest", "context", "before"]
    for batch in batches:
        k1, k2 = (batch.column(i).to_pylist() for i in (0, 1))
        rows: list[tuple] = []
        for row in range(batch.num_rows):
            text = batch.column(2)[row].as_py()
            listed = batch.column(3)[row].values
            for gram, place in zip(*(listed.field(i).to_pylist() for i in (0, 1))):
                start, before, more = place >> 16, place >> 8 & 255, place & 255
                context = text[start - before : start - before + more + LENGTH]
                digest = hashlib.blake2b(context + bytes([before]), digest_size=16).digest()
                rows.append((k1[row], k2[row], gram, start, digest, context, before))
            if len(rows) > 5_000 or (rows and row == batch.num_rows - 1):
                kinds = [pa.int64()] * 4 + [pa.binary()] * 2 + [pa.int32()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                rows = []


def contexts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(k1, k2, gram, start, digest, context, before) of every anchor whose sequence another one has."""
    keyed = _keyed(docs, id, text)
    found = keyed.mapInArrow(_anchor_rows, "k1 long, k2 long, gram long, place long")
    found = staged(found, "anchors", TEXTS)
    # Stored, so that the join below has a plain shuffle on each side, whose large partitions Spark splits.
    twice = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    twice = staged(twice, "repeated-grams")
    listed = (
        found.join(twice, "gram", "left_semi")
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("gram", "place")).alias("anchors"))
    )
    listed = staged(listed, "repeated-anchors")
    some = keyed.join(broadcast_if_small(listed.select("k1", "k2")), ["k1", "k2"], "left_semi")
    cut = some.join(listed, ["k1", "k2"]).mapInArrow(
        _context_rows,
        "k1 long, k2 long, gram long, start long, digest binary, context binary, before int",
    )
    cut = staged(cut, "contexts", TEXTS)
    dropped(found, twice, listed)
    return cut


def _common(sequences: list[bytes]) -> np.ndarray:
    """Bytes that each sequence has in common with the one before it; the first has none."""
    width = max(map(len, sequences))
    rows = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in sequences), np.uint8)
    rows = rows.reshape(-1, width)
    sizes = np.array([len(s) for s in sequences])
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.r_[0, np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))]


def _longest(common: np.ndarray) -> np.ndarray:
    return np.maximum(common, np.r_[common[1:], 0])


def repeated(contexts: list[bytes], before: np.ndarray, order: list[int]) -> np.ndarray:
    """Per context 128 bits: which of the strings it owns, by their distance to the anchor, repeat.

    ``order`` sorts the contexts by the bytes from the anchor on. Two contexts share the string that
    starts ``d`` before the anchor if they agree on ``d`` bytes before it and ``LENGTH - d`` after.
    """
    m = len(contexts)
    bits = np.zeros((m, SPREAD), bool)
    if m < 2:
        return bits
    order = np.array(order)
    after = _common([contexts[i][before[i] :] for i in order])
    ahead = [contexts[i][: before[i]][::-1] for i in range(m)]
    mirror = np.array(sorted(range(m), key=ahead.__getitem__))
    behind = _common([ahead[i] for i in mirror]) if before.any() else np.zeros(m, np.int64)
    right, left = np.empty(m, np.int64), np.empty(m, np.int64)
    right[order], left[mirror] = _longest(after), _longest(behind)
    last = before - (np.array([len(c) for c in contexts]) - LENGTH)
    alive = np.flatnonzero(right + left >= LENGTH)
    for d in range(SPREAD if len(alive) else 0):
        own = (last[alive] <= d) & (d <= before[alive])
        those = alive[own & (right[alive] >= LENGTH - d) & (left[alive] >= d)]
        if len(those) < 2:
            continue
        class_after, class_before = np.empty(m, np.int64), np.empty(m, np.int64)
        class_after[order] = np.cumsum(after < LENGTH - d)
        class_before[mirror] = np.cumsum(behind < d)
        both = class_after[those] * (m + 1) + class_before[those]
        ranks = np.argsort(both, kind="stable")
        same = both[ranks][1:] == both[ranks][:-1]
        bits[those[ranks[1:][same]], d] = True
        bits[those[ranks[:-1][same]], d] = True
    return bits


def _as_longs(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


_ROWS = pa.schema(
    [
        ("owner", pa.int32()),
        ("level", pa.int32()),
        ("place", pa.int32()),
        ("digest", pa.binary()),
        ("context", pa.binary()),
        ("before", pa.int32()),
        ("copies", pa.int64()),
        ("low", pa.int64()),
        ("high", pa.int64()),
    ]
)
_COLUMNS = "owner int, level int, place int, digest binary, context binary, before int, copies long, low long, high long"
NEW, FLAGS = 0, -1


def _added(joined: frozenset[int], into: int, batch: int) -> Callable[[pa.Table], pa.Table]:
    """The work of one owner when a batch arrives.

    Rows of level `NEW` are the batch's, unsorted; those of other levels are sorted by ``place``. The
    result holds the levels ``joined`` as one level ``into``, the batch as level ``batch``, and rows of
    level `FLAGS` for what repeats.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by([("level", "ascending"), ("place", "ascending")])
        owner = table.column("owner")[0].as_py()
        level = table.column("level").to_numpy()
        digest, context = (table.column(c).to_pylist() for c in ("digest", "context"))
        before, copies = (table.column(c).to_numpy() for c in ("before", "copies"))
        suffix = [c[b:] for c, b in zip(context, before)]
        fresh = sorted(np.flatnonzero(level == NEW).tolist(), key=suffix.__getitem__)
        # Levels are sorted already, so that this merges runs.
        order = sorted(np.flatnonzero(level != NEW).tolist() + fresh, key=suffix.__getitem__)
        bits = repeated(context, before, order)
        many = np.flatnonzero(copies > 1)
        distance = np.arange(SPREAD)
        first = before[many] - (np.array([len(context[i]) for i in many], np.int64) - LENGTH)
        bits[many] |= (distance >= first[:, None]) & (distance <= before[many][:, None])
        longs = _as_longs(bits)
        rows = [
            (owner, FLAGS, None, digest[i], None, None, None, int(longs[i, 0]), int(longs[i, 1]))
            for i in np.flatnonzero(bits.any(axis=1))
        ]
        rows += [
            (owner, batch, p, digest[i], context[i], int(before[i]), int(copies[i]), None, None)
            for p, i in enumerate(fresh)
        ]
        kept: dict[bytes, list] = {}
        for i in order:
            if level[i] in joined:
                entry = kept.setdefault(digest[i], [i, 0])
                entry[1] += int(copies[i])
        rows += [
            (owner, into, p, digest[i], context[i], int(before[i]), n, None, None)
            for p, (i, n) in enumerate(kept.values())
        ]
        columns = zip(*rows) if rows else [[] for _ in _ROWS]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ROWS)], schema=_ROWS)

    return add


def scanned(pieces: DataFrame, batches: int = BATCHES, owned: int = OWNED) -> DataFrame:
    """(digest, low, high): which strings of the contexts in ``pieces`` repeat, as bits by distance.

    ``pieces`` has batch, gram, digest, context, before and copies. Batches are added one after
    another; a level of size n holds n batches. Levels of equal size are merged when the next batch
    is added. Each owner has a group of sequences with some ``owned`` contexts, so tasks stay small
    however many batches and levels there are.
    """
    owners = max(1, -(-pieces.count() // owned))
    pieces = pieces.withColumn("owner", F.pmod(F.xxhash64("gram"), F.lit(owners)).cast("int"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("low", "long"), ("high", "long"))]
    levels: list[tuple[int, int, DataFrame]] = []  # (number, batches in it, rows)
    flags, number = None, 0
    for batch in range(batches):
        joined, size = levels[-1:], levels[-1][1] if levels else 0
        del levels[-1:]
        while levels and levels[-1][1] == size:
            joined.append(levels.pop())
            size *= 2
        into, number = number + 1, number + 2
        fresh = pieces.where(F.col("batch") == batch).select(
            "owner", F.lit(NEW).alias("level"), F.lit(None).cast("int").alias("place"),
            "digest", "context", "before", "copies", *nothing,
        )
        rows = reduce(DataFrame.unionByName, [frame for _, _, frame in levels + joined], fresh)
        numbers = frozenset(n for n, _, _ in joined) if len(joined) > 1 else frozenset()
        add = _added(numbers, into, number)
        made = staged(rows.groupBy("owner").applyInArrow(add, _COLUMNS), "levels")
        levels += [(into, size, made.where(F.col("level") == into))] if numbers else joined
        levels.append((number, 1, made.where(F.col("level") == number)))
        found = made.where(F.col("level") == FLAGS).select("digest", "low", "high")
        flags = found if flags is None else flags.unionByName(found)
    return flags.groupBy("digest").agg(F.bit_or("low").alias("low"), F.bit_or("high").alias("high"))


def _combined(cut: DataFrame, batches: int) -> DataFrame:
    """Contexts of a batch that are the same as one row with their number as ``copies``."""
    batch = F.pmod("k1", F.lit(batches)).cast("int").alias("batch")
    return cut.groupBy(batch, "digest").agg(
        F.first("gram").alias("gram"),
        F.first("context").alias("context"),
        F.first("before").alias("before"),
        F.count(F.lit(1)).alias("copies"),
    )


def repeats(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    *,
    batches: int = BATCHES,
    owned: int = OWNED,
    hot: int = HOT_CONTEXTS,
) -> DataFrame:
    """(k1, k2, spans): the maximal runs (start, stop) of repeated bytes of each row that has any.

    Contexts of one sequence go to one owner. Where there are more than ``hot`` of them, as around a
    passage that many documents share, each of their strings is a context of its own, filed under its
    own hash, so no owner gets them all.
    """
    cut = contexts(docs, id, text)
    pieces = staged(_combined(cut, batches), "pieces")
    # From here on the bytes are needed once per distinct context, and of each occurrence its place alone.
    places = staged(cut.select("k1", "k2", "start", "digest"), "places")
    dropped(cut)
    crowded = pieces.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    crowded = staged(crowded.select("gram"), "crowded")
    if crowded.isEmpty():
        bits = scanned(pieces, batches, owned)
    else:
        single = _singles(pieces.join(broadcast_if_small(crowded), "gram", "left_semi"))
        single = staged(single, "strings")
        own = single.groupBy("batch", "digest").agg(
            F.first("gram").alias("gram"),
            F.first("context").alias("context"),
            F.first("before").alias("before"),
            F.sum("copies").alias("copies"),
        )
        rest = pieces.join(broadcast_if_small(crowded), "gram", "left_anti")
        bits = scanned(staged(rest.unionByName(own), "pieces"), batches, owned)
        back = single.select("digest", "parent").distinct().join(bits, "digest")
        back = back.groupBy(F.col("parent").alias("digest")).agg(
            F.bit_or("low").alias("low"), F.bit_or("high").alias("high")
        )
        bits = bits.unionByName(back)
    # Stored, so that a context with a third of all occurrences is a skewed partition that Spark splits.
    bits = staged(bits, "bits")
    marks = F.collect_list(F.struct("start", "low", "high")).alias("marks")
    placed = places.join(bits, "digest").groupBy("k1", "k2").agg(marks)
    found = placed.mapInArrow(_span_rows, "k1 long, k2 long, spans array<struct<start long, stop long>>")
    return staged(found, "spans")


def _singles(pieces: DataFrame) -> DataFrame:
    """Every string of the contexts as a context of its own, with its parent's digest."""
    at = F.explode(F.sequence(F.lit(0), F.length("context") - F.lit(LENGTH))).alias("at")
    string = F.expr(f"substring(context, at + 1, {LENGTH})")
    before = F.col("before") - F.col("at")
    return (
        pieces.withColumnRenamed("digest", "parent")
        .select("*", at)
        .select(
            "batch",
            "parent",
            F.unhex(F.md5(F.concat(string, before.cast("string").cast("binary")))).alias("digest"),
            F.xxhash64(string).alias("gram"),
            string.alias("context"),
            before.alias("before"),
            "copies",
        )
    )


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        spans = []
        for marks in batch.column(2):
            start, low, high = (marks.values.field(i).to_numpy() for i in range(3))
            spans.append([{"start": a, "stop": b} for a, b in spans_of(start, low, high)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(spans, kind)], names=["k1", "k2", "spans"]
        )


def spans_of(start: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that repeated strings cover, from the bits of a text's anchors."""
    longs = np.column_stack([low, high]).astype(np.int64)
    found = []
    for i in range(0, len(start), 10_000):
        bits = np.unpackbits(longs[i : i + 10_000].view(np.uint8), axis=1, bitorder="little")
        row, distance = np.nonzero(bits)
        found.append(start[i : i + 10_000][row] - distance)
    begin = np.sort(np.concatenate(found))
    cuts = np.flatnonzero(np.diff(begin) > LENGTH)
    first, last = begin[np.r_[0, cuts + 1]], begin[np.r_[cuts, len(begin) - 1]] + LENGTH
    return list(zip(first.tolist(), last.tolist()))


def without_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", **settings: int
) -> DataFrame:
    """``docs`` with ``kept`` (the bytes of the text that stay), ``n_bytes`` and ``spans`` besides.

    A byte goes if some string of `LENGTH` bytes that covers it also starts at another place, of the
    same text or another row's; all are judged on the input, so no copy stays. A null text is empty.
    Rows repeated in id and text are texts of their own, whose bytes go if there are 200 of them. Texts
    below `LENGTH` bytes stay whole; ids may be null, of any type that has a text form, and repeated.
    Texts of any length are read whole. An empty table gives an empty one. Columns of ``docs`` that have
    the names of the new ones are replaced.
    """
    spans = repeats(docs, id, text, **settings)
    k1, k2, data, cut = (unused(docs, n) for n in ("_k1", "_k2", "_data", "_cut"))
    binary = F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))
    docs = docs.drop("kept", "n_bytes", "spans")
    whole = docs.withColumn(data, binary).withColumns(
        {
            k1: F.xxhash64(F.col(id).cast("string"), F.col(data)),
            k2: F.xxhash64(F.col(data), F.col(id).cast("string"), F.lit(1)),
        }
    )
    spans = spans.select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("spans").alias(cut))
    found = whole.join(broadcast_if_small(spans), [k1, k2], "left")
    nothing = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    size = F.octet_length(data)
    # What stays lies between a span's end and the next one's start.
    stops = F.concat(F.array(F.lit(0).cast("bigint")), F.col(f"{cut}.stop"))
    starts = F.concat(F.col(f"{cut}.start"), F.array(size.cast("bigint")))
    between = F.zip_with(
        stops,
        starts,
        lambda a, b: F.hex(F.substring(F.col(data), (a + 1).cast("int"), (b - a).cast("int"))),
    )
    kept = F.when(F.col(cut).isNull(), F.col(data)).otherwise(F.unhex(F.array_join(between, "")))
    return found.select(
        *docs.columns,
        kept.alias("kept"),
        size.cast("bigint").alias("n_bytes"),
        F.coalesce(F.col(cut), nothing).alias("spans"),
    )
