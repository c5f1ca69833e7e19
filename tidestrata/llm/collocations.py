"""Phrases of two to four words that keep together, counted in tiles of frequency-ranked ids.

Texts are cut into blocks of one language, in which words are numbers. Frequent words get ids by
falling frequency. Adjacent ids are cells of a plane that is cut into square tiles: a tile that many
pairs of a block fall into is counted by direct address, the pairs of the others by sorting their
coordinates. Frequent pairs are ranked in their turn, and two of them that overlap in a word are again
a pair of adjacent ids, so the same step counts phrases of three words and then of four.

Blocks send what they have counted to owners, each of a share of a language's units. An owner adds up
its units, ranks those that are frequent, and sends every block the ids of its own. Ids of several
owners interleave, so small ids are frequent ones. Counts travel as arrays, one row per block and owner.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidestrata.llm.common import LOWER, UPPER, dropped, staged

#: Phrases rarer than this are no candidates; the longest has so many words.
FREQUENT = 30
WORDS = 4
#: A phrase goes if a longer candidate around it has this percentage of its occurrences.
COVERED = 80
#: Phrases reported of each language, and what stands for a language that is missing.
BEST = 2000
NO_LANGUAGE = "und"
#: Bytes of text in a block, and ids on a side of a tile.
BLOCK = 4 << 20
TILE_BITS = 10
#: A tile of a block is dense if at least one in so many of its cells is hit.
DENSE = 16

# Punctuation and line ends become a byte that UTF-8 does not have; a tab parts words like a space.
_BREAK = b"\xff"
_PLAIN = bytes.maketrans(
    UPPER.encode() + b".,;:!?\x0a\x0b\x0c\x0d\x09", LOWER.encode() + _BREAK * 10 + b" "
)
NOTHING = -1
#: Words of text for which there is one owner per language.
OWNED = 4 << 20


def _parts(text: bytes, size: int) -> Iterator[bytes]:
    """``text``, once plain, cut at breaks into parts of about ``size`` bytes; no phrase is cut."""
    start = 0
    while len(text) - start > size:
        at = text.rfind(_BREAK, start, start + size)
        at = at if at >= 0 else text.find(_BREAK, start + size)
        if at < 0:
            break
        yield text[start:at]
        start = at + 1
    yield text[start:]


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of plain texts, and the number of the word at each place or `NOTHING`."""
    spread = (b" " + _BREAK + b" ").join(texts).replace(_BREAK, b" " + _BREAK + b" ")
    numbers: dict[bytes, int] = {_BREAK: 0}
    places = [numbers.setdefault(word, len(numbers)) for word in spread.split()]
    return list(numbers)[1:], np.array(places, np.int32) - 1


def _block_rows(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        open_texts: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def block(lang: str) -> pa.RecordBatch:
            nonlocal made
            words, units = numbered(open_texts.pop(lang))
            times = np.bincount(units[units >= 0], minlength=len(words))
            made += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | made]),
                    pa.array([lang]),
                    pa.array([units.tobytes()], pa.binary()),
                    pa.array([words], pa.list_(pa.binary())),
                    pa.array([times], pa.list_(pa.int64())),
                ],
                names=["block", "lang", "units", "words", "times"],
            )

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in _parts(text.as_py().translate(_PLAIN), size):
                    open_texts.setdefault(lang, []).append(part)
                    sizes[lang] = sizes.get(lang, 0) + len(part)
                    if sizes[lang] >= size:
                        sizes[lang] = 0
                        yield block(lang)
        for lang in list(open_texts):
            yield block(lang)

    return cut


def counted(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, second, times) of the distinct pairs of ids.

    Pairs are dealt into tiles of 2^`TILE_BITS` ids a side. Dense tiles are counted by direct address,
    one array of counts a tile; the coordinates of the pairs in sparse ones are sorted.
    """
    first, second = first.astype(np.int64), second.astype(np.int64)
    low = (1 << TILE_BITS) - 1
    tiles, tile, sizes = np.unique(
        (first >> TILE_BITS) << 32 | second >> TILE_BITS, return_inverse=True, return_counts=True
    )
    dense = sizes >= (1 << 2 * TILE_BITS) // DENSE
    found = []
    for t in np.flatnonzero(dense):
        inside = tile == t
        cells = (first[inside] & low) << TILE_BITS | second[inside] & low
        times = np.bincount(cells, minlength=1 << 2 * TILE_BITS)
        hit = np.flatnonzero(times)
        corner = int(tiles[t])
        found.append(
            (
                (corner >> 32 << TILE_BITS) + (hit >> TILE_BITS),
                ((corner & 0xFFFFFFFF) << TILE_BITS) + (hit & low),
                times[hit],
            )
        )
    sparse = ~dense[tile] if len(tile) else np.zeros(0, bool)
    cells, times = np.unique(first[sparse] << 32 | second[sparse], return_counts=True)
    found.append((cells >> 32, cells & 0xFFFFFFFF, times))
    return tuple(np.concatenate(part) for part in zip(*found))


def _paired(units: np.ndarray) -> np.ndarray:
    """The pair that starts at each place as one number, `NOTHING` where there is none."""
    pairs = units[:-1].astype(np.int64) << 32 | units[1:].astype(np.int64)
    pairs[(units[:-1] < 0) | (units[1:] < 0)] = NOTHING
    return pairs


def _looked_up(keys: np.ndarray, known: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The id of each key, `NOTHING` for one that is not known."""
    if not len(known):
        return np.full(len(keys), NOTHING, np.int32)
    order = np.argsort(known)
    known, ids = known[order], ids[order]
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, ids[at], NOTHING).astype(np.int32)


_COUNTS = pa.schema(
    [
        ("block", pa.int64()),
        ("lang", pa.string()),
        ("owner", pa.int32()),
        ("units", pa.binary()),
        ("words", pa.list_(pa.binary())),
        ("times", pa.binary()),
    ]
)
_COUNT_COLUMNS = "block long, lang string, owner int, units binary, words array<binary>, times binary"


def _dealt(block: int, lang: str, units: np.ndarray, times: np.ndarray, owner: np.ndarray, words=None):
    """A row of `_COUNTS` for every owner of units of the block; words come with those of the first step."""
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        own = None if words is None else [words[i] for i in part]
        yield (block, lang, int(owner[part[0]]), units[part].tobytes(), own, times[part].tobytes())


def _count_table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in _COUNTS]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTS)], schema=_COUNTS)


def _word_counts(owners: int):
    """The words of each block, dealt to their owners by a checksum."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, words, times in zip(*(c.to_pylist() for c in batch.columns)):
                owner = np.array([crc32(word) % owners for word in words], np.int64)
                places = np.arange(len(words), dtype=np.int64)
                rows = list(_dealt(block, lang, places, np.array(times, np.int64), owner, words))
                yield from _count_table(rows).to_batches()

    return deal


def _step(paired: bool, owners: int):
    """A block in the ids of its known units, and how often ids meet, dealt to the owners of pairs."""

    def step(block: pa.Table, known: pa.Table) -> pa.Table:
        number, lang = (block.column(c)[0].as_py() for c in ("block", "lang"))
        units = np.frombuffer(block.column("units")[0].as_py(), np.int32)
        units = _paired(units) if paired else units
        keys, ids = (np.frombuffer(b"".join(known.column(c).to_pylist()), np.int64) for c in ("units", "ids"))
        units = _looked_up(units, keys, ids)
        pairs = _paired(units)
        pairs = pairs[pairs != NOTHING]
        first, second, times = counted(pairs >> 32, pairs & 0xFFFFFFFF)
        pairs = first << 32 | second
        mixed = pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        owner = ((mixed >> np.uint64(32)) % np.uint64(owners)).astype(np.int64)
        rows = [(number, lang, None, units.tobytes(), None, None)]
        return _count_table(rows + list(_dealt(number, lang, pairs, times.astype(np.int64), owner)))

    return step


_RANKED = pa.schema(
    [
        ("lang", pa.string()),
        ("block", pa.int64()),
        ("units", pa.binary()),
        ("ids", pa.binary()),
        ("phrases", pa.list_(pa.struct([("unit", pa.int64()), ("word", pa.binary()), ("id", pa.int64()), ("f", pa.int64())]))),
    ]
)
_RANKED_COLUMNS = (
    "lang string, block long, units binary, ids binary, "
    "phrases array<struct<unit:bigint,word:binary,id:bigint,f:bigint>>"
)


def _owner(owners: int, frequent: int):
    """The frequent units of an owner with their ids, and for each block the ids of those it has."""

    def rank(table: pa.Table) -> pa.Table:
        lang, owner = (table.column(c)[0].as_py() for c in ("lang", "owner"))
        blocks = table.column("block").to_pylist()
        units = [np.frombuffer(x, np.int64) for x in table.column("units").to_pylist()]
        times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.int64)
        every = np.concatenate(units)
        words = table.column("words").combine_chunks()
        if words.null_count:
            names, distinct, place = None, *np.unique(every, return_inverse=True)
        else:
            coded = words.flatten().dictionary_encode()
            names, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            distinct = np.arange(len(names))
        order = np.argsort(place, kind="stable")
        begin = np.flatnonzero(np.diff(place[order], prepend=-1))
        sums = np.add.reduceat(times[order], begin) if len(begin) else times
        often = np.flatnonzero(sums >= frequent)
        often = often[np.argsort(-sums[often], kind="stable")]
        ids = np.full(len(distinct), NOTHING, np.int64)
        ids[often] = np.arange(len(often)) * owners + owner
        phrases = [
            {"unit": int(distinct[i]), "word": names[i] if names else None, "id": int(ids[i]), "f": int(sums[i])}
            for i in often
        ]
        rows, at = [(lang, None, None, None, phrases)], 0
        for block, own in zip(blocks, units):
            given = ids[place[at : at + len(own)]]
            at += len(own)
            if (given >= 0).any():
                rows.append((lang, block, own[given >= 0].tobytes(), given[given >= 0].tobytes(), None))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RANKED)], schema=_RANKED)

    return rank


def _ranked(counts: DataFrame, owners: int, frequent: int) -> tuple[DataFrame, DataFrame]:
    """(phrases, known): the frequent units of ``counts`` by language, and each block's part of them."""
    made = counts.where(F.col("owner").isNotNull()).groupBy("lang", "owner")
    made = staged(made.applyInArrow(_owner(owners, frequent), _RANKED_COLUMNS), "ranked")
    phrases = made.where(F.col("block").isNull()).select("lang", F.explode("phrases").alias("p"))
    known = made.where(F.col("block").isNotNull()).select(F.col("block").alias("of"), "units", "ids")
    return phrases.select("lang", "p.*"), known


def _phrases(often: DataFrame, shorter: DataFrame) -> DataFrame:
    """The frequent pairs ``often`` with their words and the counts of their beginnings and ends.

    Of a phrase (x, y), x is the phrase without its last word and y the one without its first.
    """
    often = often.select(
        "lang", "id", "f", F.shiftright("unit", 32).alias("first"), F.col("unit").bitwiseAND(2**32 - 1).alias("second")
    )
    x = shorter.select(
        "lang", F.col("id").alias("first"), F.col("phrase").alias("opening"), F.col("starts").alias("s")
    )
    y = shorter.select("lang", F.col("id").alias("second"), "last", F.col("ends").alias("e"))
    named = often.join(x, ["lang", "first"]).join(y, ["lang", "second"])
    return named.select(
        "lang",
        "id",
        "first",
        "second",
        "f",
        F.concat_ws(" ", "opening", "last").alias("phrase"),
        "last",
        F.concat("s", F.array("f")).alias("starts"),
        F.concat("e", F.array("f")).alias("ends"),
    )


def _exact(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def _scored(phrases: DataFrame, words: int) -> DataFrame:
    """Each phrase with its lowest-scoring cut; products are decimals, as they may pass 64 bits."""
    cuts = []
    for k in range(1, words):
        left, right = F.col("starts")[k - 1], F.col("ends")[words - k - 1]
        score = F.call_function(
            "div", (_exact(F.lit(1_000_000 * 2)) * _exact(F.col("f"))), _exact(left) + _exact(right)
        )
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    lowest = F.array_min(F.array(*cuts)).alias("cut")
    return phrases.select("*", lowest).select("lang", "id", "phrase", F.col("f").alias("a"), "cut.*")


def collocations(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    *,
    frequent: int = FREQUENT,
    best: int = BEST,
    block: int = BLOCK,
    owned: int = OWNED,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``best`` phrases of each language.

    Words are parted by spaces and tabs after A-Z are lower-cased; no phrase goes over a line end or one of
    ``.,;:!?``. A phrase of two to four words counts from ``frequent`` occurrences on, overlaps included.
    Its score is the least of 2,000,000 a / (l + r), rounded down, over the cuts into a beginning (l
    occurrences) and an end (r); of equal cuts the earliest stands. Phrases that a longer one covers
    (`COVERED`) are left out. Equal scores are ordered by frequency, then by the phrase's bytes, which no
    two phrases share. n counts all words of the language.

    A null text is empty, a null language `NO_LANGUAGE`; repeated rows count as often as they come.
    Texts of any length are read whole, other columns not at all. An empty table, or one in which
    nothing is frequent, gives no rows. Texts have to be valid UTF-8.

    Every shuffle moves counts that a block has combined, or the blocks themselves, so a language or a
    word with a third of all occurrences makes no large group. There is an owner of a language's units
    for every ``owned`` words of all text.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary")).alias("text"),
    )
    blocks = staged(
        rows.mapInArrow(
            _block_rows(block),
            "block long, lang string, units binary, words array<binary>, times array<long>",
        ),
        "blocks",
    )
    sizes = blocks.select("lang", F.aggregate("times", F.lit(0).cast("bigint"), lambda n, t: n + t).alias("n"))
    totals = staged(sizes.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    owners = max(1, -(-(totals.agg(F.sum("n")).first()[0] or 0) // owned))
    counts = blocks.select("block", "lang", "words", "times").mapInArrow(_word_counts(owners), _COUNT_COLUMNS)
    often, known = _ranked(counts, owners, frequent)
    word = F.col("word").cast("string")
    shorter = often.select(
        "lang", "id", word.alias("phrase"), word.alias("last"), F.array("f").alias("starts"), F.array("f").alias("ends")
    )
    results: list[tuple[DataFrame, DataFrame | None]] = []
    for words in range(2, WORDS + 1):
        sides = blocks.select("block", "lang", "units").groupBy("block"), known.groupBy("of")
        step = sides[0].cogroup(sides[1]).applyInArrow(_step(words > 2, owners), _COUNT_COLUMNS)
        counts = staged(step, "pairs")
        dropped(blocks)
        blocks = counts.where(F.col("owner").isNull())
        often, known = _ranked(counts, owners, frequent)
        phrases = staged(_phrases(often, shorter), "phrases")
        cover = (
            phrases.select("lang", F.col("first").alias("id"), "f")
            .unionByName(phrases.select("lang", F.col("second").alias("id"), "f"))
            .groupBy("lang", "id")
            .agg(F.max("f").alias("around"))
        )
        if results:
            results[-1] = (results[-1][0], cover)
        results.append((_scored(phrases, words), None))
        shorter = phrases
    every = None
    for scored, cover in results:
        if cover is not None:
            scored = scored.join(cover, ["lang", "id"], "left").where(
                F.coalesce(_exact(F.col("around")) * 100 < _exact(F.col("a")) * COVERED, F.lit(True))
            )
        scored = scored.select("lang", "phrase", "a", "l", "r", "score")
        every = scored if every is None else every.unionByName(scored)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    top = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
