"""Benchmark items found inside documents, by size-partitioned MinHash containment search.

Items are put into partitions by their number of shingles, sizes doubling from one to the next. An
item's sketch holds the k smallest values of its shingles' hashes, with one k for each partition. A
document becomes a candidate for an item when it holds any value of the sketch, however long the
document is. At containment ``threshold`` an item of n shingles misses at most
``n - ceil(threshold * n)`` of them, and k is one more for the largest item of the partition, so
the search misses nothing. Candidates are verified by exact shingle containment.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import stored, unused
from tidestrata.operators.bounds import broadcast_if_small, row_bytes

WORDS = 5
THRESHOLD = 0.8
#: Bytes of items that one pass over the documents searches for; more items take more passes.
BLOCK_BYTES = 16 * 1024 * 1024
#: Word hashes, and items' shingle sets, a task remembers before it starts anew.
MEMORY = 200_000
SETS = 2_000
FILTER_BITS = 20
MATCHES = "array<struct<item_id: bigint, shared: int, shingles: int>>"
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORD.findall((text or "").lower())


def shingles_of(words: Sequence[str], size: int = WORDS) -> set[tuple[str, ...]]:
    """Distinct word shingles; a shorter sequence is one shingle, an empty one none."""
    if not words:
        return set()
    size = min(size, len(words))
    return set(zip(*(words[i:] for i in range(size))))


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word):
        if len(self) >= MEMORY:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value

    def shingles(self, words: Sequence[str], size: int) -> np.ndarray:
        """A hash for each shingle of ``size`` words, in order."""
        hashed = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        count = len(words) - size + 1
        mixed = np.zeros(max(count, 0), np.uint64)
        for place in range(size):
            mixed *= np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed += hashed[place : place + count] if count > 0 else np.uint64(0)
        return mixed ^ (mixed >> np.uint64(32))


class Search:
    """The items of a block, ready to be looked for in one text after another.

    Sketches are sorted arrays of 12 bytes a value, and shingles of an item are made when it is a
    candidate, so a block takes little more memory than its texts.
    """

    def __init__(self, items: Sequence[tuple[int, str]], threshold: float = THRESHOLD, size: int = WORDS):
        self.threshold, self.size = threshold, size
        #: Item id, words of a shingle, number of shingles, text.
        self.items: list[tuple[int, int, int, str]] = []
        self.known: dict[int, set] = {}
        partitions = defaultdict(list)
        hashes = WordHashes()
        for item_id, text in items:
            words = words_of(text)
            count = len(shingles_of(words, size))
            if count:
                width = min(size, len(words))
                values = np.unique(hashes.shingles(words, width))
                partitions[width, count.bit_length()].append((len(self.items), count, values))
                self.items.append((item_id, width, count, text))
        found = defaultdict(list)
        for (width, _), members in partitions.items():
            k = max(self._missing(count) for _, count, _ in members) + 1
            found[width] += [(values[:k], np.full(min(k, len(values)), i, np.int32)) for i, _, values in members]
        self.sketches, self.filters = {}, {}
        for width, parts in found.items():
            values, owners = map(np.concatenate, zip(*parts))
            order = np.argsort(values, kind="stable")
            self.sketches[width] = values[order], owners[order]
            self.filters[width] = np.zeros(2**FILTER_BITS, bool)
            self.filters[width][values >> np.uint64(64 - FILTER_BITS)] = True

    def _missing(self, n: int) -> int:
        """The most of ``n`` shingles that may be missing."""
        return n - max(1, math.ceil(self.threshold * n - 1e-9))

    def candidates(self, words: Sequence[str], hashes: WordHashes) -> set[int]:
        met: set[int] = set()
        for width, (values, owners) in self.sketches.items():
            if len(words) < width:
                continue
            mixed = hashes.shingles(words, width)
            mixed = np.unique(mixed[self.filters[width][mixed >> np.uint64(64 - FILTER_BITS)]])
            first, last = np.searchsorted(values, mixed, "left"), np.searchsorted(values, mixed, "right")
            for i in np.nonzero(last > first)[0]:
                met.update(owners[first[i] : last[i]].tolist())
        return met

    def shingles(self, i: int) -> set:
        if i not in self.known:
            if len(self.known) >= SETS:
                self.known.clear()
            self.known[i] = shingles_of(words_of(self.items[i][3]), self.size)
        return self.known[i]

    def matches(self, text: str | None, hashes: WordHashes) -> list[tuple[int, int, int]]:
        """(item id, shared shingles, the item's shingles) of the items that the text contains."""
        words = words_of(text)
        result, own = [], {}
        for i in sorted(self.candidates(words, hashes)):
            item_id, width, count, _ = self.items[i]
            if width not in own:
                own[width] = shingles_of(words, width)
            shared = len(self.shingles(i) & own[width])
            if shared / count >= self.threshold:
                result.append((item_id, shared, count))
        return result


def with_matches(
    docs: DataFrame,
    items: DataFrame,
    name: str,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with the items each text contains as column ``name``, sorted by item id.

    Containment is the share of an item's distinct shingles of ``words`` words that the text has; an
    item of fewer words is one shingle of all of them, one without words or with a null text is in
    no text. Null and empty texts contain nothing. Repeated items, or several under a null id, are
    reported one by one. Items are the query set: they go to the tasks in blocks of at most about
    ``block_bytes``, one pass over the texts for each, so that a task holds one block. With one block
    documents are neither shuffled nor grouped; with more, what the passes find is put together by
    128-bit digests of the texts, which equal texts share.
    """
    small = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    total = small.agg(F.sum(row_bytes(small)).alias("bytes")).first()["bytes"] or 0
    blocks = math.ceil(total / block_bytes)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(max(blocks, 1)))

    def search(block: int):
        chosen = [tuple(row) for row in small.where(part == block).collect()]
        return _finder(Search(sorted(chosen, key=str), threshold, words))(F.col(text))

    empty = F.array().cast(MATCHES)
    if blocks <= 1:
        return docs.withColumn(name, F.array_sort(search(0)) if blocks else empty)
    key, met = unused(docs, "_digest"), unused(docs, "_found")
    digest = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    passes = [
        docs.select(digest.alias(key), search(block).alias(met))
        .where(F.size(met) > 0)
        .groupBy(key)
        .agg(F.first(met).alias(met))
        for block in range(blocks)
    ]
    # A text has at most one row of each block, and no more matches than items.
    found = reduce(DataFrame.unionByName, passes).groupBy(key).agg(
        F.array_sort(F.flatten(F.collect_list(met))).alias(met)
    )
    joined = docs.join(broadcast_if_small(stored(found, "matches")), digest == F.col(key), "left")
    return joined.withColumn(name, F.coalesce(met, empty)).drop(key, met)


def _finder(search: Search):
    """A function of the text. Called not deterministic, as filters on its result would search again."""
    hashes = WordHashes()

    @F.udf(MATCHES, useArrow=True)
    def find(text):
        return search.matches(text, hashes)

    return find.asNondeterministic()


def contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """(id, item_id, shared, shingles, containment) of every document and item it contains."""
    found = with_matches(docs.select(F.col(id).alias("id"), "text"), items, "match", **options)
    return found.select("id", F.explode("match").alias("match")).select(
        "id", "match.*", (F.col("match.shared") / F.col("match.shingles")).alias("containment")
    )


def without_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns as they were."""
    name = unused(docs, "_matches")
    return with_matches(docs, items, name, **options).where(F.size(name) == 0).drop(name)
