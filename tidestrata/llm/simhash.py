"""Near duplicates by SimHash, compared exactly in tiles.

Every text gets a 64-bit fingerprint of its word shingles. Distinct fingerprints are put into tiles
by the population counts of their four 16-bit parts. Two fingerprints within the radius differ by at
most the radius in the sum of these counts, so all other pairs of tiles are skipped; the tiles left
are compared with numpy: exclusive or, bit count, threshold. Nothing is estimated: every pair of
distinct fingerprints within the radius is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import stored, unused
from tidestrata.llm.components import connected

WORDS = 3
RADIUS = 2
SEED = 42
PARTS = 4
PART_BITS = 64 // PARTS
#: Room for one part's count in a class code; counts go to 16, so a neighbour outside 0-16 meets no class.
CODE_STEP = 32
#: Expected fingerprints of a tile; a pair of tiles takes at most some 16 MB in a task.
TILE = 2048
#: Shingles hashed before their bits are counted.
BLOCK = 65_536
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def simhash(data: bytes | None, words: int = WORDS) -> int:
    """The fingerprint of a UTF-8 text, as a signed 64-bit number.

    A-Z are lower-cased, words are runs without ASCII white space, shingles count as often as they
    occur. A text of fewer words is one shingle; a text without words or null has fingerprint 0.
    """
    found = (data or b"").lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = iter([b" ".join(found)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*(found[i:] for i in range(words))))
        total = len(found) - words + 1
    counts = np.zeros((8, 8), np.int64)
    hashed = xxhash.xxh64_intdigest
    for start in range(0, total, BLOCK):
        size = min(BLOCK, total - start)
        block = np.fromiter((hashed(next(shingles), SEED) for _ in range(size)), "<u8", size)
        octets = block.view(np.uint8).reshape(-1, 8)
        for place in range(8):
            counts[place] += np.bincount(octets[:, place], minlength=256) @ BITS
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the SimHash of column ``text`` as column ``name``."""

    @F.udf("bigint", useArrow=True)
    def fingerprint(data):
        return simhash(data)

    return docs.withColumn(name, fingerprint(F.col(text).cast("binary")))


def population_code(fingerprint):
    """The bit counts of the parts as one number."""
    code = F.lit(0)
    for part in range(PARTS):
        bits = F.shiftrightunsigned(fingerprint, part * PART_BITS).bitwiseAND(F.lit(2**PART_BITS - 1))
        code = code * CODE_STEP + F.bit_count(bits)
    return code


def near_codes(radius: int) -> list[int]:
    """What to add to a class code to reach each near class once: no change, and one of each sign."""
    reach = range(-radius, radius + 1)
    codes = set()
    for steps in product(reach, repeat=PARTS):
        if sum(map(abs, steps)) <= radius:
            code = 0
            for step in steps:
                code = code * CODE_STEP + step
            codes.add(code)
    return sorted(c for c in codes if c >= 0)


def near_fingerprints(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between the distinct fingerprints (column fp) that connect all pairs in ``radius``.

    Of the pairs within two tiles a spanning forest is returned, so links stay in proportion to the
    rows, while their connected components are those of all pairs.
    """
    coded = distinct.select("fp", population_code(F.col("fp")).alias("code"))
    # At most 17^4 classes, whatever the input: small enough to broadcast.
    classes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("blocks"))
    tiles = (
        coded.join(F.broadcast(classes), "code")
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .groupBy("code", "block")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = stored(tiles, "tiles")

    near = F.explode(F.array(*map(F.lit, near_codes(radius))))
    other = classes.select(F.col("code").alias("code_b"), F.col("blocks").alias("blocks_b"))
    pairs = (
        classes.select("code", "blocks", near.alias("step"))
        .withColumn("code_b", F.col("code") + F.col("step"))
        .join(F.broadcast(other), "code_b")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("block_b", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)))
        .where((F.col("step") > 0) | (F.col("block") <= F.col("block_b")))
    )
    right = tiles.select(
        F.col("code").alias("code_b"), F.col("block").alias("block_b"), F.col("fps").alias("fps_b")
    )
    compared = pairs.join(tiles, ["code", "block"]).join(right, ["code_b", "block_b"])
    same = (F.col("step") == 0) & (F.col("block") == F.col("block_b"))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, equal = (batch.column(i) for i in range(3))
            a, b = [], []
            for i in range(batch.num_rows):
                one = left[i].values.to_numpy(zero_copy_only=False)
                two = right[i].values.to_numpy(zero_copy_only=False)
                for x, y in tile_links(one, two, equal[i].as_py(), radius):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return compared.select("fps", "fps_b", same.alias("same")).mapInArrow(links, "a bigint, b bigint")


def tile_links(left: np.ndarray, right: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of two tiles that are within ``radius`` bits."""
    parent: dict[int, int] = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    kept = []
    for start in range(0, len(left), 256):
        part = left[start : start + 256]
        other = right[start:] if same else right
        # Bits of a signed number would be counted in its absolute value.
        differing = (part[:, None] ^ other[None, :]).view(np.uint64)
        close = np.bitwise_count(differing) <= radius
        for i, j in zip(*np.nonzero(close)):
            x, y = int(part[i]), int(other[j])
            if x != y and (a := root(x)) != (b := root(y)):
                parent[a] = b
                kept.append((x, y))
    return kept


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, digest, fingerprint, first_id, first_digest) of every row of ``docs``.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; ``first_id`` and
    ``first_digest`` name the smallest member (by id, then digest of the text) of the group a row is
    linked to directly or through others. Nulls: a null text has fingerprint 0 like an empty one; a
    null id counts after every other, so a group of null ids has ``first_id`` null. Rows repeated in
    id and text are one member. An empty input gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    rows = with_fingerprint(rows, "text", "fp").select("id", F.xxhash64("text").alias("digest"), "fp")
    rows = stored(rows, "fingerprints")
    member = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    firsts = rows.groupBy("fp").agg(F.min(member).alias("first"))

    labels = connected(near_fingerprints(firsts.select("fp"))).withColumnRenamed("node", "fp")
    linked = firsts.join(labels, "fp")
    heads = linked.groupBy("component").agg(F.min("first").alias("head"))
    heads = labels.join(heads, "component").select("fp", "head")
    groups = firsts.join(heads, "fp", "left").select("fp", F.coalesce("head", "first").alias("first"))
    return rows.join(groups, "fp", "left").select(
        "id",
        "digest",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("first_id"),
        F.col("first.digest").alias("first_digest"),
    )


def without_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the first of their group, all columns as they were.

    Rows repeated in id and text stay together; remove exact copies before.
    """
    groups = near_duplicates(docs, id, text)
    later_id, later_digest = unused(docs, "_later_id"), unused(docs, "_later_digest")
    later = groups.where(
        ~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("digest") == F.col("first_digest")))
    ).select(F.col("id").alias(later_id), F.col("digest").alias(later_digest))
    here = F.col(id).eqNullSafe(F.col(later_id)) & (F.xxhash64(F.col(text)) == F.col(later_digest))
    return docs.join(later, here, "left_anti")
