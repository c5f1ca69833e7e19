"""Exact duplicates through an extendible-hash index on shared files.

The directory maps the leading bits of a text's 64-bit hash to buckets. It starts as one bucket;
a bucket with more than its share of distinct hashes is split, doubling the directory where it has
to. Buckets are ranges of hashes. Texts are dealt by the directory: an owner task gets the buckets of a
range of hashes, chains the texts that meet under one hash, tells the chain's entries apart by their
bytes, and writes for each text which row stays and how many there are. What becomes of a row is read
from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import ascii_lower, stored, unused
from tidestrata.operators.bounds import broadcast_if_small

#: Distinct hashes a bucket holds before it is split.
BUCKET_HASHES = 10_000
#: Leading bits of a hash that at most tell owners apart; an owner may have many buckets.
OWNER_BITS = 13
#: Entries that the rows of one text are combined into before they are dealt.
SALTS = 16
#: Leading bits a round of splitting looks at.
ROUND_BITS = 12
HASH_BITS = 64


def normal_text(text: Column) -> Column:
    """A text as compared: null as empty, A-Z lower-cased."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def leading(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of a hash as a number."""
    return F.shiftrightunsigned(key, HASH_BITS - bits) if bits else F.lit(0).cast("bigint")


def directory(keys: DataFrame, capacity: int = BUCKET_HASHES) -> tuple[DataFrame, int]:
    """Buckets (prefix, depth, hashes) of the distinct hashes in ``keys`` (key), and the depth.

    One aggregation counts hashes by their first bits; from it follow the counts of every shorter
    prefix, hence which buckets overflow and are split. Only buckets that are still too full after
    ``ROUND_BITS`` more bits need another look at their hashes.
    """
    leaves, base, depth = None, 0, 0
    while True:
        deep = min(base + ROUND_BITS, HASH_BITS)
        cells = keys.groupBy(leading(F.col("key"), deep).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
        levels = (
            cells.select("cell", "n", F.explode(F.sequence(F.lit(base), F.lit(deep))).alias("depth"))
            .withColumn("prefix", F.expr(f"shiftrightunsigned(cell, {deep} - depth)"))
            .groupBy("depth", "prefix")
            .agg(F.sum("n").alias("hashes"))
        )
        levels = stored(levels, "directory")
        full = levels.where(F.col("hashes") > capacity)
        parents = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        split = levels.withColumn("parent", F.shiftrightunsigned("prefix", 1)).join(
            parents, ["depth", "parent"], "left_semi"
        )
        if base == 0:
            split = split.select(*levels.columns).unionByName(levels.where(F.col("depth") == 0))
        last = deep == HASH_BITS
        fits = split.select(*levels.columns).where(
            (F.col("hashes") <= capacity) | (F.lit(last) & (F.col("depth") == deep))
        )
        leaves = fits if leaves is None else leaves.unionByName(fits)
        depth = max(depth, fits.agg(F.max("depth")).first()[0] or 0)
        over = full.where(F.col("depth") == deep)
        if last or over.isEmpty():
            return leaves, depth
        over = over.select(F.col("prefix").alias("over"))
        keys = keys.join(over, leading(F.col("key"), deep) == F.col("over"), "left_semi")
        base = deep


def with_bucket(entries: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """``entries`` with the prefix and depth of the bucket that owns their hash."""
    spread = leaves.withColumn("width", F.lit(depth) - F.col("depth"))
    cells = spread.select(
        F.explode(
            F.expr("sequence(shiftleft(prefix, width), shiftleft(prefix + 1, width) - 1)")
        ).alias("cell"),
        F.col("prefix").alias("bucket"),
        F.col("depth").alias("bucket_depth"),
    )
    return (
        entries.withColumn("cell", leading(F.col("key"), depth))
        .join(broadcast_if_small(cells), "cell")
        .drop("cell")
    )


def text_rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    normal = normal_text(F.col(text))
    return docs.select(F.col(id).alias("id"), normal.alias("normal")).select(
        "id", "normal", F.xxhash64("normal").alias("key"), F.unhex(F.sha2("normal", 256)).alias("sha")
    )


def owner_of(depth: int) -> tuple[Column, int]:
    """The owner of a bucket, by the first hash of its range, and the number of owners."""
    bits = min(depth, OWNER_BITS)
    first = F.expr(f"shiftleft(bucket, {depth} - bucket_depth)")
    return F.shiftrightunsigned(first, depth - bits).cast("int").alias("owner"), 1 << bits


def duplicate_index(docs: DataFrame, id: str, text: str, capacity: int = BUCKET_HASHES):
    """(rows, index): the stored rows (id, key, sha, copies) and index of ``docs``.

    The index has one entry per distinct text: owner, bucket, key, sha, keep_id, group_size. Rows equal
    in id and text are one row with their number as ``copies``. A text alone under its hash comes
    without its bytes, as there is nothing to compare it with. The rows of any other are combined into at
    most `SALTS` entries before they are dealt, so that one with a third of all rows makes no large group.
    """
    texts = text_rows(docs, id, text)
    rows = stored(texts.groupBy("id", "key", "sha").agg(F.count(F.lit(1)).alias("copies")), "rows")
    keys = stored(
        rows.groupBy("key").agg(
            F.sum("copies").alias("group_size"), F.max("id").alias("keep_id"), F.min("sha").alias("sha")
        ),
        "hashes",
    )
    nothing = F.lit(None).cast("string").alias("normal")
    alone = keys.where(F.col("group_size") == 1).select("key", nothing, "sha", "keep_id", "group_size")
    chained = broadcast_if_small(keys.where(F.col("group_size") > 1).select("key"))
    salt = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(1)), F.lit(SALTS)).alias("salt")
    chains = texts.join(chained, "key", "left_semi").groupBy("key", "normal", "sha", salt).agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    leaves, depth = directory(keys, capacity)
    owner, owners = owner_of(depth)
    entries = with_bucket(chains.drop("salt").unionByName(alone), leaves, depth).select("*", owner)
    # Dealt by owner, equal texts are in one task, where the rest happens without another shuffle.
    dealt = entries.repartitionById(owners, F.col("owner"))
    told = dealt.groupBy("owner", "bucket_depth", "bucket", "key", "normal", "sha").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    index = told.drop("normal").sortWithinPartitions("owner", "bucket", "key")
    return rows, stored(index, "index")


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    Texts are equal if their bytes are after A-Z are lower-cased; null counts as empty. Of equal
    texts the row with the largest id is kept; null ids come last, so a group without ids keeps one
    row and has ``keep_id`` null. Of rows repeated in id and text one is kept, and all are returned.
    An empty input gives an empty result; other columns are not read.
    """
    rows, index = duplicate_index(docs, id, text)
    joined = rows.join(index.select("key", "sha", "keep_id", "group_size"), ["key", "sha"])
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    return joined.select("*", copy).select(
        "id",
        "keep_id",
        "group_size",
        ((F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def without_exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that `exact_duplicates` keeps, all columns as they were."""
    rows, index = duplicate_index(docs, id, text)
    names = {c: unused(docs, f"_{c}") for c in ("key", "sha", "keep_id", "copies")}
    groups = (
        index.where(F.col("group_size") > 1)
        .join(rows, ["key", "sha"])
        .where(F.col("id").eqNullSafe(F.col("keep_id")))
        .select(*(F.col(c).alias(n) for c, n in names.items()))
    )
    key, sha, keep, copies = (F.col(n) for n in names.values())
    normal = normal_text(F.col(text))
    same = (F.xxhash64(normal) == key) & (F.unhex(F.sha2(normal, 256)) == sha)
    marked = docs.join(broadcast_if_small(groups), same, "left")
    kept = marked.where(key.isNull() | F.col(id).eqNullSafe(keep))
    single = kept.where(F.coalesce(copies, F.lit(1)) == 1)
    repeated = kept.where(copies > 1).dropDuplicates([names["key"], names["sha"]])
    return single.unionByName(repeated).select(*docs.columns)
