"""Removal of lines that many sites share.

The spread of a line, the number of distinct sites it occurs on, is counted with HyperLogLog
sketches, one per line digest, that partial aggregation merges. Where a sketch's estimate is too
close to the threshold to decide, the sites of just those lines are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import stored, unused
from tidestrata.operators.bounds import broadcast_if_small

#: A line on this many sites or more is boilerplate.
MIN_SITES = 5
#: Base-2 logarithm of a sketch's registers; the standard error is 1.04 / 2^(LG_K / 2).
LG_K = 10
#: Standard errors around the threshold within which sites are counted exactly.
MARGIN = 6
#: Runs of white space other than a single space.
RUNS = " {2,}| *[\\t\\r\\x0B\\f][ \\t\\r\\x0B\\f]*"


def line_key(line: Column) -> Column:
    """A line as compared: lower-cased, runs of ASCII white space one space, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(line), RUNS, " "))


def lines_of(docs: DataFrame, site: str, text: str) -> DataFrame:
    """(doc, pos, site, key) of all lines that are not blank.

    ``doc`` is the pair of hashes of the text and ``key`` that of the line: 128 bits each.
    """
    lines = docs.select(
        F.struct(*_hashes(F.col(text))).alias("doc"),
        F.col(site).alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"),
    ).withColumn("line", line_key(F.col("line")))
    return lines.where(F.col("line") != "").select(
        "doc", "pos", "site", F.struct(*_hashes(F.col("line"))).alias("key")
    )


def _hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b")]


def shared_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """The keys of lines on at least ``min_sites`` distinct sites. A null site counts as none."""
    error = MARGIN * 1.04 / 2 ** (lg_k / 2)
    low, high = min_sites * (1 - error) - 1, min_sites * (1 + error) + 1
    spread = lines.groupBy("key").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg(F.col("site").cast("string"), lg_k)).alias("sites"),
        F.count(F.lit(1)).alias("rows"),
    )
    # A line with fewer rows than sites asked for cannot be on so many.
    spread = stored(spread.where((F.col("rows") >= min_sites) & (F.col("sites") >= low)), "spread")
    sure = spread.where(F.col("sites") > high).select("key")
    near = spread.where(F.col("sites") <= high).select("key")
    counted = (
        lines.join(broadcast_if_small(near), "key", "left_semi")
        .where(F.col("site").isNotNull())
        .select("key", "site")
        .distinct()
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    return stored(sure.unionByName(counted.select("key")), "shared-lines")


def without_shared_lines(
    docs: DataFrame, site: str = "source", text: str = "text", min_sites: int = MIN_SITES
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text`` and a column ``removed_lines``.

    ``removed_lines`` holds the numbers (from 0) of the lines removed from the original text, in
    order. Blank lines stay. A null text stays null, an empty one empty, both with nothing removed;
    rows with a null site keep their lines' share of no site but lose boilerplate like others.
    Repeated rows are treated alike, since removal depends on the text alone. Other columns stay; a
    column of ``docs`` named ``removed_lines`` is replaced.
    """
    lines = stored(lines_of(docs, site, text), "lines")
    shared = broadcast_if_small(shared_lines(lines, min_sites))
    hits = lines.select("doc", "pos", "key").join(shared, "key", "left_semi")
    # Positions of one text are at most its lines; equal texts share one list.
    removed = hits.groupBy("doc").agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    doc, positions = unused(docs, "_doc"), unused(docs, "_positions")
    removed = removed.select(F.col("doc").alias(doc), F.col("positions").alias(positions))
    named = docs.join(removed, F.struct(*_hashes(F.col(text))) == F.col(doc), "left")
    kept = F.filter(
        F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(F.col(positions), i)
    )
    return named.withColumns(
        {
            text: F.when(F.col(positions).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
            "removed_lines": F.coalesce(F.col(positions), F.array().cast("array<int>")),
        }
    ).drop(doc, positions)
