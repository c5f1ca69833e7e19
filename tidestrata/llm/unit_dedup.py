"""Removal of repeated passages by hashing lines, paragraphs or sentences.

Texts are cut into units whose normalised words are digested. Digests are grouped over all
documents; the earliest occurrence of each stays and the others are cut out, with their places in
the original text kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestrata.llm.common import unused

#: What a unit is. Sentences end at ``.``, ``!`` or ``?`` before white space, and with their line.
UNITS = {
    "paragraph": r"(?:(?!\n[ \t\r]*\n).)+",
    "line": r"[^\n]+",
    "sentence": r"[^\n.!?]+(?:[.!?]+(?![\s.!?])[^\n.!?]*)*[.!?]*",
}
#: Units of fewer words are too common to tell a copy from chance.
MIN_WORDS = 5
WORD = re.compile(r"[^\W_]+")
#: Units a task gathers before it passes them on.
BATCH = 50_000


def units_of(text: str | None, unit: str = "sentence", min_words: int = MIN_WORDS) -> list[tuple]:
    """(start, stop, digest) of the units of a text with at least ``min_words`` words.

    Places count characters. The digest is that of the lower-cased words, so units that differ in
    case, punctuation or spacing are equal.
    """
    found = []
    pattern = re.compile(UNITS[unit], re.DOTALL)
    for match in pattern.finditer(text or ""):
        words = WORD.findall(match[0].lower())
        if len(words) >= min_words:
            found.append((*match.span(), xxhash.xxh128_digest(" ".join(words).encode())))
    return found


def _unit_rows(docs: DataFrame, id: str, text: str, unit: str, min_words: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, units = [], []
            for row, value in enumerate(batch.column(2)):
                found = units_of(value.as_py(), unit, min_words)
                rows.extend([row] * len(found))
                units.extend(found)
                if len(units) >= BATCH or row == batch.num_rows - 1:
                    own = batch.select([0, 1]).take(pa.array(rows, pa.int32()))
                    start, stop, digest = zip(*units) if units else ((), (), ())
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(digest, pa.binary())],
                        ["id", "digest_of_text", "start", "stop", "digest"],
                    )
                    rows, units = [], []

    texts = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("digest_of_text"), F.col(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.mapInArrow(cut, f"id {kind}, digest_of_text bigint, start int, stop int, digest binary")
    # Ids first, null ones last; then place.
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest_of_text", "start")
    return rows.select(rank.alias("rank"), "stop", "digest")


def repeated_units(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    unit: str = "sentence",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """(id, digest_of_text, start, stop, first_id, first_start) of every unit but the earliest of its kind.

    Occurrences rank by id, then by place in the text; null ids come last. Rows repeated in id and
    text are one document, so both keep what is earliest in it. Units are combined by digest before
    the shuffle, and the units of repeated digests alone are looked at again: a unit that every
    document has costs one row per task there, and its copies, which are all results, are spread.
    """
    rows = _unit_rows(docs, id, text, unit, min_words)
    digests = rows.groupBy("digest").agg(
        F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Repeated digests grow with the documents, so they are not broadcast.
    repeated = digests.where(F.col("n") > 1).select("digest", "first").hint("merge")
    return rows.join(repeated, "digest").where(F.col("rank") != F.col("first")).select(
        "rank.id",
        "rank.digest_of_text",
        "rank.start",
        "stop",
        F.col("first.id").alias("first_id"),
        F.col("first.start").alias("first_start"),
    )


def without_repeated_units(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with repeated units cut out of ``text`` and their places in ``removed``.

    ``removed`` lists (start, stop, first_id, first_start) by place in the original text, counted in
    characters; everything outside these places stays, so text and places give the original back
    with the earliest occurrences. Null and empty texts have nothing removed. Rows repeated in id
    and text are treated alike. Other columns stay; a column named ``removed`` is replaced.
    """
    spans = repeated_units(docs, id, text, **options)
    place = F.struct("start", "stop", "first_id", "first_start")
    # A text has no more spans than units.
    cuts = spans.groupBy("id", "digest_of_text").agg(
        F.sort_array(F.collect_set(place)).alias("spans")
    )
    cut_id, cut_text, cut_spans = (unused(docs, c) for c in ("_cut_id", "_cut_text", "_cut_spans"))
    cuts = cuts.select(
        F.col("id").alias(cut_id), F.col("digest_of_text").alias(cut_text), F.col("spans").alias(cut_spans)
    )
    same = F.col(id).eqNullSafe(F.col(cut_id)) & (F.xxhash64(F.col(text)) == F.col(cut_text))

    def kept(i):
        """What lies before the cut of number ``i`` and after the one before it."""
        cuts_of = F.col(cut_spans)
        start = F.when(i == 0, 0).otherwise(F.get(cuts_of, i - 1)["stop"])
        stop = F.when(i == F.size(cuts_of), F.length(text)).otherwise(F.get(cuts_of, i)["start"])
        return F.substring(F.col(text), start + 1, stop - start)

    pieces = F.transform(F.sequence(F.lit(0), F.size(cut_spans)), kept)
    none = F.array().cast(cuts.schema[cut_spans].dataType)
    joined = docs.join(cuts, same, "left")
    whole = F.col(cut_spans).isNull()
    return joined.withColumns(
        {
            text: F.when(whole, F.col(text)).otherwise(F.array_join(pieces, "")),
            "removed": F.coalesce(cut_spans, none),
        }
    ).drop(cut_id, cut_text, cut_spans)
