"""Category documents: one JSON object per file, normally with an ``items`` list."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tidestrata.functions import region_of_path
from tidestrata.schemas import CATEGORY_ITEM, LANDING_STAMP
from tidestrata.sources.files import (
    JSON_FILES,
    JSON_NAME,
    as_pattern,
    listed_files,
    qualified,
    wanted_files,
)
from tidestrata.sources.rejected import NO_ITEMS, NOT_JSON
from tidestrata.sources.statistics import BAD, document_options


def found_item(spark: SparkSession, path: str | list[str], **options) -> StructType:
    """The declared item fields and, as text, further ones of the items in the files.

    Fields outside any ``items`` count only where no document has the list.
    """
    try:
        found = spark.read.options(**options, primitivesAsString=True).json(path).schema
    except AnalysisException as problem:
        if problem.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return CATEGORY_ITEM
    if "items" not in found.names:
        own = {"_corrupt_record", "_pipeline_metadata"}
        return with_further(CATEGORY_ITEM, StructType([f for f in found if f.name not in own]))
    items = found["items"].dataType
    entry = items.elementType if isinstance(items, ArrayType) else None
    return with_further(CATEGORY_ITEM, entry) if isinstance(entry, StructType) else CATEGORY_ITEM


def with_further(declared: StructType, found: StructType) -> StructType:
    """``declared`` with the fields that only ``found`` has, at every level."""
    others = {f.name.lower(): f for f in found.fields}
    fields = []
    for field in declared.fields:
        other = others.pop(field.name.lower(), None)
        kind = field.dataType
        if other is not None and isinstance(kind, StructType) and isinstance(other.dataType, StructType):
            kind = with_further(kind, other.dataType)
        fields.append(StructField(field.name, kind))
    return StructType(fields + list(others.values()))


def category_documents(
    spark: SparkSession,
    path: str,
    *,
    layout: str = "documents",
    item: StructType | None = None,
    files: list[str] | None = None,
    **options,
) -> DataFrame:
    """One row per document: items, region, file, its times, and the text if unreadable.

    A document without an ``items`` list is taken as one item itself. ``item`` declares the item's
    fields; without it they are the usual ones and whatever else the files hold, found by a pass
    over them. A field the document lacks is null. Given ``files``, exactly those are read.
    """
    settings = {"pathGlobFilter": JSON_FILES, "recursiveFileLookup": True} | document_options(layout)
    named = files if files is not None else listed_files(spark, path)
    found = wanted_files(qualified(spark, path), named, JSON_NAME, region=False)
    if files is not None:
        path = [as_pattern(file) for file in found]
    item = item or found_item(spark, path, **(settings | options))
    # "items" is declared next to the item's own fields, for the document that is one item.
    document = StructType(
        [
            StructField("items", ArrayType(item)),
            *item.fields,
            StructField("_pipeline_metadata", LANDING_STAMP),
            StructField(BAD, StringType()),
        ]
    )
    settings["columnNameOfCorruptRecord"] = BAD
    raw = spark.read.schema(document).options(**(settings | options)).json(path)
    fields = [F.col(field.name) for field in item.fields]
    items = F.coalesce("items", F.array(F.struct(*fields)))
    # A field of another type than declared marks a document too, but leaves the rest readable.
    found = [value.isNotNull() for value in (F.col("items"), *fields)]
    readable = reduce(or_, found, F.col(BAD).isNull())
    return raw.select(
        F.when(readable, items).alias("items"),
        F.when(~readable, F.col(BAD)).alias("unreadable"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.coalesce("_pipeline_metadata.ingestion_timestamp", F.lit("")).alias("_landed_at"),
        region_of_path(F.col("_metadata.file_path")).alias("region"),
    )


def refused_documents(documents: DataFrame) -> DataFrame:
    """(source, region, file, place, reason, record) of category documents that give no items."""
    unreadable = F.col("items").isNull()
    return documents.where(unreadable | (F.size("items") == 0)).select(
        F.lit("categories").alias("source"),
        "region",
        F.col("_source_file").alias("file"),
        F.lit(0).cast("bigint").alias("place"),
        F.when(unreadable, NOT_JSON).otherwise(NO_ITEMS).alias("reason"),
        F.col("unreadable").alias("record"),
    )
