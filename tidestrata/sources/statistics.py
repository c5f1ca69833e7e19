"""Raw statistics files.

Each reader declares its schema, so no file is read twice to infer one. Given ``files``, a reader takes
exactly those, as a stream does that has learnt which ones are new; otherwise all files under the path
at any depth. Records that cannot be read are marked (``sources.rejected``) by the ``_input`` readers
and left out by the ``_statistics`` ones.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidestrata.operators.columns import flatten, quoted
from tidestrata.schemas import API_DOCUMENT, CSV_SCHEMA
from tidestrata.sources.files import (
    CSV_FILES,
    CSV_NAME,
    JSON_FILES,
    JSON_NAME,
    as_pattern,
    by_depth,
    first_lines,
    listed_files,
    qualified,
    wanted_files,
    whole_or_listed,
)
from tidestrata.sources.rejected import MARKS, NO_LIST, NOT_JSON, RAGGED, accepted, marks

LAYOUTS = ("documents", "lines")
BAD = "_unparsed"


def document_options(layout: str) -> dict[str, object]:
    if layout not in LAYOUTS:
        raise ValueError(f"layout is one of {LAYOUTS}, not {layout!r}")
    return {"multiLine": layout == "documents"}


def keep_regions(frame: DataFrame, regions: Iterable[str] | None) -> DataFrame:
    """Only the named region partitions, as spelled in storage; None keeps all.

    On a table partitioned by region this becomes a partition filter, so other regions' files
    are not even listed.
    """
    return frame if regions is None else frame.where(F.col("region").isin(list(regions)))


def with_bad(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BAD, StringType())])


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name != "region"]
    fields += ["region string", *(f"{m} {'long' if m == MARKS[2] else 'string'}" for m in MARKS)]
    return spark.createDataFrame([], ", ".join(fields))


def csv_input(
    spark: SparkSession,
    path: str,
    *,
    layout: str = "documents",
    files: list[str] | None = None,
    regions: Iterable[str] | None = None,
    **options,
) -> DataFrame:
    """CSV rows under ``region=xx/``, at any depth, as text columns, with marks on those that are ragged.

    Files that no reader takes are an error (``wanted_files``). Files of other than the chosen
    ``regions`` are not opened. Columns go by the header of each file, in whatever order; one that a
    file lacks is null, further ones are left out. A row with more or fewer fields than its header is
    marked.

    Descriptions hold line breaks inside quotes, so with the ``documents`` layout a file is parsed as a
    whole and files are the unit of parallelism. Where no field has a line break, ``lines`` lets Spark
    split files.
    """
    settings = {"quote": '"', "escape": '"', "basePath": path, "columnNameOfCorruptRecord": BAD}
    settings |= document_options(layout) | options | {"header": True, "enforceSchema": False}
    root = qualified(spark, path)
    listed = files if files is not None else listed_files(spark, path)
    found = wanted_files(root, listed, CSV_NAME, regions=regions)
    headers = defaultdict(list)
    for file, head in first_lines(spark, found).items():
        headers[head].append(file)
    frames = []
    for head, group in headers.items():
        names = next(csv.reader([head.removeprefix("\ufeff")]))
        schema = with_bad(StructType([StructField(name, StringType()) for name in names]))
        reader = spark.read.schema(schema).options(**settings)
        if files is None and len(headers) == 1:
            reader = reader.option("pathGlobFilter", CSV_FILES)
            frames += whole_or_listed(root, listed, group, regions, reader.csv)
        else:
            frames += [reader.csv([as_pattern(f) for f in level]) for level in by_depth(root, group)]
    rows = [named_columns(frame) for frame in frames]
    return reduce(DataFrame.unionByName, rows) if rows else no_rows(spark, CSV_SCHEMA)


def named_columns(frame: DataFrame) -> DataFrame:
    """The declared columns by name, null where ``frame`` has none, and marks on ragged rows."""
    # Spark wants a query to name another column of the file as well, even one that only counts rows.
    sizes = F.length(BAD) + F.length(F.coalesce(quoted(frame.columns[0]), F.lit("")))
    ragged = F.when(sizes >= 0, F.lit(RAGGED))
    return frame.select(
        *[
            (quoted(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in CSV_SCHEMA.fields
        ],
        *marks(ragged, F.col(BAD)),
    )


def csv_statistics(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows of ``csv_input`` that can be read."""
    return accepted(csv_input(spark, path, **options))


def api_items(documents: DataFrame, *context: str | Column) -> DataFrame:
    """One row per entry of ``items``, nested fields as dotted columns, next to ``context``."""
    exploded = documents.select(*context, F.explode("items").alias("item"))
    kept = [name for name in exploded.columns if name != "item"]
    return flatten(exploded.select(*kept, "item.*"))


def api_input(
    spark: SparkSession,
    path: str,
    *,
    layout: str = "documents",
    files: list[str] | None = None,
    regions: Iterable[str] | None = None,
    **options,
) -> DataFrame:
    """Video items of API documents under ``region=xx/``, flattened, and a marked row per unreadable one.

    Documents are found at any depth, normally ``region=/date=/hour=``; files that no reader takes are
    an error (``wanted_files``). A document that is no JSON object, or has no list of items, is marked. A
    field of another type than declared is null and leaves the rest readable.
    """
    settings = {"basePath": path, "columnNameOfCorruptRecord": BAD} | document_options(layout) | options
    reader = spark.read.schema(with_bad(API_DOCUMENT)).options(**settings)
    root = qualified(spark, path)
    listed = files if files is not None else listed_files(spark, path)
    found = wanted_files(root, listed, JSON_NAME, regions=regions)
    if not found:
        return api_items(no_rows(spark, API_DOCUMENT), "region", *MARKS)
    if files is None:
        whole = reader.option("pathGlobFilter", JSON_FILES)
        frames = whole_or_listed(root, listed, found, regions, whole.json)
    else:
        frames = [reader.json([as_pattern(f) for f in level]) for level in by_depth(root, found)]
    reason = F.when(F.col("items").isNull(), F.when(F.col(BAD).isNotNull(), NOT_JSON).otherwise(NO_LIST))
    record = F.coalesce(F.col(BAD), F.to_json("_pipeline_metadata"))
    # An unreadable document keeps one row, of an item without fields.
    nothing = F.array(F.lit(None).cast(API_DOCUMENT["items"].dataType.elementType))
    rows = [
        frame.select(
            F.coalesce("items", nothing).alias("items"),
            F.col("region").cast("string").alias("region"),
            *marks(reason, record),
        )
        for frame in frames
    ]
    return api_items(reduce(DataFrame.unionByName, rows), "region", *MARKS)


def api_statistics(spark: SparkSession, path: str, **options) -> DataFrame:
    """The items of ``api_input`` from documents that can be read."""
    return accepted(api_input(spark, path, **options))
