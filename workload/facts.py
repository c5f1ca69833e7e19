"""The test tables reshaped as raw statistics, and as the files they would arrive in.

A line item becomes a video's appearance in a region's trending list; nations become category
names. Nothing is made up: every row derives from the given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.operators.bounds import broadcast_if_small
from tidestrata.sinks.merge import stored
from tidestrata.workspace import scratch_folder

# One instant for all runs, so that two engines and two runs can be compared.
AS_OF = datetime(2024, 2, 1, 9, 30, 0, tzinfo=timezone.utc)
JOB = "workload"

# The region whose fetched documents never break off.
SOUND_REGION = " ASIA"


# Declared, so that planning a query does not open files to find their columns.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "pages": "page_id bigint, url string, html string",
}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def short_form(day: Column) -> Column:
    """A date as ``yy.dd.MM`` text."""
    iso = day.cast("string")
    return F.concat_ws(".", *[F.substring(iso, start, 2) for start in (3, 9, 6)])


def appearances(spark: SparkSession, folder: str) -> DataFrame:
    """Raw statistics records in the layout of a CSV row, typed as the tables have them."""
    region = source(spark, folder, "region").select("r_regionkey", "r_name")
    nation = source(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    customer = source(spark, folder, "customer").select("c_custkey", "c_nationkey")
    buyers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = source(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_orderdate", "r_name", (F.col("o_custkey") % 100).alias("comment_count")
    )
    part = source(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    supplier = source(spark, folder, "supplier").select("s_suppkey", "s_name")
    no_views = (F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "N")
    no_likes = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1)
    # What a record takes from its line item alone is derived before the line items are shuffled, up to
    # once for each join.
    lines = source(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.when(no_views, F.lit(0))
        .otherwise(F.floor("l_extendedprice"))
        .cast("bigint")
        .alias("views"),
        F.when(~no_likes, F.floor("l_quantity").cast("bigint") * 10).alias("likes"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("dislikes"),
        (F.col("l_returnflag") == "R").alias("comments_disabled"),
        (F.col("l_returnflag") == "A").alias("ratings_disabled"),
        (F.col("l_linestatus") == "F").alias("video_error_or_removed"),
    )
    # The two large tables meet in a sorted join at any scale. Left alone, the planner rates the
    # joined orders above the line items, and would send the largest table to every task.
    lines = (
        lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(broadcast_if_small(supplier), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    month = F.add_months(F.date_trunc("month", F.col("o_orderdate")).cast("date"), 180)
    return lines.select(
        F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("video_id"),
        short_form(month).alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.col("o_orderdate").cast("string").alias("publish_time"),
        F.lit(None).cast("string").alias("tags"),
        "views",
        "likes",
        "dislikes",
        "comment_count",
        F.lit(None).cast("string").alias("thumbnail_link"),
        "comments_disabled",
        "ratings_disabled",
        "video_error_or_removed",
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit(" "), F.col("r_name")).alias("region"),
    )


def staged_appearances(spark: SparkSession, folder: str) -> DataFrame:
    """``appearances`` written once to a scratch folder and read back.

    For queries that load the same records several times: each load, and its check for rows, reads the
    files instead of joining the line items and orders again.
    """
    return stored(appearances(spark, folder), fresh_folder(spark, "records"))


def as_text(frame: DataFrame) -> DataFrame:
    """Every column as text, the way a CSV file delivers it."""
    return frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])


def categories(spark: SparkSession, folder: str) -> DataFrame:
    """A reference table: one category per nation."""
    nation = source(spark, folder, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("snippet.title"),
        F.lit("all").alias("region"),
    )


def row_items(field: Callable[[str], Column] = F.col) -> Column:
    """A row's API items: one, listed twice if it has likes. ``field`` gives a column by name."""
    item = F.struct(
        field("video_id").alias("id"),
        F.struct(
            field("title").alias("title"),
            field("channel_title").alias("channelTitle"),
            field("category_id").cast("string").alias("categoryId"),
            field("publish_time").alias("publishedAt"),
            F.array(field("title"), field("channel_title")).alias("tags"),
            F.lit(None).cast("string").alias("description"),
        ).alias("snippet"),
        F.struct(
            field("views").cast("string").alias("viewCount"),
            field("likes").cast("string").alias("likeCount"),
            field("comment_count").cast("string").alias("commentCount"),
        ).alias("statistics"),
    )
    again = F.when(field("likes").isNotNull(), item)
    return F.array_compact(F.array(item, again))


# The columns ``row_items`` reads.
ITEM_FIELDS = (
    "video_id", "title", "channel_title", "category_id", "publish_time", "views", "likes",
    "comment_count",
)


def api_documents(frame: DataFrame) -> DataFrame:
    """One API document per row, its region beside it.

    A row with likes is listed twice, so documents hold one or two items; building them needs no
    shuffle, whatever the size of a region.
    """
    return frame.select("region", row_items().alias("items"))


def category_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A category document per region, listing its nations; nations are few by definition."""
    region, nation = source(spark, folder, "region"), source(spark, folder, "nation")
    item = F.struct(
        F.col("n_nationkey").cast("string").alias("id"),
        F.struct(F.col("n_name").alias("title")).alias("snippet"),
    )
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name")
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .select(
            F.col("r_name").alias("region"),
            F.lit("categories").alias("kind"),
            F.to_json(F.struct("items")).alias("payload"),
        )
    )


def trending_payloads(frame: DataFrame, *, breaking: bool = False) -> DataFrame:
    """API documents as fetched text.

    With ``breaking`` the text of a video without views breaks off, in every region but one.
    """
    payload = F.to_json(F.struct("items"))
    if breaking:
        views = F.element_at("items", 1)["statistics"]["viewCount"]
        broken = (views == "0") & (F.col("region") != SOUND_REGION)
        payload = F.when(broken, F.substring(payload, 1, 40)).otherwise(payload)
    return api_documents(frame).select(
        "region", F.lit("trending").alias("kind"), payload.alias("payload")
    )


def upper_case_endings(spark: SparkSession, path: str) -> None:
    """Rename the hour folders' CSV files to end in capitals, as some uploads do."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*/*/*/*.csv*")):
        stem, _, codec = found.getPath().toString().rpartition(".csv")
        files.rename(found.getPath(), spark._jvm.org.apache.hadoop.fs.Path(f"{stem}.CSV{codec}"))


def fresh_folder(spark: SparkSession, name: str) -> str:
    return scratch_folder(spark, f"workload/{name}")


def fresh_database(spark: SparkSession, name: str) -> str:
    database = f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{fresh_folder(spark, name)}'")
    return database
