"""One query per operator. Each takes (spark, folder of the tables) and gives a DataFrame.

Results are shown in types any engine has: dates, times and lists as text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.config import PipelineConfig, QualityRules
from tidestrata.functions import (
    day_of_trend,
    instant,
    plain_region,
    region_of_path,
    utc_text,
)
from tidestrata.operators.categories import (
    category_lookup,
    document_report,
    reference_records,
    with_category_names,
)
from tidestrata.operators.cleanse import cleansed, with_counts, with_key, with_rates
from tidestrata.operators.columns import quoted
from tidestrata.operators.conform import from_api, from_csv, statistics_record
from tidestrata.operators.counts import run_counts
from tidestrata.operators.landing import DATE_FORMAT, HOUR_FORMAT, ID_FORMAT
from tidestrata.operators.latest import latest_records
from tidestrata.operators.quality import check_table, check_tables, verdict
from tidestrata.operators.rank import with_rank
from tidestrata.operators.summaries import (
    category_trends,
    channel_performance,
    daily_trends,
)
from tidestrata.plans import (
    bronze_to_silver,
    clean_statistics,
    land_raw,
    load_inputs,
    load_statistics,
    reference_to_silver,
    refresh_gold,
    run_pipeline,
)
from tidestrata.sinks import append, overwrite_partitions
from tidestrata.sources import (
    api_items,
    api_statistics,
    category_documents,
    csv_statistics,
    keep_regions,
    optional_table,
    table,
)
from tidestrata.streaming import stream_categories, stream_statistics
from tidestrata.workspace import shuffles_removed
from workload.facts import (
    AS_OF,
    ITEM_FIELDS,
    JOB,
    api_documents,
    appearances,
    as_text,
    categories,
    category_payloads,
    fresh_database,
    fresh_folder,
    row_items,
    source,
    staged_appearances,
    trending_payloads,
    upper_case_endings,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHOSEN_REGIONS = (" AFRICA", " AMERICA", " ASIA", " EUROPE")
SOURCE_NAME = "fixture"
# Landed JSON and CSV text is many times the size of the tables it comes from; readers take .gz files.
TEXT_CODEC = "gzip"
# For a file per document: tasks move their own files into place, instead of the driver all of them one
# by one, and texts are compressed fast. The folder is read only if the whole write has gone well.
MANY_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2", "zlib.compress.level": "BEST_SPEED"}


def query(make: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(make(spark, folder))

    QUERIES[make.__name__] = run
    return run


def portable(frame: DataFrame) -> DataFrame:
    def shown(name: str, kind: str):
        value = quoted(name)
        if kind == "date":
            value = value.cast("string")
        elif kind.startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        elif kind == "array<string>":
            value = F.array_join(value, "|")
        return value.alias(name.replace(".", "_"))

    return frame.select(*[shown(name, kind) for name, kind in frame.dtypes])


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return clean_statistics(appearances(spark, folder), JOB, AS_OF)


def write_csv(
    frame: DataFrame, path: str, mode: str = "append", compression: str = "none", folders: tuple[str, ...] = ("region",)
) -> None:
    with shuffles_removed(frame.sparkSession):
        (
            as_text(frame)
            .write.mode(mode)
            .options(header=True, quote='"', escape='"', compression=compression)
            .partitionBy(*folders)
            .csv(path)
        )


# --- sources -------------------------------------------------------------------------------


@query
def region_scan(spark, folder):
    """Chosen region partitions of a catalogue table."""
    name = f"{fresh_database(spark, 'bronze')}.raw_statistics"
    append(appearances(spark, folder).select("video_id", "views", "region"), name)
    return keep_regions(table(spark, name), CHOSEN_REGIONS)


@query
def csv_source(spark, folder):
    """CSV files with quotes and line breaks inside fields, read back and typed."""
    path = fresh_folder(spark, "csv")
    quote = F.format_string('says "%s"\nand, by %s', "title", "channel_title")
    write_csv(appearances(spark, folder).withColumn("description", quote), path)
    return from_csv(csv_statistics(spark, path))


@query
def source_files_complete(spark, folder):
    """CSV files in the region's folder and one level below, read back and typed."""
    path = fresh_folder(spark, "depths")
    facts = staged_appearances(spark, folder)
    write_csv(facts.where("length(title) % 2 = 0"), path)
    deeper = as_text(facts.where("length(title) % 2 = 1").withColumn("date", F.col("trending_date")))
    deeper.write.mode("append").options(header=True, quote='"', escape='"').partitionBy("region", "date").csv(path)
    return from_csv(csv_statistics(spark, path))


@query
def csv_header_order(spark, folder):
    """Files whose headers are turned round, or lack a column and have one more."""
    path = fresh_folder(spark, "headers")
    records = as_text(appearances(spark, folder))
    turned = F.length("title") % 2 == 0
    write_csv(records.where(turned).select(*reversed(records.columns)), path)
    write_csv(records.where(~turned).drop("dislikes").withColumn("more", F.lit("x")), path)
    return from_csv(csv_statistics(spark, path))


@query
def csv_lines(spark, folder):
    """CSV files without line breaks in fields, which Spark may split."""
    path = fresh_folder(spark, "csv-lines")
    quote = F.format_string('says "%s", by %s', "title", "channel_title")
    write_csv(appearances(spark, folder).withColumn("description", quote), path)
    return from_csv(csv_statistics(spark, path, layout="lines"))


@query
def api_documents_layout(spark, folder):
    """One pretty-printed document per file: each channel's videos of a region."""
    path = fresh_folder(spark, "documents")
    rows = appearances(spark, folder).select(
        "region", F.col("channel_title").alias("channel"), F.struct(*ITEM_FIELDS).alias("row")
    )
    # A channel is a supplier, whose line items do not grow with the tables. Its rows are gathered
    # as their plain fields and become items after the shuffle: an item repeats its channel and
    # title, and a row with likes is listed twice.
    documents = rows.groupBy("region", "channel").agg(F.collect_list("row").alias("rows"))
    items = F.flatten(F.transform("rows", lambda row: row_items(lambda name: row[name])))
    documents = documents.select("region", "channel", items.alias("items"))
    text = F.to_json(F.struct("items"), {"pretty": "true"})
    documents = documents.select(
        text, "region", F.lit("2024-02-01").alias("date"), F.lit("09").alias("hour")
    )
    with shuffles_removed(spark):
        documents.write.options(maxRecordsPerFile=1, compression=TEXT_CODEC, **MANY_FILES).partitionBy(
            "region", "date", "hour"
        ).text(path)
    return statistics_record(api_statistics(spark, path), AS_OF)


@query
def region_from_path(spark, folder):
    """Regions from encoded paths; a page without a language folder has none."""
    path = F.regexp_replace("url", "/([a-z]{2})/", "/region%3D$1/")
    pages = source(spark, folder, "pages")
    return pages.select("page_id", path.alias("_source_file")).withColumn(
        "region", region_of_path(F.col("_source_file"))
    )


@query
def missing_lookup(spark, folder):
    """Category trends where the reference table does not exist."""
    lookup = category_lookup(optional_table(spark, "absent_reference_data"))
    return category_trends(silver(spark, folder), lookup)


# --- projections and scalar functions -------------------------------------------------------


@query
def typed_projection(spark, folder):
    return from_csv(as_text(appearances(spark, folder)))


@query
def typed_projection_numeric(spark, folder):
    """Counts that a catalogue table holds as doubles, decimals and floats, large ones among them."""
    counts = {
        "views": (F.col("views") * 1000).cast("double"),
        "likes": (F.col("likes") + F.lit(20_000_000)).cast("decimal(20,2)"),
        "comment_count": F.col("comment_count").cast("float"),
    }
    return from_csv(appearances(spark, folder).withColumns(counts))


@query
def api_flatten(spark, folder):
    items = api_items(api_documents(appearances(spark, folder)), "region")
    return from_api(items, AS_OF)


@query
def api_flatten_underscores(spark, folder):
    """Items whose nested fields a catalogue names with double underscores."""
    items = api_items(api_documents(appearances(spark, folder)), "region")
    names = [quoted(c).alias(c.replace(".", "__")) for c in items.columns]
    return from_api(items.select(*names), AS_OF)


@query
def api_trending_date(spark, folder):
    """The run's day on API rows, and the run instant as folder names and id."""
    items = api_items(api_documents(appearances(spark, folder)), "region")
    now = instant(AS_OF)
    return (
        statistics_record(items, AS_OF)
        .groupBy("region", "trending_date")
        .agg(F.count(F.lit(1)).alias("items"))
        .withColumns(
            {
                "date": utc_text(now, DATE_FORMAT),
                "hour": utc_text(now, HOUR_FORMAT),
                "ingestion_id": utc_text(now, ID_FORMAT),
            }
        )
    )


@query
def date_parse(spark, folder):
    frame = appearances(spark, folder)
    return frame.select(
        "video_id",
        "trending_date",
        day_of_trend(F.col("trending_date")).alias("from_short"),
        day_of_trend(F.substring("publish_time", 1, 10)).alias("from_iso"),
        day_of_trend(F.regexp_replace("trending_date", r"\d\d$", "13")).alias("from_bad_month"),
        day_of_trend(F.col("title")).alias("from_words"),
    )


@query
def region_normalize(spark, folder):
    frame = appearances(spark, folder).select(
        "region", plain_region(F.col("region")).alias("plain_region")
    )
    return frame.groupBy("region", "plain_region").agg(F.count(F.lit(1)).alias("records"))


@query
def null_fill(spark, folder):
    """Records without an id are dropped, missing counts become 0."""
    no_id = F.when(F.col("views") > 0, F.col("video_id"))
    frame = appearances(spark, folder).withColumn("video_id", no_id)
    return with_counts(with_key(frame)).select(
        "video_id", "publish_time", "views", "likes", "dislikes", "comment_count"
    )


@query
def ratios(spark, folder):
    return with_rates(with_counts(appearances(spark, folder))).select(
        "video_id", "views", "likes", "dislikes", "comment_count", "like_ratio", "engagement_rate"
    )


# --- cleaned statistics ---------------------------------------------------------------------


@query
def dedup_latest(spark, folder):
    kept = latest_records(cleansed(appearances(spark, folder)))
    return kept.select("video_id", "region", "trending_date_parsed", "publish_time", "views")


@query
def job_counts(spark, folder):
    raw = appearances(spark, folder)
    return run_counts(raw, clean_statistics(raw, JOB, AS_OF))


# --- categories -----------------------------------------------------------------------------


@query
def reference_dedup(spark, folder):
    """The newest of many documents per region, and in it the last entry of each id."""
    part = source(spark, folder, "part")

    def item(key, title):
        return F.struct(
            key.cast("string").alias("id"),
            F.struct(F.col(title).alias("title")).alias("snippet"),
        )

    size = F.col("p_size")
    items = F.array(item(size, "p_brand"), item(size, "p_name"), item(size + 1, "p_type"))
    region = F.concat(F.lit("r"), (F.col("p_partkey") % 5).cast("string"))
    documents = part.select(
        items.alias("items"),
        F.concat(F.lit("in/"), F.lpad(F.col("p_partkey").cast("string"), 20, "0")).alias(
            "_source_file"
        ),
        F.lit("2024-01-01").cast("timestamp").alias("_file_time"),
        F.lit("").alias("_landed_at"),
        region.alias("region"),
    )
    return reference_records(documents, AS_OF)


def category_files(spark, folder) -> str:
    """A pretty-printed category file per region, each in another state."""
    region, nation = source(spark, folder, "region"), source(spark, folder, "nation")
    key = F.col("n_nationkey").cast("string").alias("id")
    titled = F.struct(key, F.struct(F.col("n_name").alias("title")).alias("snippet"))
    grouped = (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_regionkey", "r_name")
        .agg(
            F.array_sort(F.collect_list(titled)).alias("titled"),
            F.array_sort(F.collect_list(F.struct(key))).alias("untitled"),
        )
    )
    whole = F.to_json(F.struct(F.col("titled").alias("items")), {"pretty": "true"})
    forms = [
        whole,
        F.to_json(F.struct(F.col("untitled").alias("items"))),
        F.to_json(F.col("titled")[0], {"pretty": "true"}),
        F.substring(whole, 1, 20),
        F.lit('{"items": []}'),
    ]
    text = F.element_at(F.array(*forms), (F.col("r_regionkey") % len(forms) + 1).cast("int"))
    path = fresh_folder(spark, "category-files")
    grouped.select(text, F.lower("r_name").alias("region")).write.partitionBy("region").text(path)
    return path


@query
def reference_report(spark, folder):
    """The report of category files: good, without titles, one item, unreadable, empty."""
    report = document_report(category_documents(spark, category_files(spark, folder)))
    place = F.regexp_extract("_source_file", r"/(region=[^/]*)/[^/]*\.txt$", 1)
    return report.withColumn("_source_file", place)


@query
def reference_files(spark, folder):
    """The rows that the same files give."""
    records = reference_records(category_documents(spark, category_files(spark, folder)), AS_OF)
    place = F.regexp_extract("_source_file", r"/(region=[^/]*)/[^/]*\.txt$", 1)
    return records.select(
        "id", quoted("snippet.title"), "_ingestion_timestamp", place.alias("_source_file"), "region"
    )


@query
def category_names(spark, folder):
    """One name per category out of many regions' names for it."""
    part = source(spark, folder, "part")
    reference = part.select(
        F.col("p_size").cast("string").alias("id"),
        F.concat(F.lit("r"), (F.col("p_partkey") % 5).cast("string")).alias("region"),
        F.col("p_name").alias("snippet_title"),
    )
    return category_lookup(reference)


@query
def category_join(spark, folder):
    lookup = category_lookup(categories(spark, folder))
    named = with_category_names(cleansed(appearances(spark, folder)), lookup)
    return named.select("video_id", "region", "publish_time", "category_id", "category_name")


# --- summaries ------------------------------------------------------------------------------


@query
def trending_analytics(spark, folder):
    return daily_trends(silver(spark, folder))


@query
def channel_analytics(spark, folder):
    lookup = category_lookup(categories(spark, folder))
    return channel_performance(silver(spark, folder), lookup)


@query
def category_analytics(spark, folder):
    lookup = category_lookup(categories(spark, folder))
    return category_trends(silver(spark, folder), lookup)


@query
def rank_in_group(spark, folder):
    """Every record ranked by views in its region; equal records are interchangeable."""
    frame = cleansed(appearances(spark, folder)).select("region", "views", "video_id")
    order = [F.col("views").desc(), F.col("video_id").asc()]
    return with_rank(frame, ["region"], order, "rank_in_region")


# --- quality gate ---------------------------------------------------------------------------


def statistics_check(check: str) -> Query:
    def run(spark, folder):
        frame = silver(spark, folder)
        return check_table(frame, "clean_statistics", as_of=AS_OF, checks=[check])

    return run


def shown_columns(make: Query, *columns: str) -> Query:
    return lambda spark, folder: make(spark, folder).select("check", "table", *columns)


def register(name: str, make: Query) -> None:
    make.__name__ = name
    query(make)


register("clean_statistics", silver)
register(
    "dq_row_count",
    shown_columns(statistics_check("row_count"), "value", "threshold", "passed", "message"),
)
register(
    "dq_null_pct",
    shown_columns(statistics_check("null_pct"), "column", "value", "threshold", "passed", "message"),
)
register(
    "dq_value_range",
    shown_columns(
        statistics_check("value_range"),
        "column", "negative_count", "extreme_count", "passed", "message",
    ),
)


@query
def dq_value_range_text(spark, folder):
    """Views as text: negative, beyond the limit, and no numbers at all."""
    views = F.col("views").cast("string")
    kind = F.col("dislikes")
    texts = (
        F.when(kind == 0, F.concat(F.lit("-"), views, F.lit(".5")))
        .when(kind == 1, F.lit("none"))
        .when(kind == 2, F.concat(views, F.lit("0000000")))
        .otherwise(views)
    )
    frame = silver(spark, folder).withColumn("views", texts)
    results = check_table(frame, "clean_statistics", as_of=AS_OF, checks=["value_range"])
    return results.select(
        "check", "table", "column", "negative_count", "extreme_count", "passed", "message"
    )


@query
def dq_freshness_text(spark, folder):
    """Times as text: with an offset, without a zone, which means UTC, and no times."""
    events = source(spark, folder, "events")
    zoned = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    naive = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    texts = (
        F.when(F.col("event_id") % 3 == 0, zoned)
        .when(F.col("event_id") % 3 == 1, naive)
        .otherwise(F.lit("soon"))
    )
    frame = events.select(texts.alias("_processed_at"))
    results = check_table(frame, "events", as_of=AS_OF, checks=["freshness"])
    return results.select("check", "table", "latest_record", "cutoff", "passed", "message")


@query
def dq_null_pct_partial(spark, folder):
    """Missing values in a table that has many: raw likes, and a column that is not there."""
    rules = QualityRules(critical_columns={"raw": ("video_id", "likes", "absent")})
    results = check_table(appearances(spark, folder), "raw", rules, AS_OF, ["null_pct"])
    return results.select("check", "table", "column", "value", "threshold", "passed", "message")


@query
def dq_schema(spark, folder):
    """Column checks of the statistics table, and of raw records under the reference's rules."""
    good = check_table(silver(spark, folder), "clean_statistics", as_of=AS_OF, checks=["schema"])
    bad = check_table(appearances(spark, folder), "reference_data", as_of=AS_OF, checks=["schema"])
    return good.unionByName(bad).select("check", "table", "missing_columns", "passed", "message")


@query
def dq_freshness(spark, folder):
    """Events as records made at their time, against a run then and a run two days on."""
    events = source(spark, folder, "events").withColumnRenamed("ts", "_processed_at")
    late = QualityRules(freshness_hours=1)
    fresh = check_table(events, "events", as_of=AS_OF, checks=["freshness"])
    stale = check_table(events, "events_late", late, AS_OF, ["freshness"])
    return fresh.unionByName(stale).select(
        "check", "table", "latest_record", "cutoff", "passed", "message"
    )


@query
def dq_sample(spark, folder):
    """The gate on a bounded sample, for its row count and nulls, which any sample has alike."""
    rules = QualityRules(sample_rows=10_000)
    checks = ["row_count", "null_pct"]
    results = check_table(silver(spark, folder), "clean_statistics", rules, AS_OF, checks)
    return results.select("check", "column", "value", "passed")


@query
def dq_sample_by_key(spark, folder):
    """Real null shares in a sample of raw records that any run and any engine picks alike."""
    key = ("video_id", "region", "publish_time", "channel_title", "views", "comment_count", "dislikes")
    rules = QualityRules(
        sample_rows=2_000, sample_key=key, critical_columns={"raw": ("likes", "title", "views")}
    )
    results = check_table(appearances(spark, folder), "raw", rules, AS_OF, ["row_count", "null_pct"])
    return results.select("check", "column", "value", "passed")


@query
def dq_unreadable_table(spark, folder):
    """A table that cannot be read fails; the other one is still checked."""
    name = f"{fresh_database(spark, 'silver')}.reference_data"
    append(categories(spark, folder), name)
    tables = {"absent": "absent_statistics", "reference_data": name}
    results = check_tables(spark, tables, as_of=AS_OF)
    return results.select("check", "table", "column", "value", "passed")


@query
def dq_verdict(spark, folder):
    checks = check_table(silver(spark, folder), "clean_statistics", as_of=AS_OF)
    raw = check_table(appearances(spark, folder), "raw", as_of=AS_OF)
    return verdict(checks.unionByName(raw)).drop("details")


# --- sinks, landing, incremental loads, whole run --------------------------------------------


def run_config(spark, name: str) -> PipelineConfig:
    return PipelineConfig(
        silver_database=fresh_database(spark, f"{name}_silver"),
        gold_database=fresh_database(spark, f"{name}_gold"),
        regions=None,
        job_name=JOB,
        as_of=AS_OF,
    )


@query
def append_vs_merge(spark, folder):
    """The same records loaded twice: appended rows double, merged rows do not."""
    records = staged_appearances(spark, folder)
    results = []
    for mode in ("append", "merge"):
        cfg = replace(
            run_config(spark, mode), statistics_mode=mode, statistics_partitions=("region",)
        )
        for _ in range(2):
            load_statistics(records, cfg)
        results.append(
            table(spark, cfg.statistics)
            .groupBy("region")
            .agg(
                F.count(F.lit(1)).alias("records"),
                F.sum("views").alias("total_views"),
            )
            .withColumn("mode", F.lit(mode))
        )
    return results[0].unionByName(results[1])


@query
def schema_evolution(spark, folder):
    """One partition written again with a column the others do not have."""
    customer = source(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.col("c_mktsegment").alias("region")
    )
    name = f"{fresh_database(spark, 'evolving')}.customers"
    overwrite_partitions(customer.drop("c_acctbal"), name)
    overwrite_partitions(customer.where("region = 'BUILDING'"), name)
    return table(spark, name)


@query
def raw_landing(spark, folder):
    """Payloads landed as files, read back as items with their folders."""
    path = fresh_folder(spark, "landing")
    payloads = trending_payloads(appearances(spark, folder)).unionByName(
        category_payloads(spark, folder)
    )
    land_raw(payloads, path, SOURCE_NAME, AS_OF, TEXT_CODEC)
    landed = spark.read.schema(
        "items array<struct<id string>>, _pipeline_metadata struct<ingestion_id string,"
        "region string, ingestion_timestamp string, video_count bigint, source string>,"
        "region string, date string, hour string"
    ).json(f"{path}/raw_statistics")
    stamp = "_pipeline_metadata"
    return landed.groupBy(
        "region", "date", "hour", f"{stamp}.ingestion_id", f"{stamp}.ingestion_timestamp",
        f"{stamp}.source",
    ).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(f"{stamp}.video_count").alias("video_count"),
        F.sum(F.size("items").cast("bigint")).alias("items"),
    )


@query
def landed_statistics(spark, folder):
    """Landed documents through the API reader into statistics records."""
    path = fresh_folder(spark, "landing")
    land_raw(trending_payloads(appearances(spark, folder)), path, SOURCE_NAME, AS_OF, TEXT_CODEC)
    items = api_statistics(spark, f"{path}/raw_statistics", layout="lines")
    return statistics_record(items, AS_OF)


@query
def load_manifest(spark, folder):
    """Broken trending payloads: their region fails, and its categories are not landed."""
    trending = trending_payloads(appearances(spark, folder), breaking=True)
    every = trending.unionByName(category_payloads(spark, folder))
    return land_raw(every, fresh_folder(spark, "landing"), SOURCE_NAME, AS_OF, TEXT_CODEC)


@query
def landing_edge_payloads(spark, folder):
    """Repeated fields and a missing list are fine; trailing text, line breaks in strings and cuts are not."""
    customer = source(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = source(spark, folder, "nation").select("n_nationkey", "n_name")
    items = F.format_string('"items":[{"id":"%d"}]', "c_custkey")
    forms = [
        F.concat(F.lit("{"), items, F.lit("}")),
        F.concat(F.lit('{"a":1,"a":2,'), items, F.lit("}")),
        F.concat(F.lit("{"), items, F.lit("} and more")),
        F.concat(F.lit('{"a":"one\ntwo",'), items, F.lit("}")),
        F.lit('{"kind":"list"}'),
        F.concat(F.lit("{"), items),
    ]
    payloads = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("region"),
        F.lit("trending").alias("kind"),
        F.element_at(F.array(*forms), (F.col("n_nationkey") % len(forms) + 1).cast("int")).alias("payload"),
    )
    return land_raw(payloads, fresh_folder(spark, "landing"), SOURCE_NAME, AS_OF)


@query
def incremental_silver(spark, folder):
    """CSV files arriving in two lots, each loaded once by a stream."""
    path = fresh_folder(spark, "arrivals")
    cfg = replace(run_config(spark, "incremental"), csv_path=path)
    records = staged_appearances(spark, folder)
    # Keys occur in both lots, so the second one replaces records of the first.
    early = F.crc32(F.concat_ws("|", "title", "views")) % 2 == 0
    for lot in (records.where(early), records.where(~early)):
        write_csv(lot, path, compression=TEXT_CODEC)
        stream_statistics(spark, cfg, checkpoint=f"{path}-progress")
    return table(spark, cfg.statistics)


@query
def incremental_any_file(spark, folder):
    """A lot in one layout, then one of other depths, another header order and upper-case endings."""
    path = fresh_folder(spark, "any-file")
    cfg = replace(run_config(spark, "any_file"), csv_path=path, statistics_partitions=("region",))
    lot = F.crc32(F.concat_ws("|", "title", "views")) % 4
    records = as_text(staged_appearances(spark, folder).withColumn("lot", lot))
    day = F.col("trending_date").alias("date")

    def write(number, columns, folders):
        rows = records.where(F.col("lot") == number).select(*columns, *folders[1:])
        below = [f for f in ("date", "hour") if f in rows.columns]
        write_csv(rows, path, compression=TEXT_CODEC, folders=("region", *below))

    names = [c for c in records.columns if c != "lot"]
    write("0", names, ["region"])
    stream_statistics(spark, cfg, checkpoint=f"{path}-progress")
    write("1", names[::-1], ["region", day])
    write("2", names, ["region", day, F.lit("09").alias("hour")])
    upper_case_endings(spark, path)
    write("3", names[::-1], ["region"])
    stream_statistics(spark, cfg, checkpoint=f"{path}-progress")
    return table(spark, cfg.statistics)


@query
def incremental_gold(spark, folder):
    """Summaries refreshed after each of two lots, of which the second touches the days of one year."""
    cfg = replace(run_config(spark, "refreshed"), statistics_partitions=("region",))
    append(categories(spark, folder), cfg.reference)
    records = staged_appearances(spark, folder)
    late = F.col("trending_date").startswith("13.") & (F.col("views") % 2 == 0)
    days = []
    for lot in (records.where(~late), records.where(late)):
        load_statistics(lot, cfg)
        days.append(refresh_gold(spark, cfg)["days_read"])
    return table(spark, cfg.gold("channel_analytics")).withColumns(
        {"days_first": F.lit(days[0]).cast("bigint"), "days_second": F.lit(days[1]).cast("bigint")}
    )


@query
def refreshed_days(spark, folder):
    """Daily trends from partials of days, those of one year built again after a second lot."""
    cfg = replace(run_config(spark, "days"), statistics_partitions=("region",))
    records = staged_appearances(spark, folder)
    late = F.col("trending_date").startswith("12.") & (F.col("views") % 2 == 1)
    for lot in (records.where(~late), records.where(late)):
        load_statistics(lot, cfg)
        refresh_gold(spark, cfg)
    return table(spark, cfg.gold("trending_analytics"))


@query
def append_redelivered(spark, folder):
    """A stream's batch delivered twice in append mode, and another batch: each adds its rows once."""
    cfg = replace(
        run_config(spark, "redelivered"), statistics_mode="append", statistics_partitions=("region",)
    )
    records = staged_appearances(spark, folder)
    even = F.length("title") % 2 == 0
    lots = {"stream-0": records.where(even), "stream-1": records.where(~even)}
    for load in ("stream-0", "stream-0", "stream-1", "stream-0"):
        load_inputs({"table": lots[load]}, cfg, load)
    counts = [F.count(F.lit(1)).alias("records"), F.sum("views").alias("total_views")]
    return table(spark, cfg.statistics).groupBy("region", F.col("_load").alias("load")).agg(*counts)


@query
def rejected_input(spark, folder):
    """Rows with a field too many and documents that break off are set aside; the others are cleaned."""
    path = fresh_folder(spark, "rejected")
    records = staged_appearances(spark, folder)
    # Zero bytes instead of quotes, so that a comma in the text makes another field.
    words = F.when(F.col("views") == 0, "one,more").otherwise("none")
    rows = as_text(records.withColumn("description", words))
    rows.write.options(header=True, quote="\u0000", compression=TEXT_CODEC).partitionBy(
        "region"
    ).csv(f"{path}/csv")
    documents = trending_payloads(records, breaking=True).select(
        "payload", "region", F.lit("2024-02-01").alias("date"), F.lit("09").alias("hour")
    )
    documents.write.option("compression", TEXT_CODEC).partitionBy("region", "date", "hour").text(
        f"{path}/api"
    )
    cfg = replace(
        run_config(spark, "rejecting"),
        csv_path=f"{path}/csv",
        api_path=f"{path}/api",
        api_layout="lines",
        statistics_partitions=("region",),
    )
    counts = bronze_to_silver(spark, cfg)
    return (
        table(spark, cfg.rejected)
        .groupBy("source", "region", "reason")
        .agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("record")).alias("characters"))
        .withColumns({c: F.lit(counts[c]).cast("bigint") for c in ("rows_read", "rows_rejected")})
    )


@query
def reference_replay(spark, folder):
    """Category files landed and loaded twice: the table stays as after the first time."""
    path = fresh_folder(spark, "categories")
    cfg = replace(
        run_config(spark, "replay"),
        category_path=f"{path}/raw_statistics_reference_data",
        category_layout="lines",
    )
    for _ in range(2):
        land_raw(category_payloads(spark, folder), path, SOURCE_NAME, AS_OF)
        stream_categories(spark, cfg, checkpoint=f"{path}/progress")
    return table(spark, cfg.reference).select(
        "id", quoted("snippet.title"), "_ingestion_timestamp", "region"
    )


@query
def reference_new_field(spark, folder):
    """A later load of category files brings a field that no schema declares."""
    path = fresh_folder(spark, "new-field")
    cfg = replace(
        run_config(spark, "field"), category_path=path, category_layout="lines"
    )
    region, nation = source(spark, folder, "region"), source(spark, folder, "nation")
    nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    title = F.col("n_name").alias("title")
    odd = F.col("r_regionkey") % 2 == 1
    for chosen, snippet in (
        (~odd, F.struct(title)),
        (odd, F.struct(title, F.col("r_name").alias("label"))),
    ):
        item = F.struct(F.col("n_nationkey").cast("string").alias("id"), snippet.alias("snippet"))
        lot = nations.where(chosen).groupBy(F.lower("r_name").alias("region"))
        documents = lot.agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("text"))
        documents.write.mode("append").partitionBy("region").text(path)
        reference_to_silver(spark, cfg)
    return table(spark, cfg.reference).select(
        "id", quoted("snippet.title"), quoted("snippet.label"), "region"
    )


@query
def empty_input(spark, folder):
    """A run over all records, and one that finds none: it reads no rows and changes none."""
    cfg = run_config(spark, "empty")
    records = staged_appearances(spark, folder)
    first = load_statistics(records, cfg)
    second = load_statistics(records.where("video_id = ''"), cfg)
    return (
        table(spark, cfg.statistics)
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumns(
            {
                "first_read": F.lit(first["rows_read"]).cast("bigint"),
                "second_read": F.lit(second["rows_read"]).cast("bigint"),
            }
        )
    )


@query
def blocked_gate(spark, folder):
    """A whole run whose views exceed the limit: cleaned tables are there, summaries are not."""
    path = fresh_folder(spark, "blocked")
    write_csv(appearances(spark, folder), f"{path}/statistics", compression=TEXT_CODEC)
    land_raw(category_payloads(spark, folder), path, SOURCE_NAME, AS_OF)
    cfg = replace(
        run_config(spark, "blocked"),
        csv_path=f"{path}/statistics",
        csv_layout="lines",
        category_path=f"{path}/raw_statistics_reference_data",
        category_layout="lines",
        rules=QualityRules(max_views=1000),
    )
    run = run_pipeline(spark, cfg)
    built = spark.catalog.tableExists(cfg.gold("channel_analytics"))
    return (
        table(spark, cfg.statistics)
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumns(
            {
                "quality_passed": F.lit(run.quality_passed),
                "checks_failed": F.lit(run.checks_total - run.checks_passed),
                "summaries_built": F.lit(built),
            }
        )
    )


@query
def gated_gold(spark, folder):
    """All layers from files to the channel summary, behind the gate."""
    path = fresh_folder(spark, "run")
    write_csv(appearances(spark, folder), f"{path}/statistics", compression=TEXT_CODEC)
    land_raw(category_payloads(spark, folder), path, SOURCE_NAME, AS_OF)
    cfg = replace(
        run_config(spark, "gated"),
        csv_path=f"{path}/statistics",
        category_path=f"{path}/raw_statistics_reference_data",
        category_layout="lines",
    )
    run = run_pipeline(spark, cfg)
    return (
        table(spark, cfg.gold("channel_analytics"))
        .withColumn("checks_passed", F.lit(run.checks_passed))
        .withColumn("checks_total", F.lit(run.checks_total))
    )
