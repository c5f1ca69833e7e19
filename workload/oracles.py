"""The same queries as SQL over the test tables, for a second engine to run."""

from __future__ import annotations

# The raw records: see workload.facts.appearances.
FACTS = """
facts AS (
  SELECT 'v' || l_partkey::varchar AS video_id,
         strftime(date_trunc('month', o_orderdate) + INTERVAL 15 YEAR, '%y.%d.%m') AS trending_date,
         p_name AS title, s_name AS channel_title, p_size::bigint AS category_id,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS publish_time,
         NULL::varchar AS tags,
         (CASE WHEN l_linenumber = 7 AND l_returnflag = 'N' THEN 0
               ELSE floor(l_extendedprice) END)::bigint AS views,
         (CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN NULL
               ELSE floor(l_quantity) * 10 END)::bigint AS likes,
         round(l_tax * 100)::bigint AS dislikes,
         (o_custkey % 100)::bigint AS comment_count,
         NULL::varchar AS thumbnail_link,
         l_returnflag = 'R' AS comments_disabled,
         l_returnflag = 'A' AS ratings_disabled,
         l_linestatus = 'F' AS video_error_or_removed,
         NULL::varchar AS description,
         ' ' || r_name AS region
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey)"""

COLUMNS = (
    "video_id, trending_date, title, channel_title, category_id, publish_time, tags, views, "
    "likes, dislikes, comment_count, thumbnail_link, comments_disabled, ratings_disabled, "
    "video_error_or_removed, description, region"
)

CLEAN = f"""{FACTS},
filled AS (
  SELECT * REPLACE (lower(trim(region)) AS region, coalesce(likes, 0) AS likes),
         strptime(trending_date, '%y.%d.%m')::date AS trending_date_parsed
  FROM facts),
clean AS (
  SELECT *,
    (CASE WHEN views > 0 THEN round(likes / views * 100, 4) ELSE 0 END)::double AS like_ratio,
    (CASE WHEN views > 0 THEN round((likes + dislikes + comment_count) / views * 100, 4)
          ELSE 0 END)::double AS engagement_rate
  FROM filled)"""

SILVER = f"""{CLEAN},
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY video_id, region, trending_date_parsed
    ORDER BY publish_time DESC, views DESC, likes DESC, dislikes DESC, comment_count DESC,
      title DESC, channel_title DESC, category_id DESC, comments_disabled DESC,
      ratings_disabled DESC, video_error_or_removed DESC) AS place
  FROM clean),
silver AS (SELECT * EXCLUDE (place) FROM placed WHERE place = 1)"""

STAMPED = (
    f"SELECT {COLUMNS}, trending_date_parsed::varchar AS trending_date_parsed, like_ratio, "
    "engagement_rate, '2024-02-01 09:30:00' AS _processed_at, 'workload' AS _job_name FROM silver"
)

NAMED = "coalesce(n_name, 'Unknown')"


def category_trends(name: str, lookup: str) -> str:
    return f"""WITH {SILVER},
    grouped AS (
      SELECT {name} AS category_name, category_id, region, trending_date_parsed,
        count(video_id) AS video_count,
        sum(views)::bigint AS total_views, sum(likes)::bigint AS total_likes,
        sum(comment_count)::bigint AS total_comments,
        sum(engagement_rate::decimal(30,4))::double / count(*) AS avg_engagement_rate,
        count(DISTINCT channel_title) AS unique_channels
      FROM silver {lookup}
      GROUP BY ALL)
    SELECT * REPLACE (trending_date_parsed::varchar AS trending_date_parsed),
      round(total_views::double
        / nullif(sum(total_views) OVER (PARTITION BY region, trending_date_parsed), 0)::double
        * 100, 2)::double AS view_share_pct
    FROM grouped"""


LOOKUP_JOIN = "LEFT JOIN nation ON category_id = n_nationkey"

CHANNELS = f"""WITH {SILVER},
  grouped AS (
    SELECT channel_title, region,
      count(DISTINCT video_id) AS total_videos,
      sum(views)::bigint AS total_views, sum(likes)::bigint AS total_likes,
      sum(comment_count)::bigint AS total_comments,
      sum(views)::double / count(views) AS avg_views_per_video,
      sum(engagement_rate::decimal(30,4))::double / count(*) AS avg_engagement_rate,
      max(views) AS peak_views, count(trending_date_parsed) AS times_trending,
      min(trending_date_parsed)::varchar AS first_trending,
      max(trending_date_parsed)::varchar AS last_trending,
      array_to_string(list_sort(list(DISTINCT {NAMED})), '|') AS categories
    FROM silver {LOOKUP_JOIN}
    GROUP BY channel_title, region)
  SELECT *, row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title)::int
    AS rank_in_region"""

DAYS = f"""WITH {SILVER}
      SELECT region, trending_date_parsed::varchar AS trending_date_parsed,
        count(video_id) AS total_videos, sum(views)::bigint AS total_views,
        sum(likes)::bigint AS total_likes, sum(dislikes)::bigint AS total_dislikes,
        sum(comment_count)::bigint AS total_comments,
        sum(views)::double / count(views) AS avg_views_per_video,
        sum(like_ratio::decimal(30,4))::double / count(*) AS avg_like_ratio,
        sum(engagement_rate::decimal(30,4))::double / count(*) AS avg_engagement_rate,
        max(views) AS max_views, count(DISTINCT channel_title) AS unique_channels,
        count(DISTINCT category_id) AS unique_categories
      FROM silver"""

# Documents made from raw records list a record twice when it has likes.
ITEMS = f"""{FACTS},
items AS (
  SELECT * FROM facts UNION ALL SELECT * FROM facts WHERE likes IS NOT NULL)"""

API_RECORD = """video_id, '24.01.02' AS trending_date, title, channel_title, category_id,
  publish_time, title || '|' || channel_title AS tags, views, likes, 0::bigint AS dislikes,
  comment_count, NULL::varchar AS thumbnail_link, false AS comments_disabled,
  false AS ratings_disabled, false AS video_error_or_removed, NULL::varchar AS description"""

# One category file per region, each in another state.
CATEGORY_FILES = """WITH files AS (
  SELECT r_regionkey, r_name, r_regionkey % 5 AS state, count(*) AS nations,
    min(n_nationkey::varchar) AS first_id
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""

CRITICAL = ("video_id", "title", "channel_title", "views", "region")

ORACLES: dict[str, str] = {
    "region_scan": f"""WITH {FACTS}
      SELECT video_id, views, region FROM facts
      WHERE region IN (' AFRICA', ' AMERICA', ' ASIA', ' EUROPE')""",
    "csv_source": f"""WITH {FACTS}
      SELECT * REPLACE ('says "' || title || '"' || chr(10) || 'and, by ' || channel_title
        AS description) FROM facts""",
    "source_files_complete": f"WITH {FACTS} SELECT * FROM facts",
    "csv_header_order": f"""WITH {FACTS}
      SELECT * REPLACE (CASE WHEN length(title) % 2 = 0 THEN dislikes END AS dislikes) FROM facts""",
    "typed_projection_numeric": f"""WITH {FACTS}
      SELECT * REPLACE (views * 1000 AS views, likes + 20000000 AS likes) FROM facts""",
    "csv_lines": f"""WITH {FACTS}
      SELECT * REPLACE ('says "' || title || '", by ' || channel_title AS description) FROM facts""",
    "api_documents_layout": f"""WITH {ITEMS}
      SELECT * REPLACE (NULL::bigint AS dislikes) FROM (
        SELECT {API_RECORD}, region FROM items)""",
    "api_flatten_underscores": f"WITH {ITEMS} SELECT {API_RECORD}, region FROM items",
    "reference_report": f"""{CATEGORY_FILES}
      SELECT lower(r_name) AS region, 'region=' || replace(lower(r_name), ' ', '%20') AS _source_file,
        CASE WHEN state < 3 THEN 'success' ELSE 'failed' END AS status,
        (CASE WHEN state < 2 THEN nations WHEN state = 2 THEN 1 ELSE 0 END)::int AS items,
        CASE state WHEN 0 THEN '' WHEN 1 THEN 'snippet.title' WHEN 2 THEN '' END AS missing_columns,
        CASE state WHEN 3 THEN 'not readable as JSON' WHEN 4 THEN 'no category items found' END
          AS error
      FROM files""",
    "reference_files": f"""{CATEGORY_FILES}
      SELECT n_nationkey::varchar AS id, CASE WHEN state <> 1 THEN n_name END AS snippet_title,
        '2024-02-01T09:30:00+00:00' AS _ingestion_timestamp, 'region=' || replace(lower(r_name), ' ', '%20') AS _source_file,
        lower(r_name) AS region
      FROM files JOIN nation ON n_regionkey = r_regionkey
      WHERE state < 2 OR (state = 2 AND n_nationkey::varchar = first_id)""",
    "dq_value_range_text": f"""WITH {SILVER},
      counted AS (
        SELECT count_if(dislikes = 0)::bigint AS below,
          count_if(dislikes = 2 AND views * 10000000 > 50000000000)::bigint AS above
        FROM silver)
      SELECT 'value_range' AS "check", 'clean_statistics' AS "table", 'views' AS "column",
        below AS negative_count, above AS extreme_count, below = 0 AND above = 0 AS passed,
        'Views: ' || below::varchar || ' negative, ' || above::varchar
          || ' extreme (>50,000,000,000)' AS message
      FROM counted""",
    "dq_freshness_text": """
      WITH shown AS (
        SELECT max(date_trunc('second', ts)) AS newest FROM events WHERE event_id % 3 < 2),
      texts AS (
        SELECT strftime(newest, '%Y-%m-%d %H:%M:%S') || '+00:00' AS latest_record,
          '2024-01-30 09:30:00+00:00' AS cutoff,
          newest >= TIMESTAMP '2024-01-30 09:30:00' AS passed
        FROM shown)
      SELECT 'freshness' AS "check", 'events' AS "table", latest_record, cutoff, passed,
        'Latest: ' || latest_record || ', Cutoff: ' || cutoff AS message
      FROM texts""",
    "reference_new_field": """
      SELECT n_nationkey::varchar AS id, n_name AS snippet_title,
        CASE WHEN r_regionkey % 2 = 1 THEN r_name END AS snippet_label, lower(r_name) AS region
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "empty_input": f"""WITH {SILVER}
      SELECT region, count(*) AS records, (SELECT count(*) FROM facts) AS first_read,
        (SELECT count(*) FROM facts WHERE video_id = '') AS second_read
      FROM silver GROUP BY region""",
    "blocked_gate": f"""WITH {SILVER},
      far AS (SELECT count_if(views > 1000) AS n FROM silver)
      SELECT region, count(*) AS records, (SELECT n = 0 FROM far) AS quality_passed,
        (SELECT least(n, 1)::int FROM far) AS checks_failed,
        (SELECT n = 0 FROM far) AS summaries_built
      FROM silver GROUP BY region""",
    "landing_edge_payloads": """
      SELECT '20240201_093000' AS ingestion_id, lower(n_name) AS region, 'trending' AS kind,
        CASE WHEN n_nationkey % 6 IN (2, 3, 5) THEN 'failed' ELSE 'success' END AS status,
        count(*) AS documents,
        CASE WHEN n_nationkey % 6 IN (0, 1) THEN count(*) ELSE 0 END AS item_count,
        CASE WHEN n_nationkey % 6 IN (2, 3, 5) THEN 'payload is not a JSON object' END AS error
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey""",
    "region_from_path": r"""
      WITH paths AS (
        SELECT page_id, regexp_replace(url, '/([a-z]{2})/', '/region%3D\1/') AS _source_file
        FROM pages)
      SELECT page_id, _source_file,
        coalesce(nullif(regexp_extract(url_decode(_source_file), '(?:^|/)region=([^/=]*)', 1), ''),
                 'unknown') AS region
      FROM paths""",
    "missing_lookup": category_trends("'Unknown'", ""),
    "typed_projection": f"WITH {FACTS} SELECT * FROM facts",
    "api_flatten": f"WITH {ITEMS} SELECT {API_RECORD}, region FROM items",
    "api_trending_date": f"""WITH {ITEMS}
      SELECT region, '24.01.02' AS trending_date, count(*) AS items, '2024-02-01' AS date,
        '09' AS hour, '20240201_093000' AS ingestion_id
      FROM items GROUP BY region""",
    "date_parse": f"""WITH {FACTS}
      SELECT video_id, trending_date,
        strptime(trending_date, '%y.%d.%m')::date::varchar AS from_short,
        try_cast(substr(publish_time, 1, 10) AS date)::varchar AS from_iso,
        try_strptime(regexp_replace(trending_date, '\\d\\d$', '13'), '%y.%d.%m')::date::varchar
          AS from_bad_month,
        try_cast(title AS date)::varchar AS from_words
      FROM facts""",
    "region_normalize": f"""WITH {FACTS}
      SELECT region, lower(trim(region)) AS plain_region, count(*) AS records
      FROM facts GROUP BY ALL""",
    "null_fill": f"""WITH {FACTS}
      SELECT video_id, publish_time, coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
        coalesce(dislikes, 0) AS dislikes, coalesce(comment_count, 0) AS comment_count
      FROM facts WHERE views > 0""",
    "ratios": f"""WITH {CLEAN}
      SELECT video_id, views, likes, dislikes, comment_count, like_ratio, engagement_rate
      FROM clean""",
    "dedup_latest": f"""WITH {SILVER}
      SELECT video_id, region, trending_date_parsed::varchar AS trending_date_parsed,
        publish_time, views FROM silver""",
    "clean_statistics": f"WITH {SILVER} {STAMPED}",
    "job_counts": f"""WITH {SILVER}
      SELECT *, rows_read - rows_kept AS rows_removed FROM (
        SELECT count(*) AS rows_read, count_if(video_id IS NULL)::bigint AS raw_null_video_id,
          count_if(title IS NULL)::bigint AS raw_null_title,
          count_if(channel_title IS NULL)::bigint AS raw_null_channel_title,
          count_if(views IS NULL)::bigint AS raw_null_views
        FROM facts) CROSS JOIN (
        SELECT count(*) AS rows_kept, count_if(video_id IS NULL)::bigint AS null_video_id,
          count_if(title IS NULL)::bigint AS null_title,
          count_if(channel_title IS NULL)::bigint AS null_channel_title,
          count_if(views IS NULL)::bigint AS null_views,
          count_if(views < 0)::bigint AS negative_views
        FROM silver)""",
    "reference_dedup": """
      WITH newest AS (
        SELECT p_partkey % 5 AS r, max(p_partkey) AS p_partkey FROM part GROUP BY 1),
      kept AS (SELECT * FROM part SEMI JOIN newest USING (p_partkey)),
      items AS (
        SELECT p_partkey, p_size::varchar AS id, p_name AS title FROM kept UNION ALL
        SELECT p_partkey, (p_size + 1)::varchar, p_type FROM kept)
      SELECT id, title AS snippet_title,
        '2024-02-01T09:30:00+00:00' AS _ingestion_timestamp,
        'in/' || lpad(p_partkey::varchar, 20, '0') AS _source_file,
        'r' || (p_partkey % 5)::varchar AS region
      FROM items""",
    "category_names": """
      SELECT category_id, category_name FROM (
        SELECT p_size::bigint AS category_id, p_name AS category_name,
          row_number() OVER (PARTITION BY p_size ORDER BY p_partkey % 5, p_name) AS place
        FROM part) WHERE place = 1""",
    "category_join": f"""WITH {CLEAN}
      SELECT video_id, region, publish_time, category_id, {NAMED} AS category_name
      FROM clean {LOOKUP_JOIN}""",
    "trending_analytics": f"""{DAYS} GROUP BY region, trending_date_parsed""",
    "refreshed_days": f"""{DAYS.replace('FROM silver', ", '2024-02-01 09:30:00' AS _aggregated_at FROM silver")}
      GROUP BY region, trending_date_parsed""",
    "channel_analytics": f"{CHANNELS} FROM grouped",
    "category_analytics": category_trends(NAMED, LOOKUP_JOIN),
    "rank_in_group": f"""WITH {CLEAN}
      SELECT region, views, video_id, row_number() OVER (
        PARTITION BY region ORDER BY views DESC, video_id)::int AS rank_in_region
      FROM clean""",
    "dq_row_count": f"""WITH {SILVER}
      SELECT 'row_count' AS "check", 'clean_statistics' AS "table", count(*)::double AS value,
        10::double AS threshold, count(*) >= 10 AS passed,
        'Row count: ' || count(*)::varchar || ' (min: 10)' AS message
      FROM silver""",
    "dq_null_pct": f"WITH {SILVER} "
    + " UNION ALL ".join(
        f"""SELECT 'null_pct' AS "check", 'clean_statistics' AS "table", '{c}' AS "column",
        round_even(pct, 2)::double AS value, 5::double AS threshold, pct <= 5 AS passed,
        '{c} null%: ' || printf('%.2f', round_even(pct, 2)) || '% (max: 5.0%)' AS message
        FROM (SELECT count_if({c} IS NULL) * 100.0::double / count(*) AS pct FROM silver)"""
        for c in CRITICAL
    ),
    "dq_null_pct_partial": f"WITH {FACTS} "
    + " UNION ALL ".join(
        f"""SELECT 'null_pct' AS "check", 'raw' AS "table", '{c}' AS "column",
        round_even(pct, 2)::double AS value, 5::double AS threshold, pct <= 5 AS passed,
        '{c} null%: ' || printf('%.2f', round_even(pct, 2)) || '% (max: 5.0%)' AS message
        FROM (SELECT count_if({c} IS NULL)::double / count(*) * 100 AS pct FROM facts)"""
        for c in ("video_id", "likes")
    )
    + """ UNION ALL SELECT 'null_pct', 'raw', 'absent', NULL, NULL, false,
        'Column ''absent'' missing from table'""",
    "dq_value_range": f"""WITH {SILVER},
      counted AS (
        SELECT count_if(views < 0)::bigint AS below, count_if(views > 50000000000)::bigint AS above
        FROM silver)
      SELECT 'value_range' AS "check", 'clean_statistics' AS "table", 'views' AS "column",
        below AS negative_count, above AS extreme_count, below = 0 AND above = 0 AS passed,
        'Views: ' || below::varchar || ' negative, ' || above::varchar
          || ' extreme (>50,000,000,000)' AS message
      FROM counted""",
    "dq_schema": f"""WITH {FACTS}
      SELECT 'schema' AS "check", 'clean_statistics' AS "table", '' AS missing_columns,
        true AS passed, 'All expected columns present' AS message
      UNION ALL
      SELECT 'schema', 'reference_data', 'id', count(*) < 0, 'Missing columns: [''id'']'
      FROM facts""",
    "dq_freshness": """
      WITH newest AS (SELECT max(ts) AS newest FROM events),
      runs AS (
        SELECT * FROM (VALUES ('events', TIMESTAMP '2024-01-30 09:30:00'),
                              ('events_late', TIMESTAMP '2024-02-01 08:30:00')) AS r(name, cutoff)),
      shown AS (
        SELECT name, newest >= cutoff AS passed,
          strftime(newest, '%Y-%m-%d %H:%M:%S')
            || (CASE WHEN microsecond(newest) % 1000000 <> 0
                     THEN strftime(newest, '.%f') ELSE '' END) || '+00:00' AS latest_record,
          strftime(cutoff, '%Y-%m-%d %H:%M:%S') || '+00:00' AS cutoff
        FROM newest CROSS JOIN runs)
      SELECT 'freshness' AS "check", name AS "table", latest_record, cutoff, passed,
        'Latest: ' || latest_record || ', Cutoff: ' || cutoff AS message
      FROM shown""",
    "dq_sample": f"""WITH {SILVER}, sampled AS (SELECT least(count(*), 10000) AS n FROM silver)
      SELECT 'row_count' AS "check", NULL::varchar AS "column", n::double AS value,
        n >= 10 AS passed FROM sampled
      """
    + "".join(
        f"UNION ALL SELECT 'null_pct', '{c}', 0::double, n > 0 FROM sampled " for c in CRITICAL
    ),
    "dq_sample_by_key": f"""WITH {FACTS},
      sampled AS (
        SELECT * FROM facts
        ORDER BY md5(video_id || '|' || region || '|' || publish_time || '|' || channel_title || '|'
            || views::varchar || '|' || comment_count::varchar || '|' || dislikes::varchar),
          video_id, region, publish_time, channel_title, views, comment_count, dislikes
        LIMIT 2000)
      SELECT 'row_count' AS "check", NULL::varchar AS "column", count(*)::double AS value,
        count(*) >= 10 AS passed FROM sampled
      """
    + "".join(
        f"""UNION ALL SELECT 'null_pct', '{c}', round_even(pct, 2)::double, pct <= 5
        FROM (SELECT count_if({c} IS NULL)::double / count(*) * 100 AS pct FROM sampled) """
        for c in ("likes", "title", "views")
    ),
    "dq_unreadable_table": """
      WITH n AS (SELECT count(*) AS n FROM nation)
      SELECT 'read_table' AS "check", 'absent' AS "table", NULL::varchar AS "column",
        NULL::double AS value, false AS passed
      UNION ALL SELECT 'row_count', 'reference_data', NULL, n::double, n >= 10 FROM n
      UNION ALL SELECT 'null_pct', 'reference_data', 'id',
        (SELECT count_if(n_nationkey IS NULL) * 100.0 / count(*) FROM nation)::double, true
      UNION ALL SELECT 'null_pct', 'reference_data', 'region', 0, true
      UNION ALL SELECT 'schema', 'reference_data', NULL, NULL, true
      UNION ALL SELECT 'freshness', 'reference_data', NULL, NULL, true""",
    "dq_verdict": f"""WITH {SILVER},
      checks AS (
        SELECT count(*) >= 10 AS passed FROM silver
        UNION ALL SELECT count_if(video_id IS NULL) * 20 <= count(*) FROM silver
        UNION ALL SELECT count_if(title IS NULL) * 20 <= count(*) FROM silver
        UNION ALL SELECT count_if(channel_title IS NULL) * 20 <= count(*) FROM silver
        UNION ALL SELECT count_if(views IS NULL) * 20 <= count(*) FROM silver
        UNION ALL SELECT count_if(region IS NULL) * 20 <= count(*) FROM silver
        UNION ALL SELECT true
        UNION ALL SELECT count_if(views < 0 OR views > 50000000000) = 0 FROM silver
        UNION ALL SELECT true
        UNION ALL SELECT count(*) >= 10 FROM facts
        UNION ALL SELECT false UNION ALL SELECT false UNION ALL SELECT true)
      SELECT bool_and(passed) AS quality_passed, count_if(passed)::bigint AS checks_passed,
        count(*) AS checks_total FROM checks""",
    "append_vs_merge": f"""WITH {SILVER},
      modes AS (SELECT * FROM (VALUES ('append', 2), ('merge', 1)) AS m(mode, times))
      SELECT region, (count(*) * times)::bigint AS records,
        (sum(views) * times)::bigint AS total_views, mode
      FROM silver CROSS JOIN modes GROUP BY region, mode, times""",
    "schema_evolution": """
      SELECT c_custkey, c_name,
        CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal,
        c_mktsegment AS region FROM customer""",
    "raw_landing": f"""WITH {FACTS}
      SELECT lower(trim(region)) AS region, '2024-02-01' AS date, '09' AS hour,
        '20240201_093000' AS ingestion_id,
        '2024-02-01T09:30:00+00:00' AS ingestion_timestamp, 'fixture' AS source,
        count(*) AS documents,
        sum(CASE WHEN likes IS NULL THEN 1 ELSE 2 END)::bigint AS video_count,
        sum(CASE WHEN likes IS NULL THEN 1 ELSE 2 END)::bigint AS items
      FROM facts GROUP BY region""",
    "landed_statistics": f"""WITH {ITEMS}
      SELECT * REPLACE (NULL::bigint AS dislikes) FROM (
        SELECT {API_RECORD}, lower(trim(region)) AS region FROM items)""",
    "load_manifest": f"""WITH {FACTS},
      trending AS (
        SELECT lower(trim(region)) AS region, count(*) AS documents,
          count_if(views = 0 AND region <> ' ASIA') AS failed,
          sum(CASE WHEN views = 0 AND region <> ' ASIA' THEN 0 WHEN likes IS NULL THEN 1
                   ELSE 2 END)::bigint AS items
        FROM facts GROUP BY region)
      SELECT '20240201_093000' AS ingestion_id, region, 'trending' AS kind,
        CASE WHEN failed = 0 THEN 'success' ELSE 'failed' END AS status, documents,
        items AS item_count,
        CASE WHEN failed > 0 THEN 'payload is not a JSON object' END AS error
      FROM trending
      UNION ALL
      SELECT '20240201_093000', lower(r_name), 'categories', 'success', 1, count(*), NULL
      FROM nation JOIN region ON n_regionkey = r_regionkey
      WHERE lower(r_name) NOT IN (SELECT region FROM trending WHERE failed > 0)
      GROUP BY r_name""",
    "incremental_silver": f"WITH {SILVER} {STAMPED}",
    "incremental_any_file": f"WITH {SILVER} {STAMPED}",
    "incremental_gold": f"""{CHANNELS}, '2024-02-01 09:30:00' AS _aggregated_at,
        (SELECT count(*) FROM (SELECT DISTINCT region, trending_date_parsed FROM clean
          WHERE NOT (trending_date LIKE '13.%' AND views % 2 = 0))) AS days_first,
        (SELECT count(*) FROM (SELECT DISTINCT region, trending_date_parsed FROM clean
          WHERE trending_date LIKE '13.%' AND views % 2 = 0)) AS days_second
      FROM grouped""",
    "append_redelivered": f"""WITH {SILVER}
      SELECT region, CASE WHEN length(title) % 2 = 0 THEN 'stream-0' ELSE 'stream-1' END AS load,
        count(*) AS records, sum(views)::bigint AS total_views
      FROM silver GROUP BY ALL""",
    "rejected_input": f"""WITH {FACTS},
      lines AS (
        SELECT 'csv' AS source, region, 'fields do not match the header' AS reason, 1 AS records,
          length(concat_ws(',', video_id, trending_date, title, channel_title, category_id::varchar,
            publish_time, '', views::varchar, coalesce(likes::varchar, ''), dislikes::varchar,
            comment_count::varchar, '', comments_disabled::varchar, ratings_disabled::varchar,
            video_error_or_removed::varchar, 'one,more')) + 2 AS characters
        FROM facts WHERE views = 0
        UNION ALL
        SELECT 'api', region, 'not readable as JSON', 1, 40 FROM facts
        WHERE views = 0 AND region <> ' ASIA'),
      totals AS (
        SELECT 2 * count(*) + count(likes) - count_if(views = 0)
          - sum(CASE WHEN views = 0 AND region <> ' ASIA' THEN 1 + (likes IS NOT NULL)::int ELSE 0 END) AS n
        FROM facts)
      SELECT source, region, reason, sum(records)::bigint AS records, sum(characters)::bigint AS characters,
        (SELECT n FROM totals)::bigint AS rows_read, (SELECT count(*) FROM lines) AS rows_rejected
      FROM lines GROUP BY source, region, reason""",
    "reference_replay": """
      SELECT n_nationkey::varchar AS id, n_name AS snippet_title,
        '2024-02-01T09:30:00+00:00' AS _ingestion_timestamp, lower(r_name) AS region
      FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "gated_gold": f"""{CHANNELS},
        '2024-02-01 09:30:00' AS _aggregated_at, 14::int AS checks_passed,
        14::int AS checks_total
      FROM grouped""",
}
