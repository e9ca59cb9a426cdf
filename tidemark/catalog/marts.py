"""Joins, merges, aggregates, ranking and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.feeds import (
    FEED,
    FEED_SQL,
    LOOKBACK_SECONDS,
    SHIPMENTS,
    SHIPMENTS_SQL,
    STAGED_SQL,
    WINDOW,
    feed,
    shipments,
    staged,
    table,
)
from tidemark.catalog.registry import query
from tidemark.catalog.scans import newest
from tidemark.functions.times import epoch_of, epoch_seconds
from tidemark.operators import merge, pages, quality, ranking, windows

KEYED_SQL = STAGED_SQL + """,
keyed AS (SELECT code, row_number() OVER (ORDER BY code) AS product_key
          FROM (SELECT DISTINCT code FROM staged))"""

PAGED_SQL = FEED_SQL + """,
paged AS (SELECT *, (n - 1) // 50 + 1 AS page_number FROM (
  SELECT *, row_number() OVER (ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n
  FROM feed))"""

INSIDE_SQL = (
    "last_modified_t >= epoch(TIMESTAMP '2024-01-15') AND last_modified_t < epoch(TIMESTAMP '2024-01-16')"
)


def keyed_dimension(rows):
    """Codes numbered in order, as a dimension of keys only."""
    return ranking.surrogate_keys(rows.select("code").distinct(), "code", "product_key", 1)


def paged_feed(spark, sf_dir):
    rows = feed(spark, sf_dir).select("event_id", "code", "last_modified_t")
    return pages.paginate(rows, newest())


# --- joins -------------------------------------------------------------------------


@query(
    "fact_key_lookup",
    f"""WITH {KEYED_SQL}
    SELECT s.code, s.last_modified_t, min(s.batch_date) AS batch_date, k.product_key
    FROM staged s JOIN keyed k USING (code) WHERE s.last_modified_t IS NOT NULL
    GROUP BY s.code, s.last_modified_t, k.product_key""",
)
def fact_key_lookup(spark, sf_dir):
    rows = staged(spark, sf_dir)
    return merge.lookup_surrogates(
        merge.distinct_events(rows, FEED), keyed_dimension(rows), FEED, hot_from=rows
    )


@query(
    "scd1_merge",
    f"""WITH {FEED_SQL},
    ranked AS (SELECT *, event_id % 3 = 0 AS old, row_number() OVER (
      PARTITION BY code, event_id % 3 = 0 ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n
      FROM feed WHERE NOT (user_id_is_new AND event_id % 3 = 0)),
    d AS (SELECT * FROM ranked WHERE n = 1 AND old),
    s AS (SELECT * FROM ranked WHERE n = 1 AND NOT old),
    j AS (SELECT coalesce(d.code, s.code) AS code,
      CASE WHEN d.code IS NULL THEN 'I'
           WHEN s.code IS NOT NULL AND (d.last_modified_t IS NULL OR s.last_modified_t > d.last_modified_t)
           THEN 'U' ELSE 'K' END AS action,
      d.product_name AS dn, s.product_name AS sn, d.brands AS db, s.brands AS sb,
      d.last_modified_t AS dt, s.last_modified_t AS st, d.code IS NULL AS fresh
      FROM d FULL JOIN s ON d.code = s.code)
    SELECT code, action, CASE WHEN action = 'K' THEN dn ELSE sn END AS product_name,
           CASE WHEN action = 'K' THEN db ELSE sb END AS brands,
           CASE WHEN action = 'K' THEN dt ELSE st END AS source_last_modified_t,
           CASE WHEN action = 'I' THEN 2000 ELSE 1000 END AS created_t,
           CASE WHEN action = 'K' THEN 1000 ELSE 2000 END AS updated_t
    FROM j""".replace("user_id_is_new", "CAST(code AS BIGINT) % 11 = 0"),
)
def scd1_merge(spark, sf_dir):
    """A third of the events make the old dimension, the rest are merged into it."""
    return merged_feed(spark, sf_dir).select(
        "code", "action", "product_name", "brands", "source_last_modified_t",
        F.unix_timestamp("created_at").cast("int").alias("created_t"),
        F.unix_timestamp("updated_at").cast("int").alias("updated_t"),
    )


def merged_feed(spark, sf_dir):
    rows = feed(spark, sf_dir)
    old = F.col("event_id") % 3 == 0
    known = old & (F.col("code").cast("bigint") % 11 != 0)
    stamp = F.timestamp_seconds(F.lit(1000))
    dimension = ranking.latest_per_key(rows.filter(known), FEED).select(
        F.lit(1).cast("long").alias("product_key"), "code", *FEED.attributes,
        F.col("last_modified_t").alias("source_last_modified_t"),
        stamp.alias("created_at"), stamp.alias("updated_at"),
    )
    latest = ranking.materialise(ranking.latest_per_key(rows.filter(~old), FEED), "latest")
    return merge.merge_type1(dimension, latest, FEED, F.timestamp_seconds(F.lit(2000)))


@query(
    "merge_change_counts",
    f"""WITH {FEED_SQL},
    d AS (SELECT code, max(last_modified_t) AS t FROM feed
          WHERE event_id % 3 = 0 AND CAST(code AS BIGINT) % 11 <> 0 GROUP BY 1),
    s AS (SELECT code, max(last_modified_t) AS t FROM feed WHERE event_id % 3 <> 0 GROUP BY 1)
    SELECT CASE WHEN d.code IS NULL THEN 'I'
                WHEN s.code IS NOT NULL AND (d.t IS NULL OR s.t > d.t) THEN 'U' ELSE 'K' END AS action,
           count(*) AS rows
    FROM d FULL JOIN s ON d.code = s.code GROUP BY 1""",
)
def merge_change_counts(spark, sf_dir):
    return merge.change_counts(merged_feed(spark, sf_dir))


@query(
    "fact_insert_new",
    f"""WITH {KEYED_SQL},
    events_ AS (SELECT code, last_modified_t, min(batch_date) AS batch_date,
                       bool_or(day(batch_date) % 2 = 1) AS known
                FROM staged WHERE last_modified_t IS NOT NULL GROUP BY 1, 2)
    SELECT k.product_key, e.last_modified_t AS source_last_modified_t, e.batch_date
    FROM events_ e JOIN keyed k USING (code) WHERE NOT e.known""",
)
def fact_insert_new(spark, sf_dir):
    """Facts of odd days are known; those of all days are offered."""
    rows = staged(spark, sf_dir)
    dimension = keyed_dimension(rows)
    odd = rows.filter(F.dayofmonth("batch_date") % 2 == 1)
    known = merge.lookup_surrogates(
        merge.distinct_events(odd, FEED), dimension, FEED, hot_from=odd
    ).withColumnRenamed("last_modified_t", "source_last_modified_t")
    offered = merge.lookup_surrogates(merge.distinct_events(rows, FEED), dimension, FEED, hot_from=rows)
    return merge.new_facts(offered, known, FEED)


@query(
    "fk_orphans",
    """SELECT l_partkey, count(*) AS rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0) GROUP BY 1""",
)
def fk_orphans(spark, sf_dir):
    parts = table(spark, sf_dir, "part").filter("p_partkey % 10 <> 0")
    return merge.orphans(
        table(spark, sf_dir, "lineitem"), parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey"
    )


@query(
    "window_assign",
    """WITH spans AS (
      SELECT event_type AS source_name, CAST(ts AS DATE) + 1 AS batch_date,
             CAST(epoch(CAST(ts AS DATE)) AS BIGINT) - 21600 AS a,
             CAST(epoch(CAST(ts AS DATE)) AS BIGINT) + 86400 AS b
      FROM events GROUP BY ALL)
    SELECT e.event_id, s.source_name, s.batch_date
    FROM events e JOIN spans s ON e.event_type = s.source_name
     AND CAST(floor(epoch(e.ts)) AS BIGINT) >= s.a AND CAST(floor(epoch(e.ts)) AS BIGINT) < s.b""",
)
def window_assign(spark, sf_dir):
    """Every event under all windows of its source; windows come as a table."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("source_name"), epoch_seconds("ts").alias("t"), "ts"
    )
    day = F.to_date("ts").cast("timestamp")
    spans = events.select("source_name", day.alias("day")).distinct().select(
        "source_name",
        F.date_add(F.to_date("day"), 1).alias("batch_date"),
        (F.col("day") - F.make_dt_interval(F.lit(0), F.lit(LOOKBACK_SECONDS // 3600))).alias("extract_start"),
        (F.col("day") + F.make_dt_interval(F.lit(1))).alias("extract_end"),
    )
    return windows.assign_windows(
        events.drop("ts"), spans, "t", ["event_id"], ["source_name"]
    ).select("event_id", "source_name", "batch_date")


# --- aggregates --------------------------------------------------------------------


@query(
    "page_bounds",
    f"""WITH {PAGED_SQL} SELECT page_number, max(last_modified_t) AS newest_t,
        min(last_modified_t) AS oldest_t FROM paged GROUP BY 1""",
)
def page_bounds(spark, sf_dir):
    return pages.page_bounds(paged_feed(spark, sf_dir), "last_modified_t")


STATS_SQL = f"""stats AS (
  SELECT page_number, count(*) AS returned, count(*) FILTER (WHERE {INSIDE_SQL}) AS in_window,
         max(last_modified_t) AS newest_t, min(last_modified_t) AS oldest_t
  FROM paged GROUP BY 1)"""


def page_statistics(spark, sf_dir):
    return pages.page_stats(
        paged_feed(spark, sf_dir), "last_modified_t", windows.in_window("last_modified_t", *WINDOW)
    )


@query(
    "page_counts",
    f"WITH {PAGED_SQL}, {STATS_SQL} SELECT page_number, returned, in_window FROM stats",
)
def page_counts(spark, sf_dir):
    return page_statistics(spark, sf_dir).select("page_number", "returned", "in_window")


SEEN_SQL = "seen AS (SELECT *, CAST(sum(returned) OVER (ORDER BY page_number) AS BIGINT) AS total_seen FROM stats)"


@query("running_seen", f"""WITH {PAGED_SQL}, {STATS_SQL}, {SEEN_SQL}
       SELECT page_number, returned, total_seen FROM seen""")
def running_seen(spark, sf_dir):
    return pages.running_seen(page_statistics(spark, sf_dir)).select("page_number", "returned", "total_seen")


@query(
    "stop_page",
    f"""WITH {PAGED_SQL}, {STATS_SQL}, {SEEN_SQL},
    ends AS (SELECT page_number,
      CASE WHEN newest_t < epoch(TIMESTAMP '2024-01-15') THEN 'too_old'
           WHEN total_seen >= (SELECT count(*) FROM events) THEN 'all_seen' END AS reason FROM seen)
    SELECT page_number AS stop_page,
           CASE WHEN reason = 'too_old' THEN page_number - 1 ELSE page_number END AS last_page, reason
    FROM ends WHERE reason IS NOT NULL ORDER BY page_number LIMIT 1""",
)
def stop_page(spark, sf_dir):
    """Where a scan for the window ends, given the declared size of the source."""
    stats = pages.running_seen(page_statistics(spark, sf_dir))
    declared = table(spark, sf_dir, "events").count()
    return pages.stop_page(
        stats.withColumn("declared_count", F.lit(declared)), F.lit(epoch_of(WINDOW[0]))
    )


@query("page_cap", f"WITH {PAGED_SQL} SELECT event_id, page_number FROM paged WHERE page_number <= 7")
def page_cap(spark, sf_dir):
    return pages.page_cap(paged_feed(spark, sf_dir), 7).select("event_id", "page_number")


@query(
    "null_key_count",
    f"""WITH {STAGED_SQL} SELECT batch_date, count(*) FILTER (WHERE nutrition_grades IS NULL) AS null_keys
        FROM staged GROUP BY 1""",
)
def null_key_count(spark, sf_dir):
    """Counted on the one column of the feed that has nulls."""
    return quality.null_key_count(staged(spark, sf_dir), "nutrition_grades", ["batch_date"])


@query(
    "duplicate_keys",
    f"""WITH {PAGED_SQL} SELECT page_number, code, count(*) AS rows FROM paged
        GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(paged_feed(spark, sf_dir), "code", ["page_number"])


@query(
    "filtered_counts",
    f"""WITH {STAGED_SQL} SELECT batch_date, count(*) AS row_count,
        count(*) FILTER (WHERE nutrition_grades IS NULL) AS null_code_count FROM staged GROUP BY 1""",
)
def filtered_counts(spark, sf_dir):
    return quality.filtered_counts(staged(spark, sf_dir), "nutrition_grades")


@query(
    "distinct_events",
    f"""WITH {STAGED_SQL} SELECT code, last_modified_t, min(batch_date) AS batch_date FROM staged
        WHERE last_modified_t IS NOT NULL GROUP BY 1, 2""",
)
def distinct_events(spark, sf_dir):
    return merge.distinct_events(staged(spark, sf_dir), FEED)


@query(
    "unique_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def unique_violations(spark, sf_dir):
    return quality.unique_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "not_null_violations",
    f"""WITH {FEED_SQL}
    SELECT 'code' AS column_name, count(*) FILTER (WHERE code IS NULL) AS null_rows FROM feed
    UNION ALL SELECT 'nutrition_grades', count(*) FILTER (WHERE nutrition_grades IS NULL) FROM feed
    UNION ALL SELECT 'last_modified_t', count(*) FILTER (WHERE last_modified_t IS NULL) FROM feed""",
)
def not_null_violations(spark, sf_dir):
    return quality.not_null_violations(
        feed(spark, sf_dir), ["code", "nutrition_grades", "last_modified_t"]
    )


# --- ranking -----------------------------------------------------------------------


@query(
    "latest_per_key",
    f"""WITH {STAGED_SQL}
    SELECT batch_date, code, product_name, brands, nutrition_grades,
           array_to_string(categories_tags_en, '|') AS tags, last_modified_t
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_date, code
            ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n FROM staged)
    WHERE n = 1""",
)
def latest_per_key(spark, sf_dir):
    """Newest version of every code in every batch."""
    from tidemark.catalog.scans import flat

    return flat(ranking.latest_per_key(staged(spark, sf_dir), FEED, ["batch_date"]), "batch_date")


@query(
    "surrogate_keys",
    """WITH old AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_returnflag = 'R'),
    fresh AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT l_partkey FROM old))
    SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) AS part_key, 'old' AS state FROM old
    UNION ALL
    SELECT l_partkey, (SELECT count(*) FROM old) + row_number() OVER (ORDER BY l_partkey), 'new' FROM fresh""",
)
def surrogate_keys(spark, sf_dir):
    """Parts of returned items have keys; the other parts are numbered on from there."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag")
    known = ranking.surrogate_keys(
        items.filter("l_returnflag = 'R'").select("l_partkey").distinct(), "l_partkey", "part_key", 1
    )
    highest = known.agg(F.coalesce(F.max("part_key"), F.lit(0))).first()[0]
    fresh = merge.unknown_keys(items.select("l_partkey").distinct(), known, "l_partkey")
    numbered = ranking.surrogate_keys(fresh, "l_partkey", "part_key", highest + 1)
    return known.withColumn("state", F.lit("old")).unionByName(
        numbered.withColumn("state", F.lit("new"))
    )


# --- gates -------------------------------------------------------------------------


@query(
    "raw_gate",
    f"""WITH {PAGED_SQL}
    SELECT page_number, count(*) AS rows, count(*) FILTER (WHERE code IS NULL) AS null_keys,
           count(DISTINCT code) AS distinct_keys,
           CASE WHEN count(*) FILTER (WHERE code IS NULL) > 0 THEN 'null_keys'
                WHEN count(DISTINCT code) <> count(*) THEN 'duplicate_keys' END AS failed_check
    FROM paged GROUP BY 1""",
)
def raw_gate(spark, sf_dir):
    return quality.raw_gate(paged_feed(spark, sf_dir), "code")


@query(
    "staging_gate",
    f"""WITH {STAGED_SQL},
    counts AS (SELECT batch_date, count(*) AS n,
                      count(*) FILTER (WHERE nutrition_grades IS NULL) AS nulls FROM staged GROUP BY 1)
    SELECT 'feed' AS source_name, 'staging' AS pipeline_layer, batch_date, 'row_count' AS metric_name,
           n AS metric_value, day(batch_date) % 5 <> 0 AS passed,
           CASE WHEN day(batch_date) % 5 = 0 THEN n + 1 ELSE n END AS expected_value FROM counts
    UNION ALL
    SELECT 'feed', 'staging', batch_date, 'null_code_count', nulls, nulls = 0, 0 FROM counts""",
)
def staging_gate(spark, sf_dir):
    """The gate over all batches; every fifth expects one row too many."""
    rows = staged(spark, sf_dir)
    expected = rows.groupBy("batch_date").agg(
        (F.count(F.lit(1)) + F.when(F.dayofmonth("batch_date") % 5 == 0, 1).otherwise(0)).alias("expected_rows")
    )
    return quality.staging_gate(rows, expected, "nutrition_grades", "feed")


MART_COUNTS_SQL = KEYED_SQL + """,
dim AS (SELECT * FROM keyed WHERE CAST(code AS BIGINT) % 10 <> 0),
fact AS (SELECT DISTINCT d.product_key, s.last_modified_t AS t FROM staged s JOIN dim d USING (code)
         WHERE s.last_modified_t % 11 <> 0),
lacks AS (
  SELECT batch_date, 1 AS no_dim, 0 AS no_fact FROM staged ANTI JOIN dim USING (code)
  UNION ALL
  SELECT batch_date, 0, 1 FROM (SELECT batch_date, code, last_modified_t AS t FROM staged WHERE last_modified_t IS NOT NULL)
  ANTI JOIN (SELECT code, t FROM dim JOIN fact USING (product_key)) USING (code, t)
  UNION ALL
  SELECT DISTINCT batch_date, 0, 0 FROM staged),
counts AS (
  SELECT batch_date, CAST(sum(no_dim) AS BIGINT) AS missing_dimension_count,
         CAST(sum(no_fact) AS BIGINT) AS missing_fact_count
  FROM lacks GROUP BY 1)"""


def broken_mart(spark, sf_dir):
    """Staging with a dimension and facts that miss some rows on purpose."""
    rows = staged(spark, sf_dir)
    dimension = keyed_dimension(rows).filter(F.col("code").cast("bigint") % 10 != 0)
    kept = rows.filter(F.col("last_modified_t") % 11 != 0)
    facts = merge.lookup_surrogates(
        merge.distinct_events(kept, FEED), dimension, FEED, hot_from=kept
    ).withColumnRenamed("last_modified_t", "source_last_modified_t")
    return rows, dimension, facts


@query("mart_reconcile", f"WITH {MART_COUNTS_SQL} SELECT * FROM counts")
def mart_reconcile(spark, sf_dir):
    return quality.mart_counts(*broken_mart(spark, sf_dir), FEED)


@query(
    "dq_metrics",
    f"""WITH {MART_COUNTS_SQL}
    SELECT 'feed' AS source_name, 'mart' AS pipeline_layer, batch_date,
           'missing_dimension_count' AS metric_name, CAST(missing_dimension_count AS BIGINT) AS metric_value,
           missing_dimension_count = 0 AS passed, CAST(0 AS BIGINT) AS expected_value FROM counts
    UNION ALL
    SELECT 'feed', 'mart', batch_date, 'missing_fact_count', missing_fact_count,
           missing_fact_count = 0, 0 FROM counts""",
)
def dq_metrics(spark, sf_dir):
    return quality.mart_gate(*broken_mart(spark, sf_dir), FEED, "feed")


@query(
    "gate_outcomes",
    f"""WITH {MART_COUNTS_SQL},
    staging AS (SELECT batch_date, day(batch_date) % 5 = 0 AS rows_failed,
                       count(*) FILTER (WHERE nutrition_grades IS NULL) > 0 AS nulls_failed FROM staged GROUP BY 1)
    SELECT 'feed' AS source_name, 'staging' AS pipeline_layer, batch_date,
           CAST(rows_failed AS BIGINT) + CAST(nulls_failed AS BIGINT) AS failed_checks,
           CASE WHEN rows_failed THEN 'row_count' WHEN nulls_failed THEN 'null_code_count' END AS blocked_by FROM staging
    UNION ALL
    SELECT 'feed', 'mart', batch_date,
           CAST(missing_dimension_count > 0 AS BIGINT) + CAST(missing_fact_count > 0 AS BIGINT),
           CASE WHEN missing_dimension_count > 0 THEN 'missing_dimension_count'
                WHEN missing_fact_count > 0 THEN 'missing_fact_count' END FROM counts""",
)
def gate_outcomes(spark, sf_dir):
    """Which batches the staging and mart gates block, and by which check."""
    metrics = staging_gate(spark, sf_dir).unionByName(dq_metrics(spark, sf_dir))
    return quality.gate_outcomes(metrics)


# --- the wider feed ----------------------------------------------------------------


@query(
    "shipment_latest_per_key",
    f"""WITH {SHIPMENTS_SQL}
    SELECT batch_date, part_id, supplier_id, quantity, price, shipped_t
    FROM (SELECT *, row_number() OVER (PARTITION BY batch_date, part_id
            ORDER BY shipped_t DESC NULLS LAST, order_id DESC, line DESC, supplier_id DESC,
                     quantity DESC, price DESC) AS n FROM shipments) WHERE n = 1""",
)
def shipment_latest_per_key(spark, sf_dir):
    return ranking.latest_per_key(shipments(spark, sf_dir), SHIPMENTS, ["batch_date"])


@query(
    "shipment_backfill_dim",
    f"""WITH {SHIPMENTS_SQL}
    SELECT part_id, supplier_id, quantity, price, shipped_t AS source_shipped_t
    FROM (SELECT *, row_number() OVER (PARTITION BY part_id
            ORDER BY shipped_t DESC NULLS LAST, batch_date, order_id DESC, line DESC, supplier_id DESC,
                     quantity DESC, price DESC) AS n FROM shipments) WHERE n = 1""",
)
def shipment_backfill_dim(spark, sf_dir):
    return merge.dimension_closed_form(shipments(spark, sf_dir), SHIPMENTS)


@query(
    "shipment_backfill_fact",
    f"""WITH {SHIPMENTS_SQL}
    SELECT part_id, shipped_t, min(batch_date) AS batch_date FROM shipments
    WHERE shipped_t IS NOT NULL GROUP BY 1, 2""",
)
def shipment_backfill_fact(spark, sf_dir):
    return merge.facts_closed_form(shipments(spark, sf_dir), SHIPMENTS)


@query(
    "shipment_reconcile",
    f"""WITH {SHIPMENTS_SQL},
    known AS (SELECT p_partkey AS part_id FROM part WHERE p_partkey % 10 <> 0),
    fact AS (SELECT DISTINCT part_id, shipped_t FROM shipments JOIN known USING (part_id) WHERE supplier_id % 13 <> 0),
    lacks AS (
      SELECT batch_date, 1 AS no_dim, 0 AS no_fact FROM shipments ANTI JOIN known USING (part_id)
      UNION ALL
      SELECT batch_date, 0, 1 FROM (SELECT * FROM shipments WHERE shipped_t IS NOT NULL) ANTI JOIN fact USING (part_id, shipped_t)
      UNION ALL
      SELECT DISTINCT batch_date, 0, 0 FROM shipments)
    SELECT batch_date, CAST(sum(no_dim) AS BIGINT) AS missing_dimension_count,
           CAST(sum(no_fact) AS BIGINT) AS missing_fact_count
    FROM lacks GROUP BY 1""",
)
def shipment_reconcile(spark, sf_dir):
    """Mart gate with the part table as dimension; some parts and facts are missing."""
    rows = shipments(spark, sf_dir)
    dimension = table(spark, sf_dir, "part").filter("p_partkey % 10 <> 0").select(
        F.col("p_partkey").alias("part_id"), F.col("p_partkey").alias("product_key")
    )
    facts = rows.filter("supplier_id % 13 <> 0").select(
        F.col("part_id").alias("product_key"), F.col("shipped_t").alias("source_shipped_t")
    ).distinct()
    return quality.mart_counts(rows, dimension, facts, SHIPMENTS)
