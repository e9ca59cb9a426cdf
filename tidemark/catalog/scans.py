"""Scans, sources, conversion and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.feeds import (
    CONTROL_SQL,
    FEED,
    FEED_SQL,
    STAGED_SQL,
    WINDOW,
    attempts,
    feed,
    objects,
    runs,
    staged,
    table,
)
from tidemark.catalog.registry import query
from tidemark.functions import identity
from tidemark.functions.times import epoch_seconds
from tidemark.operators import conform, control, pages, windows
from tidemark.schema import RAW, STAGING
from tidemark.session import scratch_path
from tidemark.sinks.landing import write_parquet
from tidemark.sources import commits, tables
from tidemark.sources.pages import scan_pages

RAW_SQL = (
    "code, product_name, brands, nutrition_grades, "
    "array_to_string(categories_tags_en, '|') AS tags, last_modified_t"
)


def flat(df, *extra):
    """Raw columns with the list as text, so that results compare on every engine."""
    return df.select(
        "code",
        "product_name",
        "brands",
        "nutrition_grades",
        F.array_join("categories_tags_en", "|").alias("tags"),
        "last_modified_t",
        *extra,
    )


def newest(spec=FEED):
    return pages.newest_first(spec.event_time, spec.tie_break)


@query(
    "page_scan",
    f"""WITH {FEED_SQL}
    SELECT (n - 1) // 50 + 1 AS page_number, CAST((n - 1) % 50 AS BIGINT) AS position, code,
           product_name, last_modified_t AS modified_t
    FROM (SELECT *, row_number() OVER (ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n
          FROM feed)""",
)
def page_scan(spark, sf_dir):
    """Page documents are written as JSON lines, then scanned and exploded."""
    record = F.struct("page_position", "code", "product_name", "last_modified_t")
    paged = pages.paginate(feed(spark, sf_dir), newest())
    path = scratch_path(spark, "pages")
    documents = paged.groupBy("page_number").agg(
        F.array_sort(F.collect_list(record)).alias("products")
    )
    documents.select(
        F.to_json(
            F.struct(F.col("page_number").alias("page"), F.size("products").alias("page_size"), "products")
        ).alias("value")
    ).write.text(path)
    return scan_pages(spark, path).select(
        "page_number",
        F.col("position").cast("long").alias("position"),
        F.try_variant_get("record", "$.code", "string").alias("code"),
        F.try_variant_get("record", "$.product_name", "string").alias("product_name"),
        F.try_variant_get("record", "$.last_modified_t", "bigint").alias("modified_t"),
    )


@query("source_projection", f"WITH {FEED_SQL} SELECT {RAW_SQL} FROM feed")
def source_projection(spark, sf_dir):
    return flat(tables.project_raw(feed(spark, sf_dir)))


@query(
    "category_filter",
    f"WITH {FEED_SQL} SELECT {RAW_SQL} FROM feed WHERE list_contains(categories_tags_en, 'click')",
)
def category_filter(spark, sf_dir):
    return flat(tables.with_category(tables.project_raw(feed(spark, sf_dir)), "click"))


@query(
    "newest_first",
    f"""WITH {FEED_SQL}
    SELECT event_id, code, last_modified_t,
           row_number() OVER (ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS place
    FROM feed""",
)
def newest_first(spark, sf_dir):
    """The sorted feed, with each row's place in the order as a column."""
    from tidemark.operators.ranking import with_ordinal

    rows = feed(spark, sf_dir).select("event_id", "code", "last_modified_t")
    return with_ordinal(rows, newest(), "place")


@query(
    "paginate",
    f"""WITH {FEED_SQL}
    SELECT event_id, last_modified_t, (n - 1) // 50 + 1 AS page_number,
           (n - 1) % 50 + 1 AS page_position
    FROM (SELECT *, row_number() OVER (ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n
          FROM feed)""",
)
def paginate(spark, sf_dir):
    rows = feed(spark, sf_dir).select("event_id", "last_modified_t")
    return pages.paginate(rows, newest())


@query("raw_scan", f"WITH {FEED_SQL} SELECT {RAW_SQL} FROM feed WHERE event_id % 2 = 0 UNION ALL "
       f"SELECT {RAW_SQL} FROM feed WHERE event_id % 2 = 1")
def raw_scan(spark, sf_dir):
    """Two written objects read back by name in one scan."""
    rows = feed(spark, sf_dir)
    paths = []
    for half in (0, 1):
        paths.append(scratch_path(spark, "raw-scan"))
        write_parquet(tables.project_raw(rows.filter(F.col("event_id") % 2 == half)), paths[-1])
    return flat(tables.scan_raw(spark, *paths))


def object_table(landed):
    """Objects of every attempt, with their keys."""
    tried = attempts(landed).select("run_id", "attempt_id", "committed_at", "declared")
    prefix = identity.attempt_prefix("source", "logical_date", "run_id", "attempt_id")
    return (
        landed.join(tried, "run_id")
        .withColumn("object_key", identity.part_key(prefix, "part_number"))
    )


def manifest_table(landed):
    """Manifest documents of every attempt, with the declared rows as told."""
    listed = object_table(landed)
    declared = attempts(landed).select("run_id", "attempt_id", "declared")
    return (
        control.build_manifests(listed)
        .join(declared, ["run_id", "attempt_id"])
        .withColumn("row_count", F.col("declared"))
        .drop("declared")
    )


@query(
    "committed_objects",
    f"""WITH {CONTROL_SQL}
    SELECT w.source, w.logical_date, w.run_id, w.attempt_id,
           w.source || '/extract_date=' || CAST(w.logical_date AS VARCHAR) || '/run_id=' || w.run_id
             || '/attempt_id=' || w.attempt_id || '/part-'
             || lpad(CAST(o.part_number AS VARCHAR), 5, '0') || '.parquet' AS object_key,
           o.row_count, o.size_bytes
    FROM winners w JOIN objects o USING (run_id)""",
)
def committed_objects(spark, sf_dir):
    landed = objects(spark, sf_dir)
    winners = control.winning_attempts(attempts(landed))
    return control.committed_objects(winners, manifest_table(landed))


@query(
    "commit_log_scan",
    f"""WITH {CONTROL_SQL}
    SELECT source, logical_date, run_id, attempt_id, object_count, row_count,
           committed_t, CAST(epoch(logical_date) AS BIGINT) AS next_watermark_t
    FROM winners""",
)
def commit_log_scan(spark, sf_dir):
    """Commit records are written per run folder and scanned back as one table."""
    root = scratch_path(spark, "commit-log")
    won = control.winning_attempts(attempts(objects(spark, sf_dir))).select(
        "source", "run_id", "attempt_id", "object_count", "row_count", "logical_date",
        F.col("logical_date").alias("extract_date"),
        F.col("run_id").alias("run"),
        F.col("logical_date").cast("timestamp").alias("next_watermark"),
        "committed_at",
    )
    (
        won.withColumn("logical_date", F.col("logical_date").cast("string"))
        .select(
            F.to_json(F.struct("source", "logical_date", "run_id", "attempt_id", "object_count",
                               "row_count", "next_watermark", "committed_at")).alias("value"),
            "extract_date",
            F.col("run").alias("run_id"),
        )
        .write.partitionBy("extract_date", "run_id")
        .text(f"{root}/log")
    )
    found = commits.scan_markers(spark, root, "log", name="part-*")
    return found.select(
        "source", "logical_date", "run_id", "attempt_id", "object_count", "row_count",
        F.unix_timestamp("committed_at").alias("committed_t"),
        F.unix_timestamp("next_watermark").alias("next_watermark_t"),
    )


@query(
    "pending_runs",
    f"""WITH {CONTROL_SQL}
    SELECT source, logical_date, run_id,
           CASE WHEN run_id IN (SELECT run_id FROM winners) THEN 'done' ELSE 'pending' END AS state
    FROM runs""",
)
def pending_runs(spark, sf_dir):
    landed = objects(spark, sf_dir)
    wanted = runs(landed).select("source", "logical_date", "run_id")
    won = control.winning_attempts(attempts(landed))
    pending = control.pending_runs(wanted, won).withColumn("state", F.lit("pending"))
    done = control.done_runs(wanted, won).withColumn("state", F.lit("done"))
    return pending.unionByName(done)


@query(
    "staging_batch_scan",
    f"""WITH {STAGED_SQL}
    SELECT code, product_name, last_modified_t, event_id, batch_date FROM staged
    WHERE batch_date = DATE '2024-01-16'""",
)
def staging_batch_scan(spark, sf_dir):
    """Staging is written partitioned by batch; the scan reads one partition."""
    path = scratch_path(spark, "staging")
    rows = staged(spark, sf_dir).select("code", "product_name", "last_modified_t", "event_id", "batch_date")
    write_parquet(rows, path, ["batch_date"])
    return tables.staging_batch(spark.read.parquet(path), WINDOW[1].date())


@query(
    "window_filter",
    f"""WITH {FEED_SQL}
    SELECT event_id, code, last_modified_t FROM feed
    WHERE last_modified_t >= epoch(TIMESTAMP '2024-01-15 00:00:00')
      AND last_modified_t < epoch(TIMESTAMP '2024-01-16 00:00:00')""",
)
def window_filter(spark, sf_dir):
    rows = feed(spark, sf_dir).select("event_id", "code", "last_modified_t")
    return windows.window_filter(rows, "last_modified_t", *WINDOW)


def time_documents(spark, sf_dir):
    """Every event as a JSON record whose time is a number, text, boolean, fraction,
    null or missing.
    """
    seconds = epoch_seconds("ts").cast("string")
    kind = F.col("event_id") % 6
    time = (
        F.when(kind == 0, seconds)
        .when(kind == 1, F.concat(F.lit('"'), seconds, F.lit('"')))
        .when(kind == 2, F.lit("true"))
        .when(kind == 3, F.concat(seconds, F.lit(".5")))
        .when(kind == 4, F.lit("null"))
    )
    field = F.coalesce(F.concat(F.lit(',"last_modified_t":'), time), F.lit(""))
    text = F.concat(F.lit('{"code":"'), F.col("user_id").cast("string"), F.lit('"'), field, F.lit("}"))
    return table(spark, sf_dir, "events").select("event_id", F.parse_json(text).alias("record"))


@query("usable_timestamp", "SELECT event_id, event_id % 6 IN (0, 3) AS usable FROM events")
def usable_timestamp(spark, sf_dir):
    return time_documents(spark, sf_dir).select(
        "event_id", conform.is_usable_time("record", "last_modified_t").alias("usable")
    )


@query(
    "reject_report",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS code,
              CASE event_id % 6 WHEN 1 THEN 'string' WHEN 2 THEN 'boolean' WHEN 4 THEN 'void'
                   ELSE 'missing' END AS reason
       FROM events WHERE event_id % 6 NOT IN (0, 3)""",
)
def reject_report(spark, sf_dir):
    return conform.reject_report(time_documents(spark, sf_dir), "record", "code", "last_modified_t")


@query(
    "conform_schema",
    """SELECT event_id,
         CASE WHEN k = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS code,
         CASE WHEN k = 7 THEN NULL ELSE event_type END AS product_name,
         CASE WHEN k = 5 THEN NULL WHEN k = 6 THEN event_type || '|?' ELSE event_type END AS tags,
         CASE WHEN k IN (2, 3, 7) THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS last_modified_t,
         CASE k WHEN 1 THEN 'code' WHEN 2 THEN 'last_modified_t' WHEN 3 THEN 'last_modified_t'
              WHEN 5 THEN 'categories_tags_en' WHEN 7 THEN 'last_modified_t' ELSE '' END AS violations
       FROM (SELECT *, event_id % 8 AS k FROM events)""",
)
def conform_schema(spark, sf_dir):
    """JSON records, most of them with one defect or oddity, to the raw schema."""
    kind = F.col("event_id") % 8
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    seconds = epoch_seconds("ts").cast("string")
    user = F.col("user_id").cast("string")
    tag = quoted(F.col("event_type"))
    text = F.concat(
        F.lit('{"code":'), F.when(kind == 1, user).otherwise(quoted(user)),
        F.when(kind == 7, F.lit("")).otherwise(F.concat(F.lit(',"product_name":'), tag)),
        F.lit(',"categories_tags_en":'),
        F.when(kind == 5, tag)
        .when(kind == 6, F.concat(F.lit("["), tag, F.lit(',null],"unknown":1')))
        .otherwise(F.concat(F.lit("["), tag, F.lit("]"))),
        F.lit(',"last_modified_t":'),
        F.when(kind == 2, quoted(seconds))
        .when(kind == 3, F.lit("true"))
        .when(kind == 4, F.concat(seconds, F.lit(".5")))
        .when(kind == 7, F.lit("1e30"))
        .otherwise(seconds),
        F.lit("}"),
    )
    records = table(spark, sf_dir, "events").select("event_id", F.parse_json(text).alias("record"))
    return conform.conform_records(records, "record", RAW).select(
        "event_id", "code", "product_name",
        F.array_join("categories_tags_en", "|", "?").alias("tags"),
        "last_modified_t",
        F.array_join("violations", ",").alias("violations"),
    )


@query(
    "payload_shape",
    """SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'records_not_a_list'
              WHEN 4 THEN 'not_json' WHEN 5 THEN 'not_an_object' END AS problem FROM events""",
)
def payload_shape(spark, sf_dir):
    kind = F.col("event_id") % 6
    record = F.to_json(F.struct(F.col("user_id").cast("string").alias("code")))
    text = (
        F.when(kind == 0, F.concat(F.lit('{"count":1,"products":['), record, F.lit("]}")))
        .when(kind == 1, F.concat(F.lit("["), record, F.lit("]")))
        .when(kind == 2, F.concat(F.lit('{"products":'), record, F.lit("}")))
        .when(kind == 3, F.lit("{}"))
        .when(kind == 4, F.lit("<html>"))
        .otherwise(F.lit("null"))
    )
    documents = table(spark, sf_dir, "events").select("event_id", F.try_parse_json(text).alias("doc"))
    return documents.select("event_id", conform.page_shape("doc").alias("problem"))


@query(
    "event_filter",
    f"""WITH {STAGED_SQL}
    SELECT batch_date, event_id, code, last_modified_t FROM staged WHERE last_modified_t IS NOT NULL""",
)
def event_filter(spark, sf_dir):
    rows = staged(spark, sf_dir).select("batch_date", "event_id", "code", "last_modified_t")
    return tables.events_only(rows, "last_modified_t")


@query(
    "bootstrap_tables",
    f"""WITH {STAGED_SQL}
    SELECT 'staging' AS table_name, count(*) AS rows FROM staged
    UNION ALL SELECT 'dimension', count(DISTINCT code) FROM staged
    UNION ALL SELECT 'fact', 0 UNION ALL SELECT 'watermarks', 0 UNION ALL SELECT 'dq_metrics', 0""",
)
def bootstrap_tables(spark, sf_dir):
    """Empty tables are created, then first rows are added to two of them."""
    from tidemark.schema import TABLES, shaped
    from tidemark.sinks.tables import WHOLE, TableStore

    store = TableStore(spark, scratch_path(spark, "bootstrap"))
    base = store.bootstrap()
    rows = staged(spark, sf_dir).withColumn("raw_object_key", F.lit("feed"))
    codes = rows.select("code").distinct()
    store.publish(
        base,
        {
            "staging": {WHOLE: [store.write("staging", shaped(rows, STAGING))]},
            "dimension": {WHOLE: [store.write("dimension", codes)]},
        },
    )
    counts = [
        store.read(name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in TABLES
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first
