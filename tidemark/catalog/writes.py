"""Landing, manifests, commits, staging replacement and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.feeds import (
    CONTROL_SQL,
    FEED,
    FEED_SQL,
    STAGED_SQL,
    attempts,
    feed,
    objects,
    run_id_sql,
    runs,
    staged,
    table,
)
from tidemark.catalog.registry import query
from tidemark.catalog.scans import RAW_SQL, flat, manifest_table, object_table
from tidemark.functions import identity
from tidemark.operators import control, quality
from tidemark.session import scratch_path
from tidemark.sinks import landing, staging
from tidemark.sinks.tables import TableStore
from tidemark.sources import tables


@query("raw_write_roundtrip", f"WITH {FEED_SQL} SELECT {RAW_SQL} FROM feed")
def raw_write_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "raw")
    landing.write_parquet(tables.project_raw(feed(spark, sf_dir)), path)
    return flat(tables.scan_raw(spark, path))


@query(
    "attempt_layout",
    f"""WITH {FEED_SQL}
    SELECT CAST(ts AS DATE) + 1 AS extract_date,
           {run_id_sql("'feed'", "CAST(ts AS DATE) + 1")} AS run_id,
           CASE WHEN event_id % 2 = 0 THEN 'a1' ELSE 'a2' END AS attempt_id,
           count(*) AS rows, count(DISTINCT code) AS codes
    FROM feed GROUP BY ALL""",
)
def attempt_layout(spark, sf_dir):
    """The feed in run and attempt folders; the folder names come back as columns."""
    root = scratch_path(spark, "layout")
    rows = (
        feed(spark, sf_dir)
        .withColumn("extract_date", F.date_add(F.to_date("ts"), 1))
        .withColumn("run_id", identity.run_id(F.lit("feed"), "extract_date"))
        .withColumn("attempt_id", F.when(F.col("event_id") % 2 == 0, "a1").otherwise("a2"))
    )
    layout = ["extract_date", "run_id", "attempt_id"]
    landing.write_parquet(rows.select("code", "last_modified_t", *layout), f"{root}/feed", layout)
    return (
        spark.read.option("basePath", f"{root}/feed")
        .parquet(f"{root}/feed")
        .groupBy(*layout)
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("code").alias("codes"))
    )


@query(
    "flat_layout_keys",
    """SELECT 'feed/extract_date=' || CAST(CAST(ts AS DATE) + 1 AS VARCHAR) || '/part-'
              || lpad(CAST(hour(ts) // 6 AS VARCHAR), 5, '0') || '.parquet' AS object_key,
              count(*) AS rows
       FROM events GROUP BY 1""",
)
def flat_layout_keys(spark, sf_dir):
    key = identity.flat_part_key(
        F.lit("feed"), F.date_add(F.to_date("ts"), 1), F.floor(F.hour("ts") / 6)
    )
    return table(spark, sf_dir, "events").groupBy(key.alias("object_key")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def landed_feed(spark, sf_dir):
    """The timed rows of the feed, landed in a new folder: path and rows written."""
    path = scratch_path(spark, "landing")
    rows = tables.project_raw(tables.events_only(feed(spark, sf_dir), FEED.event_time))
    return path, landing.land_parts(rows, path, FEED.event_time, FEED.key)


@query("raw_landing", f"WITH {FEED_SQL} SELECT {RAW_SQL} FROM feed WHERE last_modified_t IS NOT NULL")
def raw_landing(spark, sf_dir):
    path, _ = landed_feed(spark, sf_dir)
    return flat(tables.scan_raw(spark, path))


@query(
    "object_inventory",
    f"""WITH {FEED_SQL}
    SELECT count(*) AS row_count, true AS all_keys_unique, true AS all_sized
    FROM feed WHERE last_modified_t IS NOT NULL""",
)
def object_inventory(spark, sf_dir):
    """What all engines can tell about the landed files: their rows, and that every
    object has its own key, some rows and some bytes.
    """
    path, _ = landed_feed(spark, sf_dir)
    return landing.inventory(spark, path).agg(
        F.sum("row_count").alias("row_count"),
        (F.countDistinct("object_key") == F.count(F.lit(1))).alias("all_keys_unique"),
        F.bool_and((F.col("size_bytes") > 0) & (F.col("row_count") > 0)).alias("all_sized"),
    )


@query(
    "landing_verify",
    f"""WITH {FEED_SQL}
    SELECT count(*) AS written_rows, count(*) AS readable_rows, true AS verified
    FROM feed WHERE last_modified_t IS NOT NULL""",
)
def landing_verify(spark, sf_dir):
    path, written = landed_feed(spark, sf_dir)
    found = landing.inventory(spark, path)
    landing.verify_landing(found, written)
    return found.agg(F.sum("row_count").alias("readable_rows")).select(
        F.lit(written).cast("long").alias("written_rows"),
        "readable_rows",
        (F.col("readable_rows") == written).alias("verified"),
    )


@query(
    "manifest_build",
    f"""WITH {CONTROL_SQL}
    SELECT run_id, object_count, row_count,
      to_json({{'attempt_id': 'a1',
        'completed_at': strftime(logical_date, '%Y-%m-%dT%H:%M:%S+00:00'),
        'document': 0, 'logical_date': CAST(logical_date AS VARCHAR),
        'object_count': object_count, 'objects': objects, 'row_count': row_count,
        'run_id': run_id, 'schema_version': 1, 'source': source,
        'started_at': strftime(logical_date - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+00:00')}})
        ::VARCHAR AS manifest
    FROM (SELECT source, logical_date, run_id, count(*) AS object_count,
                 CAST(sum(row_count) AS BIGINT) AS row_count,
                 list({{'object_key': 'part-' || lpad(CAST(part_number AS VARCHAR), 5, '0') || '.parquet',
                        'row_count': row_count, 'size_bytes': size_bytes}} ORDER BY part_number) AS objects
          FROM objects GROUP BY 1, 2, 3)""",
)
def manifest_build(spark, sf_dir):
    listed = (
        objects(spark, sf_dir)
        .withColumn("attempt_id", F.lit("a1"))
        .withColumn("object_key", identity.part_name("part_number"))
    )
    end = F.col("logical_date").cast("timestamp")
    return control.build_manifests(listed).select(
        "run_id",
        "object_count",
        "row_count",
        control.manifest_json(end - F.expr("interval 1 hour"), end).alias("manifest"),
    )


@query(
    "commit_record",
    f"""WITH {CONTROL_SQL}
    SELECT 2 AS schema_version, source, logical_date, run_id, attempt_id,
           source || '/extract_date=' || CAST(logical_date AS VARCHAR) || '/run_id=' || run_id
             || '/attempt_id=' || attempt_id || '/_manifest.json' AS manifest_key,
           object_count, row_count,
           CAST(epoch(logical_date) AS BIGINT) - 86400 - 21600 AS extract_start_t,
           CAST(epoch(logical_date) AS BIGINT) AS extract_end_t,
           CAST(epoch(logical_date) AS BIGINT) AS next_watermark_t,
           CAST(epoch(logical_date) AS BIGINT) + 900 AS committed_t
    FROM attempts""",
)
def commit_record(spark, sf_dir):
    landed = objects(spark, sf_dir)
    totals = control.run_totals(object_table(landed))
    end = F.col("logical_date").cast("timestamp")
    spans = runs(landed).select(
        F.col("source").alias("source_name"),
        "logical_date",
        (end - F.expr("interval 30 hours")).alias("extract_start"),
        end.alias("extract_end"),
        end.alias("next_watermark"),
    )
    records = control.commit_records(totals, spans, F.timestamp_add("MINUTE", F.lit(15), end))
    return records.select(
        *[c for c in records.columns if c not in ("extract_start", "extract_end", "next_watermark", "committed_at")],
        F.unix_timestamp("extract_start").alias("extract_start_t"),
        F.unix_timestamp("extract_end").alias("extract_end_t"),
        F.unix_timestamp("next_watermark").alias("next_watermark_t"),
        F.unix_timestamp("committed_at").alias("committed_t"),
    )


@query(
    "winning_attempt",
    f"WITH {CONTROL_SQL} SELECT source, logical_date, run_id, attempt_id, row_count, committed_t FROM winners",
)
def winning_attempt(spark, sf_dir):
    return control.winning_attempts(attempts(objects(spark, sf_dir))).select(
        "source", "logical_date", "run_id", "attempt_id", "row_count",
        F.unix_timestamp("committed_at").alias("committed_t"),
    )


@query("run_totals", f"""WITH {CONTROL_SQL}
    SELECT o.source, o.logical_date, o.run_id, t.attempt_id, count(*) AS object_count,
           CAST(sum(o.row_count) AS BIGINT) AS row_count
    FROM objects o JOIN attempts t USING (run_id) GROUP BY 1, 2, 3, 4""")
def run_totals(spark, sf_dir):
    return control.run_totals(object_table(objects(spark, sf_dir)))


@query(
    "manifest_reconcile",
    f"""WITH {CONTROL_SQL}
    SELECT source, logical_date, run_id, attempt_id, declared AS declared_rows,
           row_count AS listed_rows, declared = row_count AS matches
    FROM attempts""",
)
def manifest_reconcile(spark, sf_dir):
    return control.reconcile_manifests(manifest_table(objects(spark, sf_dir)))


@query(
    "part_keys",
    f"""WITH {FEED_SQL},
    numbered AS (SELECT *, row_number() OVER (ORDER BY last_modified_t DESC NULLS LAST, event_id DESC) AS n
                 FROM feed)
    SELECT 'part-' || lpad(CAST((n - 1) // 50 + 1 AS VARCHAR), 5, '0') || '.parquet' AS part_name,
           count(*) AS rows
    FROM numbered WHERE last_modified_t IS NOT NULL GROUP BY 1""",
)
def part_keys(spark, sf_dir):
    """One part per page; pages without usable rows leave gaps in the numbers."""
    from tidemark.catalog.scans import newest
    from tidemark.operators.pages import paginate

    rows = feed(spark, sf_dir).select("event_id", "last_modified_t")
    paged = tables.events_only(paginate(rows, newest()), "last_modified_t")
    return paged.groupBy(identity.part_name("page_number").alias("part_name")).agg(
        F.count(F.lit(1)).alias("rows")
    )


STAGING_KEY = "'feed/part-' || lpad(CAST(hour(ts) // 6 AS VARCHAR), 5, '0') || '.parquet'"


def staged_objects(spark, sf_dir):
    return staged(spark, sf_dir).withColumn(
        "raw_object_key", F.concat(F.lit("feed/"), identity.part_name(F.floor(F.hour("ts") / 6)))
    )


@query(
    "staging_replace",
    f"""WITH {STAGED_SQL},
    keyed AS (SELECT *, {STAGING_KEY} AS raw_object_key FROM staged)
    SELECT batch_date, raw_object_key, code, event_id,
           CASE WHEN hour(ts) // 6 = 1 THEN 'reloaded' ELSE product_name END AS product_name
    FROM keyed WHERE hour(ts) // 6 <> 2""",
)
def staging_replace(spark, sf_dir):
    """Second objects of every batch are reloaded with new rows, third ones turn out
    empty, the others stay.
    """
    rows = staged_objects(spark, sf_dir).withColumn("object", F.floor(F.hour("ts") / 6)).select(
        "batch_date", "raw_object_key", "code", "event_id", "product_name", "object"
    )
    fresh = rows.filter("object = 1").withColumn("product_name", F.lit("reloaded")).drop("object")
    listed = rows.filter("object in (1, 2)").select(*staging.OBJECT_KEY).distinct()
    return staging.replace_objects(rows.drop("object"), fresh, listed)


@query(
    "staging_overwrite",
    f"""WITH {STAGED_SQL},
    keyed AS (SELECT *, 'part-' || lpad(CAST(hour(ts) // 6 AS VARCHAR), 5, '0') || '.parquet'
                AS raw_object_key FROM staged)
    SELECT batch_date, raw_object_key, count(*) AS rows,
           count(*) FILTER (WHERE hour(ts) // 6 = 1) AS reloaded
    FROM keyed GROUP BY 1, 2""",
)
def staging_overwrite(spark, sf_dir):
    """The same reload in place by dynamic partition overwrite."""
    path = scratch_path(spark, "staging")
    rows = staged(spark, sf_dir).select(
        "batch_date", identity.part_name(F.floor(F.hour("ts") / 6)).alias("raw_object_key"),
        "code", "event_id", F.lit(0).alias("load"),
    )
    staging.overwrite_objects(path, rows)
    second = rows.filter(F.col("raw_object_key") == "part-00001.parquet").withColumn("load", F.lit(1))
    staging.overwrite_objects(path, second)
    return spark.read.parquet(path).groupBy(*staging.OBJECT_KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("load") == 1).alias("reloaded")
    )


@query(
    "staging_lineage",
    f"""WITH {FEED_SQL}
    SELECT DATE '2024-01-31' AS batch_date, true AS keyed, true AS loaded, count(*) AS rows
    FROM feed WHERE last_modified_t IS NOT NULL""",
)
def staging_lineage(spark, sf_dir):
    """Lineage columns of landed rows: every row names its file and load time."""
    from datetime import date

    path, _ = landed_feed(spark, sf_dir)
    root = path.rsplit("/", 1)[0]
    rows = staging.with_lineage(
        tables.scan_raw(spark, path), date(2024, 1, 31), F.current_timestamp(), root
    )
    return rows.groupBy("batch_date").agg(
        F.bool_and(F.col("raw_object_key").rlike("^landing-[0-9a-f]+/part-[0-9]{5}")).alias("keyed"),
        F.bool_and(F.col("loaded_at").isNotNull()).alias("loaded"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(
    "batch_publish",
    f"""WITH {STAGED_SQL}
    SELECT 'first' AS state, count(*) FILTER (WHERE last_modified_t IS NOT NULL) AS rows,
           CAST(0 AS BIGINT) AS late FROM staged
    UNION ALL
    SELECT 'after failed gate', count(*) FILTER (WHERE last_modified_t IS NOT NULL), 0 FROM staged
    UNION ALL
    SELECT 'second', count(*), count(*) FILTER (WHERE last_modified_t IS NULL) FROM staged""",
)
def batch_publish(spark, sf_dir):
    """A published batch, a batch whose gate fails and stays invisible, and a third one
    added to the first.
    """
    from tidemark.errors import GateError

    store = TableStore(spark, scratch_path(spark, "publish"))
    rows = staged_objects(spark, sf_dir)
    timed = F.col("last_modified_t").isNotNull()
    base = store.publish(store.bootstrap(), {"staging": {"timed": [store.write("staging", rows.filter(timed))]}})
    states = [("first", base)]
    try:
        hidden = store.write("staging", rows.withColumn("code", F.lit(None).cast("string")))
        quality.enforce_table(store.open("staging", [hidden]), "staging", (), ("code",))
        store.publish(base, {"staging": {"timed": [hidden]}})
    except GateError:
        states.append(("after failed gate", store.snapshot()))
    added = store.write("staging", rows.filter(~timed))
    states.append(("second", store.publish(states[-1][1], {"staging": {"untimed": [added]}})))
    counted = [
        store.read("staging", snapshot=snapshot).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("last_modified_t").isNull()).alias("late")
        ).withColumn("state", F.lit(state))
        for state, snapshot in states
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query(
    "dq_metric_upsert",
    f"""WITH {STAGED_SQL},
    counts AS (SELECT batch_date, count(*) AS n FROM staged GROUP BY 1)
    SELECT 'feed' AS source_name, 'staging' AS pipeline_layer, batch_date, 'row_count' AS metric_name,
           CASE WHEN day(batch_date) % 3 = 0 THEN n + 1 ELSE n END AS metric_value,
           CASE WHEN day(batch_date) % 3 = 0 THEN false ELSE true END AS passed,
           n AS expected_value
    FROM counts WHERE day(batch_date) % 3 = 0 OR day(batch_date) % 2 = 1""",
)
def dq_metric_upsert(spark, sf_dir):
    """Stored metrics of odd days; those of every third day are added or replaced."""
    counts = staged(spark, sf_dir).groupBy("batch_date").agg(F.count(F.lit(1)).alias("n"))
    day = F.dayofmonth("batch_date")
    stored = quality.metric_rows(
        counts.filter(day % 2 == 1).withColumn("row_count", F.col("n")), "feed", "staging", {"row_count": F.col("n")}
    )
    fresh = quality.metric_rows(
        counts.filter(day % 3 == 0).withColumn("row_count", F.col("n") + 1), "feed", "staging", {"row_count": F.col("n")}
    )
    return quality.upsert_metrics(stored, fresh)


@query(
    "run_ids",
    f"""SELECT DISTINCT event_type AS source, CAST(ts AS DATE) AS logical_date,
               {run_id_sql('event_type', 'CAST(ts AS DATE)')} AS run_id FROM events""",
)
def run_ids(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.to_date("ts").alias("logical_date")
    )
    return control.with_run_id(days.distinct())


@query("attempt_ids", "SELECT count(*) AS attempts, count(*) AS distinct_ids, true AS well_formed FROM events")
def attempt_ids(spark, sf_dir):
    """A random id per event: all different, 32 hex digits."""
    from tidemark.operators.ranking import materialise

    ids = table(spark, sf_dir, "events").select(identity.attempt_id().alias("attempt_id"))
    return materialise(ids, "attempt-ids").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.countDistinct("attempt_id").alias("distinct_ids"),
        F.bool_and(F.col("attempt_id").rlike("^[0-9a-f]{32}$")).alias("well_formed"),
    )

