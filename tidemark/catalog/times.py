"""Column functions on instants."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.feeds import FEED_SQL, feed, table
from tidemark.catalog.registry import query
from tidemark.functions import times


@query(
    "epoch_to_utc",
    f"""WITH {FEED_SQL} SELECT event_id, strftime(make_timestamp(last_modified_t * 1000000),
        '%Y-%m-%d %H:%M:%S') AS utc FROM feed""",
)
def epoch_to_utc(spark, sf_dir):
    return feed(spark, sf_dir).select(
        "event_id", F.date_format(times.instant("last_modified_t"), "yyyy-MM-dd HH:mm:ss").alias("utc")
    )


@query(
    "normalise_utc",
    """SELECT event_id,
         CASE event_id % 4 WHEN 0 THEN e WHEN 1 THEN e - 7200 WHEN 2 THEN NULL ELSE e + 19800 END AS text_t,
         event_id % 4 <> 2 AS has_zone, e - 7200 AS naive_t
       FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS e FROM events)""",
)
def normalise_utc(spark, sf_dir):
    """Texts with a zone become instants, texts without one are refused; a zone-less
    column is read in a named zone.
    """
    zone = F.col("event_id") % 4
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.concat(
        plain, F.when(zone == 0, "Z").when(zone == 1, "+02:00").when(zone == 2, "").otherwise("-0530")
    )
    rows = table(spark, sf_dir, "events").withColumn("text", text)
    return rows.select(
        "event_id",
        F.unix_timestamp(times.utc_from_text("text")).alias("text_t"),
        times.has_offset("text").alias("has_zone"),
        F.unix_timestamp(times.utc_from_zone("ts", "+02:00")).alias("naive_t"),
    )


@query(
    "batch_end",
    """SELECT event_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS batch_end_t,
              CAST(ts AS DATE) AS batch_date FROM events""",
)
def batch_end(spark, sf_dir):
    end = times.batch_end(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_timestamp(end).alias("batch_end_t"), times.batch_label(end).alias("batch_date")
    )


@query(
    "iso_roundtrip",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS precise,
              strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS whole, true AS same
       FROM events WHERE epoch_us(ts) % 1000000 <> 0
       UNION ALL
       SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'),
              strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00'), true
       FROM events WHERE epoch_us(ts) % 1000000 = 0""",
)
def iso_roundtrip(spark, sf_dir):
    precise = F.col("ts").cast("timestamp")
    text = times.iso_text(precise)
    return table(spark, sf_dir, "events").select(
        "event_id",
        text.alias("precise"),
        times.iso_text(F.date_trunc("second", precise)).alias("whole"),
        (times.utc_from_text(text) == precise).alias("same"),
    )
