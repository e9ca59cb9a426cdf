"""Feeds derived from the shared tables, as DataFrames and as SQL.

``feed`` reads events as updates of products, ``staged`` lists every update under each
daily batch whose window (one day and six hours of lookback) holds it, ``shipments``
reads line items as a wider feed with monthly batches. Some event times are left out
on purpose, so that the rules for missing times apply.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import epoch_seconds
from tidemark.operators.control import with_run_id
from tidemark.operators.ranking import materialise
from tidemark.operators.windows import daily_batches
from tidemark.spec import FeedSpec

LOOKBACK = timedelta(hours=6)
LOOKBACK_SECONDS = int(LOOKBACK.total_seconds())

FEED = FeedSpec(tie_break=("event_id",))
SHIPMENTS = FeedSpec(
    key="part_id",
    event_time="shipped_t",
    attributes=("supplier_id", "quantity", "price"),
    tie_break=("order_id", "line", "supplier_id", "quantity", "price"),
)
WINDOW = (datetime(2024, 1, 15, tzinfo=UTC), datetime(2024, 1, 16, tzinfo=UTC))


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A shared table; its schema is looked up in the file once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    untimed = (event % 97 == 0) | (F.col("user_id") % 50 == 0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.col("user_id").cast("string").alias("code"),
        F.col("event_type").alias("product_name"),
        F.col("props").alias("brands"),
        F.when(event % 7 != 0, F.substr(F.lit("abcde"), (event % 5 + 1).cast("int"), F.lit(1))).alias(
            "nutrition_grades"
        ),
        F.array("event_type").alias("categories_tags_en"),
        F.when(~untimed, epoch_seconds("ts")).alias("last_modified_t"),
    )


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed(spark, sf_dir).withColumn(
        "batch_date", F.explode(daily_batches(epoch_seconds("ts"), LOOKBACK_SECONDS))
    )


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part_id"),
        epoch_seconds("l_shipdate").alias("shipped_t"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.add_months(F.trunc("l_shipdate", "month"), 1).alias("batch_date"),
    )


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed objects: one per event type, day and quarter of the day.

    Events are counted once; everything else about runs comes from the written result.
    """
    counted = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias("source"),
            F.date_add(F.to_date("ts"), 1).alias("logical_date"),
            F.floor(F.hour("ts") / 6).alias("part_number"),
        )
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.length("props")).alias("size_bytes"),
        )
    )
    return materialise(with_run_id(counted), "objects")


def runs(landed: DataFrame) -> DataFrame:
    return (
        landed.groupBy("source", "logical_date", "run_id")
        .agg(F.count(F.lit(1)).alias("object_count"), F.sum("row_count").alias("row_count"))
    )


def attempts(landed: DataFrame) -> DataFrame:
    """Attempts of the runs: a second, faster one every third day, none every seventh.

    The first attempt declares one row too many every tenth day.
    """
    day = F.dayofmonth("logical_date")
    midnight = F.col("logical_date").cast("timestamp")
    first = F.struct(
        F.lit("a1").alias("attempt_id"),
        (midnight + F.expr("interval 10 minutes")).alias("committed_at"),
        (F.col("row_count") + F.when(day % 10 == 0, 1).otherwise(0)).alias("declared"),
    )
    second = F.struct(
        F.lit("a2").alias("attempt_id"),
        (midnight + F.expr("interval 5 minutes")).alias("committed_at"),
        F.col("row_count").alias("declared"),
    )
    tries = F.when(day % 3 == 0, F.array(first, second)).otherwise(F.array(first))
    return (
        runs(landed)
        .filter(day % 7 != 0)
        .withColumn("_try", F.explode(tries))
        .select("source", "logical_date", "run_id", "object_count", "row_count", "_try.*")
    )


# --- the same in SQL ---------------------------------------------------------------

FEED_SQL = """
feed AS (
  SELECT event_id, ts, CAST(floor(epoch(ts)) AS BIGINT) AS e,
         CAST(user_id AS VARCHAR) AS code, event_type AS product_name, props AS brands,
         CASE WHEN event_id % 7 <> 0 THEN substr('abcde', CAST(event_id % 5 + 1 AS BIGINT), 1) END
           AS nutrition_grades,
         [event_type] AS categories_tags_en,
         CASE WHEN event_id % 97 <> 0 AND user_id % 50 <> 0
              THEN CAST(floor(epoch(ts)) AS BIGINT) END AS last_modified_t
  FROM events)"""

STAGED_SQL = FEED_SQL + """,
staged AS (
  SELECT * EXCLUDE (d), DATE '1970-01-01' + CAST(d AS INTEGER) AS batch_date
  FROM (SELECT *, unnest(range(e // 86400 + 1, (e + 21600) // 86400 + 2)) AS d FROM feed))"""

SHIPMENTS_SQL = """
shipments AS (
  SELECT l_partkey AS part_id, CAST(floor(epoch(l_shipdate)) AS BIGINT) AS shipped_t,
         l_suppkey AS supplier_id, l_quantity AS quantity, l_extendedprice AS price,
         l_orderkey AS order_id, l_linenumber AS line,
         CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS batch_date
  FROM lineitem)"""


def run_id_sql(source: str, logical_date: str) -> str:
    digest = (
        "sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || "
        f"encode('tidemark:' || {source} || ':' || CAST({logical_date} AS VARCHAR)))"
    )
    return (
        f"(substr({digest}, 1, 12) || '5' || substr({digest}, 14, 3) || "
        f"translate(substr({digest}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
        f"substr({digest}, 18, 15))"
    )


CONTROL_SQL = f"""
objects AS (
  SELECT source, logical_date, part_number, row_count, size_bytes,
         {run_id_sql('source', 'logical_date')} AS run_id
  FROM (SELECT event_type AS source, CAST(ts AS DATE) + 1 AS logical_date,
               CAST(hour(ts) // 6 AS BIGINT) AS part_number, count(*) AS row_count,
               CAST(sum(length(props)) AS BIGINT) AS size_bytes
        FROM events GROUP BY 1, 2, 3)),
runs AS (
  SELECT source, logical_date, run_id, count(*) AS object_count,
         CAST(sum(row_count) AS BIGINT) AS row_count
  FROM objects GROUP BY 1, 2, 3),
attempts AS (
  SELECT source, logical_date, run_id, object_count, row_count, 'a1' AS attempt_id,
         CAST(epoch(logical_date) AS BIGINT) + 600 AS committed_t,
         row_count + CASE WHEN day(logical_date) % 10 = 0 THEN 1 ELSE 0 END AS declared
  FROM runs WHERE day(logical_date) % 7 <> 0
  UNION ALL
  SELECT source, logical_date, run_id, object_count, row_count, 'a2',
         CAST(epoch(logical_date) AS BIGINT) + 300, row_count
  FROM runs WHERE day(logical_date) % 7 <> 0 AND day(logical_date) % 3 = 0),
winners AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY committed_t, attempt_id) AS n
    FROM attempts) WHERE n = 1)"""
