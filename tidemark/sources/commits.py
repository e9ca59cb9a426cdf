"""Markers and manifests of landed runs, and the data of committed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identity import MANIFEST_NAME, MARKER_NAME
from tidemark.schema import MANIFEST, MARKER, empty

_MANIFEST_DOCUMENT = T.StructType([*MANIFEST.fields, T.StructField("document", T.IntegerType())])


def _documents(spark: SparkSession, location: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON control documents; one that does not parse as this schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(location)


def scan_markers(spark: SparkSession, root: str, source: str, name: str = MARKER_NAME) -> DataFrame:
    """Commit records of all runs of a source."""
    return _documents(spark, f"{root}/{source}/extract_date=*/run_id=*/{name}", MARKER)


def scan_all_markers(spark: SparkSession, root: str, name: str = MARKER_NAME) -> DataFrame:
    """Commit records of all sources, with ``file`` (below the root) and ``damaged``.

    A document that does not parse, or has no source, run or next watermark, is damaged.
    A root without markers gives an empty table.
    """
    location = f"{root}/*/extract_date=*/run_id=*/{name}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    if not len(found or []):
        return empty(spark, T.StructType([*MARKER.fields, T.StructField("file", T.StringType()), T.StructField("damaged", T.BooleanType())]))
    schema = T.StructType([*MARKER.fields, T.StructField("_text", T.StringType())])
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_text").option("multiLine", "true").json(location)
    needed = F.col("source").isNull() | F.col("run_id").isNull() | F.col("next_watermark").isNull()
    return rows.select(
        *MARKER.fieldNames(),
        F.substring_index(F.col("_metadata.file_path"), root.rstrip("/") + "/", -1).alias("file"),
        (F.col("_text").isNotNull() | needed).alias("damaged"),
    )


def scan_manifests(spark: SparkSession, root: str, source: str) -> DataFrame:
    """Manifest documents of all attempts of a source, won or lost."""
    return _documents(
        spark, f"{root}/{source}/extract_date=*/run_id=*/attempt_id=*/{MANIFEST_NAME}", _MANIFEST_DOCUMENT
    )


def read_manifest(spark: SparkSession, root: str, *manifest_keys: str) -> DataFrame:
    """Documents of one manifest or of several."""
    return _documents(spark, [f"{root}/{key}" for key in manifest_keys], _MANIFEST_DOCUMENT)
