"""Small control files through Hadoop's file system API.

Works for every file system Spark can read. Only markers and pointers go this way;
data is written by Spark jobs.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


# Schemes whose create call is one conditional request.
CONDITIONAL_STORES = ("s3a", "gs", "abfs", "abfss")


def _path(spark: SparkSession, location: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, location: str) -> bool:
    path, fs = _path(spark, location)
    return fs.exists(path)


def delete(spark: SparkSession, folder: str) -> None:
    """Remove a folder of intermediate data; a missing one is fine."""
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder of a failed or finished job its final name, which must be free."""
    path, fs = _path(spark, source)
    final, _ = _path(spark, target)
    if not fs.rename(path, final):
        raise OSError(f"{source} could not be moved to {target}")


def modified(spark: SparkSession, location: str) -> int:
    """When a file or folder was last changed, in milliseconds."""
    path, fs = _path(spark, location)
    return fs.getFileStatus(path).getModificationTime()


def names(spark: SparkSession, folder: str) -> list[str]:
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def create_json(spark: SparkSession, location: str, payload: dict[str, Any]) -> bool:
    """Create the file, whole or not at all, unless it exists. False when it did.

    The bytes go to a hidden name first and get the visible one in a step that refuses
    to replace a file: a hard link on a local disk, else a rename that does not
    overwrite. Object stores show a file only when it is closed, under the condition
    given when it was opened, so there it is created under its own name. A crash
    leaves at most a hidden file, which no reader looks at.
    """
    path, fs = _path(spark, location)
    if fs.exists(path):
        return False
    content = bytearray(json.dumps(payload, sort_keys=True, separators=(",", ":")), "utf-8")
    scheme = fs.getUri().getScheme()
    if scheme in CONDITIONAL_STORES:
        try:
            _write(fs, path, content)
        except Py4JJavaError:
            if fs.exists(path):
                return False
            raise
        return True
    hidden, _ = _path(spark, f"{location.rpartition('/')[0]}/_new-{uuid.uuid4().hex}")
    try:
        _write(fs, hidden, content)
        return _publish(spark, fs, hidden, path)
    finally:
        fs.delete(hidden, False)


def _write(fs, path, content: bytearray) -> None:
    out = fs.create(path, False)
    try:
        out.write(content)
        out.hflush()
    finally:
        out.close()


def _publish(spark: SparkSession, fs, hidden, path) -> bool:
    """Give a complete file its visible name unless that name is taken."""
    context = spark.sparkContext
    jvm = context._jvm
    try:
        if fs.getUri().getScheme() == "file":
            places = [jvm.java.nio.file.Paths.get(fs.resolvePath(p.getParent()).toUri()).resolve(p.getName()) for p in (path, hidden)]
            jvm.java.nio.file.Files.createLink(*places)
        else:
            options = context._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            conf = context._jsc.hadoopConfiguration()
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(hidden, path, options)
    except Py4JJavaError:
        if fs.exists(path):
            return False
        raise
    return True


def read_json(spark: SparkSession, location: str) -> dict[str, Any]:
    path, fs = _path(spark, location)
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    payload = json.loads(text)
    if not isinstance(payload, dict):
        raise ValueError(f"{location} does not hold a JSON object")
    return payload
