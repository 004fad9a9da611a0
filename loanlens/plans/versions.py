"""Months of a stored table as versions that are never changed, and one small record per month that names the current one.

    root/data/<month>/<version>/part-*.parquet    written whole before the switch
    root/current/<month>.json                     {"version": ..., "rows": ...}

A publish writes a new version and then replaces the record in one step (a rename over the old
record, which HDFS and local file systems do atomically).  Whoever read the record before keeps
reading the old version's files; whoever reads it afterwards gets the new one whole; a
publish that fails changes nothing.  Old versions go by ``expire``, once no reader can need them.
The record carries the version's row count, so a reader knows whether it may be broadcast.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loanlens.plans.stored import Stored


@dataclass(frozen=True)
class Version:
    month: str
    name: str
    rows: int
    path: str


def _paths(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(found), fs


def _data(root: str, month: str) -> str:
    return f"{root.rstrip('/')}/data/{month}"


def _record(root: str, month: str) -> str:
    return f"{root.rstrip('/')}/current/{month}.json"


def _switch(spark: SparkSession, path: str, record: dict) -> None:
    """Replace the record at ``path`` in one step."""
    jvm = spark.sparkContext._jvm
    target, fs = _paths(spark, path)
    fresh, _ = _paths(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(fresh, target, how)


def publish_version(df: DataFrame, root: str, month: str) -> Version:
    """Write ``df`` as the month's new version and make it the current one."""
    spark = df.sparkSession
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    path = f"{_data(root, month)}/{name}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    rows = seen.get["rows"]
    _switch(spark, _record(root, month), {"version": name, "rows": rows})
    return Version(month, name, rows, path)


def current_version(spark: SparkSession, root: str, month: str) -> Version | None:
    path, fs = _paths(spark, _record(root, month))
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        record = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Version(month, record["version"], record["rows"], f"{_data(root, month)}/{record['version']}")


def current_months(spark: SparkSession, root: str) -> list[str]:
    path, fs = _paths(spark, f"{root.rstrip('/')}/current")
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json"))


def read_version(spark: SparkSession, version: Version | None, schema: StructType) -> Stored:
    """The version's rows with their number; no version, no rows."""
    if version is None:
        return Stored(spark.createDataFrame([], schema), 0)
    return Stored(spark.read.schema(schema).parquet(version.path), version.rows)


def forget_month(spark: SparkSession, root: str, month: str) -> None:
    """The month is gone for new readers; its files stay until ``expire``."""
    path, fs = _paths(spark, _record(root, month))
    fs.delete(path, False)


def expire(spark: SparkSession, root: str, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Delete versions that are not current (half-written ones too) and were last written ``older_than`` ago; their paths."""
    top, fs = _paths(spark, f"{root.rstrip('/')}/data")
    gone = []
    if not fs.exists(top):
        return gone
    before = (time.time() - older_than.total_seconds()) * 1000
    for month in (s.getPath() for s in fs.listStatus(top)):
        for version in fs.listStatus(month):
            now = current_version(spark, root, month.getName())
            path = version.getPath()
            if version.getModificationTime() <= before and not (now and now.name == path.getName()):
                fs.delete(path, True)
                gone.append(path.toString())
    return gone
