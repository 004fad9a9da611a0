"""Intermediate tables in the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame

from loanlens.session import shared_dir


#: Spark's own setting: the shuffles of a statement are deleted when it ends.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The column that ``cut`` lays a table out by.
_BY: ContextVar[str | None] = ContextVar("loanlens_cut_by", default=None)


@contextmanager
def laid_out_by(column: str) -> Iterator[None]:
    """What is cut inside is written in buckets of ``column``, as many as a shuffle has partitions: later joins
    on the column bring the other side's rows to the buckets and do not shuffle the table again."""
    token = _BY.set(column)
    try:
        yield
    finally:
        _BY.reset(token)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor repeats the work since the last cut only.  The shuffles behind a written table
    are of no further use and are deleted with the end of the write.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        if _BY.get():
            return _bucketed(df, _BY.get(), path)
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def _bucketed(df: DataFrame, column: str, path: str) -> DataFrame:
    """``df`` written to ``path`` in buckets of ``column`` and read back.  Spark knows buckets of tables only: one stands
    for the files while they are written and looked up, and goes then; the files stay, like those of any cut."""
    spark = df.sparkSession
    name, buckets = f"loanlens_cut_{uuid.uuid4().hex}", spark.conf.get("spark.sql.shuffle.partitions")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        df.write.insertInto(name)
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")
