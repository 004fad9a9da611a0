"""Small tables written once into the shared folder: key sets that a report restricts its large inputs by.

A key set that several joins use is computed once and read back with a known row count.  A
lost executor then never makes a report evaluate the key set's own joins again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loanlens.session import shared_dir

# A key set is broadcast only when its counted rows, at this many bytes each in memory
# (row header, two 8-byte keys, hash-table entry), stay below the limit.
BYTES_PER_KEY = 64
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class Stored:
    """A written table and its number of rows."""

    table: DataFrame
    rows: int

    @property
    def fits(self) -> bool:
        """Whether the counted rows may be broadcast as keys."""
        return self.rows * BYTES_PER_KEY <= MAX_BROADCAST_BYTES

    def keys(self, key: str | Column) -> DataFrame:
        """The non-NULL values of ``key`` as column ``__key``, hinted for broadcast where the count allows."""
        column = F.col(key) if isinstance(key, str) else key
        out = self.table.select(column.alias("__key")).filter(F.col("__key").isNotNull())
        return F.broadcast(out) if self.fits else out


# Where ``store`` writes instead of the session's own folder, while a job runs.
_JOB: ContextVar[str | None] = ContextVar("loanlens_job", default=None)


def _folder(spark: SparkSession) -> str:
    return _JOB.get() or f"{shared_dir(spark)}/loanlens-stored-{spark.sparkContext.applicationId}"


@contextmanager
def job_folder(spark: SparkSession, root: str | None = None) -> Iterator[None]:
    """What is stored inside goes to a folder of its own (below ``root``), which is deleted in the end."""
    token = _JOB.set(f"{shared_dir(spark, root)}/loanlens-stored-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_stored(spark)
        _JOB.reset(token)


def store(df: DataFrame) -> Stored:
    """Write ``df`` and count it in the same job."""
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return Stored(df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"])


def stored(df: DataFrame | Stored) -> Stored:
    """``df`` as it is if it is stored already, else written and counted."""
    return df if isinstance(df, Stored) else store(df)


def restrict(big: DataFrame, big_key: str | Column, keys: Stored, key: str | Column) -> DataFrame:
    """Rows of ``big`` whose ``big_key`` is among the stored keys (left semi join).

    Within the broadcast limit ``big`` is filtered where it is scanned, whatever the session's
    own threshold; beyond it, both sides are shuffled by the key.
    """
    column = F.col(big_key) if isinstance(big_key, str) else big_key
    return big.join(keys.keys(key), column == F.col("__key"), "left_semi")


def narrow(big: DataFrame, big_key: str | Column, keys: Stored, key: str | Column) -> DataFrame:
    """``restrict`` for an inner join by the same key that follows: beyond the broadcast limit ``big`` as it is.

    The join shuffles ``big`` by the key anyway and drops the same rows, so a semi join before it
    would only shuffle the keys once more.
    """
    return restrict(big, big_key, keys, key) if keys.fits else big


def drop_stored(spark: SparkSession, *further: str) -> None:
    """Delete what this session stored, and ``further`` folders (reports built from them cannot run afterwards)."""
    for folder in (_folder(spark), *further):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
