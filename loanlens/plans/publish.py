"""Persist the monthly cohort (the one table shared between reports).

A month of the cohort is a version in a folder of its own (``plans.versions``): a publish writes the new version whole
and then switches the month's record, and the table's partition, to it.  Running readers keep the
old version's files, new readers get the new one, a publish that fails leaves the old one in
place, and other months are untouched (the source system truncated and re-inserted).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.plans.stored import Stored
from loanlens.plans.versions import (
    current_months,
    current_version,
    expire,
    forget_month,
    publish_version,
    read_version,
)
from loanlens.sources.schemas import COHORT


def _conform(cohort: DataFrame) -> DataFrame:
    cols = set(cohort.columns)
    return cohort.select(
        *[
            (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in COHORT
        ]
    )


def _root(spark: SparkSession, table: str) -> str:
    """The folder of a cohort table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return described["data_type"].rstrip("/")


def _register(spark: SparkSession, table: str, root: str, month: str) -> None:
    version = current_version(spark, root, month)
    if version is None:
        return
    spec = f"PARTITION (reporting_month = '{month}')"
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{version.path}'")
    spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{version.path}'")


def publish_cohort(cohort: DataFrame, table: str, reporting_month: str, path: str | None = None) -> None:
    """Replace ``reporting_month`` of cohort table ``table`` with ``cohort`` (by column name).

    The table is created on first publish (external at ``path`` if given, with the months that are published there).
    """
    spark = cohort.sparkSession
    fresh = not spark.catalog.tableExists(table)
    if fresh:
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COHORT)
        at = f"LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE {table} ({cols}, reporting_month string) USING parquet PARTITIONED BY (reporting_month) {at}")
    root = _root(spark, table)
    publish_version(_conform(cohort), root, reporting_month)
    for month in current_months(spark, root) if fresh else [reporting_month]:
        _register(spark, table, root, month)
    spark.catalog.refreshTable(table)


def stored_cohort(spark: SparkSession, table: str, reporting_month: str) -> Stored:
    """The published cohort of one month, counted when it was published."""
    return read_version(spark, current_version(spark, _root(spark, table), reporting_month), COHORT)


def read_cohort(spark: SparkSession, table: str, reporting_month: str) -> DataFrame:
    """The published cohort of one month (the version that is current now)."""
    return stored_cohort(spark, table, reporting_month).table


def drop_cohort_month(spark: SparkSession, table: str, reporting_month: str) -> None:
    forget_month(spark, _root(spark, table), reporting_month)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (reporting_month = '{reporting_month}')")


def expire_cohort(spark: SparkSession, table: str, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Delete replaced versions that were written ``older_than`` ago; no reader may run that long."""
    return expire(spark, _root(spark, table), older_than)


def drop_cohort(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
