from datetime import datetime, timedelta
import uuid

import pytest
from pyspark.sql import functions as F

from loanlens.operators import loan_cohort_v2
from loanlens.plans.publish import (
    drop_cohort,
    drop_cohort_month,
    expire_cohort,
    publish_cohort,
    read_cohort,
    stored_cohort,
)
from loanlens.plans.versions import publish_version
from loanlens.session import shared_dir
from tests.fixture_book import fixture_book
from datetime import date


def test_publish_is_idempotent_and_month_scoped(spark):
    book = fixture_book(spark)
    cohort = loan_cohort_v2(book, date(2018, 7, 1), load_dttm=datetime(2018, 7, 1))
    table = f"cohort_{uuid.uuid4().hex[:8]}"
    path = f"{shared_dir(spark)}/{table}"
    publish_cohort(cohort, table, "2018-07-01", path=path)
    first = sorted(map(repr, read_cohort(spark, table, "2018-07-01").collect()))
    publish_cohort(cohort, table, "2018-06-01", path=path)
    publish_cohort(cohort, table, "2018-07-01", path=path)  # re-run: same month replaced, not appended
    assert sorted(map(repr, read_cohort(spark, table, "2018-07-01").collect())) == first
    assert read_cohort(spark, table, "2018-06-01").count() == len(first)
    # publishing a smaller cohort replaces the month; the other month is untouched
    publish_cohort(cohort.filter(F.col("loan_id") == 1), table, "2018-07-01", path=path)
    assert {r.loan_id for r in read_cohort(spark, table, "2018-07-01").collect()} == {1}
    assert read_cohort(spark, table, "2018-06-01").count() == len(first)
    drop_cohort_month(spark, table, "2018-06-01")
    assert read_cohort(spark, table, "2018-06-01").count() == 0
    drop_cohort(spark, table)
    assert not spark.catalog.tableExists(table)


def test_v1_cohort_publishes_without_load_stamp(spark):
    from loanlens.operators import loan_cohort_v1

    book = fixture_book(spark)
    table = f"cohort_{uuid.uuid4().hex[:8]}"
    publish_cohort(loan_cohort_v1(book, date(2018, 7, 1)), table, "2018-07-01",
                   path=f"{shared_dir(spark)}/{table}")
    rows = read_cohort(spark, table, "2018-07-01").collect()
    assert rows and all(r.load_dttm is None for r in rows)
    assert len(read_cohort(spark, table, "2018-07-01").columns) == 15
    drop_cohort(spark, table)


def test_publish_into_existing_location_from_another_session(spark):
    book = fixture_book(spark)
    cohort = loan_cohort_v2(book, date(2018, 7, 1), load_dttm=datetime(2018, 7, 1))
    table = f"cohort_{uuid.uuid4().hex[:8]}"
    path = f"{shared_dir(spark)}/{table}"
    publish_cohort(cohort, table, "2018-06-01", path=path)
    n = read_cohort(spark, table, "2018-06-01").count()
    drop_cohort(spark, table)  # external table: the catalog entry goes, the files stay
    publish_cohort(cohort, table, "2018-07-01", path=path)
    assert read_cohort(spark, table, "2018-06-01").count() == n
    assert read_cohort(spark, table, "2018-07-01").count() == n
    drop_cohort(spark, table)


def test_publish_keeps_other_months_under_static_overwrite_mode(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(key)
    spark.conf.set(key, "static")
    try:
        book = fixture_book(spark)
        cohort = loan_cohort_v2(book, date(2018, 7, 1), load_dttm=datetime(2018, 7, 1))
        table = f"cohort_{uuid.uuid4().hex[:8]}"
        path = f"{shared_dir(spark)}/{table}"
        publish_cohort(cohort, table, "2018-06-01", path=path)
        publish_cohort(cohort, table, "2018-07-01", path=path)
        publish_cohort(cohort, table, "2018-07-01", path=path)
        n = cohort.count()
        assert read_cohort(spark, table, "2018-06-01").count() == n
        assert read_cohort(spark, table, "2018-07-01").count() == n
        drop_cohort(spark, table)
    finally:
        spark.conf.set(key, old)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture
def published(spark):
    """Two versions of a cohort, of which the larger is published."""
    cohort = loan_cohort_v2(fixture_book(spark), date(2018, 7, 1), load_dttm=datetime(2018, 7, 1))
    table = f"cohort_{uuid.uuid4().hex[:8]}"
    path = f"{shared_dir(spark)}/{table}"
    publish_cohort(cohort, table, "2018-07-01", path=path)
    yield table, path, cohort, cohort.filter(F.col("loan_id") == 1)
    drop_cohort(spark, table)


def test_a_running_reader_keeps_its_version(spark, published):
    table, _, cohort, smaller = published
    by_name = spark.sql(f"SELECT * FROM {table} WHERE reporting_month = '2018-07-01'").drop("reporting_month")
    readers = [read_cohort(spark, table, "2018-07-01"), by_name]
    for r in readers:
        r._jdf.queryExecution().executedPlan()  # files are chosen
    old = _rows(cohort.select(*readers[0].columns))
    publish_cohort(smaller, table, "2018-07-01")
    assert all(_rows(r) == old for r in readers)
    assert {r.loan_id for r in read_cohort(spark, table, "2018-07-01").collect()} == {1}
    assert {r.loan_id for r in spark.table(table).collect()} == {1}


def test_a_publish_that_fails_leaves_the_month_whole(spark, published):
    table, path, cohort, smaller = published
    old = _rows(read_cohort(spark, table, "2018-07-01"))
    broken = smaller.unionByName(cohort.withColumn("loan_id", F.raise_error(F.lit("lost half-way")).cast("long")))
    with pytest.raises(Exception, match="lost half-way"):
        publish_cohort(broken, table, "2018-07-01")
    assert _rows(read_cohort(spark, table, "2018-07-01")) == old
    assert _rows(spark.table(table).drop("reporting_month")) == old
    # what the failed run left goes with the replaced versions, the current one stays
    publish_cohort(cohort, table, "2018-07-01")
    assert expire_cohort(spark, table) == []
    assert len(expire_cohort(spark, table, timedelta(0))) >= 1
    assert _rows(read_cohort(spark, table, "2018-07-01")) == old == _rows(spark.table(table).drop("reporting_month"))
    assert expire_cohort(spark, table, timedelta(0)) == []


def test_counts_and_months_of_a_published_cohort(spark, published):
    table, path, cohort, smaller = published
    publish_cohort(smaller, table, "2018-06-01")
    assert stored_cohort(spark, table, "2018-06-01").rows == smaller.count()
    assert stored_cohort(spark, table, "2018-07-01").rows == cohort.count()
    nothing = stored_cohort(spark, table, "2018-05-01")
    assert nothing.rows == 0 and nothing.table.count() == 0
    # another session that registered the table earlier sees a switch made elsewhere
    publish_version(read_cohort(spark, table, "2018-07-01").limit(1), path, "2018-06-01")
    assert stored_cohort(spark, table, "2018-06-01").rows == 1 == read_cohort(spark, table, "2018-06-01").count()
    drop_cohort_month(spark, table, "2018-06-01")
    assert read_cohort(spark, table, "2018-06-01").count() == 0


def test_a_table_without_a_path_is_the_catalogs_own(spark):
    cohort = loan_cohort_v2(fixture_book(spark), date(2018, 7, 1), load_dttm=datetime(2018, 7, 1))
    table = f"cohort_{uuid.uuid4().hex[:8]}"
    publish_cohort(cohort, table, "2018-07-01")
    publish_cohort(cohort, table, "2018-07-01")
    assert read_cohort(spark, table, "2018-07-01").count() == spark.table(table).count() == cohort.count()
    drop_cohort(spark, table)
