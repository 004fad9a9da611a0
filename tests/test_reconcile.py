"""Row differences between two versions of a report, on small tables and against the SQL."""

from __future__ import annotations

import os
import random
import uuid
from datetime import datetime

import duckdb
from pyspark.sql import functions as F

from loanlens import oracle
from loanlens.functions.windows import WHOLE_BOOK
from loanlens.operators import loan_cohort_v1, loan_cohort_v2, reconcile
from loanlens.operators.cohort import V1_COLUMNS
from loanlens.plans import stored
from loanlens.session import shared_dir
from loanlens.sources.book import BookInUse
from loanlens.sources.replay import book_as_of
from tests.fixture_book import fixture_book
from tests.test_plans import AS_OF, no_broadcast, operators_above_scan, plan_text  # noqa: F401

SCHEMA = "k long, g string, a long, b string"


def diff(spark, old, new, **more):
    x, y = (spark.createDataFrame(r, SCHEMA) for r in (old, new))
    return sorted((tuple(r) for r in reconcile(x, y, ["k", "g"], **more).collect()), key=repr)


def test_each_fate(spark):
    old = [(1, "x", 1, "p"), (2, "x", 1, "p"), (3, None, 1, None), (4, "x", 1, "p"), (5, "x", 1, "p"), (5, "x", 2, "p"), (6, "x", 1, "p"), (6, "x", 1, "p")]
    new = [(1, "x", 1, "p"), (3, None, None, None), (4, "x", 2, "q"), (5, "x", 1, "p"), (5, "x", 3, "p"), (5, "x", 4, "p"), (6, "x", 1, "p"), (7, None, 1, "p")]
    assert diff(spark, old, new) == sorted([
        (2, "x", "dropped", None, 1), (3, None, "changed", "a", 1), (4, "x", "changed", "a,b", 1),
        (5, "x", "dropped", None, 1), (5, "x", "added", None, 2), (6, "x", "dropped", None, 1), (7, None, "added", None, 1)], key=repr)
    assert diff(spark, old, new, columns=["b"]) == sorted([
        (2, "x", "dropped", None, 1), (4, "x", "changed", "b", 1), (5, "x", "added", None, 1),
        (6, "x", "dropped", None, 1), (7, None, "added", None, 1)], key=repr)


def test_equal_and_empty_versions(spark):
    rows = [(1, "x", None, "p"), (1, "x", None, "p"), (None, None, None, None)]
    assert diff(spark, rows, rows[::-1]) == []
    assert diff(spark, [], []) == []
    assert diff(spark, rows, []) == sorted([(1, "x", "dropped", None, 2), (None, None, "dropped", None, 1)], key=repr)


def test_random_versions_against_sql(spark):
    rng = random.Random(8)
    maybe = lambda v: v if rng.random() < 0.85 else None
    make = lambda n: [(0 if rng.random() < 0.3 else maybe(rng.randrange(60)), maybe(rng.choice("xy")), maybe(rng.randrange(3)),
                       maybe(rng.choice("pq"))) for _ in range(n)]
    old = make(300)
    new = [r for r in old if rng.random() < 0.7] + make(60)
    con = duckdb.connect()
    for name, rows in (("o", old), ("n", new)):
        con.execute(f"CREATE TABLE {name} (k BIGINT, g VARCHAR, a BIGINT, b VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?, ?)", rows)
    want = con.sql(oracle.reconcile_sql("SELECT * FROM o", "SELECT * FROM n", ["k", "g"], ["a", "b"])).fetchall()
    assert diff(spark, old, new) == sorted(want, key=repr)
    assert {r[2] for r in want} == {"added", "dropped", "changed"}


def test_versions_dealt_by_a_column_of_the_key(spark, no_broadcast):  # noqa: F811
    rng = random.Random(5)
    maybe = lambda v: v if rng.random() < 0.85 else None
    make = lambda n: [(0 if rng.random() < 0.5 else maybe(rng.randrange(40)), maybe(rng.choice("xy")), maybe(rng.randrange(3)),
                       maybe(rng.choice("pq"))) for _ in range(n)]
    old, new = make(300), make(300)
    assert diff(spark, old, new, by="k") == diff(spark, old, new)
    joined = spark.createDataFrame(old, SCHEMA).join(spark.range(40).withColumnRenamed("id", "k"), "k")
    got = reconcile(joined, spark.createDataFrame(new, SCHEMA), ["k", "g"], by="k")
    tree = plan_text(got).split("\n(1) ")[0]
    assert "Exchange" not in tree.split("Union")[0]  # the tree starts at its root
    assert tree.count("Exchange") == 3
    old = [r for r in old if r[0] is not None]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == diff(spark, old, new)


def _cohorts(book):
    load = datetime(2018, 7, 1)
    return loan_cohort_v1(book, AS_OF, window=WHOLE_BOOK), loan_cohort_v2(book, AS_OF, window=WHOLE_BOOK, load_dttm=load)


def _books(spark):
    """A hand-made book, and one with repeated rows, null keys and an application with very many scores."""
    book = fixture_book(spark)
    yield book
    nothing = lambda df, name: df.limit(3).withColumn(name, F.lit(None).cast(df.schema[name].dataType))
    more = {
        "external_score": spark.range(20000, 20400).select("id", F.lit(100).cast("long").alias("loan_application_id")),
        "loan": nothing(book.loan, "id").unionByName(nothing(book.loan, "loan_application_id"))
        .unionByName(nothing(book.loan.filter("origin_loan_id IS NOT NULL"), "id")),
        "facility": nothing(book.facility, "id"), "credit_score": nothing(book.credit_score, "loan_application_id"),
    }
    tables = {n: df.unionByName(df) if n in ("loan", "facility", "facility_has_loan", "loan_application") else df for n, df in book.tables().items()}
    tables |= {n: tables[n].unionByName(df.select(tables[n].columns)) for n, df in more.items()}
    yield type(book)(**tables)


def test_cohorts_beyond_the_broadcast_limit(spark, monkeypatch, no_broadcast):  # noqa: F811
    for book in _books(spark):
        within = [sorted(map(repr, df.collect())) for df in _cohorts(book)]
        with monkeypatch.context() as m:
            m.setattr(stored, "MAX_BROADCAST_BYTES", 0)
            for threshold in ("1k", "256MB"):  # with and without splitting of large partitions
                spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", threshold)
                try:
                    beyond = [sorted(map(repr, df.collect())) for df in _cohorts(book)]
                finally:
                    spark.conf.unset("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
                assert beyond == within
        assert all(within)


def test_large_cohorts_shuffle_no_whole_rows_for_their_distinct(spark, monkeypatch, no_broadcast):  # noqa: F811
    root = f"{shared_dir(spark)}/large_{uuid.uuid4().hex[:8]}"
    book = BookInUse.of(fixture_book(spark), root)
    object.__setattr__(book, "loan_type", F.broadcast(book.loan_type))
    monkeypatch.setattr(stored, "MAX_BROADCAST_BYTES", 0)
    for cohort in _cohorts(book):
        text = plan_text(cohort)
        assert "Exchange" not in text.split("\n(1) ")[0].split("Union")[0]
    # one join by loan and one by application: external scores are shuffled once for each use, no key sets beside them
    text = plan_text(_cohorts(book)[0])
    assert all("Exchange" in above for above in operators_above_scan(text, "external_score"))
    assert text.split("\n(1) ")[0].count("LeftSemi") == 1


def test_tables_that_no_report_asks_for_are_not_written(spark):
    root = f"{shared_dir(spark)}/use_{uuid.uuid4().hex[:8]}"
    source = fixture_book(spark)
    book = BookInUse.of(source, root)
    folder = root.removeprefix("file:")
    assert not os.path.exists(folder)
    v1, v2 = _cohorts(book)
    columns = [c for c in V1_COLUMNS if c not in ("loan_id", "external_id", "original_application_id")]
    keys = ["loan_id", "external_id", "original_application_id"]
    got = reconcile(v1, v2, keys, columns, by="loan_id")
    want = reconcile(*_cohorts(source), keys, columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []
    assert "loan" in os.listdir(folder) and not {"loan_payment", "financial_information"} & set(os.listdir(folder))
    assert book.loan is book.loan
    assert book_as_of(book, AS_OF).loan_payment.count() <= source.loan_payment.count() == book.loan_payment.count()
    assert set(os.listdir(folder)) == set(source.tables())
