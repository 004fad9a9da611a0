"""Reports against the oracle on random books: NULL keys, several scores, facilities and financial rows, hot keys.

The book is stored first, so that the folder filters are part of what is checked.
"""

from __future__ import annotations

import random
import uuid
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loanlens import oracle
from loanlens.functions.windows import WHOLE_BOOK, ReportingWindow
from loanlens.operators import (
    accepted_applications,
    all_applications_audit,
    all_applications_direct,
    all_applications_facility,
    loan_cohort_v1,
    loan_cohort_v2,
    monthly_payments,
    monthly_payments_by_loan,
    monthly_payments_for_loans,
    monthly_payments_payment_level,
    payment_branch_counts,
)
from loanlens.session import shared_dir
from loanlens.sources.book import LoanBook, read_book, write_book
from loanlens.sources.schemas import BOOK_SCHEMAS
from tests.compare import rows_key

LOAD = datetime(2018, 7, 1)


def random_rows(seed: int, loans: int = 70) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    day = lambda: datetime(2018, 5, 25) + timedelta(days=rng.randrange(60), hours=rng.randrange(24))
    maybe = lambda v, p=0.9: v if rng.random() < p else None
    money = lambda most=900: maybe(Decimal(rng.randrange(most * 100)) / 100)
    apps = [(i, maybe(rng.randrange(12)), maybe(day(), 0.95), money(), maybe(day(), 0.1)) for i in range(1, loans)]
    app = lambda: maybe(1 if rng.random() < 0.3 else rng.randrange(1, loans + 5), 0.95)  # noqa: E731  application 1 is hot
    scores, facilities = [], []
    for i in range(2 * loans):
        at = day()
        scores.append((1000 + i, app(), maybe(rng.choice([58, 59, 60, 61, 99])), maybe(at, 0.95)))
        for j in range(rng.choice([0, 1, 1, 2])):
            facilities.append((5000 + 10 * i + j, maybe(1000 + i, 0.95), maybe(at + timedelta(hours=rng.choice([0, 0, 1, 20])), 0.95)))
    bridge = [(maybe(rng.choice(facilities)[0], 0.95), maybe(rng.randrange(1, loans + 5), 0.95)) for _ in range(4 * loans)]
    rows = []
    for i in range(1, loans):
        rows.append((i, app(), app(), maybe(rng.randrange(1, loans), 0.4), maybe(rng.choice([751, 756, 752])), money(), money(50), money(90),
                     maybe(rng.randrange(0, 9)), maybe(day(), 0.8), maybe(day(), 0.85), maybe(day(), 0.08), maybe(day(), 0.1), maybe(day(), 0.1),
                     maybe(day(), 0.2), maybe(day(), 0.2), maybe(day(), 0.2)))
    payments = []
    for _ in range(25 * loans):
        due = date(2018, 5, 1) + timedelta(days=rng.randrange(100))
        payments.append((maybe(1 if rng.random() < 0.3 else rng.randrange(1, loans + 3), 0.97), rng.randrange(2), maybe(due, 0.95),
                         maybe(due + timedelta(days=rng.randrange(-20, 30)), 0.6), *(money(30) for _ in range(10)), maybe(day(), 0.05)))
    return {
        "loan_application": apps, "external_score": [(9000 + i, app()) for i in range(loans)], "credit_score": scores,
        "credit_score_config": [(58, 796), (59, 959), (60, 960), (61, 500)], "facility": facilities, "facility_has_loan": bridge,
        "loan_type": [(751, "Instalment"), (756, "Top up")], "loan": rows, "loan_payment": payments,
        "financial_information": [(maybe(rng.randrange(12)), money(), money(), maybe(day(), 0.1)) for _ in range(30)],
    }


@pytest.fixture(scope="module", params=[2])
def stored(spark, request):
    book = LoanBook(**{n: spark.createDataFrame(r, BOOK_SCHEMAS[n]) for n, r in random_rows(request.param).items()})
    root = f"{shared_dir(spark)}/random_{uuid.uuid4().hex[:8]}"
    write_book(book, root)
    con = duckdb.connect()
    for name, df in book.tables().items():
        con.register(f"{name}_arrow", df.toArrow())
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM {name}_arrow")
    return read_book(spark, root), con


def check(con, name, df, sql) -> int:
    df = entry.comparable(df)
    rel = con.sql(sql)
    got = rows_key(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_key(rel.columns, rel.fetchall()), name
    return len(got)


@pytest.mark.parametrize("as_of", [date(2018, 7, 1), date(2018, 7, 12)])
def test_reports(stored, as_of):
    book, con = stored
    whole = loan_cohort_v2(book, as_of, window=WHOLE_BOOK, load_dttm=LOAD)
    month = loan_cohort_v2(book, as_of, load_dttm=LOAD)
    pay, replay = book.loan_payment, (date(2018, 6, 3), date(2018, 6, 9))
    with oracle.over_book_tables():
        cases = {
            "cohort_v1": (loan_cohort_v1(book, as_of), oracle.cohort_v1_sql(as_of)),
            "cohort_v2": (month, oracle.cohort_v2_sql(as_of, LOAD)),
            "whole": (whole, oracle.cohort_v2_sql(as_of, LOAD, whole_book=True)),
            "accepted": (accepted_applications(month, pay, as_of), oracle.accepted_sql(as_of, LOAD)),
            "direct": (all_applications_direct(book, as_of), oracle.applications_direct_sql(as_of)),
            "facility": (all_applications_facility(book, as_of), oracle.applications_facility_sql(as_of)),
            "audit": (all_applications_audit(book, as_of), oracle.applications_audit_sql(as_of)),
            "replay": (all_applications_audit(book, as_of, ReportingWindow(*replay)), oracle.applications_audit_sql(as_of, oracle.typed(*replay))),
            "level_b": (monthly_payments(whole, pay, as_of), oracle.payments_level_sql(as_of, LOAD, "B")),
            "level_c": (monthly_payments_payment_level(whole, book, as_of), oracle.payments_level_sql(as_of, LOAD, "C")),
            "by_loan": (monthly_payments_by_loan(whole, pay, as_of), oracle.payments_by_loan_sql(as_of, LOAD)),
            "null_safe": (monthly_payments_by_loan(whole, pay, as_of, null_safe_least=True),
                          oracle.payments_by_loan_sql(as_of, LOAD, null_safe=True)),
            "for_loans": (monthly_payments_for_loans(book, as_of), oracle.payments_for_loans_sql(as_of)),
            "for_given": (monthly_payments_for_loans(book, as_of, loan_ids=range(1, 40)), oracle.payments_for_loans_sql(as_of, range(1, 40))),
            "branches": (payment_branch_counts(book, as_of), oracle.payment_branch_counts_sql(as_of)),
        }
        rows = {name: check(con, name, df, sql) for name, (df, sql) in cases.items()}
    assert all(rows.values()), rows
    assert rows["whole"] > rows["cohort_v2"]


def test_whole_book_takes_loans_without_a_date(stored):
    book, _ = stored
    undated = replace(book, loan=book.loan.withColumn("created_at", F.lit(None).cast("timestamp_ntz")))
    whole = loan_cohort_v2(undated, date(2018, 7, 1), window=WHOLE_BOOK, load_dttm=LOAD)
    assert whole.filter("created_at IS NULL").count() > 0
    assert loan_cohort_v2(undated, date(2018, 7, 1), load_dttm=LOAD).count() == 0


def ordered(rows, *keys):
    """The values of the stated sort keys, NULLs last in a descending order."""
    return [tuple((r[k] is not None, r[k]) for k in keys) for r in rows]


def test_stated_orders(stored):
    book, _ = stored
    as_of = date(2018, 7, 1)
    whole = loan_cohort_v2(book, as_of, window=WHOLE_BOOK, load_dttm=LOAD)
    for df in (monthly_payments(whole, book.loan_payment, as_of), monthly_payments_payment_level(whole, book, as_of),
               monthly_payments_for_loans(book, as_of)):
        rows = df.collect()
        keys = ordered(rows, "Application_ID", "Loan_Id")
        assert keys == sorted(keys, key=lambda k: tuple((known, v if known else 0) for known, v in k), reverse=True)
        assert len(set(keys)) > 5
    audit = all_applications_audit(book, as_of)
    got = [(r["id"], r["external_id"], r["final_decision"], r["rejection_reason"]) for r in audit.collect()]
    with oracle.over_book_tables():
        want = duckdb_rows(stored[1], oracle.applications_audit_sql(as_of))
    assert got == [(r["id"], r["external_id"], r["final_decision"], r["rejection_reason"]) for r in want]
    assert len(got) > 5


def duckdb_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    return [dict(zip(names, r, strict=True)) for r in rel.fetchall()]


def test_a_cluster_must_name_its_folder(spark):
    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError):
        shared_dir(Session())
    assert shared_dir(Session(), "hdfs://name/folder/") == "hdfs://name/folder"
    Context.master = "local[4]"
    assert shared_dir(Session()) == shared_dir(Session()) and Session.conf == {}
