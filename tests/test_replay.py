"""A past date replayed: later events change nothing, and the reports equal the oracle on the book as it stood."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from loanlens import oracle
from loanlens.functions.windows import WHOLE_BOOK
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
)
from loanlens.sources.book import LoanBook
from loanlens.sources.replay import EVENTS, PAID_PARTS, book_as_of
from loanlens.sources.schemas import BOOK_SCHEMAS
from tests.test_random_book import LOAD, check, random_rows, stored  # noqa: F401

DAY = date(2018, 7, 1)


def test_reports_on_the_book_as_it_stood(stored):  # noqa: F811
    book, con = stored
    then = book_as_of(book, DAY)
    whole = loan_cohort_v2(then, DAY, window=WHOLE_BOOK, load_dttm=LOAD)
    with oracle.over_book_tables(), oracle.as_it_stood(DAY):
        cases = {
            "cohort_v1": (loan_cohort_v1(then, DAY), oracle.cohort_v1_sql(DAY)),
            "whole": (whole, oracle.cohort_v2_sql(DAY, LOAD, whole_book=True)),
            "accepted": (accepted_applications(loan_cohort_v2(then, DAY, load_dttm=LOAD), then.loan_payment, DAY), oracle.accepted_sql(DAY, LOAD)),
            "direct": (all_applications_direct(then, DAY), oracle.applications_direct_sql(DAY)),
            "facility": (all_applications_facility(then, DAY), oracle.applications_facility_sql(DAY)),
            "audit": (all_applications_audit(then, DAY), oracle.applications_audit_sql(DAY)),
            "level_b": (monthly_payments(whole, then.loan_payment, DAY), oracle.payments_level_sql(DAY, LOAD, "B")),
            "by_loan": (monthly_payments_by_loan(whole, then.loan_payment, DAY), oracle.payments_by_loan_sql(DAY, LOAD)),
            "for_loans": (monthly_payments_for_loans(then, DAY), oracle.payments_for_loans_sql(DAY)),
        }
        rows = {name: check(con, name, df, sql) for name, (df, sql) in cases.items()}
    assert all(rows.values()), rows


def happened_later(rows: dict[str, list[tuple]], seed: int) -> dict[str, list[tuple]]:
    """The same book with further events after ``DAY``: deletions, payments, cancellations, new rows."""
    rng = random.Random(seed)
    out = {}
    for name, table in rows.items():
        fields = BOOK_SCHEMAS[name].fieldNames()
        out[name] = []
        for row in table:
            r = dict(zip(fields, row, strict=True))
            for c in EVENTS.get(name, []):
                if r[c] is None and rng.random() < 0.5:
                    r[c] = datetime(2018, 7, 2) + timedelta(hours=rng.randrange(2000))
            if name == "loan_payment" and r["paid_at_date"] is None and rng.random() < 0.6:
                r["paid_at_date"] = DAY + timedelta(days=rng.randrange(1, 90))
                r |= {c: Decimal(7) if r[c] is not None else None for c in PAID_PARTS}
            out[name].append(tuple(r.values()))
        if "created_at" in fields and name in EVENTS:
            for row in rng.sample(table, 10):
                r = dict(zip(fields, row, strict=True))
                out[name].append(tuple((r | {"created_at": datetime(2018, 7, 2, 3)}).values()))
    return out


def test_later_events_change_nothing(spark):
    # an unpaid payment has paid nothing, and nothing lies after the day
    rows = random_rows(5, 40)
    known = BOOK_SCHEMAS["loan_payment"].fieldNames()
    unpaid = lambda r: {c: Decimal(0) if r["paid_at_date"] is None and r[c] is not None else r[c] for c in PAID_PARTS}
    rows["loan_payment"] = [tuple((r | unpaid(r)).values()) for r in (dict(zip(known, x, strict=True)) for x in rows["loan_payment"])]
    make = lambda rows: LoanBook(**{n: spark.createDataFrame(r, BOOK_SCHEMAS[n]) for n, r in rows.items()})
    now = make(rows)
    base = {n: [tuple(r) for r in df.collect()] for n, df in book_as_of(now, DAY).tables().items()}
    results = []
    for book in (make(base), make(happened_later(base, 1)), make(happened_later(base, 2))):
        then = book_as_of(book, DAY)
        whole = loan_cohort_v2(then, DAY, window=WHOLE_BOOK, load_dttm=LOAD)
        results.append([sorted(map(repr, df.collect())) for df in (
            whole, all_applications_facility(then, DAY), monthly_payments_by_loan(whole, then.loan_payment, DAY),
            monthly_payments_for_loans(then, DAY))])
    assert results[0] == results[1] == results[2]
    assert all(results[0])
    later = make(happened_later(base, 1))  # and without the replay they would
    assert sorted(map(repr, monthly_payments_for_loans(later, DAY).collect())) != results[0][3]


def test_paid_history_is_still_not_opened(stored):  # noqa: F811
    from tests.test_plans import plan_text

    text = plan_text(monthly_payments_for_loans(book_as_of(stored[0], DAY), DAY))
    assert "paid_month" in text and ">= 2018-0" in text
