"""Many as-of dates in one pass, against one run of the report for each."""

from __future__ import annotations

from datetime import date

from loanlens import oracle
from loanlens.functions.windows import WHOLE_BOOK
from loanlens.operators import loan_cohort_v2, payments_by_loan_backfill, payments_for_loans_backfill
from tests.test_plans import before_exchange, operators_above_scan, plan_text
from tests.test_random_book import LOAD, check, stored  # noqa: F401

DAYS = [date(2018, 5, 20), date(2018, 6, 1), date(2018, 6, 30), date(2018, 7, 1), date(2018, 7, 12), date(2018, 7, 31), date(2018, 9, 1)]


def test_backfill_equals_single_runs(stored):  # noqa: F811
    book, con = stored
    whole = loan_cohort_v2(book, DAYS[-1], window=WHOLE_BOOK, load_dttm=LOAD)
    with oracle.over_book_tables():
        cases = {
            "for_loans": (payments_for_loans_backfill(book, DAYS), oracle.every(DAYS, oracle.payments_for_loans_sql)),
            "for_given": (payments_for_loans_backfill(book, DAYS, loan_ids=range(1, 40)),
                          oracle.every(DAYS, lambda d: oracle.payments_for_loans_sql(d, range(1, 40)))),
            "by_loan": (payments_by_loan_backfill(whole, book.loan_payment, DAYS), oracle.every(DAYS, lambda d: oracle.payments_by_loan_sql(d, LOAD))),
            "null_safe": (payments_by_loan_backfill(whole, book.loan_payment, DAYS, null_safe_least=True),
                          oracle.every(DAYS, lambda d: oracle.payments_by_loan_sql(d, LOAD, null_safe=True))),
        }
        rows = {name: check(con, name, df, sql) for name, (df, sql) in cases.items()}
    assert all(n > len(DAYS) for n in rows.values()), rows


def test_payments_are_read_once_and_aggregated_before_their_exchange(stored):  # noqa: F811
    book, _ = stored
    text = plan_text(payments_for_loans_backfill(book, DAYS))
    scans = operators_above_scan(text, "loan_payment")
    assert len(scans) == 1
    assert "HashAggregate" in before_exchange(scans[0])
    assert "paid_month" in text and ">= 2018-04" in text


def test_payments_become_rows_of_their_dates_only_after_their_exchange(stored):  # noqa: F811
    """Before it a scan task holds one sum for payments with the same dates, not one for each date."""
    book, _ = stored
    whole = loan_cohort_v2(book, DAYS[-1], window=WHOLE_BOOK, load_dttm=LOAD)
    for df in (payments_for_loans_backfill(book, DAYS), payments_by_loan_backfill(whole, book.loan_payment, DAYS)):
        above = operators_above_scan(plan_text(df), "loan_payment")[0]
        assert "Generate" not in before_exchange(above) and "Generate" in above, above
        assert "HashAggregate" in before_exchange(above), above


def test_one_date_twice_is_one_date(stored):  # noqa: F811
    book, _ = stored
    once = sorted(map(repr, payments_for_loans_backfill(book, [DAYS[3]]).collect()))
    assert sorted(map(repr, payments_for_loans_backfill(book, [DAYS[3], DAYS[3]]).collect())) == once
