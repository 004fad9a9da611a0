"""Monthly payment reports: due, paid and overdue payments per instalment and per loan.

* ``monthly_payments``: one row per (cohort loan, due date), window B by
  default; with ``applications``/``loan_types`` and window C it is the
  payment-level variant that also requires an application and a type;
* ``monthly_payments_by_loan``: per cohort loan, sums over the selected
  payments with the wider selection rule (window B);
* ``monthly_payments_for_loans``: per loan straight from the loan table
  (no cohort), window C, optionally for given loan ids;
* ``payment_branch_counts``: how the live payments of the whole book fall
  into the branches of the selection rule (a check of the rule itself).

Plan shape: the payment table is the only large input.  The payment-only
part of the selection rule is pushed into its scan, and what is left is
aggregated before it meets the loans.  That works because the loan's part of
the rule, the superseded test, needs only the loan and one date:

* payment level: every payment of a (loan, due date) has that date, so one
  payment per (loan, due date) is picked first and tested after the join;
* per loan: payments are summed per (loan, date to test), where the date is
  NULL for payments that need no test; the few sums of a loan are tested after the
  join and summed again.

Both aggregations are partial before the exchange on ``loan_id``, so a loan
with a large share of all payments is a few rows per task by then.

A report on a cohort, or on given loans, first restricts the payments to them where they are scanned: the cohort is
stored and counted (``stored_cohort`` reads a published one with its count), and its loan ids are broadcast
while they fit.  A cohort beyond that limit is most of a book; then the aggregation
comes first, and the join on ``loan_id`` may be cut by Spark's own runtime filter.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.functions.measures import loan_measures, payment_measures, summed_measures
from loanlens.functions.predicates import (
    AGGREGATED,
    LEVEL,
    current_only,
    least_strict,
    payment_in_scope,
    payment_prefilter,
    superseded_at,
)
from loanlens.functions.windows import (
    ReportingWindow,
    reporting_month,
    rolling_month,
    rolling_month_shifted,
)
from loanlens.operators.dedupe import one_row_per
from loanlens.plans.stored import Stored, restrict, store, stored
from loanlens.sources.book import LoanBook
from loanlens.sources.layout import paid_since_or_due_by

# Order that picks one payment when a loan has several with the same due date:
# earliest paid first (unpaid last), then the amounts, all ascending, NULLs last.
PAYMENT_PICK_ORDER = [
    "paid_at_date", "principal", "interest", "fees", "penalty", "discount", "balance_left",
    "principal_paid", "interest_paid", "fees_paid", "penalty_paid",
]

COHORT_KEYS = ["loan_id", "external_id", "application_id", "original_application_id", "loan_type"]

LEVEL_COLUMNS = [
    "Loan_Id", "External_ID", "Application_ID", "Original_Application_Id", "Reporting_Month",
    "Actual_Payment_Date", "Paid_At_Date", "Type_of_Loan", "Outstanding_Principal",
    "Due_payment", "Monthly_payment", "Principal_Paid", "Interest_Paid", "Late_Payment_Interest",
]
MEASURE_COLUMNS = LEVEL_COLUMNS[8:]


def _due():
    return F.col("actual_payment_date")


def _paid():
    return F.col("paid_at_date")


def _superseded() -> Column:
    return superseded_at(F.col("topped_up_at"), F.col("extended_at"), F.col("arranged_rp_at"))


def _report_order(*ties: str) -> list[Column]:
    """By application and loan, descending, as the reports state; ``ties`` spread a loan's rows over sort tasks."""
    return [F.col("Application_ID").desc(), F.col("Loan_Id").desc(), *(F.col(c) for c in ties)]


def _candidates(loan_payment: DataFrame, window: ReportingWindow, variant: str) -> DataFrame:
    """Live payments that pass the payment-only part of the selection rule (pushed to the scan)."""
    pay = current_only(paid_since_or_due_by(loan_payment, window.start, window.end))
    return pay.filter(payment_prefilter(_due(), _paid(), window, variant))


def of_cohort(payments: DataFrame, cohort: Stored) -> DataFrame:
    """Payments of the cohort's loans, as far as its keys can be broadcast."""
    return restrict(payments, "loan_id", cohort, "loan_id") if cohort.fits else payments


def month_payments(loan_payment: DataFrame, as_of: date) -> DataFrame:
    """Every payment that some payment report of the run may select: one scan for all of them, stored."""
    windows = [(rolling_month(as_of), AGGREGATED), (rolling_month(as_of), LEVEL), (rolling_month_shifted(as_of), LEVEL)]
    any_rule = reduce(or_, [payment_prefilter(_due(), _paid(), w, variant) for w, variant in windows])
    pay = current_only(paid_since_or_due_by(loan_payment, min(w.start for w, _ in windows), max(w.end for w, _ in windows)))
    return store(pay.filter(any_rule)).table


def not_superseded(day: Column) -> Column:
    """The loan's part of the rule: ``day`` (NULL: nothing to test) is not after the superseded date."""
    return day.isNull() | (day <= F.col("superseded"))


def tested_day(due: Column, paid: Column, variant: str, null_safe_least: bool = False) -> tuple[Column, Column]:
    """The day that a payment due in the window has tested, and whether such a payment can pass at all.

    A payment due outside the window was taken for its paid date or as overdue, and needs no test.
    """
    if variant == LEVEL:
        return due, F.lit(True)
    if null_safe_least:
        return F.least(due, paid), F.lit(True)
    return least_strict(due, paid), paid.isNotNull()  # an unpaid one never passes the strict test


def sums_by_date(pay: DataFrame, window: ReportingWindow, variant: str, null_safe_least: bool = False) -> DataFrame:
    """Sums of each loan's candidates ``pay`` by the date its superseded test needs (``test_date``, NULL: none)."""
    day, testable = tested_day(_due(), _paid(), variant, null_safe_least)
    in_due = window.contains(_due())
    return pay.filter(~in_due | testable).groupBy("loan_id", F.when(in_due, day).alias("test_date")).agg(*loan_measures())


def _tested_sums(sums: DataFrame, loans: DataFrame, *keys: str) -> DataFrame:
    """One row per loan from its sums by date; ``loans`` has loan_id, superseded and further ``keys``."""
    return (
        sums.join(loans, "loan_id").filter(not_superseded(F.col("test_date")))
        .groupBy("loan_id", *keys).agg(*summed_measures())
    )


def cohort_lines(cohort: DataFrame) -> DataFrame:
    """Each loan's cohort rows with its superseded date (which is the loan's own)."""
    return cohort.select(*COHORT_KEYS, _superseded().alias("superseded")).distinct()


def _report_keys(as_of: date) -> list:
    return [
        F.col("loan_id").alias("Loan_Id"),
        F.col("external_id").alias("External_ID"),
        F.col("application_id").alias("Application_ID"),
        F.col("original_application_id").alias("Original_Application_Id"),
        F.lit(reporting_month(as_of)).alias("Reporting_Month"),
    ]


def monthly_payments(
    cohort: DataFrame | Stored,
    loan_payment: DataFrame,
    as_of: date,
    window: ReportingWindow | None = None,
    applications: DataFrame | None = None,
    loan_types: DataFrame | None = None,
) -> DataFrame:
    """One row per cohort loan and due date, ordered by application and loan id, descending."""
    w = window or rolling_month(as_of)
    counted = stored(cohort)
    rows = counted.table
    if applications is not None:
        named = restrict(applications, "id", counted, "application_id") if counted.fits else applications
        rows = rows.join(named.select(F.col("id").alias("application_id")), "application_id", "left_semi")
    if loan_types is not None:
        rows = rows.join(
            loan_types.select(F.col("name").alias("loan_type")), "loan_type", "left_semi",
        )
    picked = one_row_per(
        of_cohort(_candidates(loan_payment, w, LEVEL), counted).select("loan_id", "actual_payment_date", *PAYMENT_PICK_ORDER),
        ["loan_id", "actual_payment_date"], PAYMENT_PICK_ORDER,
    )
    return (
        cohort_lines(rows)
        .join(picked, "loan_id")
        .filter(not_superseded(F.when(w.contains(_due()), _due())))
        .select(
            *_report_keys(as_of),
            F.col("actual_payment_date").alias("Actual_Payment_Date"),
            F.col("paid_at_date").alias("Paid_At_Date"),
            F.col("loan_type").alias("Type_of_Loan"),
            *payment_measures(),
        )
        .orderBy(*_report_order("Actual_Payment_Date", "External_ID", "Original_Application_Id", "Type_of_Loan"))
    )


def monthly_payments_payment_level(
    cohort: DataFrame | Stored, book: LoanBook, as_of: date, window: ReportingWindow | None = None
) -> DataFrame:
    """Payment-level report on window C; the cohort loan must have an application and a type."""
    return monthly_payments(
        cohort, book.loan_payment, as_of, window or rolling_month_shifted(as_of),
        applications=book.loan_application, loan_types=book.loan_type,
    )


def monthly_payments_by_loan(
    cohort: DataFrame | Stored,
    loan_payment: DataFrame,
    as_of: date,
    window: ReportingWindow | None = None,
    null_safe_least: bool = False,
) -> DataFrame:
    """Per cohort loan sums, window B, wider selection (see ``payment_in_scope``).

    ``null_safe_least=False`` keeps the source's rule in which an unpaid
    payment due in the window never passes the superseded test.
    """
    w = window or rolling_month(as_of)
    counted = stored(cohort)
    sums = _tested_sums(
        sums_by_date(of_cohort(_candidates(loan_payment, w, AGGREGATED), counted), w, AGGREGATED, null_safe_least),
        counted.table.select("loan_id", _superseded().alias("superseded")).distinct(),
    )
    return (
        cohort_lines(counted.table).drop("superseded").distinct()
        .join(sums, "loan_id")
        .select(*_report_keys(as_of), F.col("loan_type").alias("Type_of_Loan"), *MEASURE_COLUMNS)
    )


def given_loans(spark: SparkSession, loan_ids: Iterable[int] | DataFrame | Stored) -> Stored:
    """A list of loan ids of any length as a stored key set (column ``loan_id``); the plan does not grow with it."""
    if isinstance(loan_ids, (DataFrame, Stored)):
        return stored(loan_ids)
    ids = pa.table({"loan_id": pa.array(sorted({int(i) for i in loan_ids}), pa.int64())})
    return store(spark.createDataFrame(ids))


def loans_in_scope(book: LoanBook, wanted: Stored | None = None) -> DataFrame:
    """Loans with their report columns and superseded date whose original application exists and whose type is known."""
    loans = book.loan if wanted is None else restrict(book.loan, "id", wanted, "loan_id")
    types = book.loan_type.select(F.col("id").alias("loan_type_id"), F.col("name").alias("Type_of_Loan"))
    return (
        loans.join(
            book.loan_application.select(F.col("id").alias("original_loan_application_id")),
            "original_loan_application_id", "left_semi",
        )
        .join(types, "loan_type_id")
        .select(
            F.col("id").alias("loan_id"),
            F.col("original_loan_application_id").alias("Application_ID"),
            "Type_of_Loan", _superseded().alias("superseded"),
        )
    )


def monthly_payments_for_loans(
    book: LoanBook,
    as_of: date,
    window: ReportingWindow | None = None,
    loan_ids: Iterable[int] | DataFrame | Stored | None = None,
) -> DataFrame:
    """Per-loan sums for loans of the whole book (or ``loan_ids``, a list or a table with ``loan_id``), window C.

    A loan counts if its original application exists and its type is known.
    """
    w = window or rolling_month_shifted(as_of)
    wanted = None if loan_ids is None else given_loans(book.loan.sparkSession, loan_ids)
    pay = _candidates(book.loan_payment, w, LEVEL)
    sums = sums_by_date(pay if wanted is None else restrict(pay, "loan_id", wanted, "loan_id"), w, LEVEL)
    return (
        _tested_sums(sums, loans_in_scope(book, wanted), "Application_ID", "Type_of_Loan")
        .select(
            F.col("loan_id").alias("Loan_Id"), "Application_ID",
            F.lit(reporting_month(as_of)).alias("Reporting_Month"), "Type_of_Loan", *MEASURE_COLUMNS,
        )
        .orderBy(*_report_order())
    )


# Payment classes, tested in this order (first match wins).
PAYMENT_CLASSES = [
    "due_in_unpaid", "due_in_paid_in", "due_in_paid_after", "paid_in_due_after",
    "paid_in_due_before", "overdue_unpaid", "due_in_superseded", "due_in_paid_before", "other",
]


def payment_branch_counts(book: LoanBook, as_of: date, window: ReportingWindow | None = None) -> DataFrame:
    """Live payments of the whole book by payment class and by which selection
    rule keeps them (payment-level, per-loan strict, per-loan NULL-safe)."""
    w = window or rolling_month(as_of)
    s, e = F.lit(w.start), F.lit(w.end)
    due, paid, x = _due(), _paid(), F.col("superseded")
    loans = book.loan.select(
        F.col("id").alias("loan_id"),
        _superseded().alias("superseded"),
    )
    in_due, in_paid = w.contains(due), w.contains(paid)
    cls = (
        F.when(in_due & paid.isNull() & (due <= x), "due_in_unpaid")
        .when(in_due & in_paid & (due <= x), "due_in_paid_in")
        .when(in_due & (paid > e) & (due <= x), "due_in_paid_after")
        .when(in_paid & (due > e), "paid_in_due_after")
        .when(in_paid & (due < s), "paid_in_due_before")
        .when((due < s) & paid.isNull(), "overdue_unpaid")
        .when(in_due & (due > x), "due_in_superseded")
        .when(in_due & (paid < s), "due_in_paid_before")
        .otherwise("other")
    )

    def kept(c):
        return F.coalesce(c, F.lit(False))

    return (
        current_only(book.loan_payment)
        .join(loans, "loan_id")
        .select(
            cls.alias("payment_class"),
            kept(payment_in_scope(due, paid, w, x, LEVEL)).alias("kept_level"),
            kept(payment_in_scope(due, paid, w, x, AGGREGATED)).alias("kept_by_loan"),
            kept(payment_in_scope(due, paid, w, x, AGGREGATED, null_safe_least=True)).alias("kept_by_loan_null_safe"),
            kept(least_strict(due, paid) <= x).alias("earliest_not_superseded"),
        )
        .groupBy("payment_class", "kept_level", "kept_by_loan", "kept_by_loan_null_safe",
                 "earliest_not_superseded")
        .agg(F.count(F.lit(1)).alias("n_payments"))
    )
