"""Per-loan payment reports for many as-of dates in one pass over the payments.

The windows of all dates are one literal array.  Each payment keeps the dates whose selection rule it passes:
those that take it whatever its loan (``free``) and those that test one day of it against the loan's superseded
date (``tested``, ``day``).  Payments of a loan with the same dates and day are summed, partially before the exchange,
so the payment table is read once however many dates are asked for, and a payment is one row until its loan
is known.  A payment that stays open is in every later date's report; only after the join does a sum become a row for
each of its dates, in ``parts`` partitions by loan, which the session's settings for merging small ones leave as they are.
The arrays' length is at most the number of dates asked for.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.measures import loan_measures, summed_measures
from loanlens.functions.predicates import AGGREGATED, LEVEL, current_only, payment_prefilter
from loanlens.functions.windows import ReportingWindow, reporting_month_column, reporting_window
from loanlens.operators.payments import (
    COHORT_KEYS,
    MEASURE_COLUMNS,
    cohort_lines,
    given_loans,
    loans_in_scope,
    not_superseded,
    of_cohort,
    tested_day,
)
from loanlens.plans.stored import Stored, restrict, stored
from loanlens.sources.book import LoanBook
from loanlens.sources.layout import paid_since_or_due_by


@dataclass(frozen=True)
class WindowColumns:
    """A window held by two columns of a row."""

    start: Column
    end: Column

    def contains(self, c: Column) -> Column:
        return c.between(self.start, self.end)


def _summed(loan_payment: DataFrame, windows: dict[date, ReportingWindow], variant: str, null_safe_least: bool = False) -> DataFrame:
    """Sums of each loan's live payments by the as-of dates that take them (``free``) or test their ``day`` (``tested``)."""
    listed = F.array(*[
        F.struct(F.lit(day).alias("as_of"), F.lit(w.start).alias("start"), F.lit(w.end).alias("end"))
        for day, w in sorted(windows.items())
    ])
    first, last = min(w.start for w in windows.values()), max(w.end for w in windows.values())
    due, paid = F.col("actual_payment_date"), F.col("paid_at_date")
    pay = current_only(paid_since_or_due_by(loan_payment, first, last))
    pay = pay.filter((due <= F.lit(last)) | paid.between(F.lit(first), F.lit(last)))  # reaches the scan

    def dates(rule) -> Column:
        held = F.filter(listed, lambda w: payment_prefilter(due, paid, WindowColumns(w["start"], w["end"]), variant) & rule(w))
        return F.transform(held, lambda w: w["as_of"])

    day, testable = tested_day(due, paid, variant, null_safe_least)
    pay = pay.withColumns({
        "free": dates(lambda w: ~due.between(w["start"], w["end"])),
        "tested": dates(lambda w: due.between(w["start"], w["end"]) & testable),
    }).filter((F.size("free") > 0) | (F.size("tested") > 0))
    return pay.groupBy("loan_id", "free", "tested", F.when(F.size("tested") > 0, day).alias("day")).agg(*loan_measures())


def _by_date(sums: DataFrame, loans: DataFrame, *keys: str) -> DataFrame:
    """One row per as-of date and loan; ``loans`` has loan_id, superseded and further ``keys``."""
    parts = 2 * int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.when(not_superseded(F.col("day")), F.concat("free", "tested")).otherwise(F.col("free"))
    dated = sums.repartition(parts, "loan_id").join(loans, "loan_id").withColumn("as_of", F.explode(at))
    return dated.groupBy("as_of", "loan_id", *keys).agg(*summed_measures())


def payments_for_loans_backfill(
    book: LoanBook, as_ofs: Iterable[date], kind: str = "C", loan_ids: Iterable[int] | DataFrame | Stored | None = None
) -> DataFrame:
    """``monthly_payments_for_loans`` at every date of ``as_ofs``, with a column ``as_of``."""
    windows = {day: reporting_window(day, kind) for day in as_ofs}
    wanted = None if loan_ids is None else given_loans(book.loan.sparkSession, loan_ids)
    payments = book.loan_payment if wanted is None else restrict(book.loan_payment, "loan_id", wanted, "loan_id")
    sums = _summed(payments, windows, LEVEL)
    return _by_date(sums, loans_in_scope(book, wanted), "Application_ID", "Type_of_Loan").select(
        "as_of", F.col("loan_id").alias("Loan_Id"), "Application_ID",
        reporting_month_column(F.col("as_of")).alias("Reporting_Month"), "Type_of_Loan", *MEASURE_COLUMNS,
    )


def payments_by_loan_backfill(
    cohort: DataFrame | Stored, loan_payment: DataFrame, as_ofs: Iterable[date], kind: str = "B", null_safe_least: bool = False
) -> DataFrame:
    """``monthly_payments_by_loan`` of one cohort at every date of ``as_ofs``, with a column ``as_of``."""
    windows = {day: reporting_window(day, kind) for day in as_ofs}
    counted = stored(cohort)
    lines = cohort_lines(counted.table)
    sums = _by_date(_summed(of_cohort(loan_payment, counted), windows, AGGREGATED, null_safe_least),
                    lines.select("loan_id", "superseded").distinct())
    return lines.select(*COHORT_KEYS).distinct().join(sums, "loan_id").select(
        "as_of", F.col("loan_id").alias("Loan_Id"), F.col("external_id").alias("External_ID"),
        F.col("application_id").alias("Application_ID"), F.col("original_application_id").alias("Original_Application_Id"),
        reporting_month_column(F.col("as_of")).alias("Reporting_Month"), F.col("loan_type").alias("Type_of_Loan"), *MEASURE_COLUMNS,
    )
