"""The month-end run: build and publish the cohort, then write every report.

Order of the source's hand-run scripts, as one restartable Spark job:

1. build the cohort (v2 by default) and publish it as the month's partition
   of the cohort table -- this write also cuts the lineage, so the reports
   read a small materialised table instead of re-deriving the cohort, and an
   executor lost later never forces the cohort joins to be recomputed;
2. store the payments that the month's payment reports can select, in one scan of the payment
   table for all of them;
3. run the cohort reports (accepted applications, payment level, payments per
   loan) and the book reports (decisions, payments for loans) and write each
   to ``<out_root>/<report>/reporting_month=<month>``.

Every write replaces exactly one month's folder and every report is deterministic, so re-running the whole job,
or any failed step, gives the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from loanlens.functions.windows import ReportingWindow, reporting_month
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
)
from loanlens.operators.payments import month_payments
from loanlens.plans.publish import publish_cohort, stored_cohort
from loanlens.plans.stored import Stored, job_folder, stored
from loanlens.session import shared_dir
from loanlens.sources.book import LoanBook
from loanlens.sources.replay import book_as_of


def write_report(df: DataFrame, path: str, month: str) -> None:
    """Replace one month of a report stored at ``path`` (Parquet, one folder per month).

    A report with a stated order keeps it on disk: its sort deals rows to tasks by range, every task writes its
    range as it is sorted, and files are named by task, so files in name order, read one after
    the other, give the report's order (``report_files``).
    """
    df.write.mode("overwrite").parquet(_month_folder(path, month))


def _month_folder(path: str, month: str) -> str:
    return f"{path}/reporting_month={month}"


def report_files(spark: SparkSession, path: str, month: str) -> list[str]:
    """The files of one month of a report, in the report's order."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_month_folder(path, month))
    found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().startswith("part-"))


def month_end_reports(
    book: LoanBook,
    cohort: DataFrame | Stored,
    as_of: date,
    window: ReportingWindow | None = None,
    loan_ids: Sequence[int] | None = None,
    null_safe_least: bool = False,
) -> dict[str, DataFrame]:
    """``window`` replays the decision reports for another range of dates; ``loan_ids`` and
    ``null_safe_least`` go to the per-loan payment reports."""
    cohort = stored(cohort)  # once for all reports
    month = replace(book, loan_payment=month_payments(book.loan_payment, as_of))
    return {
        "accepted_applications": accepted_applications(cohort, book.loan_payment, as_of),
        "monthly_payments": monthly_payments(cohort, month.loan_payment, as_of),
        "monthly_payments_payment_level": monthly_payments_payment_level(cohort, month, as_of),
        "monthly_payments_by_loan": monthly_payments_by_loan(
            cohort, month.loan_payment, as_of, null_safe_least=null_safe_least),
        "monthly_payments_for_loans": monthly_payments_for_loans(month, as_of, loan_ids=loan_ids),
        "applications_direct": all_applications_direct(book, as_of, window),
        "applications_facility": all_applications_facility(book, as_of, window),
        "applications_audit": all_applications_audit(book, as_of, window),
    }


def run_month_end(
    spark: SparkSession,
    book: LoanBook,
    as_of: date,
    cohort_table: str = "loanlens_cohort",
    out_root: str | None = None,
    cohort_version: int = 2,
    as_it_stood: bool = False,
    **parameters,
) -> dict[str, str]:
    """Run the month-end job; returns report name -> output path.  ``parameters``: see ``month_end_reports``.

    ``as_it_stood`` replays a past date on the book as it stood then (``sources.replay``).
    """
    book = book_as_of(book, as_of) if as_it_stood else book
    month = reporting_month(as_of)
    root = out_root or f"{shared_dir(spark)}/month_end"
    build = loan_cohort_v2 if cohort_version == 2 else loan_cohort_v1
    out = {}
    with job_folder(spark, out_root):
        publish_cohort(build(book, as_of), cohort_table, month, path=f"{root}/cohort")
        cohort = stored_cohort(spark, cohort_table, month)
        for name, df in month_end_reports(book, cohort, as_of, **parameters).items():
            path = f"{root}/{name}"
            write_report(df, path, month)
            out[name] = path
    return out
