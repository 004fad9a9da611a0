"""Accepted applications: cohort loans of the window with their first due date,
average instalment and total repayable amount."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.predicates import current_only
from loanlens.functions.windows import ReportingWindow, previous_month
from loanlens.operators.cohort import created_in
from loanlens.plans.stored import Stored, restrict, stored
from loanlens.sources.layout import first_payments

# Fixed value: day-count basis of the interest rate (days per year x percent).
DAYS_PER_YEAR_PERCENT = 36525

ACCEPTED_COLUMNS = [
    "Loan_ID", "External_ID", "Application_ID", "Original_Application_ID", "Date_of_Approval",
    "Issued_Amount", "First_payment_date", "Number_of_Payments", "Each_payment_avg",
    "Total_Repayable", "Type_of_Loan",
]


def repayable_numerator() -> Column:
    """(principal + initial_interest) * 36525 - apr * principal * days, exact at scale 4.

    ``days`` = datediff(created_at, issued_at).  Total repayable is this over
    36525; one division instead of apr / 365.25 / 100 keeps the value exact
    up to the final rounding.
    """
    days = F.datediff(F.col("created_at"), F.col("issued_at"))
    n = (
        (F.col("principal") + F.col("initial_interest")) * F.lit(DAYS_PER_YEAR_PERCENT)
        - F.col("annual_percentage_rate") * F.col("principal") * days
    )
    return n.cast("decimal(28,4)")


def total_repayable() -> Column:
    # decimal(28,4) / decimal(5,0) keeps scale 10: rounding to cents is exact.
    return F.round(repayable_numerator() / F.lit(DAYS_PER_YEAR_PERCENT).cast("decimal(5,0)"), 2)


def each_payment_avg() -> Column:
    """Total repayable / number of payments, rounded once; NULL when there are no payments."""
    n = F.col("no_of_payments")
    den = (F.lit(DAYS_PER_YEAR_PERCENT) * n).cast("decimal(10,0)")
    return F.when(n != 0, F.round(repayable_numerator() / den, 2))


def accepted_applications(
    cohort: DataFrame | Stored, loan_payment: DataFrame, as_of: date, window: ReportingWindow | None = None
) -> DataFrame:
    """Reads first payments alone where the book is laid out by them, and of those the cohort's, while its keys can be broadcast."""
    w = window or previous_month(as_of)
    counted = stored(cohort)
    first = current_only(first_payments(loan_payment))
    if counted.fits:
        first = restrict(first, "loan_id", counted, "loan_id")
    first = first.select("loan_id", F.col("actual_payment_date").alias("First_payment_date"))
    return (
        counted.table.filter(created_in(w))
        .join(first, "loan_id")
        .select(
            F.col("loan_id").alias("Loan_ID"),
            F.col("external_id").alias("External_ID"),
            F.col("application_id").alias("Application_ID"),
            F.col("original_application_id").alias("Original_Application_ID"),
            F.col("issued_at").alias("Date_of_Approval"),
            F.col("principal").alias("Issued_Amount"),
            "First_payment_date",
            F.col("no_of_payments").alias("Number_of_Payments"),
            each_payment_avg().cast("decimal(18,2)").alias("Each_payment_avg"),
            total_repayable().cast("decimal(18,2)").alias("Total_Repayable"),
            F.col("loan_type").alias("Type_of_Loan"),
        )
        .distinct()
    )
