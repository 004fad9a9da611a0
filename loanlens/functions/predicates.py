"""Row predicates and small column expressions shared by the reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.windows import ReportingWindow

# Fixed value: "never superseded" sentinel date of the payment reports.
NOT_SUPERSEDED = date(2999, 12, 31)


def current_only(df: DataFrame, deleted_col: str = "deleted_at") -> DataFrame:
    """Drop soft-deleted rows (``deleted_at IS NULL`` keeps a row)."""
    return df.filter(F.col(deleted_col).isNull())


def successful_loan(issued_at: Column, cancelled_at: Column, declined_at: Column) -> Column:
    """Issued, not cancelled, not declined."""
    return issued_at.isNotNull() & cancelled_at.isNull() & declined_at.isNull()


def superseded_at(topped_up_at: Column, extended_at: Column, arranged_rp_at: Column) -> Column:
    """First non-NULL of top-up, extension, repayment-plan date, else 2999-12-31.

    Precedence is the listed order, not the earliest date.  Timestamps are
    narrowed to dates: for a date ``d``, ``d <= ts`` iff ``d <= date(ts)``.
    """
    return F.coalesce(
        topped_up_at.cast("date"), extended_at.cast("date"), arranged_rp_at.cast("date"),
        F.lit(NOT_SUPERSEDED),
    )


def least_strict(a: Column, b: Column) -> Column:
    """``least`` that is NULL as soon as one argument is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


LEVEL = "level"            # payment-level reports and the per-loan report on raw loans
AGGREGATED = "aggregated"  # per-loan report on the cohort (wider selection)


def payment_in_scope(
    due: Column,
    paid: Column,
    window: ReportingWindow,
    superseded: Column,
    variant: str = LEVEL,
    null_safe_least: bool = False,
) -> Column:
    """Which payments a monthly payment report selects.

    Three branches, OR-ed:

    1. due in the window, and unpaid or paid in the window (``aggregated``
       also: paid after the window), and not superseded: ``due <= X``
       (``aggregated``: ``least(due, paid) <= X``, NULL if unpaid unless
       ``null_safe_least``);
    2. paid in the window and due after it (``aggregated``: or before it);
    3. due before the window and still unpaid (overdue).
    """
    in_due, in_paid = window.contains(due), window.contains(paid)
    overdue = (due < F.lit(window.start)) & paid.isNull()
    if variant == LEVEL:
        first = in_due & (paid.isNull() | in_paid) & (due <= superseded)
        second = in_paid & (due > F.lit(window.end))
    elif variant == AGGREGATED:
        earliest = F.least(due, paid) if null_safe_least else least_strict(due, paid)
        first = (
            in_due
            & (paid.isNull() | in_paid | (paid > F.lit(window.end)))
            & (earliest <= superseded)
        )
        second = in_paid & ((due < F.lit(window.start)) | (due > F.lit(window.end)))
    else:
        raise ValueError(variant)
    return first | second | overdue


def payment_prefilter(due: Column, paid: Column, window: ReportingWindow, variant: str = LEVEL) -> Column:
    """Payment-only necessary condition of ``payment_in_scope``.

    It drops the loan-side (superseded) conjunct, so it can be applied to the
    payment table before the join and reaches the Parquet scan.
    """
    s, e = F.lit(window.start), F.lit(window.end)
    in_due, in_paid = window.contains(due), window.contains(paid)
    overdue = (due < s) & paid.isNull()
    if variant == LEVEL:
        return (in_due & (paid.isNull() | in_paid)) | (in_paid & (due > e)) | overdue
    return (in_due & (paid.isNull() | (paid >= s))) | (in_paid & ((due < s) | (due > e))) | overdue
