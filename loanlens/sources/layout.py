"""How the large tables of a stored book are laid out, and the filters that use it.

Payments lie in folders by whether they are a loan's first one, and below by the month they were paid in, or, while they
are open, by the month they are due in; loans and credit scores in one for each month of creation.  Every
payment report needs only payments paid since its window began and open ones due by its end, so neither
the paid history nor the instalments of the future, which both grow without bound, are opened; the
report of accepted applications opens first payments alone.  Folder columns are extra columns of the DataFrame; on a table without them the filters do nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.windows import NoWindow, ReportingWindow

FIRST, PAID_MONTH, CREATED_MONTH = "first_payment", "paid_month", "created_month"
OPEN = "open-"  # before the month of an open payment; sorts after every month


def folders(name: str) -> dict[str, Column]:
    """Folder columns of table ``name``, outermost first, and their values."""
    if name == "loan_payment":
        return {FIRST: F.when(F.col("is_first_payment") == 1, "yes").otherwise("no"),
                PAID_MONTH: F.coalesce(F.date_format("paid_at_date", "yyyy-MM"),
                                       F.concat(F.lit(OPEN), F.coalesce(F.date_format("actual_payment_date", "yyyy-MM"), F.lit("none"))))}
    if name in ("loan", "credit_score"):
        return {CREATED_MONTH: F.date_format("created_at", "yyyy-MM")}
    return {}


def _month(day: date) -> str:
    return day.strftime("%Y-%m")


def created_months(df: DataFrame, window: ReportingWindow | NoWindow) -> DataFrame:
    if CREATED_MONTH not in df.columns or isinstance(window, NoWindow):
        return df
    return df.filter(F.col(CREATED_MONTH).between(_month(window.start), _month(window.end)))


def paid_since_or_due_by(df: DataFrame, since: date, until: date) -> DataFrame:
    """Payments paid in the month of ``since`` or later, and open ones due by the month of ``until``
    (an open payment without a due date is in no report)."""
    if PAID_MONTH not in df.columns:
        return df
    return df.filter(F.col(PAID_MONTH).between(_month(since), OPEN + _month(until)))


def first_payments(df: DataFrame) -> DataFrame:
    """Loans' first payments; a stored table opens their folders alone."""
    first = df.filter(F.col("is_first_payment") == 1)
    return first.filter(F.col(FIRST) == "yes") if FIRST in df.columns else first
