"""The loan book as it stood at the end of a past day.

A replay of a month must not see what happened later: a row deleted, paid, cancelled, declined, issued
or superseded after the day counts as live, open and so on, and a row created after it does not exist.
Amounts paid later are 0 (NULL stays NULL).  Tables without dates (external scores, links between
facilities and loans, dictionaries) are taken as they are; rows of theirs that point to later
rows find nothing.  A row without a creation date is taken to have existed.

Folder columns pass through and stay valid: a payment paid later lies in a later month's folder than
any window that ends by the day, so the pruning of ``sources.layout`` keeps it.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.sources.book import LoanBook

# What may happen to a row after it was created, by table.
EVENTS = {
    "loan_application": ["deleted_at"],
    "credit_score": [],
    "facility": [],
    "loan": ["issued_at", "cancelled_at", "declined_at", "deleted_at", "topped_up_at", "extended_at", "arranged_rp_at"],
    "loan_payment": ["deleted_at"],
    "financial_information": ["deleted_at"],
}
PAID_PARTS = ["principal_paid", "interest_paid", "fees_paid", "penalty_paid"]


def _by(column: str, day: date) -> Column:
    """The timestamp lies on ``day`` or before."""
    return F.col(column) < F.lit(day + timedelta(days=1)).cast("timestamp_ntz")


def table_as_of(df: DataFrame, name: str, day: date) -> DataFrame:
    """Table ``name`` as it stood at the end of ``day``."""
    if name not in EVENTS:
        return df
    if "created_at" in df.columns:
        df = df.filter(F.col("created_at").isNull() | _by("created_at", day))
    changed = {c: F.when(_by(c, day), F.col(c)) for c in EVENTS[name]}
    if name == "loan_payment":
        later = F.col("paid_at_date") > F.lit(day)
        changed["paid_at_date"] = F.when(F.col("paid_at_date") <= F.lit(day), F.col("paid_at_date"))
        changed |= {c: F.when(later & F.col(c).isNotNull(), F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in PAID_PARTS}
    return df.withColumns(changed) if changed else df


def book_as_of(book: LoanBook, day: date) -> LoanBook:
    return replace(book, **{name: table_as_of(df, name, day) for name, df in book.tables().items()})
