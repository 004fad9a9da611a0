"""Payment measures: due, paid, outstanding and late-interest amounts.

All arithmetic stays in decimals (exact money); only the amounts that the
source system treats as optional are defaulted to 0 (``Due_payment`` and the
payment-level outstanding principal).  ``Monthly_payment`` propagates NULL
from any of its parts, so a payment with an unknown paid part does not count
in a per-loan sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(38,2)"


def _z(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def due_amount() -> Column:
    """principal + interest + fees + penalty + discount, NULL parts as 0 (discount is added)."""
    return _z("principal") + _z("interest") + _z("fees") + _z("penalty") + _z("discount")


def paid_amount() -> Column:
    return F.col("principal_paid") + F.col("interest_paid") + F.col("fees_paid") + F.col("penalty_paid")


def payment_measures() -> list[Column]:
    """One payment row's measures (payment-level reports)."""
    return [
        (_z("principal") + _z("balance_left")).cast(MONEY).alias("Outstanding_Principal"),
        due_amount().cast(MONEY).alias("Due_payment"),
        paid_amount().cast(MONEY).alias("Monthly_payment"),
        F.col("principal_paid").cast(MONEY).alias("Principal_Paid"),
        F.col("interest_paid").cast(MONEY).alias("Interest_Paid"),
        (F.col("penalty") - F.col("penalty_paid")).cast(MONEY).alias("Late_Payment_Interest"),
    ]


def loan_measures() -> list[Column]:
    """Aggregates over a loan's selected payments (per-loan reports).

    ``Outstanding_Principal`` is the largest principal + balance before a
    payment, i.e. the balance before the first payment of the period.
    ``Late_Payment_Interest`` here is the charged penalty, not penalty - paid.
    """
    return [
        F.max(F.col("principal") + F.col("balance_left")).cast(MONEY_SUM).alias("Outstanding_Principal"),
        F.sum(due_amount()).cast(MONEY_SUM).alias("Due_payment"),
        F.sum(paid_amount()).cast(MONEY_SUM).alias("Monthly_payment"),
        F.sum("principal_paid").cast(MONEY_SUM).alias("Principal_Paid"),
        F.sum("interest_paid").cast(MONEY_SUM).alias("Interest_Paid"),
        F.sum("penalty").cast(MONEY_SUM).alias("Late_Payment_Interest"),
    ]


def summed_measures() -> list[Column]:
    """``loan_measures`` of a loan from those of its parts."""
    names = ["Due_payment", "Monthly_payment", "Principal_Paid", "Interest_Paid", "Late_Payment_Interest"]
    return [
        F.max("Outstanding_Principal").alias("Outstanding_Principal"),
        *[F.sum(n).cast(MONEY_SUM).alias(n) for n in names],
    ]
