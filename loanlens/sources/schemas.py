"""Explicit schemas of the loan book (source tables) and of the cohort table.

The source system ships no DDL; column sets come from what the reports read
and the types follow the usual money/date conventions: ids are ``long``,
money is ``decimal(18,2)``, rates ``decimal(9,2)``, ``*_at`` columns are
``timestamp_ntz`` and payment dates are ``date``.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
INT = T.IntegerType()
TS = T.TimestampNTZType()
DATE = T.DateType()
MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(9, 2)
STR = T.StringType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LOAN_APPLICATION = _schema(
    ("id", ID), ("customer_id", ID), ("created_at", TS),
    ("amount_of_credit", MONEY), ("deleted_at", TS),
)

# Scores of the external credit model; 0..n rows per application.
EXTERNAL_SCORE = _schema(("id", ID), ("loan_application_id", ID))

CREDIT_SCORE = _schema(
    ("id", ID), ("loan_application_id", ID),
    ("credit_score_config_id", INT), ("created_at", TS),
)

CREDIT_SCORE_CONFIG = _schema(("id", INT), ("scorecard_type_id", INT))

FACILITY = _schema(("id", ID), ("credit_score_id", ID), ("created_at", TS))

FACILITY_HAS_LOAN = _schema(("facility_id", ID), ("loan_id", ID))

LOAN_TYPE = _schema(("id", INT), ("name", STR))

LOAN = _schema(
    ("id", ID), ("loan_application_id", ID), ("original_loan_application_id", ID),
    ("origin_loan_id", ID), ("loan_type_id", INT),
    ("principal", MONEY), ("initial_interest", MONEY),
    ("annual_percentage_rate", RATE), ("no_of_payments", INT),
    ("created_at", TS), ("issued_at", TS), ("cancelled_at", TS),
    ("declined_at", TS), ("deleted_at", TS),
    ("topped_up_at", TS), ("extended_at", TS), ("arranged_rp_at", TS),
)

LOAN_PAYMENT = _schema(
    ("loan_id", ID), ("is_first_payment", INT),
    ("actual_payment_date", DATE), ("paid_at_date", DATE),
    ("principal", MONEY), ("interest", MONEY), ("fees", MONEY),
    ("penalty", MONEY), ("discount", MONEY), ("balance_left", MONEY),
    ("principal_paid", MONEY), ("interest_paid", MONEY),
    ("fees_paid", MONEY), ("penalty_paid", MONEY), ("deleted_at", TS),
)

FINANCIAL_INFORMATION = _schema(
    ("customer_id", ID), ("total_monthly_income", MONEY),
    ("total_monthly_expenses", MONEY), ("deleted_at", TS),
)

# The one derived table shared between reports (15 columns, written by name).
COHORT = _schema(
    ("loan_id", ID), ("loan_type", STR), ("external_id", ID),
    ("application_id", ID), ("original_application_id", ID),
    ("issued_at", TS), ("created_at", TS),
    ("principal", MONEY), ("initial_interest", MONEY),
    ("annual_percentage_rate", RATE), ("no_of_payments", INT),
    ("topped_up_at", DATE), ("extended_at", DATE), ("arranged_rp_at", DATE),
    ("load_dttm", TS),
)

BOOK_SCHEMAS: dict[str, T.StructType] = {
    "loan_application": LOAN_APPLICATION,
    "external_score": EXTERNAL_SCORE,
    "credit_score": CREDIT_SCORE,
    "credit_score_config": CREDIT_SCORE_CONFIG,
    "facility": FACILITY,
    "facility_has_loan": FACILITY_HAS_LOAN,
    "loan_type": LOAN_TYPE,
    "loan": LOAN,
    "loan_payment": LOAN_PAYMENT,
    "financial_information": FINANCIAL_INFORMATION,
}
