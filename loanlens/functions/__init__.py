"""Column-level building blocks: windows, predicates, classification, measures."""

from loanlens.functions.classify import final_decision, loan_accepted, rejection_reason
from loanlens.functions.measures import loan_measures, payment_measures
from loanlens.functions.predicates import (
    AGGREGATED,
    LEVEL,
    current_only,
    least_strict,
    payment_in_scope,
    payment_prefilter,
    successful_loan,
    superseded_at,
)
from loanlens.functions.windows import (
    WHOLE_BOOK,
    ReportingWindow,
    previous_month,
    reporting_month,
    reporting_window,
    rolling_month,
    rolling_month_shifted,
    window_columns,
)

__all__ = [
    "AGGREGATED", "LEVEL", "WHOLE_BOOK", "ReportingWindow", "current_only", "final_decision",
    "least_strict", "loan_accepted", "loan_measures", "payment_in_scope", "payment_measures",
    "payment_prefilter", "previous_month", "rejection_reason", "reporting_month",
    "reporting_window", "rolling_month", "rolling_month_shifted", "successful_loan",
    "superseded_at", "window_columns",
]
