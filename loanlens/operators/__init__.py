"""Reports (cohort, accepted applications, decisions, payments) and the dedupe operator."""

from loanlens.operators.accepted import accepted_applications
from loanlens.operators.applications import (
    all_applications_audit,
    all_applications_direct,
    all_applications_facility,
)
from loanlens.operators.backfill import payments_by_loan_backfill, payments_for_loans_backfill
from loanlens.operators.cohort import loan_cohort_v1, loan_cohort_v2
from loanlens.operators.dedupe import one_row_per
from loanlens.operators.payments import (
    monthly_payments,
    monthly_payments_by_loan,
    monthly_payments_for_loans,
    monthly_payments_payment_level,
    payment_branch_counts,
)
from loanlens.operators.reconcile import reconcile

__all__ = [
    "accepted_applications", "all_applications_audit", "all_applications_direct",
    "all_applications_facility", "loan_cohort_v1", "loan_cohort_v2", "monthly_payments",
    "monthly_payments_by_loan", "monthly_payments_for_loans", "monthly_payments_payment_level",
    "one_row_per", "payment_branch_counts", "payments_by_loan_backfill", "payments_for_loans_backfill", "reconcile",
]
