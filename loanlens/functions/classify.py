"""Decision classification of a credit application."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions.predicates import successful_loan

# Decision codes and reasons as reported.
ACCEPTED_CODE, REJECTED_CODE = "A", "R"
DECLINED, ACCEPTED, WITHDRAWN = "Declined", "Accepted", "Withdrawn by Customer"


def loan_accepted(
    loan_application_id: Column, issued_at: Column, cancelled_at: Column, declined_at: Column
) -> Column:
    """A linked loan exists and was paid out: issued, not cancelled, not declined."""
    return loan_application_id.isNotNull() & successful_loan(issued_at, cancelled_at, declined_at)


def final_decision(accepted: Column) -> Column:
    """'A' when the application ended in a paid-out loan, else 'R'."""
    return F.when(accepted, F.lit(ACCEPTED_CODE)).otherwise(F.lit(REJECTED_CODE))


def rejection_reason(has_facility: Column, declined: Column, accepted: Column) -> Column:
    """'Declined' without a facility or with a declined loan; 'Accepted' for a
    paid-out loan; otherwise 'Withdrawn by Customer'.  Order matters."""
    return (
        F.when(~has_facility | declined, F.lit(DECLINED))
        .when(accepted, F.lit(ACCEPTED))
        .otherwise(F.lit(WITHDRAWN))
    )
