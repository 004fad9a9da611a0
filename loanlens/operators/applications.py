"""Decision report: every scored credit application of the window, classified as
accepted ('A'/'Accepted'), declined ('R'/'Declined') or withdrawn
('R'/'Withdrawn by Customer'), with applied amount and the customer's
monthly income and expenses.

Three variants:

* ``all_applications_direct``: one scoring model, external score required,
  live applications only, loan linked by its original application;
* ``all_applications_facility``: all scoring models, external score
  optional, loan linked through facility -> facility_has_loan -> loan;
* ``all_applications_audit``: the facility variant restricted to scorecard
  types and to a small lag between application and scoring, with the
  external id reported only for the chosen model and rows ordered by lag.

Output grain is (application, decision, reason) [audit: + external id]; an
application linked to loans with different outcomes yields several rows.
Columns that are not part of the grain are picked deterministically: the
smallest external id and, per customer, the financial-information row with
the smallest (expenses, income), NULLs last -- the same row a row_number
over the full join would keep, because these arms are independent of the
loan arm.  Computing them per application / per customer and joining them
to the distinct grain avoids building the application x external-score x
financial-information product.

Plan shape: the windowed credit scores (date range pushed to the scan) with
their applications are computed once and stored (``plans.stored``).  Every
large table behind them -- facility, bridge, loan, external scores, financial
information -- is restricted where it is scanned by stored keys, so that none
of them is shuffled in full.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.functions.classify import final_decision, loan_accepted, rejection_reason
from loanlens.functions.predicates import current_only
from loanlens.functions.windows import ReportingWindow, previous_month
from loanlens.operators.cohort import created_within
from loanlens.operators.dedupe import one_row_per
from loanlens.plans.stored import Stored, restrict, store
from loanlens.sources.book import LoanBook

# The external model's scoring config and the regular scorecard types.
SCORING_CONFIG_ID = 58
REGULAR_SCORECARD_TYPES = (796, 959, 960)

REPORT_COLUMNS = [
    "external_id", "id", "created_at", "final_decision", "rejection_reason",
    "applied_amount", "total_monthly_expenses", "total_monthly_income",
]
AUDIT_COLUMNS = REPORT_COLUMNS[:3] + ["scorecard_type_id"] + REPORT_COLUMNS[3:]


def _scored(
    book: LoanBook, window: ReportingWindow, conf: DataFrame, live_only: bool, max_lag_days: int | None = None
) -> Stored:
    """The window's credit scores with an existing config and their applications, stored."""
    scores = store(
        created_within(book.credit_score, window)
        .select(
            F.col("id").alias("credit_score_id"), F.col("loan_application_id").alias("app_id"),
            "credit_score_config_id", F.col("created_at").alias("scored_at"),
        )
        .join(conf, "credit_score_config_id")
    )
    scored = (
        scores.table.join(restrict(_applications(book, live_only), "app_id", scores, "app_id"), "app_id")
        .withColumn("lag_days", F.datediff(F.col("scored_at"), F.col("created_at")))
    )
    return store(scored if max_lag_days is None else scored.filter(F.col("lag_days") <= max_lag_days))


def _applications(book: LoanBook, live_only: bool) -> DataFrame:
    apps = current_only(book.loan_application) if live_only else book.loan_application
    return apps.select(
        F.col("id").alias("app_id"), "created_at", "customer_id",
        F.col("amount_of_credit").alias("applied_amount"),
    )


def _loan_flags(loans: DataFrame, key: str) -> DataFrame:
    """(key, accepted, declined) per loan."""
    return loans.select(
        F.col(key),
        loan_accepted(F.col("loan_application_id"), F.col("issued_at"),
                      F.col("cancelled_at"), F.col("declined_at")).alias("accepted"),
        F.col("declined_at").isNotNull().alias("declined"),
    )


def _facility_outcomes(book: LoanBook, scored: Stored) -> DataFrame:
    """Distinct (credit_score_id, has_facility, accepted, declined) via facility -> bridge -> live loan.

    Facilities are restricted by the stored scores, the bridge by the stored facilities, the loans
    by the stored links.  A facility's outcomes are those of its live loans; where a link
    leads to no live loan, or there is no link, the outcome is neither accepted nor declined.
    Both kinds are made distinct per facility first (partially aggregated), so a facility
    linked to very many loans sends at most four rows on.
    """
    fac = store(
        restrict(book.facility, "credit_score_id", scored, "credit_score_id")
        .select(F.col("id").alias("facility_id"), "credit_score_id")
    )
    links = store(restrict(book.facility_has_loan, "facility_id", fac, "facility_id").select("facility_id", "loan_id"))
    flags = store(
        _loan_flags(restrict(current_only(book.loan), "id", links, "loan_id")
                    .withColumnRenamed("id", "loan_id"), "loan_id")
    ).table
    linked = links.table.join(flags, "loan_id").select("facility_id", "accepted", "declined").distinct()
    neither = [F.lit(False).alias("accepted"), F.lit(False).alias("declined")]
    dead = links.table.join(flags.select("loan_id"), "loan_id", "left_anti").select("facility_id", *neither)
    alone = fac.table.join(links.table.select("facility_id"), "facility_id", "left_anti").select("facility_id", *neither)
    outcomes = linked.unionByName(dead).unionByName(alone).distinct()
    return (
        fac.table.join(outcomes, "facility_id")
        .select("credit_score_id", F.lit(True).alias("has_facility"), "accepted", "declined")
        .distinct()
    )


def _classify(df: DataFrame) -> DataFrame:
    has_facility = F.coalesce("has_facility", F.lit(False))
    accepted = F.coalesce("accepted", F.lit(False))
    declined = F.coalesce("declined", F.lit(False))
    return df.withColumn("final_decision", final_decision(accepted)).withColumn(
        "rejection_reason", rejection_reason(has_facility, declined, accepted)
    )


def _min_external_id(book: LoanBook, scored: Stored) -> DataFrame:
    ext = restrict(book.external_score, "loan_application_id", scored, "app_id")
    return ext.groupBy(F.col("loan_application_id").alias("app_id")).agg(F.min("id").alias("external_id"))


def _with_financials(book: LoanBook, scored: Stored, grain: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``grain`` with one live financial-information row per customer: smallest (expenses, income), NULLs last."""
    fi = restrict(current_only(book.financial_information), "customer_id", scored, "customer_id")
    one = one_row_per(
        fi.select("customer_id", "total_monthly_expenses", "total_monthly_income"),
        ["customer_id"], ["total_monthly_expenses", "total_monthly_income"],
    )
    return grain.join(one, "customer_id", "left").withColumnRenamed("app_id", "id").select(*columns)


def all_applications_direct(
    book: LoanBook, as_of: date, window: ReportingWindow | None = None,
    config_id: int = SCORING_CONFIG_ID,
) -> DataFrame:
    conf = book.credit_score_config.filter(F.col("id") == config_id).select(
        F.col("id").alias("credit_score_config_id")
    )
    scored = _scored(book, window or previous_month(as_of), conf, live_only=True)
    fac = restrict(book.facility, "credit_score_id", scored, "credit_score_id").select(
        "credit_score_id", F.lit(True).alias("has_facility")
    ).distinct()
    loans = restrict(current_only(book.loan), "original_loan_application_id", scored, "app_id")
    flags = _loan_flags(loans, "original_loan_application_id").distinct()
    grain = (
        scored.table.join(_min_external_id(book, scored), "app_id")
        .join(fac, "credit_score_id", "left")
        .join(flags.withColumnRenamed("original_loan_application_id", "app_id"), "app_id", "left")
        .transform(_classify)
        .select("app_id", "created_at", "final_decision", "rejection_reason",
                "applied_amount", "customer_id", "external_id")
        .distinct()
    )
    return _with_financials(book, scored, grain, REPORT_COLUMNS)


def all_applications_facility(
    book: LoanBook, as_of: date, window: ReportingWindow | None = None
) -> DataFrame:
    conf = book.credit_score_config.select(F.col("id").alias("credit_score_config_id"))
    scored = _scored(book, window or previous_month(as_of), conf, live_only=False)
    grain = (
        scored.table.join(_facility_outcomes(book, scored), "credit_score_id", "left")
        .transform(_classify)
        .select("app_id", "created_at", "final_decision", "rejection_reason",
                "applied_amount", "customer_id")
        .distinct()
    )
    grain = grain.join(_min_external_id(book, scored), "app_id", "left")
    return _with_financials(book, scored, grain, REPORT_COLUMNS)


def all_applications_audit(
    book: LoanBook,
    as_of: date,
    window: ReportingWindow | None = None,
    config_id: int = SCORING_CONFIG_ID,
    scorecard_types: Sequence[int] = REGULAR_SCORECARD_TYPES,
    max_lag_days: int = 1,
) -> DataFrame:
    """Lag = datediff(scored, applied) in days; only an upper bound (negative lags pass).

    The external id is attached only to rows scored by ``config_id`` (a
    condition on the left side of the outer join); other rows keep NULL.
    ``scorecard_type_id`` and the sort key come from the score with the
    smallest (scorecard type, lag) in each output group.
    """
    conf = book.credit_score_config.filter(F.col("scorecard_type_id").isin(list(scorecard_types))).select(
        F.col("id").alias("credit_score_config_id"), "scorecard_type_id"
    )
    scored = _scored(book, window or previous_month(as_of), conf, live_only=False, max_lag_days=max_lag_days)
    ext = restrict(book.external_score, "loan_application_id", scored, "app_id").select(
        F.col("id").alias("external_id"), F.col("loan_application_id").alias("ext_app_id")
    )
    has_ext = ext.select(F.col("ext_app_id").alias("app_id"), F.lit(True).alias("has_ext")).distinct()
    rows = (
        scored.table.join(_facility_outcomes(book, scored), "credit_score_id", "left")
        .join(has_ext, "app_id", "left")
        .transform(_classify)
        .withColumn(
            "ext_mode",
            (F.col("credit_score_config_id") == config_id) & F.coalesce("has_ext", F.lit(False)),
        )
    )
    picked = one_row_per(
        rows.select("app_id", "created_at", "final_decision", "rejection_reason", "ext_mode",
                    "applied_amount", "customer_id", "scorecard_type_id", "lag_days"),
        ["app_id", "created_at", "final_decision", "rejection_reason", "ext_mode"],
        ["scorecard_type_id", "lag_days"],
    )
    # Left join on (app, ext_mode) with the condition on the left side; ext_mode implies
    # a match, so it is an inner join for those rows (AQE can split a hot application
    # on either side) plus the other rows with no external id.
    grain = (
        picked.filter(F.col("ext_mode"))
        .join(ext, F.col("app_id") == F.col("ext_app_id"))
        .drop("ext_app_id")
        .unionByName(picked.filter(~F.col("ext_mode")).withColumn("external_id", F.lit(None).cast("long")))
    )
    return (
        _with_financials(book, scored, grain, AUDIT_COLUMNS + ["lag_days"])
        # the lag has a handful of values: the further keys spread its rows over sort tasks
        .orderBy(F.col("lag_days").desc(), "id", "external_id", "final_decision", "rejection_reason")
        .drop("lag_days")
    )
