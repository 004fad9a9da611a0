"""Monthly loan cohort: scored loans created in the reporting window and
their follow-on (child) loans.

Two versions of the link between a loan and its scoring:

* ``loan_cohort_v1``: direct, the loan's original application must carry an
  external score;
* ``loan_cohort_v2``: through facility -> same-day credit score ->
  application, external score optional, child loans must be paid out too,
  ``application_id`` follows the loan type, plus a load timestamp.

Both return one row per distinct combination of the cohort columns (the
union of a root-loan branch and a child-loan branch).

Join-key semantics kept from the source: the "original loan" self join
matches loan L with every live loan whose ``coalesce(origin_loan_id, id)``
is L, i.e. L itself when L is a root, plus each of its children (one row per
child's original application).  Parents of children are taken at any age;
only the child's creation date is windowed.

Plan shape: one scan takes the window's loans (a timestamp range pushed to
it) into a small stored table (``plans.stored``); a second takes the parents
of its children, a third the live loans anchored on its loans.  Every other
large table -- bridge, facility, credit score, external score -- is
restricted by stored keys before it is joined, once, and the facility chain
with its external ids is stored too, because three parts of the report read
it.  External ids of which only the smallest counts are aggregated before
they are joined, so no fan-out is built and later collapsed.  What remains is
the report's own grain: external scores x original applications of a loan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.functions.predicates import current_only, successful_loan
from loanlens.functions.windows import NoWindow, ReportingWindow, previous_month
from loanlens.plans.stored import Stored, narrow, restrict, store
from loanlens.sources.book import LoanBook
from loanlens.sources.layout import created_months

# Fixed value: loan type whose application is the original application.
TOP_UP_TYPE_ID = 756

V1_COLUMNS = [
    "loan_id", "loan_type", "external_id", "application_id", "original_application_id",
    "issued_at", "created_at", "principal", "initial_interest", "annual_percentage_rate",
    "no_of_payments", "topped_up_at", "extended_at", "arranged_rp_at",
]
V2_COLUMNS = V1_COLUMNS + ["load_dttm"]


def created_in(window: ReportingWindow | NoWindow, col: str = "created_at") -> Column:
    """``date(col) BETWEEN start AND end`` written as a half-open timestamp range,
    which Parquet can use directly (row-group statistics, pushed filter)."""
    if isinstance(window, NoWindow):
        return F.lit(True)
    c = F.col(col)
    lo = F.lit(window.start).cast("timestamp_ntz")
    hi = F.date_add(F.lit(window.end), 1).cast("timestamp_ntz")
    return (c >= lo) & (c < hi)


def created_within(df: DataFrame, window: ReportingWindow | NoWindow) -> DataFrame:
    """Rows created in the window; a stored table reads the months of the window alone."""
    return created_months(df, window).filter(created_in(window))


def _is_successful() -> Column:
    return successful_loan(F.col("issued_at"), F.col("cancelled_at"), F.col("declined_at"))


def _loan_attributes() -> list[Column]:
    return [
        F.col("issued_at"), F.col("created_at"), F.col("principal"),
        F.col("initial_interest"), F.col("annual_percentage_rate"), F.col("no_of_payments"),
        F.col("topped_up_at").cast("date").alias("topped_up_at"),
        F.col("extended_at").cast("date").alias("extended_at"),
        F.col("arranged_rp_at").cast("date").alias("arranged_rp_at"),
    ]


def _types(book: LoanBook) -> DataFrame:
    return book.loan_type.select(F.col("id").alias("loan_type_id"), F.col("name").alias("loan_type"))


def _window_loans(book: LoanBook, window: ReportingWindow | NoWindow, children: Column) -> Stored:
    """The window's paid-out loans (``paid_out``) and child loans (``child``) with every column a cohort needs."""
    return store(
        created_within(book.loan, window).select(
            F.col("id").alias("loan_id"), "loan_type_id", "loan_application_id",
            "original_loan_application_id", "origin_loan_id",
            F.coalesce(_is_successful(), F.lit(False)).alias("paid_out"),
            F.coalesce(children, F.lit(False)).alias("child"), *_loan_attributes(),
        ).filter(F.col("paid_out") | F.col("child"))
    )


def _parents(book: LoanBook, loans: Stored) -> DataFrame:
    """Paid-out parents, of any age, of the window's child loans."""
    children = F.when(F.col("child"), F.col("origin_loan_id"))
    return restrict(book.loan, "id", loans, children).filter(_is_successful()).select(
        F.col("id").alias("origin_loan_id"), "original_loan_application_id"
    )


def _original_applications(book: LoanBook, loans: Stored) -> DataFrame:
    """(anchor loan id, original application) of live loans anchored on the paid-out ``loans``;
    anchor = origin loan, or the loan itself when it has none.

    Pre-aggregated (distinct), so that a parent with very many children sends one row per
    distinct original application into the join, not one per child.
    """
    anchor = F.coalesce("origin_loan_id", "id")
    return (
        restrict(current_only(book.loan), anchor, loans, F.when(F.col("paid_out"), F.col("loan_id")))
        .select(
            anchor.alias("loan_id"),
            F.col("original_loan_application_id").alias("original_application_id"),
        )
        .distinct()
    )


def _min_external_id(book: LoanBook, apps: Stored, app: Column, key: str, out: str) -> DataFrame:
    """Smallest external score id per application named by ``app`` (applications without one are absent),
    to be joined by application; beyond the broadcast limit other applications are there too."""
    ext = narrow(book.external_score, "loan_application_id", apps, app)
    return ext.groupBy(F.col("loan_application_id").alias(key)).agg(F.min("id").alias(out))


def facility_applications(book: LoanBook, loans: Stored, loan_col: str = "loan_id") -> DataFrame:
    """Distinct (loan_id, la_id): application reached loan -> facility -> credit
    score created the same day as the facility -> existing config -> existing application.

    The bridge is restricted by the stored loans and stored; facility and score by the keys of the
    step before.  Keys that are too many for a broadcast restrict nothing ahead of the joins, so each
    step shuffles its two sides once.
    """
    links = store(
        restrict(book.facility_has_loan, "loan_id", loans, loan_col).select("loan_id", "facility_id")
    )
    fac = narrow(book.facility, "id", links, "facility_id").select(
        F.col("id").alias("facility_id"), "credit_score_id", F.to_date("created_at").alias("facility_day"),
    )
    reached = store(links.table.join(fac, "facility_id").select("loan_id", "credit_score_id", "facility_day"))
    cs = narrow(book.credit_score, "id", reached, "credit_score_id").select(
        F.col("id").alias("credit_score_id"), F.col("loan_application_id").alias("la_id"),
        F.col("credit_score_config_id"), F.to_date("created_at").alias("score_day"),
    )
    conf = book.credit_score_config.select(F.col("id").alias("credit_score_config_id"))
    chain = store(
        reached.table.join(cs, "credit_score_id")
        .filter(F.col("facility_day") == F.col("score_day"))
        .join(conf, "credit_score_config_id", "left_semi")
        .select("loan_id", "la_id").distinct()
    )
    known = narrow(book.loan_application, "id", chain, "la_id").select(F.col("id").alias("la_id"))
    return chain.table.join(known, "la_id")


def with_external_ids(rows: DataFrame, ext: DataFrame, key: str = "la_id") -> DataFrame:
    """``rows`` LEFT JOIN ``ext`` (key, external_id), written as an inner join plus the
    rows without a match.

    An application may carry very many external scores.  AQE can split a skewed
    partition on both sides of an inner join, but never the non-preserved side
    of an outer join.  Unmatched rows are found against the distinct keys of ``ext``
    (partially aggregated, so a hot key is one row per task); ``rows`` are shuffled
    once for both joins.
    """
    matched = rows.join(ext, key)
    unmatched = rows.join(ext.select(key).distinct(), key, "left_anti").withColumn(
        "external_id", F.lit(None).cast("long")
    )
    return matched.unionByName(unmatched)


def _scored(book: LoanBook, loans: Stored) -> DataFrame:
    """(loan_id, la_id, external_id or NULL) of the loans' facility chain, stored."""
    chain = store(facility_applications(book, loans))
    ext = narrow(book.external_score, "loan_application_id", chain, "la_id").select(
        F.col("loan_application_id").alias("la_id"), F.col("id").alias("external_id")
    )
    return store(with_external_ids(chain.table, ext)).table


def _distinct_rows(roots: DataFrame, children: DataFrame, loans: Stored) -> DataFrame:
    """Distinct rows of both branches.

    Loans beyond the broadcast limit leave the roots partitioned by loan; the children are dealt
    the same way then, so that the distinct needs no shuffle of whole rows.
    """
    return roots.unionByName(children if loans.fits else children.repartition("loan_id")).distinct()


def loan_cohort_v1(book: LoanBook, as_of: date, window: ReportingWindow | NoWindow | None = None) -> DataFrame:
    loans = _window_loans(book, window or previous_month(as_of), F.col("origin_loan_id").isNotNull())
    types = _types(book)
    roots = loans.table.filter("paid_out").withColumnRenamed("original_loan_application_id", "application_id")
    ext = narrow(
        book.external_score, "loan_application_id", loans,
        F.when(F.col("paid_out"), F.col("original_loan_application_id")),
    ).select(F.col("id").alias("external_id"), F.col("loan_application_id").alias("application_id"))
    root_rows = (
        roots.join(ext, "application_id")
        .join(_original_applications(book, loans), "loan_id")
        .join(types, "loan_type_id")
        .select(*V1_COLUMNS)
    )

    parents = store(
        _parents(book, loans).withColumnRenamed("original_loan_application_id", "original_application_id")
    )
    parent_ids = _min_external_id(
        book, parents, F.col("original_application_id"), "original_application_id", "parent_external_id"
    )
    children = loans.table.filter("child").withColumnRenamed("original_loan_application_id", "application_id")
    child_ids = _min_external_id(
        book, loans, F.when(F.col("child"), F.col("original_loan_application_id")),
        "application_id", "child_external_id",
    )
    child_rows = (
        children.join(parents.table.join(parent_ids, "original_application_id"), "origin_loan_id")
        .join(types, "loan_type_id")
        .join(child_ids, "application_id", "left")
        .withColumn("external_id", F.coalesce("child_external_id", "parent_external_id"))
        .select(*V1_COLUMNS)
    )
    return _distinct_rows(root_rows, child_rows, loans)


def loan_cohort_v2(
    book: LoanBook,
    as_of: date,
    window: ReportingWindow | NoWindow | None = None,
    load_dttm: datetime | None = None,
    top_up_type_id: int = TOP_UP_TYPE_ID,
) -> DataFrame:
    """``load_dttm`` defaults to the query's local timestamp (one value per query)."""
    loans = _window_loans(
        book, window or previous_month(as_of), _is_successful() & F.col("origin_loan_id").isNotNull()
    )
    types = _types(book)
    stamp = F.localtimestamp() if load_dttm is None else F.lit(load_dttm).cast("timestamp_ntz")
    # One walk of the facility chain for the window's paid-out loans and the parents of
    # its children (both sets are paid out), with their applications' external ids.
    walked = store(
        loans.table.filter("paid_out").select("loan_id")
        .unionByName(_parents(book, loans).select(F.col("origin_loan_id").alias("loan_id")))
    )
    scored = _scored(book, walked)

    roots = loans.table.filter("paid_out").withColumn(
        "application_id",
        F.when(F.col("loan_type_id") == top_up_type_id, F.col("original_loan_application_id"))
        .otherwise(F.col("loan_application_id")),
    )
    root_rows = (
        roots.join(scored.select("loan_id", "external_id").distinct(), "loan_id")
        .join(_original_applications(book, loans), "loan_id")
        .join(types, "loan_type_id")
        .withColumn("load_dttm", stamp)
        .select(*V2_COLUMNS)
    )

    parent_apps = (
        scored
        .groupBy(F.col("loan_id").alias("origin_loan_id"), F.col("la_id").alias("original_application_id"))
        .agg(F.min("external_id").alias("parent_external_id"))
    )
    child_ids = _min_external_id(
        book, loans, F.when(F.col("child"), F.col("original_loan_application_id")),
        "original_loan_application_id", "child_external_id",
    )
    child_rows = (
        loans.table.filter("child").join(parent_apps, "origin_loan_id")
        .join(types, "loan_type_id")
        .join(child_ids, "original_loan_application_id", "left")
        .withColumn("external_id", F.coalesce("child_external_id", "parent_external_id"))
        .withColumn("application_id", F.col("loan_application_id"))
        .withColumn("load_dttm", stamp)
        .select(*V2_COLUMNS)
    )
    return _distinct_rows(root_rows, child_rows, loans)
