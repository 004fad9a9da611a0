"""

Every query reads the test tables of ``sf_dir`` through the loan-book
mapping (``loanlens.sources.testdata``), runs one report over the whole
book with as-of date 1998-07-01 and returns its DataFrame.  Some run again
at as-of dates inside and at the end of a month, or with typed parameters.  Reports that
read the cohort read it the way the month-end job does: built once from the
book, published as a table in the shared folder, read back.  Money columns
(exact decimals inside the reports) are returned as DOUBLE so both engines
present them alike; ``loanlens.oracle`` holds the matching SQL.
"""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens import oracle
from loanlens.functions.windows import (
    WHOLE_BOOK,
    ReportingWindow,
    reporting_month,
    reporting_month_column,
    window_columns,
)
from loanlens.operators import (
    accepted_applications,
    all_applications_audit,
    all_applications_direct,
    all_applications_facility,
    loan_cohort_v1,
    loan_cohort_v2,
    monthly_payments,
    monthly_payments_by_loan,
    monthly_payments_for_loans,
    monthly_payments_payment_level,
    payment_branch_counts,
    payments_by_loan_backfill,
    payments_for_loans_backfill,
    reconcile,
)
from loanlens.operators.cohort import V1_COLUMNS
from loanlens.operators.payments import LEVEL_COLUMNS
from loanlens.plans.publish import (
    drop_cohort,
    drop_cohort_month,
    publish_cohort,
    read_cohort,
    stored_cohort,
)
from loanlens.plans.stored import drop_stored, store
from loanlens.session import shared_dir
from loanlens.sources.book import BookInUse
from loanlens.sources.replay import book_as_of
from loanlens.sources.testdata import book_from_testdata

AS_OF = date(1998, 7, 1)
LOAD_DTTM = datetime(1998, 7, 1, 0, 0, 0)
# As-of dates inside and at the end of a month, where the three windows differ.
MID_MONTH, MONTH_END = date(1998, 7, 15), date(1997, 3, 31)
# A replay of a month given by its dates, and a list of loans, as a user types them.
REPLAY = ReportingWindow(date(1997, 6, 1), date(1997, 6, 30))
REPLAY_LOANS = tuple(range(1, 20000, 7))
# A year of runs to be made up for, at the first or in the middle of a month.
BACKFILL = tuple(date(1997, m, 1 if m % 2 else 15) for m in range(1, 13))
# What identifies a row of two versions of a report.
COHORT_KEY = ["loan_id", "external_id", "original_application_id"]
LEVEL_KEY = ["Loan_Id", "External_ID", "Original_Application_Id", "Actual_Payment_Date"]
FLAGSHIP_SF = "/root/testdata/sf0.001"


def comparable(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE (presentation for the cross-engine comparison)."""
    return df.select(
        [
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )


_PLANS: dict = {}
_WRITTEN: dict = {}


def forget(spark: SparkSession) -> None:
    """Delete everything that this session's queries wrote, tables included; later queries write anew."""
    for name in _WRITTEN.pop((id(spark), "tables"), []):
        drop_cohort(spark, name)
    drop_stored(spark, *_WRITTEN.pop(id(spark), []))
    _PLANS.clear()


def _book(spark: SparkSession, sf_dir: str):
    """The loan book of ``sf_dir``: derived from the test tables once per session and
    stored as Parquet tables in the session's shared folder, each when a report first
    reads it -- the shape a loan book has in production: one file set per source table,
    filters pushed into its scans."""
    key = ("book", id(spark), sf_dir)
    hit = _PLANS.get(key)
    if hit is None or hit[0] is not spark:
        root = f"{shared_dir(spark)}/loanbook_{uuid.uuid4().hex[:12]}"
        _WRITTEN.setdefault(id(spark), []).append(root)
        hit = _PLANS[key] = (spark, BookInUse.of(book_from_testdata(spark, sf_dir), root))
    return hit[1]


def _published(book, name: str, build):
    """The cohort as the reports read it: published once per book to a table in the
    shared folder (the cut between cohort build and reports), then read back."""
    key = (name, id(book))
    hit = _PLANS.get(key)
    if hit is None or hit[0] is not book:
        spark = book.loan.sparkSession
        table = f"loanlens_{name}_{uuid.uuid4().hex[:12]}"
        month = reporting_month(AS_OF)
        path = f"{shared_dir(spark)}/{table}"
        publish_cohort(build(), table, month, path=path)
        _WRITTEN.setdefault(id(spark), []).append(path)
        _WRITTEN.setdefault((id(spark), "tables"), []).append(table)
        hit = _PLANS[key] = (book, stored_cohort(spark, table, month))
    return hit[1]


def _whole_book_cohort(book):
    return _published(
        book, "cohort_book", lambda: loan_cohort_v2(book, AS_OF, window=WHOLE_BOOK, load_dttm=LOAD_DTTM)
    )


def q_cohort_v1(spark, sf_dir):
    return comparable(loan_cohort_v1(_book(spark, sf_dir), AS_OF))


def q_cohort_v2(spark, sf_dir):
    return comparable(loan_cohort_v2(_book(spark, sf_dir), AS_OF, load_dttm=LOAD_DTTM))


def q_cohort_v2_whole_book(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(loan_cohort_v2(book, AS_OF, window=WHOLE_BOOK, load_dttm=LOAD_DTTM))


def q_accepted_applications(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(accepted_applications(_month_cohort(book), book.loan_payment, AS_OF))


def q_applications_direct(spark, sf_dir):
    return comparable(all_applications_direct(_book(spark, sf_dir), AS_OF))


def q_applications_facility(spark, sf_dir):
    return comparable(all_applications_facility(_book(spark, sf_dir), AS_OF))


def q_applications_audit(spark, sf_dir):
    return comparable(all_applications_audit(_book(spark, sf_dir), AS_OF))


def q_payments_level_b(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(monthly_payments(_whole_book_cohort(book), book.loan_payment, AS_OF))


def q_payments_level_c(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(monthly_payments_payment_level(_whole_book_cohort(book), book, AS_OF))


def q_payments_by_loan(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(monthly_payments_by_loan(_whole_book_cohort(book), book.loan_payment, AS_OF))


def q_payments_by_loan_null_safe(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(
        monthly_payments_by_loan(_whole_book_cohort(book), book.loan_payment, AS_OF, null_safe_least=True)
    )


def _month_cohort(book):
    return _published(book, "cohort_month", lambda: loan_cohort_v2(book, AS_OF, load_dttm=LOAD_DTTM))


def q_payments_level_b_month_cohort(spark, sf_dir):
    """Payment level on the previous month's cohort (the reports' default use)."""
    book = _book(spark, sf_dir)
    return comparable(monthly_payments(_month_cohort(book), book.loan_payment, AS_OF))


def q_payments_by_loan_month_cohort(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(monthly_payments_by_loan(_month_cohort(book), book.loan_payment, AS_OF))


def q_payments_for_loans(spark, sf_dir):
    return comparable(monthly_payments_for_loans(_book(spark, sf_dir), AS_OF))


def q_payment_branch_counts(spark, sf_dir):
    return payment_branch_counts(_book(spark, sf_dir), AS_OF)


def q_reporting_windows(spark, sf_dir):
    as_of = F.col("as_of")
    cols = [as_of]
    for kind in "ABC":
        s, e = window_columns(as_of, kind)
        cols += [s.alias(f"{kind.lower()}_start"), e.alias(f"{kind.lower()}_end")]
    cols.append(reporting_month_column(as_of).alias("reporting_month"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(F.to_date("o_orderdate").alias("as_of")).distinct().select(*cols)


def q_cohort_publish_roundtrip(spark, sf_dir):
    """Publish the month's cohort twice (idempotent) into a table in the shared folder, read it back."""
    book = _book(spark, sf_dir)
    cohort = loan_cohort_v2(book, AS_OF, load_dttm=LOAD_DTTM)
    suffix = uuid.uuid4().hex[:12]
    table = f"loanlens_cohort_{suffix}"
    path = f"{shared_dir(spark)}/cohort_{suffix}"
    month = reporting_month(AS_OF)
    publish_cohort(cohort, table, month, path=path)
    publish_cohort(cohort, table, month, path=path)
    _WRITTEN.setdefault(id(spark), []).append(path)
    _WRITTEN.setdefault((id(spark), "tables"), []).append(table)
    return comparable(read_cohort(spark, table, month))


def q_cohort_drop(spark, sf_dir):
    """Publish two months, drop one of them, then the table; what could be read after each step."""
    book = _book(spark, sf_dir)
    suffix = uuid.uuid4().hex[:12]
    table, path = f"loanlens_drop_{suffix}", f"{shared_dir(spark)}/drop_{suffix}"
    for as_of in (AS_OF, MONTH_END):
        publish_cohort(loan_cohort_v2(book, as_of, load_dttm=LOAD_DTTM), table, reporting_month(as_of), path=path)
    _WRITTEN.setdefault(id(spark), []).append(path)
    drop_cohort_month(spark, table, reporting_month(AS_OF))
    left = spark.table(table).groupBy("reporting_month").agg(F.count(F.lit(1)).alias("n_loans"))
    left = store(left).table
    drop_cohort(spark, table)
    gone = F.lit(not spark.catalog.tableExists(table))
    return left.withColumn("table_dropped", gone)


def _report(operator, as_of, **parameters):
    """A query that runs a report of the book at another as-of date or with typed parameters."""
    def query(spark, sf_dir):
        return comparable(operator(_book(spark, sf_dir), as_of, **parameters))
    return query


def _cohort_report(operator, as_of):
    """A query that runs a payment report on the whole-book cohort at another as-of date."""
    def query(spark, sf_dir):
        book = _book(spark, sf_dir)
        return comparable(operator(_whole_book_cohort(book), book.loan_payment, as_of))
    return query


def _as_it_stood(operator, as_of, **parameters):
    """A query that runs a report at a past date on the book as it stood then."""
    def query(spark, sf_dir):
        return comparable(operator(book_as_of(_book(spark, sf_dir), as_of), as_of, **parameters))
    return query


def q_payments_for_loans_backfill(spark, sf_dir):
    """Twelve past runs of the report in one pass over the payments."""
    return comparable(payments_for_loans_backfill(_book(spark, sf_dir), BACKFILL))


def q_payments_by_loan_backfill(spark, sf_dir):
    book = _book(spark, sf_dir)
    return comparable(payments_by_loan_backfill(_whole_book_cohort(book), book.loan_payment, BACKFILL))


def q_cohort_versions_reconciled(spark, sf_dir):
    """Where the cohort through facilities differs from the direct one, on the whole book."""
    book = _book(spark, sf_dir)
    return reconcile(loan_cohort_v1(book, AS_OF, window=WHOLE_BOOK), _whole_book_cohort(book).table, COHORT_KEY, _beside(V1_COLUMNS, COHORT_KEY),
                     by="loan_id")


def q_payment_levels_reconciled(spark, sf_dir):
    """Where the payment-level report on window C differs from the one on window B."""
    book = _book(spark, sf_dir)
    cohort = _whole_book_cohort(book)
    return reconcile(monthly_payments(cohort, book.loan_payment, AS_OF), monthly_payments_payment_level(cohort, book, AS_OF),
                     LEVEL_KEY, _beside(LEVEL_COLUMNS, LEVEL_KEY))


def _beside(columns: list[str], keys: list[str]) -> list[str]:
    return [c for c in columns if c not in keys]


def q_accepted_month_end(spark, sf_dir):
    book = _book(spark, sf_dir)
    cohort = loan_cohort_v2(book, MONTH_END, load_dttm=LOAD_DTTM)
    return comparable(accepted_applications(cohort, book.loan_payment, MONTH_END))


def _optional(module: str):
    """A module of the training-data subpackage, or None where that is not installed."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name not in {module, "loanlens.llm"}:
            raise
        return None


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline."""
    found, sql = {}, {}
    if operators := _optional("loanlens.llm.queries"):
        found |= operators.queries()
        sql |= operators.oracle_sql()
    if operators and (pipeline := _optional("corpus_pipeline")):
        found["pipeline"] = pipeline.run
        if pipeline.ORACLE_SQL:
            sql["pipeline"] = pipeline.ORACLE_SQL
    return found, sql


def training_data_names() -> set[str]:
    """Names of the queries that come from the training-data subpackage."""
    return set(_training_data()[0])


# What several reports read, made once per session: name -> maker.
SETUP: dict[str, Callable] = {
    "loan_book": lambda spark, sf_dir: _book(spark, sf_dir).tables(),
    "cohort_book": lambda spark, sf_dir: _whole_book_cohort(_book(spark, sf_dir)),
    "cohort_month": lambda spark, sf_dir: _month_cohort(_book(spark, sf_dir)),
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-loan monthly payment sums of the whole-book cohort at sf0.001.

    Runs straight on the mapped test tables (no stored copy of the book), so the
    smoke check does not pay for writing the book first.
    """
    book = book_from_testdata(spark, FLAGSHIP_SF)
    cohort = loan_cohort_v2(book, AS_OF, window=WHOLE_BOOK, load_dttm=LOAD_DTTM)
    return comparable(monthly_payments_by_loan(cohort, book.loan_payment, AS_OF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cohort_v1": q_cohort_v1,
        "cohort_v2": q_cohort_v2,
        "cohort_v2_whole_book": q_cohort_v2_whole_book,
        "accepted_applications": q_accepted_applications,
        "applications_direct": q_applications_direct,
        "applications_facility": q_applications_facility,
        "applications_audit": q_applications_audit,
        "payments_level_b": q_payments_level_b,
        "payments_level_c": q_payments_level_c,
        "payments_by_loan": q_payments_by_loan,
        "payments_by_loan_null_safe": q_payments_by_loan_null_safe,
        "payments_level_b_month_cohort": q_payments_level_b_month_cohort,
        "payments_by_loan_month_cohort": q_payments_by_loan_month_cohort,
        "payments_for_loans": q_payments_for_loans,
        "payment_branch_counts": q_payment_branch_counts,
        "reporting_windows": q_reporting_windows,
        "cohort_publish_roundtrip": q_cohort_publish_roundtrip,
        "cohort_drop": q_cohort_drop,
        "cohort_v1_mid_month": _report(loan_cohort_v1, MID_MONTH),
        "cohort_v2_month_end": _report(loan_cohort_v2, MONTH_END, load_dttm=LOAD_DTTM),
        "accepted_applications_month_end": q_accepted_month_end,
        "applications_direct_mid_month": _report(all_applications_direct, MID_MONTH),
        "applications_facility_month_end": _report(all_applications_facility, MONTH_END),
        "applications_audit_replay": _report(all_applications_audit, AS_OF, window=REPLAY),
        "payments_level_b_mid_month": _cohort_report(monthly_payments, MID_MONTH),
        "payments_by_loan_month_end": _cohort_report(monthly_payments_by_loan, MONTH_END),
        "payments_for_loans_mid_month": _report(monthly_payments_for_loans, MID_MONTH),
        "payments_for_given_loans": _report(monthly_payments_for_loans, MONTH_END, loan_ids=REPLAY_LOANS),
        "payments_for_loans_backfill": q_payments_for_loans_backfill,
        "payments_by_loan_backfill": q_payments_by_loan_backfill,
        "cohort_v2_as_it_stood": _as_it_stood(loan_cohort_v2, MONTH_END, load_dttm=LOAD_DTTM),
        "applications_facility_as_it_stood": _as_it_stood(all_applications_facility, MONTH_END),
        "payments_for_loans_as_it_stood": _as_it_stood(monthly_payments_for_loans, MONTH_END),
        "cohort_versions_reconciled": q_cohort_versions_reconciled,
        "payment_levels_reconciled": q_payment_levels_reconciled,
    } | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    cohort_v2 = oracle.cohort_v2_sql(AS_OF, LOAD_DTTM)
    replay = oracle.typed(REPLAY.start, REPLAY.end)
    with oracle.as_it_stood(MONTH_END):
        stood = {
            "cohort_v2_as_it_stood": oracle.cohort_v2_sql(MONTH_END, LOAD_DTTM),
            "applications_facility_as_it_stood": oracle.applications_facility_sql(MONTH_END),
            "payments_for_loans_as_it_stood": oracle.payments_for_loans_sql(MONTH_END),
        }
    return stood | {
        "cohort_v1": oracle.cohort_v1_sql(AS_OF),
        "cohort_v2": cohort_v2,
        "cohort_v2_whole_book": oracle.cohort_v2_sql(AS_OF, LOAD_DTTM, whole_book=True),
        "accepted_applications": oracle.accepted_sql(AS_OF, LOAD_DTTM),
        "applications_direct": oracle.applications_direct_sql(AS_OF),
        "applications_facility": oracle.applications_facility_sql(AS_OF),
        "applications_audit": oracle.applications_audit_sql(AS_OF),
        "payments_level_b": oracle.payments_level_sql(AS_OF, LOAD_DTTM, "B"),
        "payments_level_c": oracle.payments_level_sql(AS_OF, LOAD_DTTM, "C"),
        "payments_by_loan": oracle.payments_by_loan_sql(AS_OF, LOAD_DTTM),
        "payments_by_loan_null_safe": oracle.payments_by_loan_sql(AS_OF, LOAD_DTTM, null_safe=True),
        "payments_level_b_month_cohort": oracle.payments_level_sql(AS_OF, LOAD_DTTM, "B", month_cohort=True),
        "payments_by_loan_month_cohort": oracle.payments_by_loan_sql(AS_OF, LOAD_DTTM, month_cohort=True),
        "payments_for_loans": oracle.payments_for_loans_sql(AS_OF),
        "payment_branch_counts": oracle.payment_branch_counts_sql(AS_OF),
        "reporting_windows": oracle.reporting_windows_sql(),
        "cohort_publish_roundtrip": cohort_v2,
        "cohort_drop": oracle.cohort_drop_sql(MONTH_END, LOAD_DTTM),
        "cohort_v1_mid_month": oracle.cohort_v1_sql(MID_MONTH),
        "cohort_v2_month_end": oracle.cohort_v2_sql(MONTH_END, LOAD_DTTM),
        "accepted_applications_month_end": oracle.accepted_sql(MONTH_END, LOAD_DTTM),
        "applications_direct_mid_month": oracle.applications_direct_sql(MID_MONTH),
        "applications_facility_month_end": oracle.applications_facility_sql(MONTH_END),
        "applications_audit_replay": oracle.applications_audit_sql(AS_OF, replay),
        "payments_level_b_mid_month": oracle.payments_level_sql(MID_MONTH, LOAD_DTTM, "B"),
        "payments_by_loan_month_end": oracle.payments_by_loan_sql(MONTH_END, LOAD_DTTM),
        "payments_for_loans_mid_month": oracle.payments_for_loans_sql(MID_MONTH),
        "payments_for_loans_backfill": oracle.every(BACKFILL, oracle.payments_for_loans_sql),
        "payments_by_loan_backfill": oracle.every(BACKFILL, lambda day: oracle.payments_by_loan_sql(day, LOAD_DTTM)),
        "cohort_versions_reconciled": oracle.reconcile_sql(
            oracle.cohort_v1_sql(AS_OF, whole_book=True), oracle.cohort_v2_sql(AS_OF, LOAD_DTTM, whole_book=True),
            COHORT_KEY, _beside(V1_COLUMNS, COHORT_KEY)),
        "payment_levels_reconciled": oracle.reconcile_sql(
            oracle.payments_level_sql(AS_OF, LOAD_DTTM, "B"), oracle.payments_level_sql(AS_OF, LOAD_DTTM, "C"),
            LEVEL_KEY, _beside(LEVEL_COLUMNS, LEVEL_KEY)),
        "payments_for_given_loans": oracle.payments_for_loans_sql(MONTH_END, REPLAY_LOANS),
    } | _training_data()[1]
