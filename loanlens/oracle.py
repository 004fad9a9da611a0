"""Independent DuckDB SQL for every registered report (the correctness oracle).

Each report is a chain of named steps over the loan book: live rows, classified dates, links,
decisions, then one row per group by ``DISTINCT ON`` with the documented pick order.  The
Spark operators reach the same rows by another route (stored key sets, aggregation
before joins), so agreement checks those.  Windows are worked out in SQL from the as-of date.

Rounded money uses exact integer arithmetic here (DuckDB divides decimals
in floating point).  Money columns are returned as DOUBLE, as the Spark side
returns them for comparison.

``MAPPING_SQL`` derives the loan book from the TPC-H-style tables exactly as
``loanlens.sources.testdata`` does.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from contextlib import contextmanager
from datetime import date, datetime

MAPPING_SQL = """
loan_application AS (
  SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount_of_credit,
         CASE WHEN o_orderkey % 41 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS deleted_at
  FROM orders),
external_score AS (
  SELECT o_orderkey + 1000000 AS id, o_orderkey AS loan_application_id FROM orders WHERE o_orderkey % 9 <> 0
  UNION ALL
  SELECT o_orderkey + 5000000 AS id, o_orderkey AS loan_application_id FROM orders WHERE o_orderkey % 50 = 1),
credit_score AS (
  SELECT o_orderkey + 2000000 AS id, o_orderkey AS loan_application_id,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 58 WHEN '2-HIGH' THEN 59 WHEN '3-MEDIUM' THEN 60
              WHEN '4-NOT SPECIFIED' THEN 61 WHEN '5-LOW' THEN 62 END AS INTEGER) AS credit_score_config_id,
         CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER) AS TIMESTAMP) AS created_at
  FROM orders),
credit_score_config AS (
  SELECT CAST(id AS INTEGER) AS id, CAST(scorecard_type_id AS INTEGER) AS scorecard_type_id
  FROM (VALUES (58, 796), (59, 959), (60, 960), (61, 500), (62, 501)) t(id, scorecard_type_id)),
facility AS (
  SELECT o_orderkey + 3000000 AS id, o_orderkey + 2000000 AS credit_score_id,
         CAST(CAST(o_orderdate AS DATE)
              + CAST(o_orderkey % 4 + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS INTEGER) AS TIMESTAMP) AS created_at
  FROM orders WHERE o_orderkey % 6 <> 0),
facility_has_loan AS (
  SELECT o_orderkey + 3000000 AS facility_id, o_orderkey AS loan_id
  FROM orders WHERE o_orderkey % 6 <> 0 AND o_orderkey % 5 <> 0),
loan_type AS (
  SELECT CAST(id AS INTEGER) AS id, name
  FROM (VALUES (751, 'Instalment'), (752, 'Extension'), (753, 'Repayment plan'), (754, 'Renewal'),
               (756, 'Top up')) t(id, name)),
loan AS (
  SELECT o_orderkey AS id, o_orderkey AS loan_application_id,
         CASE WHEN o_orderkey % 7 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 ELSE o_orderkey END AS original_loan_application_id,
         CASE WHEN o_orderkey % 7 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 END AS origin_loan_id,
         CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 751 WHEN '2-HIGH' THEN 752 WHEN '3-MEDIUM' THEN 753
              WHEN '4-NOT SPECIFIED' THEN 754 WHEN '5-LOW' THEN 756 END AS INTEGER) AS loan_type_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS principal,
         CAST(o_orderkey % 500 AS DECIMAL(18,2)) AS initial_interest,
         CAST(o_orderkey % 90 + 10 AS DECIMAL(9,2)) AS annual_percentage_rate,
         CAST(CASE WHEN o_orderkey % 97 = 1 THEN 0 ELSE o_orderkey % 12 + 1 END AS INTEGER) AS no_of_payments,
         CAST(o_orderdate AS TIMESTAMP) AS created_at,
         CASE WHEN o_orderkey % 13 <> 0
              THEN CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER) AS TIMESTAMP) END AS issued_at,
         CASE WHEN o_orderkey % 17 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS cancelled_at,
         CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS declined_at,
         CASE WHEN o_orderkey % 23 = 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS deleted_at,
         CASE WHEN o_orderkey % 8 = 1 THEN CAST(CAST(o_orderdate AS DATE) + 400 AS TIMESTAMP) END AS topped_up_at,
         CASE WHEN o_orderkey % 8 = 2 THEN CAST(CAST(o_orderdate AS DATE) + 400 AS TIMESTAMP) END AS extended_at,
         CASE WHEN o_orderkey % 8 IN (1, 3) THEN CAST(CAST(o_orderdate AS DATE) + 200 AS TIMESTAMP) END AS arranged_rp_at
  FROM orders WHERE o_orderkey % 5 <> 0),
loan_payment AS (
  SELECT l_orderkey AS loan_id,
         CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS INTEGER) AS is_first_payment,
         CAST(l_shipdate AS DATE) AS actual_payment_date,
         CASE l_returnflag WHEN 'A' THEN CAST(l_shipdate AS DATE) - CAST(l_quantity AS INTEGER)
                           WHEN 'R' THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS paid_at_date,
         CASE WHEN l_partkey % 43 <> 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS principal,
         CASE WHEN l_suppkey % 9 <> 0 THEN CAST(l_quantity AS DECIMAL(18,2)) END AS interest,
         CAST(l_linenumber AS DECIMAL(18,2)) AS fees,
         CAST(CASE WHEN l_partkey % 10 = 0 THEN 25 ELSE 0 END AS DECIMAL(18,2)) AS penalty,
         CAST(-(l_partkey % 5) AS DECIMAL(18,2)) AS discount,
         CAST(l_quantity * 100 AS DECIMAL(18,2)) AS balance_left,
         CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS principal_paid,
         CASE WHEN l_suppkey % 9 = 1 THEN NULL WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(18,2))
              ELSE CAST(l_quantity AS DECIMAL(18,2)) END AS interest_paid,
         CASE WHEN l_returnflag = 'N' THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(l_linenumber AS DECIMAL(18,2)) END AS fees_paid,
         CAST(CASE WHEN l_partkey % 20 = 0 AND l_returnflag <> 'N' THEN 25 ELSE 0 END AS DECIMAL(18,2)) AS penalty_paid,
         CASE WHEN l_partkey % 29 = 0 THEN CAST(l_shipdate AS TIMESTAMP) END AS deleted_at
  FROM lineitem),
financial_information AS (
  SELECT c_custkey AS customer_id, CAST(c_acctbal AS DECIMAL(18,2)) AS total_monthly_income,
         CAST(c_nationkey * 10 AS DECIMAL(18,2)) AS total_monthly_expenses,
         CASE WHEN c_custkey % 31 = 0 THEN TIMESTAMP '1995-01-01 00:00:00' END AS deleted_at
  FROM customer)
"""


_MAPPING = {"on": True, "as_of": None}


@contextmanager
def over_book_tables():
    """Build SQL that reads tables named like the loan book directly (no test-table mapping)."""
    _MAPPING["on"] = False
    try:
        yield
    finally:
        _MAPPING["on"] = True


@contextmanager
def as_it_stood(day: date):
    """Build SQL that sees the book as it stood at the end of ``day``."""
    _MAPPING["as_of"] = day
    try:
        yield
    finally:
        _MAPPING["as_of"] = None


def _until(day: date) -> list[str]:
    """The book's tables without what came after ``day``."""
    by = lambda c: f"CAST({c} AS DATE) <= DATE '{day.isoformat()}'"
    undone = lambda *cs: ", ".join(f"CASE WHEN {by(c)} THEN {c} END AS {c}" for c in cs)
    paid = ", ".join(f"CASE WHEN paid_at_date > DATE '{day.isoformat()}' AND {c} IS NOT NULL THEN 0 ELSE {c} END AS {c}"
                     for c in ("principal_paid", "interest_paid", "fees_paid", "penalty_paid"))
    existing = f"WHERE created_at IS NULL OR {by('created_at')}"
    view = {
        "loan_application": f"* REPLACE ({undone('deleted_at')}) {{}} {existing}",
        "credit_score": f"* {{}} {existing}",
        "facility": f"* {{}} {existing}",
        "loan": f"* REPLACE ({undone('issued_at', 'cancelled_at', 'declined_at', 'deleted_at', 'topped_up_at', 'extended_at', 'arranged_rp_at')}) {{}} {existing}",
        "loan_payment": f"* REPLACE ({undone('deleted_at', 'paid_at_date')}, {paid}) {{}}",
        "financial_information": f"* REPLACE ({undone('deleted_at')}) {{}}",
        "external_score": "* {}", "credit_score_config": "* {}", "facility_has_loan": "* {}", "loan_type": "* {}",
    }
    now = "now_" if _MAPPING["on"] else "main."
    return [f"{name} AS (SELECT {sql.format(f'FROM {now}{name}')})" for name, sql in view.items()]


def _steps(*ctes: str) -> str:
    day, mapping = _MAPPING["as_of"], MAPPING_SQL.strip()
    if day:
        mapping = re.sub(r"^(\w+) AS \(", r"now_\1 AS (", mapping, flags=re.M)
    parts = ([mapping] if _MAPPING["on"] else []) + (_until(day) if day else []) + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n"


# A window is a pair of SQL dates, both inclusive; None takes every row.
Bounds = tuple[str, str] | None


def bounds(as_of: date, kind: str) -> Bounds:
    """Window A (previous calendar month), B (rolling month) or C (rolling month, a day earlier) of an as-of date."""
    day = f"DATE '{as_of.isoformat()}'"
    eve = f"({day} - INTERVAL 1 DAY)"
    first, last = {
        "A": (f"date_trunc('month', {day} - INTERVAL 1 MONTH)", f"last_day({day} - INTERVAL 1 MONTH)"),
        "B": (f"{day} - INTERVAL 1 MONTH", eve),
        "C": (f"{eve} - INTERVAL 1 MONTH", eve),
    }[kind]
    return f"CAST({first} AS DATE)", f"CAST({last} AS DATE)"


def typed(first: date, last: date) -> Bounds:
    """A window given by its dates (a replay)."""
    return f"DATE '{first.isoformat()}'", f"DATE '{last.isoformat()}'"


def _within(column: str, window: Bounds) -> str:
    return "true" if window is None else f"CAST({column} AS DATE) BETWEEN {window[0]} AND {window[1]}"


def _month_label(as_of: date) -> str:
    return f"strftime(DATE '{as_of.isoformat()}', '%Y-%m-01')"


# ---- cohorts ---------------------------------------------------------------------------------

PAID_OUT = """paid_out AS (
  SELECT * FROM loan WHERE issued_at IS NOT NULL AND coalesce(cancelled_at, declined_at) IS NULL)"""

ANCHORED = """anchored AS (
  SELECT DISTINCT coalesce(origin_loan_id, id) AS anchor, original_loan_application_id AS anchor_application
  FROM loan WHERE deleted_at IS NULL)"""

LEAST_SCORE = """least_score AS (
  SELECT loan_application_id AS scored_application, min(id) AS score FROM external_score GROUP BY 1)"""

FACILITY_PATH = """facility_path AS (
  SELECT DISTINCT b.loan_id AS path_loan, s.loan_application_id AS path_application
  FROM credit_score s, facility f, facility_has_loan b
  WHERE f.credit_score_id = s.id AND b.facility_id = f.id
    AND date_diff('day', s.created_at, f.created_at) = 0
    AND s.credit_score_config_id IN (SELECT id FROM credit_score_config)
    AND s.loan_application_id IN (SELECT id FROM loan_application))"""

PATH_SCORE = """path_score AS (
  SELECT path_loan, path_application, x.id AS score
  FROM facility_path LEFT JOIN external_score x ON x.loan_application_id = path_application)"""

COHORT_MONEY = ["principal", "initial_interest", "annual_percentage_rate"]
ATTRIBUTES = ", ".join(
    ["issued_at", "created_at", *COHORT_MONEY, "no_of_payments",
     *(f"CAST({c} AS DATE) AS {c}" for c in ("topped_up_at", "extended_at", "arranged_rp_at"))])


def _union(name: str, roots: str, children: str, stamp: str = "") -> str:
    """Both branches (loan columns plus kind name, external id and the two applications), without repeats."""
    columns = f"""id AS loan_id, name AS loan_type, external_id, application_id, original_application_id,
    {', '.join('q.' + a if not a.startswith('CAST(') else a.replace('CAST(', 'CAST(q.') for a in ATTRIBUTES.split(', '))}{stamp}"""
    return f"""{name} AS (
  SELECT DISTINCT {columns}
  FROM (SELECT * FROM {roots} UNION ALL SELECT * FROM {children}) q
  JOIN (SELECT id AS kind, name FROM loan_type) t ON t.kind = q.loan_type_id)"""


def _cohort_v1(window: Bounds, name: str = "cohort") -> str:
    return ",\n".join([PAID_OUT, ANCHORED, LEAST_SCORE, f"""scored_roots AS (
  SELECT p.*, x.id AS external_id, p.original_loan_application_id AS application_id, anchor_application AS original_application_id
  FROM paid_out p, external_score x, anchored
  WHERE {_within('p.created_at', window)} AND x.loan_application_id = p.original_loan_application_id AND anchor = p.id)""", f"""scored_children AS (
  SELECT kid.*, coalesce(own.score, parents.score) AS external_id, kid.original_loan_application_id AS application_id,
         parent.original_loan_application_id AS original_application_id
  FROM loan kid
  JOIN paid_out parent ON parent.id = kid.origin_loan_id
  JOIN least_score parents ON parents.scored_application = parent.original_loan_application_id
  LEFT JOIN least_score own ON own.scored_application = kid.original_loan_application_id
  WHERE {_within('kid.created_at', window)})""", _union(name, "scored_roots", "scored_children")])


def _cohort_v2(window: Bounds, load_dttm: datetime, name: str = "cohort") -> str:
    stamp = f", TIMESTAMP '{load_dttm.isoformat(sep=' ')}' AS load_dttm"
    return ",\n".join([PAID_OUT, ANCHORED, LEAST_SCORE, FACILITY_PATH, PATH_SCORE, f"""linked_roots AS (
  SELECT p.*, s.score AS external_id, if(p.loan_type_id = 756, p.original_loan_application_id, p.loan_application_id) AS application_id,
         anchor_application AS original_application_id
  FROM paid_out p, path_score s, anchored
  WHERE {_within('p.created_at', window)} AND s.path_loan = p.id AND anchor = p.id)""", f"""parent_path AS (
  SELECT path_loan, path_application, min(score) AS score FROM path_score
  WHERE path_loan IN (SELECT id FROM paid_out) GROUP BY ALL)""", f"""linked_children AS (
  SELECT kid.*, coalesce(own.score, up.score) AS external_id, kid.loan_application_id AS application_id,
         up.path_application AS original_application_id
  FROM paid_out kid
  JOIN parent_path up ON up.path_loan = kid.origin_loan_id
  LEFT JOIN least_score own ON own.scored_application = kid.original_loan_application_id
  WHERE {_within('kid.created_at', window)})""", _union(name, "linked_roots", "linked_children", stamp)])


def _cohort_out(steps: str) -> str:
    doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in COHORT_MONEY)
    return _steps(steps) + f"SELECT * REPLACE ({doubles}) FROM cohort"


def cohort_v1_sql(as_of: date, whole_book: bool = False) -> str:
    return _cohort_out(_cohort_v1(None if whole_book else bounds(as_of, "A")))


def cohort_v2_sql(as_of: date, load_dttm: datetime, whole_book: bool = False) -> str:
    return _cohort_out(_cohort_v2(None if whole_book else bounds(as_of, "A"), load_dttm))


def cohort_drop_sql(kept: date, load_dttm: datetime) -> str:
    """What a published table holds once another month than ``kept`` is dropped."""
    return _steps(_cohort_v2(bounds(kept, "A"), load_dttm)) + (
        f"SELECT {_month_label(kept)} AS reporting_month, count(*) AS n_loans, true AS table_dropped FROM cohort HAVING count(*) > 0")


# ---- accepted applications -------------------------------------------------------------------


def _round_cents(num4: str, den: str) -> str:
    """round(num4 / 10000 / den, 2) half away from zero, exactly, as DOUBLE.  num4 in 1e-4 units."""
    d = f"(CAST({den} AS HUGEINT) * 100)"
    return f"(CAST(sign({num4}) * ((abs({num4}) * 2 + {d}) // (2 * {d})) AS DOUBLE) / 100)"


def accepted_sql(as_of: date, load_dttm: datetime) -> str:
    """Total repayable = principal + interest - rate / 365.25 / 100 * principal * days, in exact integers."""
    month = bounds(as_of, "A")
    return _steps(_cohort_v2(month, load_dttm), f"""amounts AS (
  SELECT *, CAST(principal * 100 AS HUGEINT) AS cents, CAST(initial_interest * 100 AS HUGEINT) AS interest_cents,
         CAST(annual_percentage_rate * 100 AS HUGEINT) AS rate_cents, date_diff('day', issued_at, created_at) AS days
  FROM cohort WHERE {_within('created_at', month)})""", """repayable AS (
  SELECT *, (cents + interest_cents) * 3652500 - rate_cents * cents * days AS total FROM amounts)""", """first_due AS (
  SELECT loan_id AS of_loan, actual_payment_date AS first_day FROM loan_payment WHERE is_first_payment = 1 AND deleted_at IS NULL)""") + f"""
SELECT DISTINCT loan_id AS Loan_ID, external_id AS External_ID, application_id AS Application_ID,
  original_application_id AS Original_Application_ID, issued_at AS Date_of_Approval, CAST(principal AS DOUBLE) AS Issued_Amount,
  first_day AS First_payment_date, no_of_payments AS Number_of_Payments,
  CASE WHEN no_of_payments <> 0 THEN {_round_cents('total', '36525 * no_of_payments')} END AS Each_payment_avg,
  {_round_cents('total', '36525')} AS Total_Repayable, loan_type AS Type_of_Loan
FROM repayable JOIN first_due ON of_loan = loan_id"""


# ---- decisions -------------------------------------------------------------------------------

LOAN_RESULT = """loan_result AS (
  SELECT id AS result_loan, original_loan_application_id AS result_application, declined_at IS NOT NULL AS refused,
         loan_application_id IS NOT NULL AND issued_at IS NOT NULL AND coalesce(cancelled_at, declined_at) IS NULL AS won
  FROM loan WHERE deleted_at IS NULL)"""

# Through the bridge a facility has one result for each of its links, and an empty one without links.
FACILITY_RESULT = """facility_result AS (
  SELECT f.credit_score_id AS facility_score, r.won, r.refused
  FROM facility f LEFT JOIN (facility_has_loan b LEFT JOIN loan_result r ON r.result_loan = b.loan_id) ON b.facility_id = f.id)"""


def _scored(window: Bounds, condition: str) -> str:
    return f"""scored AS (
  SELECT s.id AS score_id, s.loan_application_id AS application, s.created_at AS scored_at, k.id AS model, k.scorecard_type_id
  FROM credit_score s, credit_score_config k
  WHERE k.id = s.credit_score_config_id AND {condition} AND {_within('s.created_at', window)})"""


def _decided(links: str) -> str:
    """``links`` has an application's columns, whether there is a facility, and the loan's result."""
    return f"""decided AS (
  SELECT *, if(coalesce(won, false), 'A', 'R') AS final_decision,
         CASE WHEN NOT has_facility OR coalesce(refused, false) THEN 'Declined' WHEN won THEN 'Accepted'
              ELSE 'Withdrawn by Customer' END AS rejection_reason
  FROM {links})"""


INCOME = """income AS (
  SELECT customer_id AS of_customer, total_monthly_expenses, total_monthly_income FROM financial_information WHERE deleted_at IS NULL)"""


def _decision_rows(group: str, order: str, extra: str = "") -> str:
    money = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in ("applied_amount", "total_monthly_expenses", "total_monthly_income"))
    return f"""SELECT external_id, id, created_at, {extra}final_decision, rejection_reason, {money} FROM (
  SELECT DISTINCT ON ({group}) * FROM decided {{external}} LEFT JOIN income ON of_customer = customer_id
  ORDER BY {group}, {order}, total_monthly_expenses NULLS LAST, total_monthly_income NULLS LAST)"""


EXTERNAL = "(SELECT id AS external_id, loan_application_id AS of_application FROM external_score) ON of_application = id"
GRAIN = "id, created_at, final_decision, rejection_reason"


def applications_direct_sql(as_of: date, window: Bounds = None) -> str:
    links = """links AS (
  SELECT a.id, a.created_at, a.customer_id, a.amount_of_credit AS applied_amount, won, refused,
         score_id IN (SELECT credit_score_id FROM facility WHERE credit_score_id IS NOT NULL) AS has_facility
  FROM scored JOIN loan_application a ON a.id = application LEFT JOIN loan_result ON result_application = a.id
  WHERE a.deleted_at IS NULL)"""
    return _steps(_scored(window or bounds(as_of, "A"), "k.id = 58"), LOAN_RESULT, links, _decided("links"), INCOME) + _decision_rows(
        GRAIN, "external_id NULLS LAST").format(external=f"JOIN {EXTERNAL}")


def _facility_links() -> str:
    return """links AS (
  SELECT a.id, a.created_at, a.customer_id, a.amount_of_credit AS applied_amount, won, refused, model, scorecard_type_id,
         facility_score IS NOT NULL AS has_facility, date_diff('day', a.created_at, scored_at) AS lag_days
  FROM scored JOIN loan_application a ON a.id = application LEFT JOIN facility_result ON facility_score = score_id)"""


def applications_facility_sql(as_of: date, window: Bounds = None) -> str:
    return _steps(_scored(window or bounds(as_of, "A"), "true"), LOAN_RESULT, FACILITY_RESULT, _facility_links(),
                  _decided("links"), INCOME) + _decision_rows(
        GRAIN, "external_id NULLS LAST").format(external=f"LEFT JOIN {EXTERNAL}")


def applications_audit_sql(as_of: date, window: Bounds = None) -> str:
    steps = _steps(_scored(window or bounds(as_of, "A"), "k.scorecard_type_id IN (796, 959, 960)"), LOAN_RESULT, FACILITY_RESULT,
                   _facility_links(), _decided("(SELECT * FROM links WHERE lag_days <= 1)"), INCOME)
    rows = _decision_rows(f"external_id, {GRAIN}", "scorecard_type_id NULLS LAST, lag_days NULLS LAST", "scorecard_type_id, ")
    return steps + rows.format(external=f"LEFT JOIN {EXTERNAL} AND model = 58") + """
ORDER BY lag_days DESC, id, external_id NULLS FIRST, final_decision, rejection_reason"""


# ---- payments --------------------------------------------------------------------------------


def _dated(window: Bounds) -> str:
    """Live payments with where their due and paid dates lie: before, in or after the window, or none."""
    def place(column: str) -> str:
        return (f"CASE WHEN {column} IS NULL THEN 'none' WHEN {column} < {window[0]} THEN 'before' "
                f"WHEN {column} > {window[1]} THEN 'after' ELSE 'in' END")

    return f"""dated AS (
  SELECT *, loan_id AS paid_loan, {place('actual_payment_date')} AS due_at, {place('paid_at_date')} AS paid_at
  FROM loan_payment WHERE deleted_at IS NULL)"""


# Which (due, paid) places each rule takes as they are, and which it takes
# only when the day named is not after the loan's superseded date.
LEVEL_RULE = ("('after', 'in'), ('before', 'none')", "('in', 'none'), ('in', 'in')", "actual_payment_date")
STRICT = "if(actual_payment_date IS NULL OR paid_at_date IS NULL, NULL, least(actual_payment_date, paid_at_date))"
LOAN_RULE = ("('before', 'in'), ('after', 'in'), ('before', 'none')", "('in', 'none'), ('in', 'in'), ('in', 'after')", STRICT)
LOAN_RULE_NULL_SAFE = (*LOAN_RULE[:2], "least(actual_payment_date, paid_at_date)")

SUPERSEDED = "CAST(coalesce(topped_up_at, extended_at, arranged_rp_at, DATE '2999-12-31') AS DATE)"


def _takes(rule: tuple[str, str, str]) -> str:
    always, tested, day = rule
    return f"((due_at, paid_at) IN ({always}) OR ((due_at, paid_at) IN ({tested}) AND {day} <= superseded))"


DUE = " + ".join(f"coalesce({c}, 0)" for c in ("principal", "interest", "fees", "penalty", "discount"))
PAID = "principal_paid + interest_paid + fees_paid + penalty_paid"
PICK_ORDER = ", ".join(f"{c} NULLS LAST" for c in (
    "paid_at_date", "principal", "interest", "fees", "penalty", "discount", "balance_left",
    "principal_paid", "interest_paid", "fees_paid", "penalty_paid"))


def _doubles(**amounts: str) -> str:
    return ", ".join(f"CAST({sql} AS DOUBLE) AS {name}" for name, sql in amounts.items())


LOAN_SUMS = _doubles(
    Outstanding_Principal="max(principal + balance_left)", Due_payment=f"sum({DUE})", Monthly_payment=f"sum({PAID})",
    Principal_Paid="sum(principal_paid)", Interest_Paid="sum(interest_paid)", Late_Payment_Interest="sum(penalty)")


def _cohort_lines(condition: str = "true") -> str:
    """A cohort's rows as the payment reports name them, with the superseded date; money columns stay behind."""
    return f"""cohort_lines AS (
  SELECT DISTINCT loan_id AS Loan_Id, external_id AS External_ID, application_id AS Application_ID,
         original_application_id AS Original_Application_Id, loan_type AS Type_of_Loan, {SUPERSEDED} AS superseded
  FROM cohort WHERE {condition})"""


def payments_level_sql(as_of: date, load_dttm: datetime, window_kind: str = "B", month_cohort: bool = False) -> str:
    """Payment level on a cohort (default: whole book); kind 'C' adds the application / type requirement."""
    known = "application_id IN (SELECT id FROM loan_application) AND loan_type IN (SELECT name FROM loan_type)"
    keys = "Loan_Id, External_ID, Type_of_Loan, Application_ID, Original_Application_Id, actual_payment_date"
    return _steps(
        _cohort_v2(bounds(as_of, "A") if month_cohort else None, load_dttm), _cohort_lines(known if window_kind == "C" else "true"),
        _dated(bounds(as_of, window_kind)), f"""chosen AS (
  SELECT DISTINCT ON ({keys}) * FROM cohort_lines JOIN (SELECT * EXCLUDE (loan_id) FROM dated) ON paid_loan = Loan_Id
  WHERE {_takes(LEVEL_RULE)} ORDER BY {keys}, {PICK_ORDER})""") + f"""
SELECT Loan_Id, External_ID, Application_ID, Original_Application_Id, {_month_label(as_of)} AS Reporting_Month,
  actual_payment_date AS Actual_Payment_Date, paid_at_date AS Paid_At_Date, Type_of_Loan,
  {_doubles(Outstanding_Principal='coalesce(principal, 0) + coalesce(balance_left, 0)', Due_payment=DUE, Monthly_payment=PAID,
            Principal_Paid='principal_paid', Interest_Paid='interest_paid', Late_Payment_Interest='penalty - penalty_paid')}
FROM chosen ORDER BY Application_ID DESC NULLS LAST, Loan_Id DESC NULLS LAST"""


def payments_by_loan_sql(as_of: date, load_dttm: datetime, null_safe: bool = False, month_cohort: bool = False) -> str:
    return _steps(
        _cohort_v2(bounds(as_of, "A") if month_cohort else None, load_dttm), _cohort_lines(), _dated(bounds(as_of, "B"))) + f"""
SELECT Loan_Id, External_ID, Application_ID, Original_Application_Id, {_month_label(as_of)} AS Reporting_Month, Type_of_Loan,
  {LOAN_SUMS}
FROM cohort_lines JOIN (SELECT * EXCLUDE (loan_id) FROM dated) ON paid_loan = Loan_Id
WHERE {_takes(LOAN_RULE_NULL_SAFE if null_safe else LOAN_RULE)} GROUP BY ALL"""


BOOK_LINES = f"""book_lines AS (
  SELECT id AS Loan_Id, original_loan_application_id AS Application_ID, loan_type_id, {SUPERSEDED} AS superseded FROM loan)"""


def payments_for_loans_sql(as_of: date, loan_ids: Iterable[int] | None = None, window: Bounds = None) -> str:
    wanted = "true" if loan_ids is None else f"Loan_Id IN ({', '.join(str(int(i)) for i in loan_ids)})"
    return _steps(BOOK_LINES, _dated(window or bounds(as_of, "C"))) + f"""
SELECT Loan_Id, Application_ID, {_month_label(as_of)} AS Reporting_Month, t.name AS Type_of_Loan, {LOAN_SUMS}
FROM book_lines JOIN loan_type t ON t.id = loan_type_id JOIN (SELECT * EXCLUDE (loan_id) FROM dated) ON paid_loan = Loan_Id
WHERE Application_ID IN (SELECT id FROM loan_application) AND {wanted} AND {_takes(LEVEL_RULE)}
GROUP BY ALL ORDER BY Application_ID DESC NULLS LAST, Loan_Id DESC NULLS LAST"""


def payment_branch_counts_sql(as_of: date) -> str:
    classes = " ".join(
        f"WHEN due_at = '{due}' AND paid_at = '{paid}' AND {test} THEN '{name}'" for due, paid, test, name in (
            ("in", "none", "on_time", "due_in_unpaid"), ("in", "in", "on_time", "due_in_paid_in"),
            ("in", "after", "on_time", "due_in_paid_after"), ("after", "in", "true", "paid_in_due_after"),
            ("before", "in", "true", "paid_in_due_before"), ("before", "none", "true", "overdue_unpaid")))
    return _steps(BOOK_LINES, _dated(bounds(as_of, "B"))) + f"""
SELECT CASE {classes} WHEN due_at = 'in' AND NOT on_time THEN 'due_in_superseded'
            WHEN due_at = 'in' AND paid_at = 'before' THEN 'due_in_paid_before' ELSE 'other' END AS payment_class,
  coalesce({_takes(LEVEL_RULE)}, false) AS kept_level, coalesce({_takes(LOAN_RULE)}, false) AS kept_by_loan,
  coalesce({_takes(LOAN_RULE_NULL_SAFE)}, false) AS kept_by_loan_null_safe,
  coalesce({STRICT} <= superseded, false) AS earliest_not_superseded, count(*) AS n_payments
FROM (SELECT *, actual_payment_date <= superseded AS on_time FROM book_lines JOIN (SELECT * EXCLUDE (loan_id) FROM dated) ON paid_loan = Loan_Id)
GROUP BY ALL"""


def reporting_windows_sql() -> str:
    """Windows of every order date, by day counting: a month back keeps the day, or the last day of a shorter month."""
    def back(day: str) -> str:
        first = f"(date_trunc('month', {day}) - INTERVAL 1 MONTH)"
        return (f"CAST(make_date(year({first})::BIGINT, month({first})::BIGINT, "
                f"least(day({day}), day(last_day({first})))::BIGINT) AS DATE)")

    return f"""
SELECT as_of, CAST(date_trunc('month', {back('as_of')}) AS DATE) AS a_start, CAST(last_day({back('as_of')}) AS DATE) AS a_end,
  {back('as_of')} AS b_start, eve AS b_end, {back('eve')} AS c_start, eve AS c_end, strftime(as_of, '%Y-%m-01') AS reporting_month
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of, CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS eve FROM orders)"""


# ---- many dates, two versions ----------------------------------------------------------------


def every(as_ofs: Iterable[date], report) -> str:
    """The rows of ``report(as_of)`` for every date, with the date."""
    return " UNION ALL ".join(f"(SELECT DATE '{d.isoformat()}' AS as_of, * FROM ({report(d)}))" for d in as_ofs)


def reconcile_sql(before: str, after: str, keys: list[str], columns: list[str]) -> str:
    """Rows by key that only one of two reports holds: changed when one is left on either side, else dropped or added."""
    names = ", ".join(keys + columns)
    same = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in keys)
    by_key = ", ".join(keys)
    values = ", ".join(f"min({c}) AS {c}" for c in columns)
    differ = " || ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN ',{c}' ELSE '' END" for c in columns)
    o, n = (", ".join(f"{side}.{k}" for k in keys) for side in "on")
    return f"""
WITH old_rows AS (SELECT {names} FROM ({before})), new_rows AS (SELECT {names} FROM ({after})),
old_left AS (SELECT * FROM old_rows EXCEPT ALL SELECT * FROM new_rows), new_left AS (SELECT * FROM new_rows EXCEPT ALL SELECT * FROM old_rows),
old_keys AS (SELECT {by_key}, count(*) AS left_over, {values} FROM old_left GROUP BY {by_key}),
new_keys AS (SELECT {by_key}, count(*) AS left_over, {values} FROM new_left GROUP BY {by_key}),
pairs AS (SELECT {o}, substr({differ}, 2) AS changed FROM old_keys o JOIN new_keys n ON {same} WHERE o.left_over = 1 AND n.left_over = 1)
SELECT {by_key}, 'changed' AS status, changed, 1 AS n_rows FROM pairs
UNION ALL SELECT {o}, 'dropped', NULL, o.left_over FROM old_keys o LEFT JOIN new_keys n ON {same} WHERE NOT (o.left_over = 1 AND coalesce(n.left_over, 0) = 1)
UNION ALL SELECT {n}, 'added', NULL, n.left_over FROM new_keys n LEFT JOIN old_keys o ON {same} WHERE NOT (n.left_over = 1 AND coalesce(o.left_over, 0) = 1)"""
