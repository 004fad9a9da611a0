"""A hand-made loan book with the edge cases every report must handle."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from loanlens.sources.book import LoanBook
from loanlens.sources.schemas import BOOK_SCHEMAS


def D(s):
    return date.fromisoformat(s)


def T(s):
    return datetime.fromisoformat(s)


def M(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


APPLICATIONS = [
    (100, 1, T("2018-06-05 09:00"), M(1000), None),
    (101, 2, T("2018-06-10 09:00"), M(2000), None),
    (102, 3, T("2018-06-12 09:00"), M(500), T("2018-06-13 00:00")),  # soft-deleted
    (103, 1, T("2018-06-15 09:00"), M(750), None),
    (104, 4, T("2018-05-20 09:00"), M(300), None),
    (105, 5, T("2018-06-20 09:00"), M(900), None),
    (106, 2, T("2018-06-25 09:00"), M(100), None),
]
EXTERNAL = [(9000, 100), (9001, 100), (9002, 101), (9003, 103), (9004, 104), (9005, 106)]
SCORES = [
    (500, 100, 58, T("2018-06-05 10:00")),
    (501, 101, 59, T("2018-06-11 10:00")),
    (502, 102, 58, T("2018-06-12 10:00")),
    (503, 103, 58, T("2018-06-17 10:00")),  # lag 2
    (504, 104, 61, T("2018-06-02 10:00")),  # scored before applied? no: applied 05-20, lag 13
    (505, 105, 58, T("2018-06-19 10:00")),  # lag -1
    (506, 106, 59, T("2018-06-25 10:00")),
    (507, 100, 59, T("2018-06-06 10:00")),  # second model for the same application
]
CONFIGS = [(58, 796), (59, 959), (61, 500)]
FACILITIES = [
    (700, 500, T("2018-06-05 11:00")),
    (701, 501, T("2018-06-12 11:00")),  # created the day after its score
    (702, 503, T("2018-06-17 11:00")),
    (703, 505, T("2018-06-19 11:00")),
    (704, 507, T("2018-06-06 11:00")),
]
BRIDGE = [(700, 1), (701, 2), (702, 3), (703, 5), (700, 4), (704, 6), (700, 8), (700, 9), (702, 7)]
TYPES = [(751, "Instalment"), (756, "Top up")]

#        id  la   orig origin type  principal  ii     apr    n  created              issued               cancelled            declined             deleted              topped             extended            arranged
LOANS = [
    (1, 100, 100, None, 751, M(1000), M(50), M(12.5), 3, T("2018-06-05 12:00"), T("2018-06-06 08:00"), None, None, None, None, None, None),
    (2, 101, 101, None, 751, M(2000), M(80), M(10), 0, T("2018-06-11 12:00"), T("2018-06-11 13:00"), None, None, None, None, None, None),
    (3, 103, 103, None, 756, M(750), M(10.01), M(0), 2, T("2018-06-17 12:00"), T("2018-06-17 13:00"), None, None, None, T("2018-06-20 10:00"), None, T("2018-06-10 10:00")),
    (4, 105, 100, 1, 751, M(500), M(0), M(5), 4, T("2018-06-20 12:00"), T("2018-06-21 08:00"), None, None, None, None, None, None),
    (5, 105, 105, None, 751, M(900), M(0.01), M(20), 6, T("2018-06-19 12:00"), None, None, None, None, None, None, None),
    (6, 100, 100, 1, 751, M(300), M(0), M(0), 1, T("2018-06-25 12:00"), T("2018-06-25 13:00"), None, None, T("2018-06-26 00:00"), None, None, None),
    (7, 106, 106, 4, 751, M(100), M(0), M(0), 1, T("2018-06-28 12:00"), T("2018-06-28 13:00"), None, None, None, None, None, None),
    (8, 104, 104, None, 751, M(300), M(0), M(0), 1, T("2018-04-01 12:00"), T("2018-04-02 13:00"), None, T("2018-04-03 00:00"), None, None, None, None),
    (9, 104, 104, 8, 751, M(50), M(0), M(0), 1, T("2018-06-10 12:00"), T("2018-06-10 13:00"), None, None, None, None, None, None),
    (10, 101, 101, None, 751, M(123.45), M(1), M(33.33), 7, T("2018-05-10 12:00"), T("2018-05-09 13:00"), None, None, None, None, T("2018-06-15 09:00"), None),
    (11, 103, 103, 10, 756, M(10), M(0), M(0), 1, T("2018-06-29 12:00"), T("2018-06-29 13:00"), T("2018-06-30 00:00"), None, None, None, None, None),
]


def _pay(loan, first, due, paid, principal, interest, fees, penalty, discount, balance,
         p_paid, i_paid, f_paid, pen_paid, deleted=None):
    return (loan, first, D(due), None if paid is None else D(paid), M(principal), M(interest), M(fees),
            M(penalty), M(discount), M(balance), M(p_paid), M(i_paid), M(f_paid), M(pen_paid),
            None if deleted is None else T(deleted))


PAYMENTS = [
    _pay(1, 1, "2018-06-10", "2018-06-10", 300, 10, 1, 0, 0, 700, 300, 10, 1, 0),
    _pay(1, 0, "2018-06-10", None, 5, 1, 0, 0, 0, 0, 0, 0, 0, 0),  # same loan and due date, unpaid
    _pay(1, 0, "2018-07-10", "2018-06-30", 300, 10, 1, 25, -1, 400, 300, 10, 1, 25),  # paid in, due after
    _pay(1, 0, "2018-05-10", None, 300, 10, 1, 25, 0, 1000, 0, 0, 0, 0),  # overdue
    _pay(1, 0, "2018-06-20", "2018-05-25", 300, 10, 1, 0, 0, 100, 300, 10, 1, 0),  # paid before window
    _pay(1, 0, "2018-06-25", "2018-07-05", 300, None, 1, 0, 0, 100, 300, None, 1, 0),  # paid after window
    _pay(2, 1, "2018-06-11", None, 100, None, 1, 25, -2, 1900, 0, None, 0, 0),  # due in, unpaid
    _pay(3, 1, "2018-06-25", "2018-06-18", 375, 5, 0, 0, 0, 375, 375, 5, 0, 0),  # due after X, paid before X
    _pay(3, 0, "2018-06-19", None, 375, 5, 0, 0, 0, 0, 0, 0, 0, 0),
    _pay(4, 1, "2018-06-30", "2018-06-30", 125, 1, 0, 0, 0, 375, 125, 1, 0, 0),  # due = window end
    _pay(4, 1, "2018-07-01", None, 125, 1, 0, 0, 0, 250, 0, 0, 0, 0),  # due after window, unpaid
    _pay(4, 0, "2018-06-15", "2018-06-15", 125, 1, 0, 0, 0, 500, 125, 1, 0, 0, deleted="2018-06-16 00:00"),
    _pay(10, 0, "2018-05-15", "2018-06-02", 20, 2, 0, 0, 0, 100, 20, 2, 0, 0),  # paid in, due before
    _pay(10, 0, "2018-06-16", "2018-06-16", 20, 2, 0, 0, 0, 80, 20, 2, 0, 0),  # superseded
    _pay(10, 1, "2018-05-30", "2018-05-30", 20, 2, 0, 0, 0, 120, 20, 2, 0, 0),  # window C start
    _pay(9, 1, "2018-06-30", None, 50, 0, 0, 0, 0, 0, 0, 0, 0, 0),
    _pay(7, 1, "2018-06-29", "2018-06-29", 100, 0, 0, 0, 0, 0, 100, 0, 0, 0),
]
FINANCIALS = [
    (1, M(5000), M(1000), None),
    (1, M(4000), M(1000), None),  # second row for the same customer
    (2, M(3000), None, None),
    (2, M(2500), M(900), None),
    (3, M(100), M(50), T("2018-01-01 00:00")),
    (4, M(10), M(20), None),
]

ROWS = {
    "loan_application": APPLICATIONS,
    "external_score": EXTERNAL,
    "credit_score": SCORES,
    "credit_score_config": CONFIGS,
    "facility": FACILITIES,
    "facility_has_loan": BRIDGE,
    "loan_type": TYPES,
    "loan": LOANS,
    "loan_payment": PAYMENTS,
    "financial_information": FINANCIALS,
}


def fixture_book(spark, partitions: int | None = None) -> LoanBook:
    dfs = {}
    for name, rows in ROWS.items():
        df = spark.createDataFrame(rows, BOOK_SCHEMAS[name])
        if partitions:
            df = df.repartition(partitions)
        dfs[name] = df
    return LoanBook(**dfs)
