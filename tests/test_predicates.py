from datetime import date, timedelta

from pyspark.sql import functions as F

from loanlens.functions.classify import final_decision, loan_accepted, rejection_reason
from loanlens.functions.predicates import (
    AGGREGATED,
    LEVEL,
    least_strict,
    payment_in_scope,
    payment_prefilter,
    superseded_at,
)
from loanlens.functions.windows import ReportingWindow


def test_least_strict_null_table(spark):
    rows = [(1, 2), (3, None), (None, 4), (None, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = [r[0] for r in df.select(least_strict(F.col("a"), F.col("b"))).collect()]
    assert got == [1, None, None, None]
    safe = [r[0] for r in df.select(F.least("a", "b")).collect()]
    assert safe == [1, 3, 4, None]


def test_superseded_precedence_not_earliest(spark):
    rows = [
        (date(2018, 9, 1), None, date(2018, 7, 1)),  # topped-up wins even though later
        (None, date(2018, 8, 1), date(2018, 7, 1)),
        (None, None, date(2018, 7, 1)),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "t date, e date, r date")
    got = [r[0] for r in df.select(superseded_at(F.col("t"), F.col("e"), F.col("r"))).collect()]
    assert got == [date(2018, 9, 1), date(2018, 8, 1), date(2018, 7, 1), date(2999, 12, 31)]


def test_decision_truth_table(spark):
    # (has_facility, loan_app_id, issued, cancelled, declined) -> (decision, reason)
    cases = [
        (False, None, None, None, None, "R", "Declined"),
        (True, None, None, None, None, "R", "Withdrawn by Customer"),
        (True, 1, 1, None, None, "A", "Accepted"),
        (True, 1, 1, 1, None, "R", "Withdrawn by Customer"),
        (True, 1, 1, None, 1, "R", "Declined"),
        (True, 1, None, None, None, "R", "Withdrawn by Customer"),
        (False, 1, 1, None, None, "A", "Declined"),  # possible only when the loan is linked directly
        (True, None, 1, None, None, "R", "Withdrawn by Customer"),  # loan without application id
    ]
    df = spark.createDataFrame([c[:5] for c in cases], "f boolean, app int, iss int, can int, dec int")
    acc = loan_accepted(F.col("app"), F.col("iss"), F.col("can"), F.col("dec"))
    out = df.select(final_decision(acc), rejection_reason(F.col("f"), F.col("dec").isNotNull(), acc)).collect()
    assert [tuple(r) for r in out] == [c[5:] for c in cases]


def test_payment_selection_branches(spark):
    w = ReportingWindow(date(2018, 6, 1), date(2018, 6, 30))
    s, e = w.start, w.end
    x = date(2018, 6, 20)
    one = timedelta(days=1)
    dues = [s - one, s, x, x + one, e, e + one]
    paids = [None, s - one, s, e, e + one]
    rows = [(d, p) for d in dues for p in paids]
    df = spark.createDataFrame(rows, "due date, paid date").withColumn("x", F.lit(x))
    due, paid, xc = F.col("due"), F.col("paid"), F.col("x")

    def expected_level(d, p):
        first = s <= d <= e and (p is None or s <= p <= e) and d <= x
        second = p is not None and s <= p <= e and d > e
        third = d < s and p is None
        return first or second or third

    def expected_agg(d, p, null_safe):
        earliest = (min(d, p) if p is not None else (d if null_safe else None))
        first = (s <= d <= e and (p is None or s <= p <= e or p > e)
                 and earliest is not None and earliest <= x)
        second = p is not None and s <= p <= e and (d < s or d > e)
        third = d < s and p is None
        return first or second or third

    out = df.select(
        "due", "paid",
        F.coalesce(payment_in_scope(due, paid, w, xc, LEVEL), F.lit(False)).alias("lvl"),
        F.coalesce(payment_in_scope(due, paid, w, xc, AGGREGATED), F.lit(False)).alias("agg"),
        F.coalesce(payment_in_scope(due, paid, w, xc, AGGREGATED, True), F.lit(False)).alias("safe"),
        F.coalesce(payment_prefilter(due, paid, w, LEVEL), F.lit(False)).alias("pre_lvl"),
        F.coalesce(payment_prefilter(due, paid, w, AGGREGATED), F.lit(False)).alias("pre_agg"),
    ).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.lvl == expected_level(r.due, r.paid), r
        assert r.agg == expected_agg(r.due, r.paid, False), r
        assert r.safe == expected_agg(r.due, r.paid, True), r
        # the pushed-down prefilter never drops a selected payment
        assert r.pre_lvl or not r.lvl
        assert r.pre_agg or not (r.agg or r.safe)
    # never selected: due in window, paid before it
    assert not any(r.lvl or r.agg for r in out if s <= r.due <= e and r.paid == s - one)
    # strict rule drops unpaid payments due in the window; NULL-safe keeps them
    unpaid_due_in = [r for r in out if r.due == s and r.paid is None]
    assert unpaid_due_in and not unpaid_due_in[0].agg and unpaid_due_in[0].safe
