"""Report parameters: loan ids, default load stamp, command-line month-end run."""

from __future__ import annotations

import uuid
from datetime import date

from loanlens.operators import loan_cohort_v2, monthly_payments_for_loans
from loanlens.session import shared_dir
from loanlens.sources.book import write_book
from tests.fixture_book import fixture_book

AS_OF = date(2018, 7, 1)


def test_loan_ids_select_a_subset_of_the_full_report(spark):
    book = fixture_book(spark)
    full = {r.Loan_Id: r for r in monthly_payments_for_loans(book, AS_OF).collect()}
    some = {r.Loan_Id: r for r in monthly_payments_for_loans(book, AS_OF, loan_ids=[1, 10, 999]).collect()}
    assert set(some) == {1, 10} & set(full)
    assert all(some[k] == full[k] for k in some)


def test_loan_ids_as_a_table_with_repeats_and_nulls(spark):
    book = fixture_book(spark)
    ids = spark.createDataFrame([(1,), (1,), (10,), (None,)], "loan_id long")
    want = sorted(monthly_payments_for_loans(book, AS_OF, loan_ids=[10, 1, 1]).collect())
    assert sorted(monthly_payments_for_loans(book, AS_OF, loan_ids=ids).collect()) == want and want
    assert monthly_payments_for_loans(book, AS_OF, loan_ids=[]).count() == 0


def test_default_load_stamp_is_one_value_per_query(spark):
    rows = loan_cohort_v2(fixture_book(spark), AS_OF).collect()
    assert rows and len({r.load_dttm for r in rows}) == 1 and rows[0].load_dttm is not None


def test_command_line_month_end(spark, capsys):
    from loanlens.__main__ import main

    root = f"{shared_dir(spark)}/cli_{uuid.uuid4().hex[:8]}"
    write_book(fixture_book(spark), f"{root}/book")
    main(["--local", "--book", f"{root}/book", "--as-of", "2018-07-01", "--out", f"{root}/out",
          "--cohort-table", f"cli_cohort_{uuid.uuid4().hex[:8]}"])
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert "monthly_payments_by_loan" in printed
    assert spark.read.parquet(printed["monthly_payments_by_loan"]).count() > 0
