"""Every registered query against its oracle SQL on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# The training-data operators have tests of their own beside them.
REPORTS = [n for n in entry.queries() if n not in entry.training_data_names()]


def test_oracle_for_every_report():
    assert set(REPORTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", REPORTS)
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert not problems, problems
    assert n > 0


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["Loan_Id", "External_ID"]
    assert df.count() >= 0
