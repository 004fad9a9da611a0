from datetime import date
import uuid

from loanlens.plans.month_end import run_month_end
from loanlens.session import shared_dir
from tests.fixture_book import fixture_book


def test_month_end_run_is_repeatable(spark):
    book = fixture_book(spark)
    root = f"{shared_dir(spark)}/me_{uuid.uuid4().hex[:8]}"
    table = f"cohort_me_{uuid.uuid4().hex[:8]}"
    paths = run_month_end(spark, book, date(2018, 7, 1), cohort_table=table, out_root=root)
    first = {k: sorted(map(repr, spark.read.parquet(p).collect())) for k, p in paths.items()}
    assert first["monthly_payments_by_loan"] and first["applications_facility"]
    run_month_end(spark, book, date(2018, 7, 1), cohort_table=table, out_root=root)
    again = {k: sorted(map(repr, spark.read.parquet(p).collect())) for k, p in paths.items()}
    assert again == first


def test_files_in_name_order_give_the_reports_order(spark):
    import pyarrow.parquet as pq

    from loanlens.plans.month_end import report_files, write_report

    path = f"{shared_dir(spark)}/ordered_{uuid.uuid4().hex[:8]}"
    df = spark.range(20_000).selectExpr("pmod(hash(id), 997) AS Application_ID", "id AS Loan_Id").repartition(7)
    df = df.orderBy("Application_ID", "Loan_Id", ascending=False)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    try:
        for merged in ("false", "true"):
            spark.conf.set(key, merged)
            for _ in range(2):  # again: the month is replaced
                write_report(df, path, "2018-07-01")
            files = report_files(spark, path, "2018-07-01")
            assert merged == "true" or len(files) > 1
            rows = [tuple(r.values()) for f in files for r in pq.read_table(f.removeprefix("file:")).to_pylist()]
            assert rows == sorted(rows, reverse=True) and len(rows) == 20_000
    finally:
        spark.conf.set(key, old)
    assert spark.read.parquet(path).columns == ["Application_ID", "Loan_Id", "reporting_month"]
