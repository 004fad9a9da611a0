"""Loan book derived from the TPC-H-style test tables.

Every order becomes a loan application (and, for most orders, a loan), every
line item becomes a scheduled payment and every customer one row of
financial information.  The modulo expressions below are a fixed,
deterministic way to give rows domain attributes (deleted, declined, topped
up, which scoring model, ...) so that every branch of every report is
exercised; they never sample: all of ``orders``, ``lineitem`` and
``customer`` is read.  ``loanlens.oracle.MAPPING_SQL`` is the same mapping in
DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.sources.book import LoanBook, conform

# Fixed values of the mapping: order priority -> scoring model config id and
# -> loan type id; the config table (config id, scorecard type id) and the
# loan-type dictionary (type id, name).
PRIORITY_CONFIG = {
    "1-URGENT": 58, "2-HIGH": 59, "3-MEDIUM": 60, "4-NOT SPECIFIED": 61, "5-LOW": 62,
}
PRIORITY_LOAN_TYPE = {
    "1-URGENT": 751, "2-HIGH": 752, "3-MEDIUM": 753, "4-NOT SPECIFIED": 754, "5-LOW": 756,
}
CONFIG_ROWS = [(58, 796), (59, 959), (60, 960), (61, 500), (62, 501)]
LOAN_TYPE_ROWS = [
    (751, "Instalment"), (752, "Extension"), (753, "Repayment plan"),
    (754, "Renewal"), (756, "Top up"),
]


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def _ts(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def _plus_days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def _lookup(c: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def book_from_testdata(spark: SparkSession, sf_dir: str) -> LoanBook:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")

    k = F.col("o_orderkey")
    d0 = F.col("o_orderdate").cast("date")
    odate = F.col("o_orderdate")

    loan_application = orders.select(
        k.alias("id"),
        F.col("o_custkey").alias("customer_id"),
        odate.alias("created_at"),
        _money(F.col("o_totalprice")).alias("amount_of_credit"),
        F.when(k % 41 == 0, odate).alias("deleted_at"),
    )

    external_score = orders.filter(k % 9 != 0).select(
        (k + 1000000).alias("id"), k.alias("loan_application_id")
    ).unionByName(
        orders.filter(k % 50 == 1).select(
            (k + 5000000).alias("id"), k.alias("loan_application_id")
        )
    )

    credit_score = orders.select(
        (k + 2000000).alias("id"),
        k.alias("loan_application_id"),
        _lookup(F.col("o_orderpriority"), PRIORITY_CONFIG).alias("credit_score_config_id"),
        _ts(_plus_days(d0, k % 4)).alias("created_at"),
    )

    credit_score_config = spark.createDataFrame(
        CONFIG_ROWS, "id int, scorecard_type_id int"
    )

    facility = orders.filter(k % 6 != 0).select(
        (k + 3000000).alias("id"),
        (k + 2000000).alias("credit_score_id"),
        _ts(_plus_days(d0, k % 4 + F.when(k % 11 == 0, 1).otherwise(0))).alias("created_at"),
    )

    facility_has_loan = orders.filter((k % 6 != 0) & (k % 5 != 0)).select(
        (k + 3000000).alias("facility_id"), k.alias("loan_id")
    )

    loan_type = spark.createDataFrame(LOAN_TYPE_ROWS, "id int, name string")

    child = (k % 7 == 0) & (k > 0)
    loan = orders.filter(k % 5 != 0).select(
        k.alias("id"),
        k.alias("loan_application_id"),
        F.when(child, k - 1).otherwise(k).alias("original_loan_application_id"),
        F.when(child, k - 1).alias("origin_loan_id"),
        _lookup(F.col("o_orderpriority"), PRIORITY_LOAN_TYPE).alias("loan_type_id"),
        _money(F.col("o_totalprice")).alias("principal"),
        _money(k % 500).alias("initial_interest"),
        (k % 90 + 10).cast("decimal(9,2)").alias("annual_percentage_rate"),
        F.when(k % 97 == 1, 0).otherwise(k % 12 + 1).alias("no_of_payments"),
        odate.alias("created_at"),
        F.when(k % 13 != 0, _ts(_plus_days(d0, k % 3))).alias("issued_at"),
        F.when(k % 17 == 0, odate).alias("cancelled_at"),
        F.when(k % 19 == 0, odate).alias("declined_at"),
        F.when(k % 23 == 0, odate).alias("deleted_at"),
        F.when(k % 8 == 1, _ts(F.date_add(d0, 400))).alias("topped_up_at"),
        F.when(k % 8 == 2, _ts(F.date_add(d0, 400))).alias("extended_at"),
        F.when((k % 8 == 1) | (k % 8 == 3), _ts(F.date_add(d0, 200))).alias("arranged_rp_at"),
    )

    flag = F.col("l_returnflag")
    ship = F.col("l_shipdate").cast("date")
    qty = F.col("l_quantity")
    part = F.col("l_partkey")
    supp = F.col("l_suppkey")
    unpaid = flag == "N"
    loan_payment = lineitem.select(
        F.col("l_orderkey").alias("loan_id"),
        F.when(F.col("l_linenumber") == 1, 1).otherwise(0).alias("is_first_payment"),
        ship.alias("actual_payment_date"),
        F.when(flag == "A", F.date_sub(ship, qty.cast("int")))
        .when(flag == "R", F.date_add(ship, qty.cast("int")))
        .alias("paid_at_date"),
        F.when(part % 43 != 0, _money(F.col("l_extendedprice"))).alias("principal"),
        F.when(supp % 9 != 0, _money(qty)).alias("interest"),
        _money(F.col("l_linenumber")).alias("fees"),
        _money(F.when(part % 10 == 0, 25).otherwise(0)).alias("penalty"),
        _money(-(part % 5)).alias("discount"),
        _money(qty * 100).alias("balance_left"),
        F.when(unpaid, _money(F.lit(0))).otherwise(_money(F.col("l_extendedprice"))).alias("principal_paid"),
        F.when(supp % 9 == 1, F.lit(None))
        .when(unpaid, _money(F.lit(0)))
        .otherwise(_money(qty)).alias("interest_paid"),
        F.when(unpaid, _money(F.lit(0))).otherwise(_money(F.col("l_linenumber"))).alias("fees_paid"),
        _money(F.when((part % 20 == 0) & ~unpaid, 25).otherwise(0)).alias("penalty_paid"),
        F.when(part % 29 == 0, F.col("l_shipdate")).alias("deleted_at"),
    )

    ck = F.col("c_custkey")
    financial_information = customer.select(
        ck.alias("customer_id"),
        _money(F.col("c_acctbal")).alias("total_monthly_income"),
        _money(F.col("c_nationkey") * 10).alias("total_monthly_expenses"),
        F.when(ck % 31 == 0, F.lit("1995-01-01").cast("timestamp_ntz")).alias("deleted_at"),
    )

    dfs: dict[str, DataFrame] = {
        "loan_application": loan_application,
        "external_score": external_score,
        "credit_score": credit_score,
        "credit_score_config": credit_score_config,
        "facility": facility,
        "facility_has_loan": facility_has_loan,
        "loan_type": loan_type,
        "loan": loan,
        "loan_payment": loan_payment,
        "financial_information": financial_information,
    }
    return LoanBook(**{n: conform(df, n) for n, df in dfs.items()})
