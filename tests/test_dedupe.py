"""Property tests of the skew-safe building blocks against their plain Spark equivalents."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from loanlens.operators.cohort import with_external_ids
from loanlens.operators.dedupe import one_row_per


def _rows(seed: int, n: int):
    rnd = random.Random(seed)

    def maybe(v):
        return None if rnd.random() < 0.25 else v

    # key 0 is hot: about a third of all rows
    return [
        (0 if rnd.random() < 0.33 else rnd.randint(1, 20), rnd.randint(0, 2),
         maybe(rnd.randint(0, 3)), maybe(rnd.randint(0, 3)), maybe(rnd.randint(0, 9)))
        for _ in range(n)
    ]


def test_one_row_per_equals_row_number_nulls_last(spark):
    for seed in range(5):
        df = spark.createDataFrame(_rows(seed, 400), "k long, g int, a int, b int, c int").repartition(3)
        got = one_row_per(df, ["k", "g"], ["a", "b", "c"])
        w = Window.partitionBy("k", "g").orderBy(
            F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last(), F.col("c").asc_nulls_last()
        )
        want = df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_one_row_per_carries_the_chosen_rows_other_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "unpaid"), (1, 5, "late"), (1, 3, "early"), (2, None, "only")], "k long, o int, v string"
    )
    got = {r.k: (r.o, r.v) for r in one_row_per(df, ["k"], ["o"]).collect()}
    assert got == {1: (3, "early"), 2: (None, "only")}


def test_with_external_ids_equals_left_join(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        rows = spark.createDataFrame(
            [(i, 0 if rnd.random() < 0.3 else rnd.randint(1, 30)) for i in range(200)], "loan_id long, la_id long"
        )
        ext = spark.createDataFrame(
            [(1000 + i, 0 if rnd.random() < 0.4 else rnd.randint(5, 40)) for i in range(300)],
            "external_id long, la_id long",
        )
        got = with_external_ids(rows, ext).select("loan_id", "la_id", "external_id")
        want = rows.join(ext, "la_id", "left").select("loan_id", "la_id", "external_id")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
