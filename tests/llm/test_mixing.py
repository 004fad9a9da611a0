"""Source mixing against SQL, and the law of the budget on small trees."""

from __future__ import annotations

import random

import duckdb
import pytest

from loanlens.llm import mixing, sql
from tests.llm.rows import SCHEMA, documents, frame, same_rows


def in_duck(rows):
    import pandas as pd

    con = duckdb.connect()
    table = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype(
        {"doc_id": "Int64", "n_chars": "Int64"})
    con.register("raw", table)
    con.sql("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, lang::VARCHAR AS lang, "
            "source::VARCHAR AS source, n_chars::BIGINT AS n_chars FROM raw")
    return con


@pytest.mark.parametrize("percent,epochs", [(100, 2), (30, 1), (250, 3), (900, 2), (0, 2)])
def test_sql(spark, percent, epochs):
    s = mixing.Settings(budget_percent=percent, most_epochs=epochs, bucket_rows=3)
    con = in_duck(documents())
    same_rows(mixing.mix(frame(spark), s), con.sql(f"WITH {sql.mixing_ctes(s=s)} SELECT * EXCLUDE (rid) FROM mix").df())


def shared(amount: float, weights: list[int], caps: list[int]) -> list[float]:
    """Exact shares: pour until the amount is gone or all are full."""
    got, left = [0.0] * len(caps), amount
    while left > 1e-9 and (some := [i for i in range(len(caps)) if got[i] < caps[i] - 1e-9 and weights[i] > 0]):
        step = min(left / sum(weights[i] for i in some), min((caps[i] - got[i]) / weights[i] for i in some))
        for i in some:
            got[i] += step * weights[i]
        left -= step * sum(weights[i] for i in some)
    return got


def test_shortages_go_to_siblings_first(spark):
    rng = random.Random(3)
    leaves = [(d, g, s, rng.choice([0, 5, 40, 1000, 9000]), 1) for d in "ab" for g in ("x", "y", "z") for s in ("p", "q", "r")]
    s = mixing.Settings(weights=("cast(1 as bigint)", "cast(case when lang = 'x' then 3 else 1 end as bigint)",
                                 "cast(case when source = 'r' then 0 else ascii(source) end as bigint)"), budget_percent=60)
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long, rows long")
    quota = {(r["domain"], r["lang"], r["source"]): r["quota"] for r in mixing.budgets(table, s).collect()}
    hold = lambda *up: sum(2 * t for *names, t, _ in leaves if tuple(names[: len(up)]) == up)
    total = sum(x[3] for x in leaves) * 60 // 100
    tops = shared(total, [1, 1], [hold("a"), hold("b")])
    for d, amount in zip("ab", tops, strict=True):
        langs = shared(amount, [3, 1, 1], [hold(d, g) for g in "xyz"])
        for g, part in zip("xyz", langs, strict=True):
            want = shared(part, [ord("p"), ord("q"), 0], [hold(d, g, x) for x in "pqr"])
            for x, w in zip("pqr", want, strict=True):
                assert abs(quota[d, g, x] - w) <= 3  # shares are cut to whole tokens on each level
    assert all(quota[d, g, "r"] == 0 for d in "ab" for g in "xyz")


def test_prefix_fills_the_quota(spark):
    rows = [(i, "w " * (1 + i % 9), "en", "only", 0) for i in range(2000)]
    out = mixing.mix(frame(spark, rows), mixing.Settings(budget_percent=137, bucket_rows=64)).collect()
    used, quota = sum(r["copies"] * r["n_tokens"] for r in out), out[0]["quota"]
    assert {r["copies"] for r in out} == {1, 2} and quota - 9 < used <= quota
    assert {r["doc_id"] for r in out} == set(range(2000))


def test_rows_of_the_mixture(spark):
    from pyspark.sql import functions as F

    docs = frame(spark).withColumn("domain", F.lit("mine")).withColumn("copies", F.lit(1)).withColumn("col", F.lit(2)).withColumn("last", F.lit("z"))
    plain = mixing.mix(frame(spark)).collect()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted((r["doc_id"] for r in plain for _ in range(r["copies"])), key=repr)


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    assert mixing.mix(frame(spark, [(1, None, None, None, None)])).first()["copies"] == 0
