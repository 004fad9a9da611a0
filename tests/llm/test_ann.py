"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import ann

ASKS = "vec_id % 20 = 0"


def brute(rows: list[tuple[int, np.ndarray]], k: int = 20) -> dict[int, list[int]]:
    rows = sorted({(i, tuple(v)) for i, v in rows})
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            score = vectors @ np.array(v)
            out[i] = [int(ids[j]) for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
    return out


@pytest.mark.parametrize("sf,s", [("sf0.001", ann.Settings()), ("sf0.1", ann.Settings()), ("sf0.1", ann.Settings(sample_rows=400))])
def test_recall(spark, sf, s):
    """Also where the sample is a fifth of the table."""
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    want = brute([(r["vec_id"], np.array(r["embedding"], dtype=np.float64)) for r in table.collect()])
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in table.collect()}
    got: dict[int, list] = {}
    for r in sorted(ann.nearest(table, F.expr(ASKS), s).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    assert got.keys() == want.keys()
    hits = sum(len({r["vec_id"] for r in got[q]} & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        assert [r["rank"] for r in near] == list(range(1, len(near) + 1))
        assert len(near) == len(want[q]) and q not in {r["vec_id"] for r in near}
        assert all(abs(r["score"] - vectors[q] @ vectors[r["vec_id"]]) < 1e-12 for r in near)
        assert [(-r["score"], r["vec_id"]) for r in near] == sorted((-r["score"], r["vec_id"]) for r in near)


@pytest.mark.parametrize("slice_rows", [2, 16_384])
def test_odd_rows_and_copies(spark, slice_rows):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 5)]) for i in range(90)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(100, 400)]  # one very common vector
    usable = [(i, v) for i, v in rows]
    rows += [(500, None), (501, [0.0] * 6), (520, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (540, [float("nan")] + [1.0] * 5),
             (560, [float("inf")] + [1.0] * 5), (580, [1.0, 2.0]), (None, [1.0] * 6), rows[0], rows[-1]]
    table = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, score string")
    want = brute([(i, np.array(v)) for i, v in usable])
    got: dict[int, list[int]] = {}
    for r in sorted(ann.nearest(table, F.expr(ASKS), ann.Settings(cell_rows=32, slice_rows=slice_rows, target_recall=1)).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == want


def test_few_rows(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["rank"], r["vec_id"], r["score"]) for r in ann.nearest(table, F.expr(ASKS)).orderBy("rank").collect()] == [(1, 2, 1.0), (2, 1, 0.0)]
    assert ann.nearest(table.limit(0), F.expr(ASKS)).count() == 0
    assert ann.nearest(table.where("vec_id = 0"), F.expr(ASKS)).count() == 0
    assert ann.nearest(table.where("vec_id > 0"), F.expr(ASKS)).count() == 0


def clustered() -> list[tuple[int, list[float]]]:
    """4000 vectors in 40 tight clusters of very uneven sizes."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16))
    share = 0.8 ** np.arange(40)
    at = np.concatenate([np.arange(40), rng.choice(40, 3960, p=share / share.sum())])
    return [(i, [float(x) for x in centers[c] + rng.normal(size=16) * 1e-3]) for i, c in enumerate(at)]


def scattered(n: int) -> list[tuple[int, list[float]]]:
    rng = np.random.default_rng(n)
    return [(i, [float(x) for x in rng.normal(size=8)]) for i in range(n)]


@pytest.mark.parametrize("rows", [clustered(), *(scattered(n) for n in (21, 25, 33, 40))], ids=len)
def test_every_query_gets_k_rows(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["query_id"]: r["count"] for r in ann.nearest(table, F.lit(True)).groupBy("query_id").count().collect()}
    assert got == {i: min(20, len(rows) - 1) for i, _ in rows}


def test_reach():
    far, sizes = np.array([[3.0, 1.0, 2.0, 0.0], [0.0, 1.0, 2.0, 3.0]]), np.array([9, 1, 5, 2])
    bounds, lists = ann._reach(far, 1, sizes, 8)
    assert [lists[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[3, 1, 2], [0]]
    bounds, lists = ann._reach(far, 2, sizes, 100)
    assert [sorted(lists[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [[0, 1, 2, 3]] * 2


@pytest.mark.parametrize("norm", [1e4, 1e9])
def test_one_long_vector_swamps_none(spark, norm):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[7] *= norm
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    want = brute([(i, np.array(v)) for i, v in rows])
    got: dict[int, set[int]] = {}
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.expr(ASKS)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert got.keys() == want.keys()
    assert np.mean([len(got[q] & set(want[q])) / 20 for q in want]) >= 0.9


@pytest.mark.parametrize("norm", [1.0, 1e4, 1e9])
def test_scan_by_inner_product(norm):
    rng = np.random.default_rng(4)
    cell = rng.normal(size=(3000, 64))
    cell /= np.linalg.norm(cell, axis=1)[:, None]
    cell[1500] *= norm
    queries = rng.normal(size=(50, 64))
    found = ann.scan(queries, cell, 21, 16, 2.1, inner=True)
    exact = np.argsort(-queries @ cell.T, axis=1)[:, :21]
    assert np.mean([len(set(a) & set(b)) / 21 for a, b in zip(found, exact, strict=True)]) > 0.95


def test_scan_abandons_but_finds():
    rng = np.random.default_rng(2)
    cell = rng.normal(size=(3000, 65)).astype(np.float32)
    queries = cell[:40] + rng.normal(size=(40, 65)).astype(np.float32) * 0.1
    found = ann.scan(queries, cell, 10, 16, 2.1)
    far = ((queries[:, None] - cell) ** 2).sum(axis=2)
    exact = np.argsort(far, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, exact, strict=True)]) > 0.95
