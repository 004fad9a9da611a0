"""Bottom-k sketches against exact sets and against their SQL."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanlens.llm import fingerprints, sql
from loanlens.llm.fingerprints import Settings
from loanlens.llm.queries import op11_document_fingerprints
from tests.llm.rows import documents, frame, same_rows, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashes(text: str) -> set[str]:
    ws = WORD.findall(text)
    grams = [ws[i : i + 5] for i in range(len(ws) - 4)] or ([ws] if ws else [])
    return {hashlib.md5(" ".join(g).encode()).hexdigest()[:16] for g in grams}


def alike(x: set[str], y: set[str], k: int) -> float:
    u = set(sorted(x | y)[:k])
    return len(u & x & y) / len(u) if u else 1.0


def plain(rows, k):
    rows = [(r[0], r[1] or "") for r in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    out = []
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, after = hashes(text), hashes(edited), hashes(following)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(own)[:k]), "".join(sorted(changed)[:k]),
                    alike(own, changed, k), alike(own, after, k)))
    return sorted(out, key=repr)


def found(docs, s):
    got = fingerprints.compared(docs, s).select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.fingerprint(F.col("own")).alias("f"),
        fingerprints.fingerprint(F.col("edited")).alias("g"), "near_edited", "near_next")
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("s", [Settings(), Settings(k=4, bucket_bytes=500), Settings(k=16, bucket_bytes=2000, heavy=1)])
def test_equals_exact_sets(spark, s):
    assert found(frame(spark), s) == plain(documents(), s.k)


def test_equals_sql(spark, monkeypatch):
    rows = documents()
    con = duckdb.connect()
    con.register("raw", pd.DataFrame([r[:2] for r in rows], columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.sql("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text FROM raw")
    monkeypatch.setattr("loanlens.llm.queries._table", lambda *_: frame(spark, rows))
    same_rows(op11_document_fingerprints(spark, ""), con.sql(sql.document_fingerprints()).df())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_hot_id_and_hot_row(spark, doc_id):
    """A third of all rows under one id, once with one text and once with many, in many buckets."""
    rng = random.Random(2)
    rows = [(i, sentence(rng, 8), None, None, None) for i in range(60)]
    same = [(doc_id, "the very same text of seven words", None, None, None)] * 40
    other = [(doc_id, sentence(rng, 9), None, None, None) for _ in range(30)]
    for hot in (same, other, same + other):
        for heavy in (10, 1000):
            s = Settings(k=8, bucket_bytes=400, heavy=heavy)
            assert found(frame(spark, rows + hot), s) == plain(rows + hot, 8)


def test_hot_rows_do_not_share_a_bucket(spark):
    rows = [(i, f"text {i}", None, None, None) for i in range(300)] + [(None, "copy", None, None, None)] * 3000
    layout = fingerprints._layout(frame(spark, rows), Settings(bucket_bytes=200))
    sizes = [r["count"] for r in fingerprints._in_buckets(layout).groupBy("bucket").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 100
    other = [(None, f"text {i}", None, None, None) for i in range(3000)]
    layout = fingerprints._layout(frame(spark, other), Settings(bucket_bytes=1000))
    sizes = [r["count"] for r in fingerprints._in_buckets(layout).groupBy("bucket").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 600


def test_small_tables_and_clashing_names(spark):
    assert found(frame(spark, []), Settings()) == []
    for rows in ([(3, "a b c d e f", None, None, None)], [(1, None, None, None, None)], [(2, "x", None, None, None)] * 3):
        docs = frame(spark, rows).select("*", *(F.lit(1).alias(c) for c in ("key", "bucket", "own", "times", "guest", "next", "place")))
        assert found(docs, Settings()) == plain(rows, 128)


def test_parts_of_a_long_text_and_groups_merge(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PART", 10)
    texts = [" ".join(f"w{(i * 7 + j) % 90}" for j in range(200)) for i in range(5)]
    docs = frame(spark, [(i, t, None, "ab"[i % 2], None) for i, t in enumerate(texts)])
    s = Settings(k=32)
    sketched = docs.withColumn("sketch", fingerprints.sketch(F.col("text"), s))
    assert [r["sketch"] for r in sketched.orderBy("doc_id").collect()] == [sorted(hashes(t))[:32] for t in texts]
    parsed = sketched.select(fingerprints.parsed(fingerprints.fingerprint(F.col("sketch"))).alias("x"), "sketch").collect()
    assert all(r["x"] == r["sketch"] for r in parsed)
    by_source = {r["source"]: r["sketch"] for r in fingerprints.merged(sketched, ["source"], "sketch", s).collect()}
    assert by_source == {c: sorted(set().union(*(hashes(t) for t in texts["ab".index(c) :: 2])))[:32] for c in "ab"}


def test_estimates(spark):
    rng = random.Random(4)
    half = sentence(rng, 3000)
    x, y = half, half + " " + sentence(rng, 3000)
    s = Settings(k=256)
    a, b = (fingerprints.sketch(F.col(c), s) for c in "xy")
    row = spark.createDataFrame([(x, y)], "x string, y string").select(
        fingerprints.resemblance(a, b, s), fingerprints.containment(a, b, s), fingerprints.containment(b, a, s),
        fingerprints.distinct_shingles(a, s), fingerprints.distinct_shingles(b, s)).first()
    assert abs(row[0] - 0.5) < 0.1 and row[1] == 1.0 and abs(row[2] - 0.5) < 0.1
    assert abs(row[3] / len(hashes(x)) - 1) < 0.25 and abs(row[4] / len(hashes(y)) - 1) < 0.25


def test_native_only():
    import inspect

    source = inspect.getsource(fingerprints)
    assert not re.search(r"udf|InArrow|InPandas|\.rdd|toPandas|numpy|pyarrow", source)
