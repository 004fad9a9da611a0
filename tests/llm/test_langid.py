"""Language identification: held-out accuracy and odd rows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import langid
from loanlens.llm import words as W
from loanlens.llm.queries import op5_language_id
from tests.llm.rows import SCHEMA, frame


def test_held_out_accuracy(spark):
    rows = op5_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    told = [r for r in held if r["lang_pred"] != langid.UNKNOWN and truth[r["doc_id"]]["lang"]]
    right = lambda some: np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in some])
    assert right(told) > 0.95
    sure = [r for r in told if not r["rejected"]]
    assert len(sure) > 0.7 * len(told) and right(sure) >= right(told)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_rows(spark):
    docs = frame(spark).withColumn("lang_pred", F.lit("mine")).withColumn("letters", F.lit(1)).withColumn("score", F.lit(2))
    model = langid.fit(docs, F.lit(True))
    out = langid.predict(docs, model, ["doc_id", "text"]).collect()
    assert len(out) == docs.count()
    for r in out:
        none = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == langid.UNKNOWN) == none
        assert r["score"] == 0 if none else r["lang_pred"] in model.languages


def test_every_language_is_learned(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(80):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)]
        rows += [(len(rows) + k, " ".join(rng.choice(words, 40)), f"l{i:02}", "s", 0) for k in range(40 - i // 4)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = langid.fit(docs, F.lit(True))
    assert model.languages == [f"l{i:02}" for i in range(80)]
    out = langid.predict(docs, model, ["lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95
    assert len({r["lang_pred"] for r in out}) == 80


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.fit(empty, F.lit(True)) is None
    assert langid.predict(empty, None, ["doc_id"]).count() == 0
    assert langid.fit(frame(spark), F.lit(False)) is None
    assert {r["lang_pred"] for r in langid.predict(frame(spark), None, ["doc_id"]).collect()} == {langid.UNKNOWN}


def test_features_do_not_hang_on_chunks():
    import pyarrow as pa

    s = langid.Settings()
    column = pa.array(["Straße und Weg", None, "", "a", "the thing  there", "É"])
    whole = [features for c in W.chunks(column) for features in langid.features(c, s)]
    apart = [features for c in W.chunks(column, 1) for features in langid.features(c, s)]
    assert np.array_equal(whole, apart)
    assert [round(float(x.sum()), 3) for x in whole] == [1, 0, 0, 0, 1, 1]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_a_label_under_one_doc_id_is_learned_and_copies_count_once(spark, doc_id):
    rng = np.random.default_rng(4)
    rows = []
    for lang in ("aa", "bb", "cc"):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(30)]
        rows += [(doc_id if lang == "bb" else len(rows) + k, " ".join(rng.choice(words, 30)), lang, "s", 0) for k in range(100)]
    rows += [(doc_id, "the very same text again and again", "bb", "s", 0)] * 400
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    s = langid.Settings(per_language=40, sample_rows=90)
    told = docs.select("doc_id", "text", "lang")
    drawn = langid.sample(told, 30, s).collect()
    assert {lang: sum(r["lang"] == lang for r in drawn) for lang in ("aa", "bb", "cc")} == {"aa": 30, "bb": 30, "cc": 30}
    assert sorted(langid.sample(told.repartition(3), 30, s).collect()) == sorted(drawn)
    model = langid.fit(docs, F.lit(True), s)
    assert model.languages == ["aa", "bb", "cc"]
    out = langid.predict(docs.distinct(), model, ["lang"]).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.95


@pytest.mark.parametrize("sample_rows", [10, 51_200])
def test_the_sample_is_the_smallest_draws_of_a_hot_label(spark, sample_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", F.when(F.col("doc_id") % 3 == 0, "rare").otherwise("hot").alias("lang")).where("text IS NOT NULL")
    told, s = docs.unionByName(docs), langid.Settings(sample_rows=sample_rows)
    draws = docs.select("lang", F.xxhash64(F.col("doc_id").cast("string"), "text", F.lit(s.seed)).alias("draw")).collect()
    wanted = [(lang, d) for lang in ("hot", "rare") for d in sorted({r["draw"] for r in draws if r["lang"] == lang})[:20]]
    sampled = langid.sample(told, 20, s)
    assert sorted((r["lang"], r["draw"]) for r in sampled.collect()) == sorted(wanted)
    exchanges = re.findall(r"hashpartitioning\(([^)]*)\)", sampled._jdf.queryExecution().executedPlan().toString())
    assert exchanges and all("draw" in keys for keys in exchanges)  # texts never meet by label alone


def slow_features(text: str, s: langid.Settings) -> np.ndarray:
    """N-grams one by one: those of 2 to 4 bytes whose inner bytes are no white space."""
    data = [0x20 if b in (0x20, 9, 10, 11, 12, 13) else b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    out = np.zeros(s.buckets)
    for length in s.lengths:
        for i in range(len(data) - length + 1):
            gram = data[i : i + length]
            if 0x20 not in gram[1:-1]:
                code = int.from_bytes(bytes(gram), "big") + (length << 40)
                out[int(W.mix(np.array([code], np.uint64))[0]) % s.buckets] += 1
    return out / max(1, out.sum())


def test_features_and_forward_pass_against_a_slow_reference():
    import pyarrow as pa

    s = langid.Settings(buckets=512)
    rng = np.random.default_rng(1)
    texts = ["Straße und Weg", "", "a b", "ABC  def\n\tghi", "漢字 x", "The quick brown fox jumps over it"]
    fast = np.concatenate([langid.features(c, s) for c in W.chunks(pa.array(texts))])
    slow = np.array([slow_features(t, s) for t in texts])
    assert np.allclose(fast, slow, atol=1e-7)
    model = langid.Model(["x", "y", "z"], rng.normal(size=(512, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32), 0.5)
    for vector, chance in zip(slow, model.probabilities(fast), strict=True):
        score = [sum(vector[b] * float(model.table[b, k]) for b in np.flatnonzero(vector)) + float(model.bias[k]) for k in range(3)]
        want = np.exp(score) / np.exp(score).sum()
        assert np.allclose(chance, want, atol=1e-5)


def test_sparse_rows():
    x = langid.Sparse(np.array([0, 2, 2, 3]), np.array([1, 3, 0]), np.array([0.5, 0.5, 1.0]), 4)
    assert len(x) == 3 and x.dense(np.array([2, 0, 1])).tolist() == [[1, 0, 0, 0], [0, 0.5, 0, 0.5], [0, 0, 0, 0]]
