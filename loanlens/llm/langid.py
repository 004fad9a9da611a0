"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's features are its byte n-grams of 2 to 4 bytes that lie within a word, word edges
included, hashed into ``buckets``.  The mean of their embeddings goes through a linear layer
and a softmax.  Embeddings and layer are trained together by stochastic gradient descent
in numpy, on a bounded sample: of every label the ``per_language`` texts with the smallest hash of key and text
(fewer of each, but one, where that passes ``sample_rows``), so no label is lost and repeated rows count once.  The
sample comes to the driver as (bucket, share) pairs.  One text in five of it sets the softmax's
temperature and the score below which a prediction counts as rejected.

Prediction is one pass over the whole texts without a shuffle.  Only embeddings @ layer, one
table of buckets x languages, is sent to the executors; its size follows from the settings.

Defined results: ``und`` with score 0.0 (and rejected) for a null text or one without a letter, or
where nothing could be learned; a null label is never learned from; repeated rows get equal
predictions; rows that share a doc_id, or have none, are drawn by their texts; texts of any length are used whole;
of an empty table nothing is learned and nothing predicted.  Labels, sources and ids are not features.  Columns
other than doc_id, text, lang and those to carry are not read, so they may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm import words as W
from loanlens.llm.state import cut

UNKNOWN = "und"
SALTS = 64  # parts of a label's draws


@dataclass(frozen=True)
class Settings:
    buckets: int = 4096
    lengths: tuple[int, ...] = (2, 3, 4)
    dim: int = 16
    per_language: int = 800
    sample_rows: int = 51_200
    epochs: int = 12
    least_steps: int = 60  # per language: many languages with few rows each take more epochs
    batch: int = 16
    rate: float = 40.0
    precision: float = 0.995  # wanted among the predictions that aren't rejected
    seed: int = 3


def features(chunk: W.Chunk, s: Settings) -> np.ndarray:
    """Mean one-hot vector of each text's n-grams (all 0 where there are none)."""
    data = W.LOWER[chunk.data]
    n = len(data)
    space = W.SPACE[data]
    data = np.where(space, np.uint8(0x20), data)
    out = np.zeros(chunk.rows * s.buckets, dtype=np.int64)
    text = np.repeat(np.arange(chunk.rows, dtype=np.int64), np.diff(chunk.offsets))
    for length in s.lengths:
        if n < length:
            continue
        code = np.zeros(n - length + 1, dtype=np.uint64)
        fine = text[: n - length + 1] == text[length - 1 :]
        for i in range(length):
            code = code * np.uint64(256) + data[i : n - length + 1 + i]
            if 0 < i < length - 1:
                fine &= ~space[i : n - length + 1 + i]
        at = np.flatnonzero(fine)
        bucket = (W.mix(code[at] + np.uint64(length << 40)) % np.uint64(s.buckets)).astype(np.int64)
        out += np.bincount(text[at] * s.buckets + bucket, minlength=len(out))
    out = out.reshape(chunk.rows, s.buckets).astype(np.float32)
    return out / np.maximum(1, out.sum(axis=1, keepdims=True))


@dataclass(frozen=True)
class Sparse:
    """Rows of mostly empty vectors: row i has value[bounds[i]:bounds[i + 1]] in buckets bucket[...]."""

    bounds: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    width: int

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def dense(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width), dtype=np.float32)
        for k, i in enumerate(rows):
            own = slice(self.bounds[i], self.bounds[i + 1])
            out[k, self.bucket[own]] = self.value[own]
        return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings @ layer, divided by the temperature
    bias: np.ndarray
    least_score: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(x @ self.table + self.bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: Sparse, labels: list[str], s: Settings) -> Model:
    """Fit on rows of ``x``; one row in five is kept aside for the temperature and the rejection score."""
    languages = sorted(set(labels))
    place = {v: i for i, v in enumerate(languages)}
    y = np.array([place[v] for v in labels])
    rng = np.random.default_rng(s.seed)
    aside = rng.random(len(y)) < 0.2
    aside[np.unique(y, return_index=True)[1]] = False  # something to learn from in every language
    if aside.all() or len(y) < 20:
        aside[:] = False
    embed = rng.normal(0, 0.1, (s.buckets, s.dim))
    layer, bias = rng.normal(0, 0.1, (s.dim, len(languages))), np.zeros(len(languages))
    train_rows = np.flatnonzero(~aside)
    a_turn = max(1, -(-len(train_rows) // s.batch))
    epochs = max(s.epochs, -(-s.least_steps * len(languages) // a_turn))
    steps, done = epochs * a_turn, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(train_rows), a_turn):
            now = x.dense(rows)
            mean = now @ embed
            gap = softmax(mean @ layer + bias)
            gap[np.arange(len(rows)), y[rows]] -= 1
            gap /= len(rows)
            rate = s.rate * (1 - done / steps)
            step = now.T @ (gap @ layer.T)
            layer -= 0.01 * rate * (mean.T @ gap)
            bias -= 0.001 * rate * gap.sum(axis=0)
            embed -= rate * step
            done += 1
    check = np.flatnonzero(aside) if aside.any() else train_rows
    z = np.concatenate([x.dense(rows) @ embed @ layer + bias for rows in np.array_split(check, -(-len(check) // 1024))])
    loss = lambda t: -np.log(softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean()
    heat = min(np.geomspace(0.2, 5, 41), key=loss)
    chance = softmax(z / heat)
    right, top = chance.argmax(axis=1) == y[check], chance.max(axis=1)
    order = np.argsort(-top)
    exact = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(exact >= s.precision)
    least = float(top[order[enough[-1]]]) if len(enough) else 1.0
    return Model(languages, (embed @ layer / heat).astype(np.float32), (bias / heat).astype(np.float32), least)


def _featured(texts: DataFrame, s: Settings) -> DataFrame:
    """``lang``, ``draw`` and the features of each text, as far as they aren't 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for chunk in W.chunks(part.column("text")):
                    x = features(chunk, s)
                    row, bucket = np.nonzero(x)
                    bounds = pa.array(np.searchsorted(row, np.arange(chunk.rows + 1)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c).slice(chunk.first, chunk.rows) for c in ("lang", "draw")]
                        + [pa.ListArray.from_arrays(bounds, pa.array(bucket.astype(np.int32))),
                           pa.ListArray.from_arrays(bounds, pa.array(x[row, bucket]))], ["lang", "draw", "bucket", "value"])

    return texts.select("lang", "draw", "text").mapInArrow(run, "lang string, draw long, bucket array<int>, value array<float>")


def sample(told: DataFrame, each: int, s: Settings) -> DataFrame:
    """Of every label exactly the ``each`` texts with the smallest draws (all, if fewer), with repeated rows once.

    The draws are cut to ``each`` in salted parts of a label first, so that no task gets a label's rows whole, and
    written; texts are then fetched where they are scanned, by draw and hashed label.  These keys are broadcast if
    there are at most ``sample_rows``, at 16 bytes each; else both sides are shuffled by key, not by label.
    """
    drawn = told.withColumn("draw", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text", F.lit(s.seed)))
    drawn = drawn.withColumn("tag", F.xxhash64("lang"))
    low = drawn.select("tag", "draw").distinct().withColumn("salt", F.pmod("draw", F.lit(SALTS)))
    for key in (["tag", "salt"], ["tag"]):
        low = low.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("draw"))).where(F.col("nth") <= each)
    keys = cut(low.select("tag", "draw"))
    if keys.count() <= s.sample_rows:
        keys = F.broadcast(keys)
    return drawn.join(keys, ["tag", "draw"], "left_semi").select("lang", "draw", "text").dropDuplicates(["lang", "draw"])


def fit(documents: DataFrame, learn_from: Column, s: Settings = Settings()) -> Model | None:
    """A model of (text, lang), learned from a sample of the rows that ``learn_from`` marks; None if there are none."""
    told = documents.where(learn_from & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    languages = told.select("lang").distinct().count()
    if not languages:
        return None
    each = min(s.per_language, max(1, s.sample_rows // languages))
    drawn = _featured(sample(told, each, s), s).toArrow().combine_chunks()  # at most each * languages rows
    labels, draw = np.array(drawn.column("lang").to_pylist()), drawn.column("draw").to_numpy()
    order = np.lexsort((draw, labels))  # the same model however the rows arrive
    drawn = drawn.take(pa.array(order)).combine_chunks()
    bucket, value = (drawn.column(c).chunk(0) for c in ("bucket", "value"))
    x = Sparse(np.asarray(bucket.offsets).astype(np.int64) - bucket.offsets[0].as_py(), np.asarray(bucket.flatten()), np.asarray(value.flatten()), s.buckets)
    return train(x, [str(v) for v in labels[order]], s)


def predict(documents: DataFrame, model: Model | None, carried: list[str], s: Settings = Settings()) -> DataFrame:
    """``carried`` columns (names of ``documents``) with lang_pred, score and rejected."""
    row = documents.select(F.struct(*carried).alias("row"), F.col("text").alias("text"))
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return row.select("row.*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                known = part.column("letters")
                for chunk in W.chunks(part.column("text")):
                    chance = m.probabilities(features(chunk, s))
                    sure = known.slice(chunk.first, chunk.rows).to_numpy(zero_copy_only=False)
                    name = np.where(sure, np.array(m.languages, dtype=object)[chance.argmax(axis=1)], UNKNOWN)
                    score = np.where(sure, chance.max(axis=1).astype(np.float64), 0.0)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("row").slice(chunk.first, chunk.rows), pa.array(name, pa.string()), pa.array(score),
                         pa.array(score < m.least_score)], ["row", "lang_pred", "score", "rejected"])

    schema = row.select("row").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    return row.withColumn("letters", letters).mapInArrow(run, schema).select("row.*", "lang_pred", "score", "rejected")
