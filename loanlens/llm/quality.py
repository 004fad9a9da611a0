"""Quality rules by repetition coverage.

For every text, rolling hashes of several n-gram lengths find the n-grams that occur
twice or more, and the characters inside them (each character once per length) are set
against all word characters; the same is done for repeated lines.  A text is rejected
when a share passes its limit, or when one of the base rules fails.

Defined results: a null or empty text, or one without words, has all counts 0 and fails
the base rules (fewer than 20 words).  Rows are judged one by one, so repeated rows and
null ids change nothing.  A text of any length is read whole; memory is bounded by a
run of texts of about 2 MB, or by the longest single text.  Further columns of the
input, whatever their names, pass through ``rejected_removed`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm import words as W

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = True

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Limits:
    """Most allowed shares, in hundredths of the word characters (lines: of characters in lines with a word)."""

    ngrams: dict[int, int] = field(default_factory=lambda: {5: 45, 6: 42, 7: 39, 8: 36, 9: 33, 10: 30})
    lines: int = 30
    min_words: int = 20
    repeat_window: int = 8
    max_repeat: int = 30


def dup_column(n: int) -> str:
    return f"dup_chars_{n}"


def measure(chunk: W.Chunk, limits: Limits) -> dict[str, np.ndarray]:
    """Counts for each text of a chunk."""
    data, words = chunk.data, W.find_words(chunk)
    bounds = words.bounds
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])  # code points before a byte
    lengths = point[words.ends] - point[words.starts]
    out = {"n_words": np.diff(bounds), "word_chars": W.per_text(lengths, bounds)}
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data], dtype=np.int64)])
    out["n_symbols"] = symbols[chunk.offsets[1:]] - symbols[chunk.offsets[:-1]]

    hashes = W.word_hashes(chunk, words)
    text_of = words.text_of
    salt = W.mix(np.arange(1, chunk.rows + 1, dtype=np.uint64))
    twice = None
    for n in sorted({*limits.ngrams, limits.repeat_window}):
        # a longer n-gram can only occur twice where a shorter one with the same first word does
        begin, grams = W.ngrams(hashes, bounds, n, among=twice)
        twice = begin[W.repeated(W.mix(grams ^ salt[text_of[begin]]))]
        steps = np.zeros(len(hashes) + 1, dtype=np.int64)
        steps[twice] += 1
        steps[twice + n] -= 1
        inside = np.cumsum(steps[:-1]) > 0
        if n in limits.ngrams:
            out[dup_column(n)] = W.per_text(lengths * inside, bounds)
        if n == limits.repeat_window:
            out["n_repeat_words"] = W.per_text(inside, bounds)
    out |= line_counts(chunk, words, point, salt)
    return out


def line_counts(chunk: W.Chunk, words: W.Words, point: np.ndarray, salt: np.ndarray) -> dict[str, np.ndarray]:
    """Lines with a word that equal an earlier line of their text, and the characters in them."""
    begins = np.unique(np.concatenate([chunk.offsets[:-1][np.diff(chunk.offsets) > 0],
                                       np.flatnonzero(chunk.data == 0x0A) + 1]))
    begins = begins[begins < len(chunk.data)]
    if len(begins) == 0:
        none = np.zeros(chunk.rows, dtype=np.int64)
        return {"n_dup_lines": none, "line_chars": none, "dup_line_chars": none}
    # a line ends at its own newline, at the end of its text, or where the next line begins
    ends = np.append(begins[1:], len(chunk.data))
    ends = ends - (chunk.data[ends - 1] == 0x0A)
    has_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, begins)
    begins, ends = begins[has_word], ends[has_word]
    text = np.searchsorted(chunk.offsets, begins, side="right") - 1
    values = chunk.data.astype(np.uint64) + np.uint64(1)
    keys = W.mix(W.spans_hash(values, begins, ends, W.BYTE_BASE) ^ salt[text])
    order = np.argsort(keys, kind="stable")
    later = np.zeros(len(keys), dtype=bool)
    later[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    size = point[ends] - point[begins]
    rows = chunk.rows
    total = lambda w: np.bincount(text, weights=w, minlength=rows).astype(np.int64)
    return {"n_dup_lines": total(later), "line_chars": total(size), "dup_line_chars": total(size * later)}


def _judged(documents: DataFrame, limits: Limits, carried: list[str]) -> DataFrame:
    """``row`` (a struct of the carried columns) and ``found`` (counts and verdicts) for every row."""
    names = [*COUNTS, "line_chars", "dup_line_chars", *(dup_column(n) for n in sorted(limits.ngrams))]
    with_text = "text" in carried
    source = documents.select(F.struct(*carried).alias("row"), *([] if with_text else [F.col("text").alias("text")]))
    schema = T.StructType([source.schema["row"], T.StructField("counts", T.StructType(
        [T.StructField(x, T.LongType()) for x in names]))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column("row")
            for chunk in W.chunks(row.field("text") if with_text else batch.column("text")):
                got = measure(chunk, limits)
                counts = pa.StructArray.from_arrays([pa.array(got[x], pa.int64()) for x in names], names)
                yield pa.RecordBatch.from_arrays([row.slice(chunk.first, chunk.rows), counts], ["row", "counts"])

    n = {x: F.col(f"counts.{x}") for x in names}
    base_failed = (n["n_words"] < limits.min_words) | (
        100 * n["n_repeat_words"] > limits.max_repeat * n["n_words"])
    bad = 100 * n["dup_line_chars"] > limits.lines * n["line_chars"]
    for length, most in limits.ngrams.items():
        bad = bad | (100 * n[dup_column(length)] > most * n["word_chars"])
    verdict = F.struct(*n.values(), base_failed.alias("base_failed"), (~base_failed & ~bad).alias("kept"))
    return source.mapInArrow(run, schema).select("row", verdict.alias("found"))


def score(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for every row.  One pass over the table: no shuffle."""
    return _judged(documents, limits, ["doc_id"]).select("row.doc_id", "found.*")


def rejected_removed(documents: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The input without the rows that the rules reject, same columns in the same order."""
    return _judged(documents, limits, documents.columns).where("found.kept").select("row.*")
