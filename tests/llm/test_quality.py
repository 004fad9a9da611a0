"""Quality rules against a plain count in Python."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from loanlens.llm import quality
from tests.llm.rows import SCHEMA, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text: str | None, limits: quality.Limits) -> dict:
    text = text or ""
    words = WORD.findall(text)

    def inside(n: int) -> list[int]:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        seen = {g: grams.count(g) for g in set(grams)} if len(grams) < 1500 else __import__("collections").Counter(grams)
        return sorted({i + j for i, g in enumerate(grams) if seen[g] > 1 for j in range(n)})

    lines, earlier, dup, dup_chars, chars = text.split("\n"), set(), 0, 0, 0
    for line in lines:
        if WORD.search(line):
            chars += len(line)
            if line in earlier:
                dup, dup_chars = dup + 1, dup_chars + len(line)
            earlier.add(line)
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
           "n_dup_lines": dup, "n_repeat_words": len(inside(limits.repeat_window)), "line_chars": chars, "dup_line_chars": dup_chars}
    for n in limits.ngrams:
        out[f"dup_chars_{n}"] = sum(len(words[i]) for i in inside(n))
    out["base_failed"] = out["n_words"] < 20 or 100 * out["n_repeat_words"] > 30 * out["n_words"]
    out["kept"] = not out["base_failed"] and 100 * dup_chars <= limits.lines * chars and all(
        100 * out[f"dup_chars_{n}"] <= most * out["word_chars"] for n, most in limits.ngrams.items())
    return out


def test_counts_match(spark):
    limits = quality.Limits()
    got = sorted((r.asDict() for r in quality.score(frame(spark)).collect()), key=repr)
    want = sorted(({"doc_id": r[0]} | counted(r[1], limits) for r in documents()), key=repr)
    assert [sorted(r.items()) for r in got] == [sorted(r.items()) for r in want]
    assert any(r["kept"] for r in got) and any(r["base_failed"] for r in got)


def test_small_chunks_give_the_same(spark):
    import pyarrow as pa

    from loanlens.llm import words as W

    column = pa.array([r[1] for r in documents()])
    rows = lambda size: [
        tuple(int(v[i]) for v in found.values()) for c in W.chunks(column, size)
        for found in [quality.measure(c, quality.Limits())] for i in range(c.rows)]
    assert rows(1) == rows(1000) == rows(W.CHUNK_BYTES)


def test_rows_pass_with_all_columns(spark):
    docs = frame(spark).withColumn("kept", F.lit("mine")).withColumn("found", F.lit(1)).withColumn("row", F.lit(2)).withColumn("counts", F.lit(3))
    out = quality.rejected_removed(docs)
    assert out.columns == docs.columns
    limits = quality.Limits()
    want = [r[0] for r in documents() if counted(r[1], limits)["kept"]]
    assert sorted((r["doc_id"] for r in out.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert quality.score(spark.createDataFrame([], SCHEMA)).count() == 0
