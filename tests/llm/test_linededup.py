"""Line de-duplication against all pairs of lines in Python."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from loanlens.llm import linededup
from tests.llm.rows import SCHEMA, documents, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIN = linededup.Settings().min_words


def edits(x: tuple, y: tuple) -> int:
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1]


def brute(rows: list[tuple]) -> list[tuple]:
    lines = []
    for doc_id, text, *_ in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = tuple(WORD.findall(line))
            if words:
                lines.append(((doc_id is None, doc_id or 0, k), words))
    first = {}
    for rank, words in lines:
        first[words] = min(rank, first.get(words, rank))
    limit = dict(first)
    long = [w for w in first if len(w) >= MIN]
    for i, x in enumerate(long):
        for y in long[:i]:
            if abs(len(x) - len(y)) <= 1 and edits(x, y) <= 1:
                limit[x], limit[y] = min(limit[x], first[y]), min(limit[y], first[x])
    out = []
    for doc_id, text, *_ in rows:
        gone = [k for k, line in enumerate((text or "").split("\n"))
                if (w := tuple(WORD.findall(line))) and limit[w] < (doc_id is None, doc_id or 0, k)]
        clean = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        out.append((doc_id, gone, clean))
    return out


def many_near_lines() -> list[tuple]:
    rng = random.Random(8)
    base = [f"w{rng.randrange(9999)}" for _ in range(12)]
    rows = []
    for i in range(60):
        words = list(base)
        kind, at = rng.randrange(4), rng.randrange(12)
        if kind == 0:
            words[at] = f"x{rng.randrange(3)}"
        elif kind == 1:
            words.insert(at, f"y{rng.randrange(3)}")
        elif kind == 2:
            del words[at]
        if rng.random() < 0.3:
            words = words[: rng.randrange(6, 11)]
        rows.append((rng.randrange(40), "\n".join([" ".join(words), f"own line {i}", "  ".join(words[:8])]), "en", "s", 0))
    return rows


def check(spark, rows):
    got = sorted(((r["doc_id"], list(r["dropped"]), r["clean_text"]) for r in linededup.deduplicated(frame(spark, rows)).collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)
    return got


def test_all_cases(spark):
    got = check(spark, documents())
    assert sum(bool(r[1]) for r in got) > 10


def test_near_lines(spark):
    check(spark, many_near_lines())


def test_one_edit(spark):
    rng, rows = random.Random(9), []
    for _ in range(400):
        x = [rng.choice("ab") for _ in range(rng.randrange(1, 7))]
        y = list(x)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(y) + 1)
            y[at : at + rng.randrange(2)] = [rng.choice("abc")] * rng.randrange(2)
        if y:
            rows.append((x, y))
    got = spark.createDataFrame(rows, "x array<string>, y array<string>").withColumn("near", linededup.one_edit(F.col("x"), F.col("y"))).collect()
    assert [r["near"] for r in got] == [edits(tuple(r["x"]), tuple(r["y"])) <= 1 for r in got]


def test_rows_keep_their_columns(spark):
    docs = frame(spark).withColumn("clean", F.lit(1)).withColumn("row", F.lit(2)).withColumn("dropped", F.lit(3)).withColumn("h", F.lit("x"))
    out = linededup.cleaned(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    want = [(d, clean) for (d, gone, clean) in brute(documents()) if not gone or WORD.search(clean)]
    assert got == sorted(want, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if r["text"] is not None)


def test_native_only(spark):
    plan = linededup.cleaned(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table(spark):
    assert linededup.deduplicated(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_text_of_very_many_lines(spark):
    """Linear in the lines: every line comes twice, 100,000 in all."""
    lines = [f"line{i} of text{i}" for i in range(50_000)]
    docs = frame(spark, [(1, "\n".join(lines + lines), None, None, None)])
    row = linededup.deduplicated(docs).first()
    assert row["dropped"] == list(range(50_000, 100_000))
    assert row["clean_text"] == "\n".join(lines)


def test_a_line_is_cut_into_words_once_and_a_text_hashed_once(spark):
    """Neither a filter nor a join repeats the words, and the text's hash lies below the split into lines."""
    docs = frame(spark)
    lines = linededup._lines(docs, linededup.Settings())._jdf.queryExecution().executedPlan().toString()
    assert lines.count("regexp_extract_all(") == 1
    assert lines.index("Generate") < lines.index("xxhash64(text")
    wanted = spark.createDataFrame([], "h long, m int, first struct<unnamed:boolean,doc_id:long,k:int>, shared array<struct<half:long,at:int>>")
    found = linededup._with_words(docs, wanted)._jdf.queryExecution().executedPlan().toString()
    assert found.count("regexp_extract_all(") == 1
