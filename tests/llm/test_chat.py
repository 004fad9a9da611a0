"""Chat rendering against SQL and, on a few turns, by hand."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from loanlens.llm import chat, sql
from tests.llm.rows import same_rows

SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Hello\nthere"), (1, 3, "ann", None), (1, 3, "bob", "tie"), (1, 3, "bob", "tie"),
    (2, 0, "system", "alone"), (3, None, "ann", "no turn"), (3, 0, None, "no role"), (3, 0, "ann", ""), (None, 0, "eve", "no id"), (None, 1, "ann", "ü 漢"),
    *[(4, i, "ann" if i % 2 else "bob", f"turn {i} " * (1 + i % 3)) for i in range(300)], *[(5, 7, "ann", f"same {i}") for i in range(150)],
    (6, 0, "ann", "long " * 30_000), (6, 1, "bob", "x"),
]


@pytest.mark.parametrize("size", [3, 64])
def test_sql(spark, size):
    s = chat.Settings(part_turns=size)
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", TURNS)
    same_rows(chat.render(spark.createDataFrame(TURNS, SCHEMA), s), con.sql(sql.chat_formatting(s)).df())


def test_spans_cover_what_the_assistant_says(spark):
    rows = chat.render(spark.createDataFrame(TURNS, SCHEMA).withColumn("speaker", F.lit("mine")).withColumn("part", F.lit(9))).collect()
    said = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        for span in filter(None, r["loss_spans"].split(",")):
            a, b = map(int, span.split("-"))
            said.setdefault((r["conv_id"], r["speaker"]), []).append(r["text"][a:b])
    assert said[1, "bob"] == ["Hello\nthere<|im_end|>", "tie<|im_end|>"]
    assert said[1, "ann"] == ["Hi<|im_end|>", "<|im_end|>"]
    assert (2, "system") not in said and (None, "ann") in said and (3, "unknown") in said
    first = next(r for r in rows if (r["conv_id"], r["speaker"]) == (1, "bob"))
    assert first["text"] == ("<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user name=ann\nHi<|im_end|>\n<|im_start|>assistant\nHello\nthere<|im_end|>\n"
                             "<|im_start|>user name=ann\n<|im_end|>\n<|im_start|>assistant\ntie<|im_end|>\n")


def test_empty_table(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).count() == 0
