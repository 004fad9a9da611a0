"""Source divergence against a plain count in Python, and against its SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlens.llm import divergence, sql
from tests.llm.rows import SCHEMA, documents, frame, same_rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, s=divergence.Settings()):
    docs = [((r[2] or ""), (r[3] or ""), TERM.findall((r[1] or "").translate(LOWER))) for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= s.min_docs]
        uses = defaultdict(Counter)
        for _, source, terms in mine:
            uses[source].update(t for t in terms if held[t] >= s.min_docs)
        everyone = sum(uses.values(), Counter())

        def p(count, t):
            return 1 + s.unit * (count[t] + 1) // (sum(count.values()) + len(kept))

        for source in uses:
            pairs = [(sum((p(uses[source], t) - p(uses[b], t)) ** 2 // p(uses[b], t) for t in kept), b) for b in uses if b != source]
            terms = [((p(uses[source], t) - p(everyone, t)) ** 2 // p(everyone, t), t) for t in kept
                     if uses[source][t] > 0 and p(uses[source], t) > p(everyone, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, s.top_terms)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def audited(spark, rows, s=divergence.Settings()):
    found = divergence.audit(frame(spark, rows), s).select("lang", "source", "part", "item", "value", "rank")
    return sorted(tuple(r) for r in found.collect())


def test_equals_plain_count(spark):
    assert audited(spark, documents()) == plain(documents())


def test_equals_sql(spark):
    con = duckdb.connect()
    docs = frame(spark).toPandas()  # noqa: F841
    con.execute("CREATE TABLE documents AS SELECT * FROM docs")
    same_rows(divergence.audit(frame(spark)), con.sql(sql.source_divergence()).df())


def test_rank_limit_and_one_shard_per_text(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_BYTES", 100)
    s = divergence.Settings(min_docs=2, top_terms=3)
    assert audited(spark, documents(), s) == plain(documents(), s)


def test_hot_source_words_in_one_language_and_none_in_another(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["the"] * 50 + rng.choices(["der", "Haus", "naïve", "漢字"], k=5)), "en", "hot" if i % 3 else f"s{i % 7}", 0)
            for i in range(300)]
    rows += [(1000 + i, text, "xx", f"s{i}", 0) for i, text in enumerate((None, "", "1 2 3", "einmal"))]
    rows += [(None, "the the", None, None, None)] * 3
    assert audited(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert audited(spark, []) == []


def test_clashing_columns(spark):
    names = ["term", "n", "docs", "at", "uses", "sums", "n_terms", "sources", "value", "rank", "item", "part"]
    docs = frame(spark).select("*", *(F.lit("x").alias(c) for c in names))
    got = sorted(tuple(r) for r in divergence.audit(docs).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == plain(documents())


@pytest.mark.parametrize("longest", [3, 20, 300])
def test_pointer_sort(longest):
    rng = random.Random(longest)
    words = [bytes(rng.choices(b"ab", k=rng.randrange(1, longest))) for _ in range(400)]
    words += [b"a" * n for n in (7, 8, 9, 15, 16, 17, 64, 65, 200)] * 2 + [b"a" * 64 + b"b", b"a" * 64 + b"b"]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    leading = np.array([rng.randrange(2) for _ in words])
    order, new = divergence.sorted_runs(data, starts, ends, leading)
    want = sorted(range(len(words)), key=lambda i: (leading[i], words[i], i))
    assert order.tolist() == want
    assert new.tolist() == [k == 0 or (leading[i], words[i]) != (leading[want[k - 1]], words[want[k - 1]]) for k, i in enumerate(want)]


def test_counts_beyond_64_bits():
    count = np.array([[10**12, 0]])
    got = divergence.weights(count, np.array([10**12, 5]), 1, 10**9)
    assert got.tolist() == [[1 + 10**9 * (10**12 + 1) // (10**12 + 1), 1 + 10**9 // 6]]
