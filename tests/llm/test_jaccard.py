"""The n-gram Jaccard join against all pairs in Python."""

from __future__ import annotations

import random
import re

import pytest

from loanlens.llm import jaccard
from loanlens.llm.components import connected_components
from loanlens.llm.state import laid_out_by
from tests.llm.rows import PROSE, SCHEMA, documents, frame, sentence

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows: list[tuple]) -> list[tuple]:
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def found(spark, rows: list[tuple], **settings) -> list[tuple]:
    return [tuple(r) for r in jaccard.near_duplicates(frame(spark, rows), jaccard.Settings(**settings)).collect()]


def test_all_cases(spark):
    assert sorted(found(spark, documents()), key=repr) == sorted(brute(documents()), key=repr)


def chain(rng: random.Random, n: int) -> list[tuple]:
    """Texts of which only neighbours link, so that a class hangs together by single links."""
    words = [f"w{rng.randrange(10**6)}" for _ in range(60 + 2 * n)]
    return [(i, " ".join(words[2 * i : 2 * i + 60]), "en", "s", 0) for i in range(n)]


@pytest.mark.parametrize("rounds", [0, 4])
def test_single_links_are_kept(spark, rounds):
    rows = chain(random.Random(1), 25)
    got = found(spark, rows, most_rounds=rounds, finish_factor=0)
    assert sorted(got) == sorted(brute(rows))
    assert {r[2] for r in got} == {0}


def test_copies_that_link_only_through_their_original(spark):
    rng = random.Random(2)
    base = sentence(rng, 100).split()
    rows = [(1000, " ".join(base), "en", "s", 0)]
    for i in range(120):  # two words changed each: near the original, mostly not near one another
        words = list(base)
        for at in rng.sample(range(100), 2):
            words[at] = f"new{i}"
        rows.append((i, " ".join(words), "en", "s", 0))
    assert sorted(found(spark, rows)) == sorted(brute(rows))


def test_common_passage_does_not_link(spark):
    rng = random.Random(3)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, 30) + " " + passage + " " + sentence(rng, 20 + i % 7), "en", "s", 0) for i in range(60)]
    got = found(spark, rows, sketch_bits=12)
    assert sorted(got) == sorted(brute(rows))
    assert len({r[2] for r in got}) == 60


def test_random_short_texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = [rng.choice(PROSE[:4]) for _ in range(rng.randrange(0, 12))]
        rows.append((i, " ".join(words), "en", "s", 0))
    assert sorted(found(spark, rows)) == sorted(brute(rows))


def test_one_of_each(spark):
    from pyspark.sql import functions as F

    docs = frame(spark).withColumn("node", F.lit(1)).withColumn("row", F.lit(2)).withColumn("lost_id", F.lit(3)).withColumn("k", F.lit(4))
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    classes = brute(documents())
    named = [c for c in classes if c[0] is not None]
    want = {c[0] for c in named if c[1] == 0 or c[0] == c[2]}
    assert sorted(k for k in kept if k is not None) == sorted(want)
    assert kept.count(None) == sum(c[0] is None for c in classes)


def test_one_of_each_judges_rows(spark):
    rng = random.Random(7)
    one, two, three, four, five = (sentence(rng, 40) for _ in range(5))
    near = " ".join([*four.split()[:-1], "changed"])
    rows = [
        (1, one), (1, two), (1, None), (1, " "),  # different texts under one id, none a copy
        (3, three), (5, three), (5, four), (5, ""),  # one text of an id is a copy of an earlier document
        (7, near), (7, near), (9, near),  # a near copy, again, of a text of document 5
        (None, five), (None, five), (None, five.upper()), (None, sentence(rng, 30)),  # copies without ids
    ]
    rows += [(100, sentence(rng, 30)) for _ in range(20)]  # a hot id
    rows += rows[-3:]
    docs = frame(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs).collect()]
    lost = [(5, three), (7, near), (7, near), (9, near), (None, five), (None, five), *rows[-3:]]
    want = list(rows)
    for row in lost:
        want.remove(row)
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_of_one_id_meet_no_other(spark, monkeypatch, doc_id):
    rng = random.Random(8)
    base = sentence(rng, 60).split()
    texts = [" ".join([*base[:-1], f"end{i}"]) for i in range(50)]
    rows = [(doc_id, t, "en", "s", 0) for t in texts + texts[:5]] + [(100, texts[0], "en", "s", 0)]
    written = []

    def counted(df):
        out = cut(df)
        if out.columns == ["node", "text"]:
            written.append(out.count())
        return out

    cut = jaccard.cut
    monkeypatch.setattr(jaccard, "cut", counted)
    assert sorted(found(spark, rows), key=repr) == sorted(brute(rows), key=repr)
    assert written == [50]


def test_empty_table(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert jaccard.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_whole_texts_are_shuffled_once(spark):
    """Before they are written, by node; a verification brings its pairs to the written texts."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    s, before = jaccard.Settings(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = spark.createDataFrame([(1,)], "node long").distinct()
        fetched = jaccard._texts(frame(spark), nodes, s)
        assert plan(fetched).count("Exchange") == 2  # the texts and the nodes
        with laid_out_by("node"):
            texts = jaccard.cut(fetched)
        verified = plan(jaccard._verify(spark.createDataFrame([], "a long, b long"), texts, s))
        assert "Bucketed: true" in verified and verified.count("Exchange hashpartitioning(node") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_members_of_large_tokens_are_found_once_a_turn(spark, monkeypatch):
    plans, leaders = [], jaccard._to_leaders

    def seen(rows, turn, s):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return leaders(rows, turn, s)

    monkeypatch.setattr(jaccard, "_to_leaders", seen)
    rng = random.Random(3)
    passage = sentence(rng, 60)
    rows = [(i, f"{passage} {' '.join(f'w{rng.randrange(10**6)}' for _ in range(20))}", "en", "s", 0) for i in range(12)]
    got = found(spark, rows, small_group=2, finish_factor=0, most_rounds=1, sketch_bits=1)  # the passage is in every prefix
    assert sorted(got) == sorted(brute(rows))
    assert plans and not any("Join" in p for p in plans)
