"""Small documents with the cases that every operator must bear."""

from __future__ import annotations

import random

import pandas as pd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(PROSE) + rng.choice(["", "s", "ed", "ing", "ly", "er"]) + str(rng.randrange(30)) for _ in range(n))


def documents() -> list[tuple]:
    """Copies, near copies, shared lines, short, empty, null and very long texts, null columns, repeated rows."""
    rng = random.Random(5)
    base = [sentence(rng, 60) for _ in range(6)]
    out = []
    add = lambda text, lang="en", source="src1", doc_id=...: out.append(
        (len(out) if doc_id is ... else doc_id, text, lang, source, None if text is None else len(text)))
    for b in base:
        add(b)
        add(b, source="src0")
        words = b.split(" ")
        add(" ".join([*words[:-1], "changed"]), lang="de")
        add(" ".join([*words[:30], "one", "two", *words[30:]]), lang="fr", source=None)
    shared = sentence(rng, 14)
    for _ in range(5):
        add("\n".join([sentence(rng, 12), shared, sentence(rng, 25), "", "  "]), lang=None)
    add("\n".join([shared.replace(" ", "\t"), " ".join(shared.split()[1:]), shared + " more", sentence(rng, 30)]))
    for text in (None, "", " \t\n\x0b\x0c\r ", "one", "two words", "a b c d", "ONE", "12 34", "\n\n", "é ü 漢字  x"):
        add(text)
    add("\n".join([sentence(rng, 30)] * 40))  # one line again and again
    add(("spam " * 200).strip())
    add(" ".join(sentence(rng, 5000) for _ in range(6)), source="src2")  # very long
    add("#*$%&|<> " * 12 + sentence(rng, 30))
    add("<|endoftext|> it's DON'T foo<|startoftext|>bar " + sentence(rng, 30))
    out.append(out[0])
    out.append(out[0])  # repeated rows
    add(sentence(rng, 40), doc_id=None)
    add(base[0], doc_id=None)
    add(None, lang=None, source=None, doc_id=None)
    return out


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def same_rows(spark_frame, sql_frame) -> None:
    """Equal columns and equal rows, in any order."""
    got = spark_frame.toPandas()
    names = sorted(sql_frame.columns)
    assert sorted(got.columns) == names

    def plain(f):
        rows = f[names].astype(object).itertuples(index=False, name=None)
        return sorted((tuple(None if pd.isna(x) else x for x in r) for r in rows), key=repr)

    assert plain(got) == plain(sql_frame)
