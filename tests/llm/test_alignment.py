"""Alignment of two tokenizers against whole texts, tokenized and compared one by one."""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanlens.llm import alignment
from tests.llm.rows import SCHEMA, documents, frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
READER = Tokenizer.from_file(A)
READER.encode_special_tokens = True

ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "  a   b  ", "a \n b", "a\n\n b", "\n", "\t x", "a  b  c", "a　b 　c",
       "x \x1c y", "a\x85 b \x85c", "▁", "a▁ b", "a ▁b", "don't I'll", "<s> </s> <unk> <0x0A>", "<|endoftext|> x<|endoftext|>", "é ü 漢字 👩‍👩‍👧 \x00 x",
       "é ﬁ ½ Å", "a" * 3000, "ab " * 2000, "漢字" * 500, ";\r\n ;\r", "\r \r\r ", "e   f ​ g"]


def tokens(text):
    """Ids and byte intervals of both tokenizers, or None where they do not cover a space and the text."""
    t = alignment.tokenizers(A, B)
    whole = b" " + text.encode()
    a, b = READER.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
    if not text or b"".join(t.a_bytes[i] for i in a) != whole or b"".join(t.b_bytes[i] for i in b) != whole:
        return None
    return [[(i, int(s), int(s) + len(of[i])) for i, s in zip(ids, np.cumsum([0] + [len(of[i]) for i in ids]), strict=False)]
            for ids, of in ((a, t.a_bytes), (b, t.b_bytes))]


def plain(texts):
    found = [tokens(x or "") for x in texts]
    links = [[(i, j) for i, _, e in f[0] for j in [ends.get(e)] if j is not None] if f else []
             for f in found for ends in [{end: j for j, _, end in f[1]} if f else {}]]
    count = Counter(x for some in links for x in some)
    highest = defaultdict(int)
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    rows = []
    for f, some in zip(found, links, strict=True):
        if f is None:
            rows.append((0, 0, 0, 0, "", 0, 0))
            continue
        a, b = f
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = [([], []) for _ in cuts]
        for k, side in enumerate(f):
            for i, _, e in side:
                groups[bisect_left(cuts, e)][k].append(str(i))
        digest = ";".join("|".join(",".join(ids) for ids in g) for g in groups)
        rows.append((len(a), len(b), len(cuts), len(some), hashlib.sha256(digest.encode()).hexdigest(),
                     sum(count[x] == highest[x[1]] for x in some), sum(count[x] for x in some)))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


def statistics(docs):
    return Counter((r[0], *r[1:]) for r in alignment.link_statistics(docs, A, B).select("doc_id", *COLUMNS).collect())


@pytest.mark.parametrize("block", [1 << 22, 64])
def test_equals_whole_texts(spark, monkeypatch, block):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", block)
    short = [r for r in documents() if r[1] is None or len(r[1]) < 20_000]
    rows = short + [(5000 + i, x, None, None, None) for i, x in enumerate(ODD)] + [(None, "one two", None, None, None)] * 2
    want = plain([r[1] for r in rows])
    assert statistics(frame(spark, rows)) == Counter((r[0], *w) for r, w in zip(rows, want, strict=True))


def test_very_long_text_and_clashing_names(spark):
    rows = [(1, " ".join(["alpha beta gamma"] * 60_000), "en", "s", 0)]
    docs = frame(spark, rows).select("*", *(F.lit(1).alias(c) for c in ("pairs", "n_a", "pair", "n", "n_best")))
    assert statistics(docs) == Counter([(1, *plain([rows[0][1]])[0])])


def test_empty_table_and_texts_without_tokens(spark):
    assert statistics(frame(spark, [])) == Counter()
    rows = [(1, None, None, None, None), (2, "", None, None, None), (3, "▁", None, None, None)]
    assert statistics(frame(spark, rows)) == Counter((i, 0, 0, 0, 0, "", 0, 0) for i in (1, 2, 3))


def test_general_output(spark):
    """Tokens, groups and overlapping pairs, against all pairs of intervals of one text."""
    text = "internationalization of naïve cafés, don't\n you  think? 漢字"
    a, b = tokens(text)
    for links, linked in (("overlaps", lambda x, y: x[1] < y[2] and y[1] < x[2]), ("ends", lambda x, y: x[2] == y[2])):
        row = alignment.align(frame(spark, [(1, text, None, None, None)]), A, B, links=links).first()
        assert row["a_ids"] == [i for i, _, _ in a] and row["b_ids"] == [i for i, _, _ in b]
        assert list(zip(row["link_a"], row["link_b"], strict=True)) == [
            (i, j) for i, x in enumerate(a) for j, y in enumerate(b) if linked(x, y)]
        ends = lambda side, sizes: [side[k - 1][2] for k in np.cumsum(sizes)]
        assert ends(a, row["a_groups"]) == ends(b, row["b_groups"]) == sorted({x[2] for x in a} & {x[2] for x in b})


def test_pairs_are_bounded_by_the_vocabularies():
    t = alignment.tokenizers(A, B)
    assert max(len(t.a_bytes), len(t.b_bytes)) < alignment.most_pairs(t) < 1_000_000
    assert alignment.byte_of_character()["Ġ"] == 0x20


@pytest.mark.parametrize("change", [lambda j: j["model"]["merges"].reverse(), lambda j: j["pre_tokenizer"].update(add_prefix_space=True)])
def test_only_ranked_merges_are_run_as_ranks(change):
    t = alignment.tokenizers(A, B)
    settings = json.loads(READER.to_str())
    assert t._ranked(settings, {50256})(["<|endoftext|> it's"]) == [READER.encode("<|endoftext|> it's", add_special_tokens=False).ids]
    change(settings)
    assert t._ranked(settings, {50256}) is None


def test_more_pairs_than_possible_is_an_error(spark):
    aligned = alignment.align(frame(spark), A, B, outputs=("pairs",))
    with pytest.raises(ValueError):
        alignment.link_scores(aligned, alignment.pair_counts(aligned), 32000, 3)
