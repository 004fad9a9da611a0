"""Packing: ids against the tokenizer on whole texts, and the law of the sequences."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from loanlens.llm import packing
from loanlens.llm import words as W
from tests.llm.rows import SCHEMA, documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids(text: str | None) -> list[int]:
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 2]


@pytest.mark.parametrize("most", [400_000, 50])
def test_words_give_the_ids_of_the_text(most):
    texts = [d[1] for d in documents()] + ["Ångström ΣΑΣ ﬁ  x", "é ́a", "a b c\x1cd", "can't'll we're 's 've", "<|startoftext|>", "x\x00y"]
    words = packing.WordIds(PATH, most)
    tokenizer = Tokenizer.from_file(PATH)
    for chunk in W.chunks(pa.array(texts), 3000):
        got, bounds = words.encode(chunk, 2)
        for i in range(chunk.rows):
            want = tokenizer.encode(texts[chunk.first + i] or "", add_special_tokens=False).ids
            assert got[bounds[i] : bounds[i + 1]].tolist() == [*want, 2]


def law(rows, limits: packing.Limits, want: dict[int, list[int]]) -> float:
    """Checks pieces against the documents (of different ids); returns the padding's share."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert by_doc.keys() == want.keys()
    for key, pieces in by_doc.items():
        at, whole = 0, want[key]
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(whole)
            part = np.array(whole[at : at + r["length"]], dtype="<u4")
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(whole)
    tokens = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits.tokens and len(pieces) <= limits.segments
        tokens += at
        padded += at if at & (at - 1) == 0 else limits.tokens
    return 1 - tokens / padded


def test_test_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    want = {r["doc_id"]: ids(r["text"]) for r in table.collect()}
    rows = packing.pack(table, PATH).collect()
    assert law(rows, packing.Limits(), want) == 0


def test_odd_rows(spark):
    rows = [(i, *d[1:]) for i, d in enumerate(documents())]
    want = {r[0]: ids(r[1]) for r in rows}
    assert law(packing.pack(frame(spark, rows), PATH).collect(), packing.Limits(), want) == 0
    same = packing.pack(frame(spark), PATH).collect()  # repeated rows and null ids are packed each
    assert sum(r["length"] for r in same) == sum(map(len, want.values()))


@pytest.mark.parametrize("segments,look_ahead", [(3, 8), (64, 256), (1, 4)])
def test_limits_hold_at_once(segments, look_ahead):
    rng = random.Random(7)
    limits = packing.Limits(tokens=256, segments=segments, loss=100, look_ahead=look_ahead)
    packer, total = packing.Packer(limits), 0
    for at in range(300):
        n = rng.choice([1, 5, 40, 255, 256, 257, 900])
        total += n
        packer.add([packing.Example(at, np.arange(n, dtype=np.uint32), n, prompt=rng.randrange(n + 1))])
    packer.finish()
    seen = defaultdict(list)
    for number, examples in packer.take():
        assert sum(len(e.ids) for e in examples) <= 256 and len(examples) <= segments
        assert sum(e.loss(len(e.ids)) for e in examples) <= 100
        for e in examples:
            assert len(e.ids) > 0
            seen[e.key] += e.ids.tolist()
    assert sum(map(len, seen.values())) == total
    assert all(sorted(v) == list(range(len(v))) for v in seen.values())


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0
