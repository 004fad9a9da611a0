"""Cross-tokenizer alignment: which tokens of a byte-level BPE (A) and a piece vocabulary (B) cover the same bytes.

Both tokenizers see a space and the text (A reads it as written, B adds it itself).  Byte offsets
where a token of A and one of B both end cut the tokens into groups; two tokens are linked when their
byte ranges end together (``links="ends"``) or overlap (``links="overlaps"``).

1. Texts are cut before a space that follows another character and precedes one that is not white
   space.  Neither tokenizer has a token across such a place (for B, ``Tokenizers`` makes sure of it),
   so each distinct piece of a block of texts is tokenized once.
2. Interval coalescing, for a block of texts at once: the tokens of A and B, as byte intervals, are
   lexsorted by start, the running maximum of their ends is accumulated, and a group begins where a
   start reaches it.  Overlaps are expanded inside a group: there are fewer of them than tokens.
3. Links are written once per document (as pair codes), counted per pair over the corpus, and scored
   from the counts.  Of two linked tokens one's bytes end with the other's, so the vocabularies alone
   bound the number of pairs (``most_pairs``); the counts are broadcast under that bound.

Defined results: texts that are null or empty, or whose joined token bytes differ from a space and the text
under A or B, have no tokens (zeros, empty digest).  Special tokens inside texts are plain text.  Texts
of any length are tokenized whole, each repeated row for itself; a null or repeated doc_id is returned as
it is; equal counts all are best; an empty table has no rows.  Only ``text`` and the columns to carry are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.llm.state import cut
from loanlens.llm.words import Chunk, chunks

BLOCK_BYTES = 1 << 20

#: Bytes that may begin a white space character (some begin others too: there a text is not cut).
MAYBE_SPACE = np.zeros(256, dtype=bool)
MAYBE_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True

#: What ``align`` can return beside the carried columns.
OUTPUTS = {
    "n_a": T.LongType(), "n_b": T.LongType(), "n_groups": T.LongType(), "n_links": T.LongType(),
    "a_ids": T.ArrayType(T.IntegerType()), "b_ids": T.ArrayType(T.IntegerType()),
    "a_groups": T.ArrayType(T.IntegerType()), "b_groups": T.ArrayType(T.IntegerType()),
    "link_a": T.ArrayType(T.IntegerType()), "link_b": T.ArrayType(T.IntegerType()),
    "pairs": T.ArrayType(T.LongType()), "groups_sha256": T.StringType(),
}


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest in order from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens.

    Where A's merges make tokens in the order of their ids (so that a token's id is its rank), its vocabulary
    is run by tiktoken, which gives the same ids in a third of the time; any other A by its own library.
    """

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        a.encode_special_tokens = True
        settings, of = json.loads(a.to_str()), byte_of_character()
        vocabulary = {i: t for t, i in a.get_vocab(with_added_tokens=True).items()}
        special = {t["id"] for t in settings["added_tokens"]}
        self.a_bytes = [vocabulary[i].encode() if i in special else bytes(of[c] for c in vocabulary[i]) if i in vocabulary else b""
                        for i in range(max(vocabulary) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{b_path} has pieces across words: texts cannot be cut before spaces")
        self.a_size, self.b_size = (np.array([len(t) for t in x], dtype=np.int64) for x in (self.a_bytes, self.b_bytes))
        self._encode_a = self._ranked(settings, special) or (
            lambda texts: [e.ids for e in a.encode_batch_fast(texts, add_special_tokens=False)])

    def _ranked(self, settings: dict, special: set[int]):
        made = [settings["model"]["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in settings["model"]["merges"]]
        plain = settings["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if not plain or settings["normalizer"] or None in made or any(x >= y for x, y in zip(made, made[1:], strict=False)):
            return None
        import tiktoken

        ranks = {t: i for i, t in enumerate(self.a_bytes) if t and i not in special}
        encoding = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [encoding.encode_ordinary(x) for x in texts]

    def of(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of A and of B for each piece (without its leading space), and whether the bytes of both are the piece's."""
        a, b = self._encode_a([" " + p for p in pieces]), self.b.encode(pieces, num_threads=1) if pieces else []
        same = [b"".join([self.a_bytes[i] for i in x]) == b" " + p.encode() == b"".join([self.b_bytes[i] for i in y])
                for p, x, y in zip(pieces, a, b, strict=True)]
        return a, b, np.array(same, dtype=bool)


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def most_pairs(t: Tokenizers) -> int:
    """How many (A, B) id pairs can end together at all: the bytes of one end with those of the other."""
    def endings(tokens: list[bytes], among: list[bytes], least: int) -> int:
        times: dict[bytes, int] = {}
        for x in among:
            times[x] = times.get(x, 0) + 1
        return sum(times.get(x[k:], 0) for x in tokens for k in range(least, len(x)))

    return endings(t.a_bytes, t.b_bytes, 0) + endings(t.b_bytes, t.a_bytes, 1)


def _ragged(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists ``rows`` out of a ragged array, joined, and their lengths."""
    size = np.diff(offsets)[rows]
    ends = np.cumsum(size)
    return values[np.arange(size.sum()) + np.repeat(offsets[rows] - (ends - size), size)], size


def _pieces(block: Chunk) -> tuple[pa.Array, np.ndarray]:
    """Pieces of all texts, and for text i the pieces bounds[i]..bounds[i + 1]; a piece's leading space is left out."""
    data, n = block.data, len(block.data)
    first = np.zeros(n + 1, dtype=bool)  # a text begins here
    first[block.offsets] = True
    space = data == 0x20
    splits = space.copy()
    splits[1:] &= ~space[:-1]
    splits &= ~first[:-1]
    splits[:-1] &= ~MAYBE_SPACE[data[1:]] & ~first[1:n]
    splits[-1:] = False
    at = np.flatnonzero(splits)
    filled = np.diff(block.offsets) > 0
    begins = np.sort(np.concatenate([block.offsets[:-1][filled], at + 1]))
    before = np.searchsorted(at, np.append(begins, n), side="left")  # splitting spaces left out so far
    offsets = np.append(begins, n) - before
    pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(data[~splits]))
    return pieces, np.searchsorted(begins, block.offsets)


@dataclass
class Aligned:
    """A block of texts; the tokens of text i are a_bounds[i]..a_bounds[i + 1], and so on."""

    a: np.ndarray
    b: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    link_bounds: np.ndarray
    group_bounds: np.ndarray


def _starts(ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], ends])[: len(ends)]


def coalesced(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every token of A and B, given where they end on one line of bytes."""
    start, end = np.concatenate([_starts(a_ends), _starts(b_ends)]), np.concatenate([a_ends, b_ends])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[: len(a_ends)], group[len(a_ends) :]


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of tokens that share a byte, expanded inside the groups."""
    group_from = np.searchsorted(b_group, a_group, side="left")
    group_to = np.searchsorted(b_group, a_group, side="right")
    low = np.maximum(np.searchsorted(b_ends, _starts(a_ends), side="right"), group_from)
    high = np.minimum(np.searchsorted(_starts(b_ends), a_ends, side="left"), group_to)
    size = high - low
    until = np.cumsum(size)
    return np.repeat(np.arange(len(a_ends)), size), np.arange(size.sum()) + np.repeat(low - (until - size), size)


def align_block(block: Chunk, t: Tokenizers, links: str = "ends") -> Aligned:
    pieces, bounds = _pieces(block)
    coded = pieces.dictionary_encode()
    code = coded.indices.to_numpy()
    *ids, same = t.of(coded.dictionary.to_pylist())
    text_of = np.repeat(np.arange(block.rows), np.diff(bounds))
    whole = np.ones(block.rows, dtype=bool)
    whole[text_of[~same[code]]] = False
    use = whole[text_of]
    code, text_of = code[use], text_of[use]

    def flat(side: int) -> tuple[np.ndarray, np.ndarray]:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids[side]], dtype=np.int64)])
        values = np.fromiter(chain.from_iterable(ids[side]), dtype=np.int64, count=offsets[-1])
        taken, size = _ragged(values, offsets, code)
        return taken, np.concatenate([[0], np.cumsum(np.bincount(text_of, size, block.rows).astype(np.int64))])

    (a, a_bounds), (b, b_bounds) = flat(0), flat(1)
    a_ends, b_ends = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])  # the same bytes: every text used is whole
    a_group, b_group = coalesced(a_ends, b_ends)
    link_a, link_b = overlaps(a_ends, b_ends, a_group, b_group)
    if links == "ends":
        together = a_ends[link_a] == b_ends[link_b]
        link_a, link_b = link_a[together], link_b[together]
    group_bounds = np.append(a_group, a_group[-1] + 1 if len(a_group) else 0)[a_bounds]
    return Aligned(a, b, a_bounds, b_bounds, a_group, b_group, link_a, link_b, np.searchsorted(link_a, a_bounds), group_bounds)


@lru_cache(maxsize=2)
def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of 0..n - 1, padded with zero bytes and one more column, and their number."""
    width = len(str(n))
    table = np.array([str(i) for i in range(n)], dtype=f"S{width + 1}")
    table = np.frombuffer(table.tobytes(), np.uint8).reshape(n, width + 1)
    return table, np.count_nonzero(table, axis=1)


def group_digests(x: Aligned, size: int) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for every text, empty for a text without tokens; ids are below ``size``."""
    rows = len(x.a_bounds) - 1
    group = np.concatenate([x.a_group, x.b_group])
    order = np.argsort(2 * group + np.repeat([0, 1], [len(x.a), len(x.b)]), kind="stable")
    ids, group, side = np.concatenate([x.a, x.b])[order], group[order], (order >= len(x.a))
    table, length = _digits(size)
    out = table[ids]
    bounds = x.a_bounds + x.b_bounds
    after = np.full(len(ids), ord(","), dtype=np.uint8)
    if len(ids):
        after[:-1][side[1:] != side[:-1]] = ord("|")
        after[:-1][group[1:] != group[:-1]] = ord(";")
        after[bounds[1:][np.diff(bounds) > 0] - 1] = 0
    out[np.arange(len(ids)), length[ids]] = after
    sizes = np.concatenate([[0], np.cumsum(length[ids] + (after > 0))])
    line = memoryview(out[out > 0].tobytes())
    at = sizes[bounds].tolist()
    return [hashlib.sha256(line[at[i] : at[i + 1]]).hexdigest() if at[i + 1] > at[i] else "" for i in range(rows)]


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def _column(name: str, x: Aligned, t: Tokenizers) -> pa.Array:
    links = np.repeat(np.arange(len(x.a_bounds) - 1), np.diff(x.link_bounds))
    match name:
        case "n_a" | "n_b":
            return pa.array(np.diff(x.a_bounds if name == "n_a" else x.b_bounds))
        case "n_groups":
            return pa.array(np.diff(x.group_bounds))
        case "n_links":
            return pa.array(np.diff(x.link_bounds))
        case "a_ids" | "b_ids":
            return _lists(x.a, x.a_bounds, pa.int32()) if name == "a_ids" else _lists(x.b, x.b_bounds, pa.int32())
        case "a_groups" | "b_groups":
            return _lists(np.bincount(x.a_group if name == "a_groups" else x.b_group, minlength=x.group_bounds[-1]), x.group_bounds, pa.int32())
        case "link_a":
            return _lists(x.link_a - x.a_bounds[links], x.link_bounds, pa.int32())
        case "link_b":
            return _lists(x.link_b - x.b_bounds[links], x.link_bounds, pa.int32())
        case "pairs":
            return _lists(x.a[x.link_a] * len(t.b_bytes) + x.b[x.link_b], x.link_bounds, pa.int64())
        case "groups_sha256":
            return pa.array(group_digests(x, max(len(t.a_bytes), len(t.b_bytes))), pa.string())
    raise ValueError(name)


def align(documents: DataFrame, a_path: str, b_path: str, carry: Sequence[str] = ("doc_id",),
          outputs: Sequence[str] = ("a_ids", "b_ids", "a_groups", "b_groups", "link_a", "link_b"), links: str = "ends") -> DataFrame:
    """The carried columns and ``outputs`` for every row of ``documents``, in one pass without a shuffle.

    ``a_ids`` and ``b_ids`` are the tokens, ``a_groups`` and ``b_groups`` how many of them each group
    takes, ``link_a`` and ``link_b`` the places of linked tokens, ``pairs`` their ids as id of A times
    the size of B's vocabulary plus id of B, ``groups_sha256`` a digest of the groups.
    """
    if links not in ("ends", "overlaps"):
        raise ValueError(links)
    schema = T.StructType([documents.schema[c] for c in carry] + [T.StructField(c, OUTPUTS[c]) for c in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(a_path, b_path)
        for batch in batches:
            for block in chunks(batch.column(len(carry)), BLOCK_BYTES):
                x = align_block(block, t, links)
                kept = [batch.column(k).slice(block.first, block.rows) for k in range(len(carry))]
                yield pa.RecordBatch.from_arrays(kept + [_column(c, x, t) for c in outputs], names=[*carry, *outputs])

    return documents.select(*carry, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair`` and how many links of the corpus hold it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, n = np.unique(np.asarray(batch.column(0).flatten()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    return aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def link_scores(aligned: DataFrame, counts: DataFrame, n_b: int, most: int) -> DataFrame:
    """``aligned`` with ``n_best`` and ``count_sum`` in place of ``pairs``; ``counts`` has at most ``most`` rows."""
    spark = aligned.sparkSession
    found = counts.limit(most + 1).toArrow()
    if found.num_rows > most:
        raise ValueError(f"more than {most} pairs of tokens that end together")
    pair, n = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    highest = np.zeros(n_b, dtype=np.int64)
    np.maximum.at(highest, pair % n_b, n)
    table = spark.sparkContext.broadcast((pair, n, n == highest[pair % n_b]))
    rest = [c for c in aligned.columns if c != "pairs"]
    schema = T.StructType([aligned.schema[c] for c in rest] + [T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            links = batch.column(len(rest))
            bounds = np.asarray(links.offsets).astype(np.int64)
            at = np.searchsorted(pair, np.asarray(links.flatten()))
            sums = []
            for value in (best, n):
                total = np.concatenate([[0], np.cumsum(value[at], dtype=np.int64)])
                sums.append(pa.array(total[bounds[1:] - bounds[0]] - total[bounds[:-1] - bounds[0]]))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(rest))] + sums, names=[*rest, "n_best", "count_sum"])

    return aligned.select(*rest, "pairs").mapInArrow(run, schema)


def link_statistics(documents: DataFrame, a_path: str, b_path: str, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Tokens, groups, links, their digest and corpus-wide scores for every row of ``documents``."""
    aligned = cut(align(documents, a_path, b_path, carry, ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs")))
    t = tokenizers(a_path, b_path)
    return link_scores(aligned, pair_counts(aligned), len(t.b_bytes), most_pairs(t))
