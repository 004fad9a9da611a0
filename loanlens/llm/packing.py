"""Packing token sequences by vector bin packing with the dot-product heuristic.

An example is a vector of tokens, one segment, and loss-bearing tokens; a sequence has limits
on all three.  An open sequence takes, among ``look_ahead`` waiting examples, the one that fits
and has the largest dot product of its vector with the room left, both as shares of the
limits.  When none fits, an example is cut so that its first part fills the room.  A
sequence that its segments close early is cut back to a power of two, as is what is left at
the end of a task: sequences are 4096 tokens or a power of two long, and need no padding.

One pass without a shuffle: a task tokenizes and packs the rows of its own partition, so
the result of a lost task is made again from the same rows.  It holds one chunk of texts, the
waiting examples (less than one sequence's tokens each), and a bounded cache of words, which the
worker keeps.

Tokens: the tokenizer never joins what white space parts, so each distinct word is encoded
once and looked up by its 64-bit hash from then on (``WordIds``; written for the lower-casing
word vocabulary, whose ids it gives exactly).

Defined results: a null or empty text has the end token alone; rows that repeat are packed each;
a text of any length is cut over as many sequences as it needs; among examples of equal product the first
waiting one is taken; a null doc_id is carried; an empty table gives an empty result.  Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from loanlens.llm import words as W


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 64
    loss: int = 4096
    look_ahead: int = 256

    @property
    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.segments, self.loss], dtype=np.float64)


@dataclass
class Example:
    """What is still to be placed of one example: ids from ``start`` on; the first ``prompt`` ids bear no loss."""

    key: object
    ids: np.ndarray
    total: int
    start: int = 0
    prompt: int = 0

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.prompt))

    def fitting(self, tokens: int, loss: int) -> int:
        """The longest first part within ``tokens`` and ``loss``."""
        unpaid = max(0, self.prompt - self.start)
        return max(0, min(len(self.ids), tokens, unpaid + loss))

    def cut(self, length: int) -> tuple[Example, Example | None]:
        first = Example(self.key, self.ids[:length], self.total, self.start, self.prompt)
        rest = self.ids[length:]
        return first, Example(self.key, rest, self.total, self.start + length, self.prompt) if len(rest) else None


@dataclass
class Packer:
    """Packs examples as they come; ``done`` gathers (sequence number, examples in order)."""

    limits: Limits
    done: list[tuple[int, list[Example]]] = field(default_factory=list)
    count: int = 0

    def __post_init__(self) -> None:
        self.waiting: list[Example] = []
        self.vectors = np.zeros((0, 3))

    def add(self, examples: list[Example]) -> None:
        whole = min(self.limits.tokens, self.limits.loss)
        fresh = []
        for e in examples:
            while e is not None and len(e.ids) >= whole:
                first, e = e.cut(e.fitting(self.limits.tokens, self.limits.loss))
                if len(first.ids) == self.limits.tokens:
                    self._close([first])
                else:
                    fresh.append(first)
            if e is not None:
                fresh.append(e)
        for at in range(0, len(fresh), self.limits.look_ahead):
            self._wait(fresh[at : at + self.limits.look_ahead])
            while len(self.waiting) >= self.limits.look_ahead:
                self._fill()

    def finish(self) -> None:
        while self.waiting:
            self._fill()

    def _wait(self, examples: list[Example]) -> None:
        self.waiting += examples
        self.vectors = np.concatenate([self.vectors, [[len(e.ids), 1, e.loss(len(e.ids))] for e in examples]])

    def _fill(self) -> None:
        limit, room, taken = self.limits.vector, self.limits.vector, []
        free = np.ones(len(self.waiting), dtype=bool)
        while room[0] > 0 and room[1] > 0:
            fits = free & (self.vectors <= room).all(axis=1)
            if not fits.any():
                break
            value = np.where(fits, (self.vectors / limit) @ (room / limit), -1.0)
            pick = int(value.argmax())
            free[pick] = False
            taken.append(self.waiting[pick])
            room = room - self.vectors[pick]
        rest = None
        if room[0] > 0 and room[1] > 0 and free.any():  # cut one: the longest first part that fills the room
            pick = int(np.where(free, self.vectors[:, 0], -1).argmax())
            length = self.waiting[pick].fitting(int(room[0]), int(room[2]))
            if length:
                free[pick] = False
                first, rest = self.waiting[pick].cut(length)
                taken.append(first)
        self.waiting = [e for e, f in zip(self.waiting, free, strict=True) if f]
        self.vectors = self.vectors[free]
        if rest is not None:
            self._wait([rest])
        total = sum(len(e.ids) for e in taken)
        if total < self.limits.tokens:
            taken, back = self._cut_back(taken, 1 << (total.bit_length() - 1))
            if back:
                self._wait(back)
        self._close(taken)

    @staticmethod
    def _cut_back(taken: list[Example], length: int) -> tuple[list[Example], list[Example]]:
        kept, back = [], []
        for e in taken:
            if length >= len(e.ids):
                kept.append(e)
                length -= len(e.ids)
            elif length:
                first, rest = e.cut(length)
                kept.append(first)
                back.append(rest)
                length = 0
            else:
                back.append(e)
        return kept, back

    def _close(self, examples: list[Example]) -> None:
        self.done.append((self.count, examples))
        self.count += 1

    def take(self) -> list[tuple[int, list[Example]]]:
        done, self.done = self.done, []
        return done


class WordIds:
    """Token ids of words, by word hash, for at most ``most`` words at a time (or those of one chunk).

    The vocabulary lower-cases text and splits punctuation from letters, so words are looked up
    in lower case, and a full stop or comma behind an ASCII letter is a word of its own.  Words
    with a ``|`` keep their case, because a special token's name may be part of them.
    """

    def __init__(self, path: str, most: int = 800_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)  # ascending hashes, and their words
        self.ids, self.offsets = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Add words whose hashes are new and ascending."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        place = np.searchsorted(self.keys, hashes)
        self.keys = np.insert(self.keys, place, hashes)
        self.at = np.insert(self.at, place, len(self.offsets) - 1 + np.arange(len(words)))
        lengths = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        flat = np.fromiter(chain.from_iterable(got), dtype=np.uint32, count=int(lengths.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.keys, hashes), max(0, len(self.keys) - 1))
        return self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), dtype=bool)

    @staticmethod
    def _split(chunk: W.Chunk) -> tuple[W.Chunk, W.Words]:
        """The chunk in lower case, and its words without the stop or comma behind them, which follow as words."""
        words, data = W.find_words(chunk), W.LOWER[chunk.data]
        bars = np.flatnonzero(chunk.data == ord("|"))
        for i in np.unique(np.searchsorted(words.starts, bars, side="right") - 1):
            data[words.starts[i] : words.ends[i]] = chunk.data[words.starts[i] : words.ends[i]]
        long = words.ends - words.starts > 1
        last, before = data[words.ends - 1], data[np.maximum(words.ends - 2, 0)]
        parted = long & ((last == ord(".")) | (last == ord(","))) & (before >= ord("a")) & (before <= ord("z"))
        at = np.arange(len(parted)) + np.concatenate([[0], np.cumsum(parted)])[:-1]  # places of the words proper
        starts = np.empty(len(parted) + int(parted.sum()), dtype=np.int64)
        ends = np.empty_like(starts)
        starts[at], ends[at] = words.starts, words.ends - parted
        mark = at[parted] + 1
        starts[mark], ends[mark] = words.ends[parted] - 1, words.ends[parted]
        bounds = words.bounds + np.concatenate([[0], np.cumsum(parted)])[words.bounds]
        return W.Chunk(chunk.first, data, chunk.offsets, chunk.null), W.Words(starts, ends, bounds)

    def encode(self, chunk: W.Chunk, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, ``end`` after each, and where each text begins (and the last ends)."""
        chunk, words = self._split(chunk)
        unique, first, which = np.unique(W.word_hashes(chunk, words), return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(unique))
        if len(self.keys) + len(new) > self.most:  # start over with this chunk's words
            self._forget()
            new = np.arange(len(unique))
        if len(new):
            raw = chunk.data.tobytes()
            self._learn(unique[new], [raw[words.starts[i] : words.ends[i]].decode("utf-8") for i in first[new].tolist()])
        at = self.at[np.searchsorted(self.keys, unique)][which]
        lengths = np.diff(self.offsets)[at]
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        flat = np.repeat(self.offsets[at] - bounds[:-1], lengths) + np.arange(bounds[-1])
        texts = bounds[words.bounds]
        of_token = np.repeat(np.arange(chunk.rows), np.diff(texts))
        out = np.full(bounds[-1] + chunk.rows, end, dtype=np.uint32)
        out[np.arange(bounds[-1]) + of_token] = self.ids[flat]
        return out, texts + np.arange(chunk.rows + 1)


#: Kept by each Python worker from task to task; ids don't hang on what it holds.
_WORD_IDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")


def pack(documents: DataFrame, tokenizer: str, end: int = 2, limits: Limits = Limits()) -> DataFrame:
    """A row for every piece of (doc_id, text); ``tokenizer`` is the path of a vocabulary file on every executor.

    ``sequence_id`` is the partition's number times 2**36, plus the sequence's number in it.
    """
    names = [c.strip().split()[0] for c in SCHEMA.split(",")]

    def rows(done: list[tuple[int, list[Example]]], base: int) -> pa.RecordBatch:
        out = []
        for number, examples in done:
            at, total = 0, sum(len(e.ids) for e in examples)
            for e in examples:
                out.append((e.key, e.start, len(e.ids), zlib.crc32(e.ids.astype("<u4").tobytes()), e.total, base + number, at, total))
                at += len(e.ids)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * len(names))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer = _word_ids(tokenizer), Packer(limits)
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for chunk in W.chunks(batch.column("text")):
                ids, bounds = words.encode(chunk, end)
                packer.add([Example(keys[chunk.first + i], ids[bounds[i] : bounds[i + 1]].copy(), int(bounds[i + 1] - bounds[i]))
                            for i in range(chunk.rows)])
                yield rows(packer.take(), base)
        packer.finish()
        yield rows(packer.take(), base)

    source = documents.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return source.mapInArrow(run, SCHEMA)
