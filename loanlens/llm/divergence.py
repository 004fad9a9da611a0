"""Source divergence audit: how far the word use of each source lies from the others of its language.

Terms are runs of letters (A-Z in lower case, every character beyond ASCII counts as a letter).
A language keeps the terms that at least ``min_docs`` of its documents hold.  With ``count`` the
occurrences of a kept term in a group, N their sum over all kept terms and V their number, the group
gives the term p = 1 + floor(10^9 (count + 1) / (N + V)); (lang, source) groups and whole languages
alike.  A divergence is the sum of f = floor((p - q)^2 / q).

1. Documents are counted shard by shard: pointers to the word starts of an Arrow text buffer are
   ordered by language, source and document, then by a multikey quicksort whose characters are eight
   bytes wide: at each depth, the pointers of one slice are sorted by their next eight bytes, and
   slices of equal ones go on to the next depth.  Runs of equal words give occurrences per source and
   document frequency.
2. Shards are summed by term (an exchange by language and term, so that the rows of a term compress
   and stay together), terms of too few documents leave, and what is left is written once.
3. ``pair``: tasks hold a block of terms as a matrix of terms and sources and add up the sources x
   sources sums, which are as many as the result has rows.  ``term``: the terms that a group uses more
   than its language does; only the first ranks are kept, a limit Spark also applies before it sorts.

Integer arithmetic throughout (Python integers where 64 bits do not hold a product).

Defined results: null text, lang and source count as empty; a document is a row, so a repeated row
counts again; a group without terms takes part with count 0; a language without kept terms has
``pair`` rows of value 0 and no ``term`` rows; equal values rank by item, in UTF-8 order; an empty
table has no rows.  Texts of any length are read whole (one text is at least one shard).  Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm.state import cut
from loanlens.llm.words import Chunk, chunks, find_words

SHARD_BYTES = 1 << 24
CELLS = 1 << 20  # of a block of terms x sources
COMPARED = 8  # depths of eight bytes; what is beyond is compared whole

#: Bytes of terms, in lower case; all others become a blank.
TERM_BYTES = np.full(256, 0x20, dtype=np.uint8)
TERM_BYTES[0x61:0x7B] = TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)
TERM_BYTES[0x80:] = np.arange(0x80, 0x100)

#: Of eight bytes, the first r.
FIRST_BYTES = np.array([0] + [((1 << 64) - 1) ^ ((1 << (64 - 8 * r)) - 1) for r in range(1, 9)], dtype=np.uint64)


@dataclass(frozen=True)
class Settings:
    min_docs: int = 3
    unit: int = 1_000_000_000
    top_terms: int = 200


def sorted_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, leading: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of pointers by ``leading`` and word, and where in it a new word (or leading value) begins.

    Words hold no zero byte, so a word padded with zeros sorts before its continuations.
    """
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,))
    size = ends - starts

    def characters(p: np.ndarray, depth: int) -> np.ndarray:
        rest = np.clip(size[p] - 8 * depth, 0, 8)
        return eight[np.minimum(starts[p] + 8 * depth, len(data))].astype(np.uint64) & FIRST_BYTES[rest]

    order = np.lexsort((characters(np.arange(len(starts)), 0), leading))
    key = characters(order, 0)
    new = np.ones(len(order), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (leading[order[1:]] != leading[order[:-1]])
    depth = 1
    while True:
        begins = np.flatnonzero(new)
        longer = np.maximum.reduceat(size[order], begins) > 8 * depth
        lengths = np.diff(np.append(begins, len(order)))
        at = np.flatnonzero(np.repeat(longer & (lengths > 1), lengths))
        if len(at) == 0:
            return order, new
        run = np.cumsum(new)[at]
        if depth == COMPARED:
            rest = [data[starts[p] + 8 * depth : ends[p]].tobytes() for p in order[at]]
            by = sorted(range(len(at)), key=lambda i: (run[i], rest[i]))
            order[at] = order[at][by]
            new[at[1:]] |= np.array([rest[by[i]] != rest[by[i - 1]] for i in range(1, len(by))], dtype=bool)
            return order, new
        key = characters(order[at], depth)
        by = np.lexsort((key, run))
        order[at], key = order[at][by], key[by]
        new[at[1:]] |= key[1:] != key[:-1]
        depth += 1


def _spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as strings."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, dtype=np.int64)
    np.cumsum(size, out=offsets[1:])
    taken = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)]
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(taken)).cast(pa.string())


def count_shard(shard: Chunk, lang: np.ndarray, source: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Terms by (lang, term, source): the term, one of its documents, its occurrences, and how many documents hold it."""
    lowered = Chunk(shard.first, TERM_BYTES[shard.data], shard.offsets, shard.null)
    words = find_words(lowered)
    document = words.text_of
    place = np.empty(shard.rows, dtype=np.int64)
    place[np.lexsort((source, lang))] = np.arange(shard.rows)
    grouped = np.argsort(place[document], kind="stable")  # pointers by lang, source, document
    document, starts, ends = document[grouped], words.starts[grouped], words.ends[grouped]
    order, new = sorted_runs(lowered.data, starts, ends, lang[document])
    document, starts, ends = document[order], starts[order], ends[order]
    new[1:] |= source[document[1:]] != source[document[:-1]]
    begins = np.flatnonzero(new)
    fresh = new.copy()
    fresh[1:] |= document[1:] != document[:-1]
    docs = np.add.reduceat(fresh.astype(np.int64), begins) if len(begins) else np.zeros(0, np.int64)
    return (_spans(lowered.data, starts[begins], ends[begins]), document[begins],
            np.diff(np.append(begins, len(order))).astype(np.int64), docs)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in (0, 1))
        for shard in chunks(batch.column(2), SHARD_BYTES):
            rows = slice(shard.first, shard.first + shard.rows)
            terms, document, n, docs = count_shard(
                shard, lang.indices.to_numpy()[rows], source.indices.to_numpy()[rows])
            at = pa.array(document + shard.first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), terms, pa.array(n), pa.array(docs)],
                names=["lang", "source", "term", "n", "docs"])


def _labelled(documents: DataFrame) -> DataFrame:
    return documents.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and its documents ``docs``; one row each."""
    shards = _labelled(documents).mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return shards.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _groups(documents: DataFrame) -> DataFrame:
    """Every (lang, source) and its number ``at`` among the sources of its language, in UTF-8 order."""
    found = _labelled(documents).select("lang", "source").distinct()
    return found.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)


def kept_terms(counts: DataFrame, groups: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``lang``, ``term`` and ``uses``, the (at, n) of the sources that use it, for terms of enough documents."""
    return (counts.join(groups, ["lang", "source"]).groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("at", "n")).alias("uses"))  # at most the sources of a language
            .where(F.col("docs") >= s.min_docs).select("lang", "term", "uses"))


def _languages(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per language: its sources, the N of each (``sums``) and V (``n_terms``)."""
    sums = kept.select("lang", F.explode("uses").alias("use")).groupBy("lang", "use.at").agg(F.sum("use.n").alias("total"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    each = groups.join(sums, ["lang", "at"], "left")
    found = each.groupBy("lang").agg(F.sort_array(F.collect_list(
        F.struct("at", "source", F.coalesce("total", F.lit(0)).alias("total")))).alias("g"))  # its sources
    return (found.join(terms, "lang", "left")
            .select("lang", F.col("g.source").alias("sources"), F.col("g.total").alias("sums"),
                    F.coalesce("n_terms", F.lit(0)).alias("n_terms")))


def weights(count: np.ndarray, total: np.ndarray, n_terms: int, unit: int) -> np.ndarray:
    """p of ``count`` occurrences out of ``total``, exactly."""
    if (int(count.max(initial=0)) + 1) * unit >= 1 << 63:
        count = count.astype(object)
    return (1 + unit * (count + 1) // (total + n_terms)).astype(np.int64)


@dataclass
class _Block:
    """Terms of one language: occurrences by term and source."""

    lang: str
    terms: pa.Array
    count: np.ndarray
    sums: np.ndarray
    n_terms: int


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        lang = batch.column("lang").dictionary_encode()
        code = lang.indices.to_numpy()
        at = batch.column("at")
        for k, name in enumerate(lang.dictionary.to_pylist()):
            rows = np.flatnonzero(code == k)
            sums = np.asarray(batch.column("sums")[int(rows[0])].values)
            step = max(1, CELLS // len(sums))
            for i in range(0, len(rows), step):
                some = pa.array(rows[i : i + step])
                uses, n = at.take(some), batch.column("n").take(some)
                term = np.repeat(np.arange(len(some)), np.diff(np.asarray(uses.offsets)))
                count = np.zeros((len(some), len(sums)), dtype=np.int64)
                count[term, np.asarray(uses.flatten())] = np.asarray(n.flatten())
                yield _Block(name, batch.column("term").take(some), count, sums, batch.column("n_terms")[int(rows[0])].as_py())


def _pair_sums(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def rows():
            for lang, found in sums.items():
                a, b = np.nonzero(~np.eye(len(found), dtype=bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(len(a), np.int64))), pa.array(a.astype(np.int32)),
                     pa.array(b.astype(np.int32)), pa.array(found[a, b])], names=["lang", "a", "b", "value"])
            sums.clear()

        for block in _blocks(batches):
            p = weights(block.count, block.sums, block.n_terms, s.unit)
            size = len(block.sums)
            if block.lang not in sums and sum(x.size for x in sums.values()) + size * size > 2 * CELLS:
                yield from rows()
            total = sums.setdefault(block.lang, np.zeros((size, size), dtype=np.int64))
            for a in range(size):
                gap = p[:, a : a + 1] - p
                total[a] += (gap * gap // p).sum(axis=0)
        yield from rows()

    return run


def _term_values(s: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            p = weights(block.count, block.sums, block.n_terms, s.unit)
            q = weights(block.count.sum(axis=1, keepdims=True), block.sums.sum(), block.n_terms, s.unit)
            term, a = np.nonzero((block.count > 0) & (p > q))
            gap = p[term, a] - q[term, 0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.lang]).take(pa.array(np.zeros(len(a), np.int64))), pa.array(a.astype(np.int32)),
                 block.terms.take(pa.array(term)), pa.array(gap * gap // q[term, 0])], names=["lang", "a", "item", "value"])

    return run


def audit(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value`` and ``rank`` for every (lang, source)."""
    groups = cut(_groups(documents))
    kept = cut(kept_terms(term_counts(documents), groups, s))
    langs = cut(_languages(kept, groups))
    known = kept.join(langs.drop("sources"), "lang").select(
        "lang", "term", F.col("uses.at").alias("at"), F.col("uses.n").alias("n"), "sums", "n_terms")
    named = langs.select("lang", "sources")
    source, other = (F.get("sources", F.col(c)) for c in ("a", "b"))

    pairs = (known.mapInArrow(_pair_sums(s), "lang string, a int, b int, value long")
             .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")).join(named, "lang")
             .select("lang", source.alias("source"), other.alias("item"), "value"))
    bare = langs.where("n_terms = 0").select("lang", F.explode("sources").alias("source"), "sources")
    bare = bare.select("lang", "source", F.explode("sources").alias("item"), F.lit(0).cast("long").alias("value")).where("item <> source")
    terms = (known.mapInArrow(_term_values(s), "lang string, a int, item string, value long").join(named, "lang")
             .select("lang", source.alias("source"), "item", "value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = [part.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
              for name, part in (("pair", pairs.unionByName(bare)), ("term", terms))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= s.top_terms))
