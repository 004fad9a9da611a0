"""N-gram Jaccard join: near-duplicate texts and their classes.

A text's set holds its distinct shingles of five words (words lower-cased in A-Z; a text
with fewer words is one shingle; a text without words has an empty set and links with
nothing).  Two texts link when 100 * intersection >= 80 * union.

Method: rare-first prefix filtering.
1. One pass counts shingles in a table of 2**``sketch_bits`` hash buckets, which travels in blocks; it
   orders all shingles, rare buckets first, ties by hash.  The order steers cost only: any one
   total order gives the same links.  The fewer shingles fall into one bucket, the better common passages
   are told from rare ones; ``sketch_bits`` may grow with the corpus (4 bytes a bucket on driver and workers).
2. A set's prefix is its rarest n - ceil(0.8 n) + 1 shingles: linked sets share one.  Prefix
   shingles are shuffled by shingle and sorted; a streaming pass keeps the shared ones.
3. Candidates that share a prefix shingle pass a length filter, a positional filter (shingles
   left after the match on either side, the match taken as the first) and a suffix filter (the
   parities of bin-wise counts bound the sets' difference from below), and are verified once on
   whole sets.

Pairs inside a large group are never all emitted. First every shared shingle pairs its members with
one leader, its smallest node; verified links make components. Shingles whose members lie in one
component by then are done. Of the others, those with at most ``small_group`` members emit their
candidates across components (no more than small_group per row), while larger ones go on with a few
leaders drawn anew in every round, until all their members lie in one component, or no more pairs
across components are left than ``finish_factor`` times the members, or ``most_rounds`` are over.
Then all candidates left across components are verified, so that no link between two components is
lost. Equal sets are one node from the start.

Defined results: null, empty and wordless texts have n_shingles 0 and their own doc_id as
class; repeated rows and rows that share a doc_id with different texts are separate members
whose class is the smallest doc_id (nulls left out) of their component; a null doc_id is
carried; texts of any length are compared whole; an empty table has no rows.  Only doc_id and text are
read (``one_of_each`` carries the other columns as one struct), so other columns may have any name.
Sets are of 64-bit hashes; equal sets are told by the sum of mixed hashes.

Memory: a streaming pass holds one batch, a verification one chunk of texts and the
leader's set.  The driver holds the bucket counts (2**sketch_bits numbers).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm import words as W
from loanlens.llm.components import connected_components
from loanlens.llm.state import cut, laid_out_by


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80
    sketch_bits: int = 20
    bins: int = 256  # of the suffix filter; a multiple of 64
    small_group: int = 32
    partners: int = 1000  # of one text, that a verification task takes
    finish_factor: int = 32
    most_rounds: int = 4
    leaders: int = 4  # of a large token, in a round


BLOCK = 4096  # buckets of the sketch that travel as one row
SCANNED = ["doc_id", "n_shingles", "node", "block", "counts"]


def need(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Least intersection of linked sets of n and m shingles: percent * union <= 100 * intersection."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (-(-percent * n // 100)) + 1


@dataclass
class Sets:
    """Distinct shingles of a chunk's texts: text i has values[bounds[i]:bounds[i + 1]], ascending."""

    values: np.ndarray
    bounds: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    def node(self) -> np.ndarray:
        """A 64-bit name of every set; equal sets have equal names."""
        total = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(self.values ^ np.uint64(0xA5A5A5A55A5A5A5A)))])
        return W.mix(total[self.bounds[1:]] - total[self.bounds[:-1]] + self.sizes.astype(np.uint64))


    def parities(self, bins: int) -> np.ndarray:
        """Per text, whether its shingles in each of ``bins`` hash bins are odd in number, 64 bins to an integer.

        Sets that differ in d shingles differ in d parities at most.
        """
        bin_of = (W.mix(self.values) & np.uint64(bins - 1)).astype(np.int64)
        rows = len(self.sizes)
        out = np.empty((rows, bins // 64), dtype=np.int64)
        for lo in range(0, rows, 4096):
            hi = min(rows, lo + 4096)
            part = slice(self.bounds[lo], self.bounds[hi])
            odd = np.bincount((self.text_of[part] - lo) * bins + bin_of[part], minlength=(hi - lo) * bins) & 1
            out[lo:hi] = np.packbits(odd.astype(np.uint8).reshape(hi - lo, bins), axis=1).view(np.int64)
        return out


def shingle_sets(chunk: W.Chunk, n: int) -> Sets:
    words = W.find_words(chunk)
    hashes = W.word_hashes(chunk, words, lower=True)
    counts = np.diff(words.bounds)
    begin, grams = W.ngrams(hashes, words.bounds, n)
    text = words.text_of[begin]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = W.spans_hash(hashes | np.uint64(1), words.bounds[short], words.bounds[short + 1], W.WORD_BASE)
        text, grams = np.concatenate([text, short]), np.concatenate([grams, whole])
    order = np.lexsort((grams, text))
    text, grams = text[order], grams[order]
    fresh = np.ones(len(grams), dtype=bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    text, grams = text[fresh], grams[fresh]
    return Sets(grams, np.searchsorted(text, np.arange(chunk.rows + 1)))


def _scan(documents: DataFrame, s: Settings) -> DataFrame:
    """Rows of two kinds: a document's set size and node, and shingle counts, a block of buckets at a time."""
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    shift = np.uint64(64 - s.sketch_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << s.sketch_bits, dtype=np.int64)
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                seen += np.bincount((W.mix(sets.values) >> shift).astype(np.int64), minlength=len(seen))
                ids = batch.column("doc_id").slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sets.sizes, pa.int64()), pa.array(sets.node().view(np.int64)),
                     pa.nulls(chunk.rows, pa.int32()), pa.nulls(chunk.rows, pa.binary())], SCANNED)
        blocks = seen.reshape(-1, min(BLOCK, len(seen)))
        at = np.flatnonzero(blocks.any(axis=1))
        for some in np.array_split(at, -(-len(at) // 256) or 1):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), pa.int64())] * 3 + [pa.array(some.astype(np.int32)),
                 pa.array([blocks[k].astype(np.uint32).tobytes() for k in some], pa.binary())], SCANNED)

    return source.mapInArrow(run, "doc_id long, n_shingles long, node long, block int, counts binary")


def _frequencies(scan: DataFrame, s: Settings) -> np.ndarray:
    """How many sets hold a shingle of each bucket: the tasks' blocks are added up in Spark, 2**sketch_bits numbers come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
                part = np.frombuffer(counts.as_buffer(), dtype=np.uint32)
                sums[block] = sums[block] + part if block in sums else part.astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.astype(np.float32).tobytes() for v in sums.values()], pa.binary())], ["block", "counts"])

    found = scan.where("block IS NOT NULL").select("block", "counts").repartition("block").mapInArrow(run, "block int, counts binary").toArrow()
    out = np.zeros(1 << s.sketch_bits, dtype=np.float32)
    width = min(BLOCK, len(out))
    for block, counts in zip(found.column("block").to_pylist(), found.column("counts").to_pylist(), strict=True):
        out[block * width : (block + 1) * width] = np.frombuffer(counts, dtype=np.float32)
    return out


def _prefixes(documents: DataFrame, rank: np.ndarray, s: Settings) -> DataFrame:
    """Prefix shingles: token, node, set size and place in the rare-first order.  Equal sets of a batch go once."""
    shift = np.uint64(64 - s.sketch_bits)
    shared = documents.sparkSession.sparkContext.broadcast(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of = shared.value
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                nodes, sizes, text = sets.node(), sets.sizes, sets.text_of
                tokens = W.mix(sets.values)
                order = np.lexsort((tokens, order_of[(tokens >> shift).astype(np.int64)], text))
                place = np.arange(len(order)) - sets.bounds[text]  # text is ascending, so order keeps it
                once = np.zeros(chunk.rows, dtype=bool)
                once[np.unique(nodes, return_index=True)[1]] = True
                keep = (place < prefix_size(sizes, s.percent)[text]) & once[text]
                text, place = text[keep], place[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[order][keep].view(np.int64)), pa.array(nodes[text].view(np.int64)),
                     pa.array(sizes[text].astype(np.int32)), pa.array(place.astype(np.int32))],
                    ["token", "node", "n", "place"])

    return documents.select("text").mapInArrow(run, "token long, node long, n int, place int")


def _shared(rows: DataFrame) -> DataFrame:
    """Prefix rows whose token has two nodes or more, once per (token, node), with the token's first leader.

    One shuffle by token, sorted by node, so that the leader of many tokens is the same node; the
    pass over the sorted rows keeps one row from batch to batch.
    """
    ordered = rows.repartition("token").sortWithinPartitions("token", "node")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead, lead_told = None, True  # the current token's first row, and whether it went out
        for frame in frames:
            if frame.empty:
                continue
            old = lead is not None
            if old:
                frame = pd.concat([lead, frame], ignore_index=True)
            token, node = frame["token"].to_numpy(), frame["node"].to_numpy()
            head = np.ones(len(frame), dtype=bool)
            head[1:] = token[1:] != token[:-1]
            first = np.flatnonzero(head)[np.cumsum(head) - 1]
            same = np.zeros(len(frame), dtype=bool)  # a copy's row of the same token and node
            same[1:] = (token[1:] == token[:-1]) & (node[1:] == node[:-1])
            other = node != node[first]
            last = first[-1]
            told = bool(lead_told and old and last == 0) or bool(other[last:].any())
            keep = other & ~same
            keep[first[keep]] = True
            if old and lead_told:
                keep[0] = False
            # a node seen at the end of the last batch may come again: pairs are made distinct anyway
            out = frame.assign(lead=node[first], lead_n=frame["n"].to_numpy()[first],
                               lead_place=frame["place"].to_numpy()[first])[keep]
            lead, lead_told = frame.iloc[[last]], told
            if len(out):
                yield out

    schema = "token long, node long, n int, place int, lead long, lead_n int, lead_place int"
    return ordered.mapInPandas(run, schema)


def _possible(n, i, m, j, percent: int):
    """Length and positional filter (columns or arrays): set sizes n, m and places i, j of a shared shingle.

    Taken as the first one that both share: a linked pair passes at that one, and need not at the others.
    """
    least, most = (F.least, F.greatest) if isinstance(n, Column) else (np.minimum, np.maximum)
    overlap = 1 + least(n - i - 1, m - j - 1)
    return (100 * least(n, m) >= percent * most(n, m)) & ((100 + percent) * overlap >= percent * (n + m))


def _texts(documents: DataFrame, nodes: DataFrame, s: Settings) -> DataFrame:
    """One text of every node of ``nodes``, whichever: texts of one node have equal sets.

    Whole texts are shuffled once, by node, and copies only once a task: no row meets another of its doc_id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                node = sets.node().view(np.int64)
                once = np.unique(node, return_index=True)[1]
                once = pa.array(once[sets.sizes[once] > 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node).take(once), batch.column("text").slice(chunk.first, chunk.rows).take(once)], ["node", "text"])

    rows = documents.select("text").mapInArrow(run, "node long, text string")
    return rows.dropDuplicates(["node"]).join(nodes, "node", "left_semi")


def _signed(texts: DataFrame, s: Settings) -> DataFrame:
    """Each node's set size and parities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                bits = sets.parities(s.bins)
                lists = pa.ListArray.from_arrays(np.arange(chunk.rows + 1, dtype=np.int32) * bits.shape[1], bits.ravel())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.node().view(np.int64)), pa.array(sets.sizes, pa.int32()), lists], ["node", "size", "bits"])

    return texts.select("text").mapInArrow(run, "node long, size int, bits array<long>")


def _alike(n: Column, m: Column, x: Column, y: Column, s: Settings) -> Column:
    """Suffix filter: the parities' distance is within what linked sets of n and m shingles may differ in."""
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(s.bins // 64)), F.lit(0))
    return (100 + s.percent) * (n + m - apart) >= 2 * s.percent * (n + m)


def _plausible(pairs: DataFrame, signed: DataFrame, s: Settings) -> DataFrame:
    """Pairs (a, b) that pass the suffix filter."""
    x, y = (signed.select(F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("bits").alias(f"{c}_bits")) for c in "ab")
    return pairs.join(x, "a").join(y, "b").where(
        _alike(F.col("a_size"), F.col("b_size"), F.col("a_bits"), F.col("b_bits"), s)).select("a", "b")


def _across(rows: DataFrame, s: Settings) -> DataFrame:
    """Candidate pairs (a, b) across components among rows (token, node, n, place, root) whose tokens have at most
    ``small_group`` rows.  The pass over the rows sorted by token holds one batch and a token's first rows."""
    ordered = rows.repartition("token").sortWithinPartitions("token", "node")
    names = ["token", "node", "n", "place", "root"]

    def pairs(x: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Candidates among whole runs of equal tokens, by distance in the sorted rows."""
        none = np.zeros(0, dtype=np.int64)
        got_a, got_b = [none], [none]
        at = np.arange(len(x["token"]))
        for step in range(1, s.small_group):
            at = at[at + step < len(x["token"])]
            at = at[x["token"][at] == x["token"][at + step]]
            if len(at) == 0:
                break
            other = at + step
            fine = (x["root"][at] != x["root"][other]) & _possible(
                x["n"][at], x["place"][at], x["n"][other], x["place"][other], s.percent)
            got_a.append(x["node"][other[fine]])
            got_b.append(x["node"][at[fine]])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(got_a)), pa.array(np.concatenate(got_b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None  # the last token's rows: more may follow
        for batch in batches:
            x = {c: batch.column(c).to_numpy() for c in names}
            if held is not None:
                x = {c: np.concatenate([held[c], x[c]]) for c in names}
            if len(x["token"]) == 0:
                continue
            tail = int(np.searchsorted(x["token"], x["token"][-1]))
            held = {c: v[tail:] for c, v in x.items()}
            yield pairs({c: v[:tail] for c, v in x.items()})
        if held is not None:
            yield pairs(held)

    return ordered.select(*names).mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The linked ones of distinct pairs (a, b).  Rows go to b: its text first, then the texts of its partners.

    b's set is made once for all its partners; a text with more than ``partners`` of them goes to several tasks.
    """
    many = pairs.groupBy("b").agg(F.count("*").alias("k")).where(F.col("k") > s.partners)
    dealt = pairs.join(many, "b", "left").select(
        "a", "b", F.when(F.col("k").isNull(), 0).otherwise(F.pmod(F.xxhash64("a"), F.ceil(F.col("k") / s.partners))).cast("int").alias("part"))
    both = dealt.select("b", "part", F.col("a").alias("node"), F.lit(1).alias("kind")).unionByName(
        dealt.select("b", "part", F.col("b").alias("node"), F.lit(0).alias("kind")).distinct())
    rows = both.join(texts, "node").repartition("b", "part").sortWithinPartitions("b", "part", "kind", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_set = None, None
        for batch in batches:
            b = batch.column("b").to_numpy()
            node = batch.column("node").to_numpy()
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                linked = []
                for i in range(chunk.rows):
                    k = chunk.first + i
                    mine = sets.values[sets.bounds[i] : sets.bounds[i + 1]]
                    if node[k] == b[k]:
                        head, head_set = b[k], mine.copy()
                        continue
                    if head != b[k]:
                        continue
                    least = int(need(len(mine), len(head_set), s.percent))
                    at = np.minimum(np.searchsorted(head_set, mine), len(head_set) - 1)
                    if np.count_nonzero(head_set[at] == mine) >= least:
                        linked.append(k)
                yield pa.RecordBatch.from_arrays([pa.array(node[linked], pa.int64()), pa.array(b[linked], pa.int64())],
                                                 ["a", "b"])

    return rows.select("b", "node", "text").mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for every row of ``documents`` (doc_id, text)."""
    members, roots = _classes(documents, s)
    nodes = members.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.join(least, "root").select("node", "component_id")
    single = F.col("n_shingles") == 0
    # rows without shingles have one node in common but no class: keep them out of the join
    return (members.where(~single).join(of_node, "node").select("doc_id", "n_shingles", "component_id")
            .unionByName(members.where(single).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))))


def _classes(documents: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Every row's node, and the root of every node that has a link."""
    scan = cut(_scan(documents, s))
    members = scan.where("block IS NULL").select("doc_id", "n_shingles", "node")
    shared = cut(_shared(_prefixes(documents, _frequencies(scan, s), s)))

    with laid_out_by("node"):  # every verification joins the texts by node
        texts = cut(_texts(documents, shared.select("node").distinct(), s))

    signed = cut(_signed(texts, s))
    # a leader is its token's smallest node: pairs are (larger node, smaller node) throughout
    first = shared.where("node <> lead").where(
        _possible(F.col("n"), F.col("place"), F.col("lead_n"), F.col("lead_place"), s.percent))
    tried = cut(first.select(F.col("node").alias("a"), F.col("lead").alias("b")).distinct())
    links = cut(_verify(cut(_plausible(tried, signed, s)), texts, s))
    roots = cut(connected_components(links))
    # tokens whose members still lie in several components; most lie in one by now
    named = _named(shared.select("token", "node", "n", "place"), roots)
    several = named.groupBy("token").agg(F.count("*").alias("k"), F.min("root").alias("low"), F.max("root").alias("high"))
    rows = cut(named.join(several.where("low <> high").select("token", "k"), "token"))
    pairs = cut(_plausible(_across(rows.where(F.col("k") <= s.small_group), s).distinct().join(tried, ["a", "b"], "left_anti"), signed, s))
    rows = rows.where(F.col("k") > s.small_group).select("token", "node", "n", "place").distinct()
    for turn in range(s.most_rounds + 1):
        # pairs of the small groups, or of the round before
        more = cut(_verify(pairs, texts, s))
        tried = tried.unionByName(pairs)
        roots = cut(_joined(roots, more))
        if turn == 0 and not _any(rows):
            return members, roots
        rows = cut(_named(rows.select("token", "node", "n", "place"), roots))
        size = rows.groupBy("token", "root").agg(F.count("*").alias("k")).groupBy("token").agg(
            F.sum("k").alias("k"), ((F.sum("k") * F.sum("k") - F.sum(F.col("k") * F.col("k"))) / 2).alias("pairs"))
        size = size.where("pairs > 0")
        left = size.agg(F.sum("k").alias("k"), F.sum("pairs").alias("pairs")).first()
        if not left["k"]:
            return members, roots
        rows = cut(rows.join(size.select("token"), "token", "left_semi"))  # leaders, members and the next turn read it
        last = turn == s.most_rounds or left["pairs"] <= s.finish_factor * left["k"]
        if last:
            pairs = _all_across(rows.join(signed.select("node", "bits"), "node"), s).join(tried, ["a", "b"], "left_anti")
        else:
            pairs = _plausible(_to_leaders(rows, turn, s).join(tried, ["a", "b"], "left_anti"), signed, s)
        pairs = cut(pairs)
        if last:
            return members, _joined(roots, cut(_verify(pairs, texts, s)))
    raise AssertionError("the last turn returns")


def _any(df: DataFrame) -> bool:
    return df.limit(1).count() > 0


def _named(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows with their node's component (a node without links is its own)."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Components after further links: only the components' names meet in the new graph."""
    if not _any(links):
        return roots
    ends = _named(_named(links.withColumnRenamed("a", "node"), roots).select(F.col("root").alias("x"), F.col("b").alias("node")), roots)
    merged = cut(connected_components(ends.select(F.col("x").alias("a"), F.col("root").alias("b"))))
    old = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left").select(
        "node", F.coalesce("top", "root").alias("root"))
    return old.unionByName(merged.join(roots, "node", "left_anti").select("node", "root"))


def _to_leaders(rows: DataFrame, turn: int, s: Settings) -> DataFrame:
    """Per token a few leaders, drawn anew every turn; their candidates in other components.

    A member drawn at random most likely lies in the token's largest component, where the others' links lead.
    """
    draws = [F.min_by(F.struct("node", "n", "place", "root"), F.xxhash64("node", F.lit(turn * s.leaders + i))) for i in range(s.leaders)]
    lead = rows.groupBy("token").agg(F.array_distinct(F.array(*draws)).alias("leads")).select("token", F.explode("leads").alias("lead"))
    near = rows.join(lead, "token").where(F.col("root") != F.col("lead.root")).where(
        _possible(F.col("n"), F.col("place"), F.col("lead.n"), F.col("lead.place"), s.percent))
    return near.select(F.greatest("node", "lead.node").alias("a"), F.least("node", "lead.node").alias("b")).distinct()


def _all_across(rows: DataFrame, s: Settings) -> DataFrame:
    """All candidates left between different components."""
    x = rows.select("token", *(F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "root", "bits")))
    y = rows.select("token", *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "place", "root", "bits")))
    near = x.join(y, (x["token"] == y["token"]) & (F.col("x_node") > F.col("y_node")) & (
        F.col("x_root") != F.col("y_root")) & _possible(
        F.col("x_n"), F.col("x_place"), F.col("y_n"), F.col("y_place"), s.percent) & _alike(
        F.col("x_n"), F.col("y_n"), F.col("x_bits"), F.col("y_bits"), s))
    return near.select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()


def _noded(documents: DataFrame, s: Settings) -> DataFrame:
    """Every row whole, as ``row``, with its node (null without words)."""
    source = documents.select(F.struct(*documents.columns).alias("row"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                sets = shingle_sets(chunk, s.words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(chunk.first, chunk.rows),
                     pa.array(sets.node().view(np.int64), pa.int64(), mask=sets.sizes == 0)], ["row", "node"])

    return source.mapInArrow(run, source.select("row").schema.add("node", "long"))


def one_of_each(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The input with one row of each class, the one with the smallest doc_id, then the first by text; same columns in the same order.

    Only rows of one class replace each other: rows that share a doc_id with different texts are
    judged one by one.  Rows without words are in no class and stay.  Rows with a null doc_id
    cannot be named: of those in a class one stays, the first by text, beside the one with the smallest doc_id.
    """
    members, roots = _classes(documents, s)
    keys = members.where("n_shingles > 0").groupBy("doc_id", "node").agg(F.count("*").alias("copies"))
    named = cut(_named(keys, roots).withColumn("nameless", F.col("doc_id").isNull()))
    least = named.groupBy("root", "nameless").agg(F.min("doc_id").alias("least"), F.sum("copies").alias("rows"))
    several = named.join(least.where("rows > 1"), ["root", "nameless"]).withColumn("first", F.col("doc_id").eqNullSafe(F.col("least")))
    first = several.where("first").groupBy("root", "nameless").agg(F.sum("copies").alias("firsts")).where("firsts > 1")
    key = [F.col("doc_id").alias("its_id"), F.col("node").alias("its_node")]
    lose = several.where("NOT first").select(*key)
    again = cut(several.where("first").join(first, ["root", "nameless"]).select(*key, "root", "nameless"))
    rows = _noded(documents, s)
    same = (F.col("node") == F.col("its_node")) & F.col("row.doc_id").cast("long").eqNullSafe(F.col("its_id"))
    kept = rows.join(lose.unionByName(again.select("its_id", "its_node")), same, "left_anti").select("row")
    if _any(again):
        order = F.struct(F.col("row.text").alias("text"), F.to_json("row").alias("whole"))
        repeats = rows.join(again, same).groupBy("root", "nameless").agg(F.min_by("row", order).alias("row"))
        kept = kept.unionByName(repeats.select("row"))
    return kept.select("row.*")
