"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are rows of equal text.  In order of falling size each group enters the shard with the
tightest capacity left that holds it, found in a balanced tree.  The capacity is the
smallest for which the wanted number of shards is enough, so shards come out nearly equal in bytes.

At scale the packing runs over units, whose number is bounded by shards and grain alone: a
group of at least 1 / ``grain`` of a mean shard is a unit (at most shards * grain of them), and
smaller groups go by text hash into shards * grain bundles, each whole in one shard.  Only a
group larger than a mean shard is cut, into pieces by a hash of doc_id and row number, because no shard
could hold it beside its share.  Sizes, checksums and row numbers are written once and read from there, so
that a row has one number throughout.  The driver sees unit sizes, never rows; texts are not shuffled.

Slots are numbered without sorting a shard: each unit is cut into runs of about ``run_rows``
rows, counted, and numbered on from the runs before it.

Defined results: a null text counts as the empty one (size 8, group and checksum of no
bytes); null and equal doc_ids are rows like others, spread by row number, however many they are; rows with
equal doc_id and text get different slots in either order; a very long text is a group of its own size;
hash collisions put two texts into one group, which costs balance only; an empty table gives an empty
result.  Only doc_id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm.state import cut


@dataclass(frozen=True)
class Settings:
    shards: int = 24
    grain: int = 256
    pieces: int = 64  # that a mean shard would be cut into
    run_rows: int = 100_000


class FreeSpace:
    """Bins by capacity left: a treap of (left, bin) that finds the tightest bin holding a size."""

    def __init__(self) -> None:
        self.root, self.random = None, random.Random(1)

    def put(self, left: int, name: int) -> None:
        low, high = self._split(self.root, (left, name))
        self.root = self._merge(self._merge(low, [(left, name), self.random.random(), None, None]), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the bin with the least capacity left that is at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            self.root = low
            return None
        first = high
        while first[2] is not None:
            first = first[2]
        _, rest = self._split(high, (first[0][0], first[0][1] + 1))
        self.root = self._merge(low, rest)
        return first[0]

    def _split(self, node, key):
        """Entries below ``key``, and the others."""
        if node is None:
            return None, None
        if node[0] < key:
            low, high = self._split(node[3], key)
            return [node[0], node[1], node[2], low], high
        low, high = self._split(node[2], key)
        return low, [node[0], node[1], high, node[3]]

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if low[1] > high[1]:
            return [low[0], low[1], low[2], self._merge(low[3], high)]
        return [high[0], high[1], self._merge(low, high[2]), high[3]]


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of every item; None if an item is too large or more than ``most`` bins are needed."""
    bins, free, out = 0, FreeSpace(), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if sizes[i] > capacity:
            return None
        hit = free.take(sizes[i])
        if hit is None:
            if bins == most:
                return None
            hit, bins = (capacity, bins), bins + 1
        out[i] = hit[1]
        free.put(hit[0] - sizes[i], hit[1])
    return out


def least_capacity(sizes: list[int], bins: int) -> list[int]:
    """Bins of the packing with the smallest capacity found for which ``bins`` are enough."""
    low, high = max([-(-sum(sizes) // bins), *sizes]), sum(sizes)
    best = best_fit_decreasing(sizes, high, bins)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, bins)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
        if high - low < 1 + sum(sizes) // (bins * 10_000):
            break
    return best


def shard(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row."""
    spark = documents.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = cut(documents.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
                                F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_group"),
                                F.monotonically_increasing_id().alias("row")))
    groups = cut(rows.groupBy("text_group").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")))
    total = groups.agg(F.sum("bytes")).first()[0]
    if total is None:
        return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    mean = total / s.shards
    bundles = s.shards * s.grain
    large = groups.where(F.col("bytes") >= mean / s.grain).orderBy("text_group").collect()  # at most shards * grain
    parts = {r["text_group"]: max(1, -(-int(r["bytes"] * s.pieces) // max(1, int(mean)))) if r["bytes"] > mean else 1 for r in large}
    named = spark.createDataFrame([(g, bundles + i, p) for i, (g, p) in enumerate(parts.items())],
                                  "text_group long, large int, pieces int")
    rows = rows.join(F.broadcast(named), "text_group", "left").select(
        "doc_id", "size", "text_crc32", "row",
        F.coalesce("large", F.pmod("text_group", F.lit(bundles)).cast("int")).alias("unit"),
        F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id", "row"), F.col("pieces")).cast("int")).otherwise(0).alias("piece"))

    units = rows.groupBy("unit", "piece").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()  # bounded as above
    units.sort(key=lambda r: (r["unit"], r["piece"]))
    bins = least_capacity([r["bytes"] for r in units], s.shards)
    placed = spark.createDataFrame([(r["unit"], r["piece"], b, -(-r["n"] // s.run_rows)) for r, b in zip(units, bins, strict=True)],
                                   "unit int, piece int, shard int, runs int")
    rows = rows.join(F.broadcast(placed), ["unit", "piece"]).withColumn("run", F.pmod(F.xxhash64("doc_id", "row", F.lit(1)), F.col("runs")))

    counts = rows.groupBy("shard", "unit", "piece", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("unit", "piece", "run").rowsBetween(Window.unboundedPreceding, -1)
    begin = counts.withColumn("begin", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("shard", "unit", "piece", "run").orderBy("doc_id", "text_crc32", "row")
    return (rows.withColumn("nth", F.row_number().over(inside)).join(begin, ["shard", "unit", "piece", "run"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("begin") + F.col("nth") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")))
