"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch holds the k smallest hashes (first 16 hexadecimal digits of MD5) of a text's distinct five-word
shingles, ascending; a text of fewer words is one shingle, a text without words has an empty sketch.
Sketches merge: the k smallest of several sketches are the sketch of the texts together, so a text is
sketched in parts of ``PART`` shingles, and ``merged`` sketches whole groups.  From two sketches,
the k smallest of both estimate

* resemblance: the share of them that both hold;
* containment of x in y: of those that x holds, the share that y holds too;
* the distinct shingles of one: exactly below k, else from the k-th smallest hash.

``compared`` sketches every document beside an edited version and the next document.  The next
one, by descending doc_id, is found without moving a text twice: slim keys (doc_id, MD5 of the text) are
range-partitioned, the first key of each range becomes a bucket's boundary (at most ``most_buckets`` of
them), every row goes to its bucket, and the first row of a bucket goes to the one before it too, where it
sorts last.  Rows that share doc_id and text are one another's next document; above ``heavy`` times they
travel as one row with a count, so that no bucket holds them all.

Defined results: null texts count as empty; null doc_ids come last; equal doc_ids are ordered by MD5 of
the text; a repeated row is a document of its own, whose next document is its copy; after the last
document comes the first, which for a table of one row is itself; two empty sketches are alike (1.0); an
empty table has no rows.  Texts are used whole, whatever their length.  Only doc_id and text
are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from loanlens.llm.state import cut

SPACE = r"[\x20\x09-\x0D]+"
DIGITS = 16
PART = 4096


@dataclass(frozen=True)
class Settings:
    k: int = 128
    shingle: int = 5
    bucket_bytes: int = 1 << 24
    most_buckets: int = 100_000
    heavy: int = 1000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch(text: Column, s: Settings = Settings()) -> Column:
    """The k smallest shingle hashes of a text, ascending."""
    def of(words: Column, at: Column, size: Column) -> Column:
        return F.substring(F.md5(F.array_join(F.slice(words, at, size), " ")), 1, DIGITS)

    def parts(words: Column) -> Column:
        last = F.size(words) - (s.shingle - 1)

        def part(p: Column) -> Column:
            return _smallest(F.transform(F.sequence(p, F.least(p + (PART - 1), last)), lambda i: of(words, i, F.lit(s.shingle))), s.k)

        whole = F.filter(F.array(of(words, F.lit(1), F.size(words))), lambda _: F.size(words) > 0)
        return F.when(last < 1, whole).when(last <= PART, part(F.lit(1))).otherwise(
            _smallest(F.flatten(F.transform(F.sequence(F.lit(1), last, F.lit(PART)), part)), s.k))

    return _let(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), ""), parts)


def merge(x: Column, y: Column, s: Settings = Settings()) -> Column:
    """The sketch of two texts together."""
    return F.slice(F.sort_array(F.array_union(x, y)), 1, s.k)


def merged(sketches: DataFrame, by: list[str], column: str, s: Settings = Settings()) -> DataFrame:
    """One sketch per group of rows; a group's hashes are cut to the k smallest before and after the exchange."""
    smallest = Window.partitionBy(*by).orderBy("__hash")
    each = sketches.select(*by, F.explode_outer(column).alias("__hash")).distinct()
    ranked = each.withColumn("__rank", F.row_number().over(smallest)).where(F.col("__rank") <= s.k + 1)  # a null may come first
    return ranked.groupBy(*by).agg(F.slice(F.sort_array(F.collect_list("__hash")), 1, s.k).alias(column))


def resemblance(x: Column, y: Column, s: Settings = Settings()) -> Column:
    both = lambda u: F.size(F.array_intersect(u, F.array_intersect(x, y))) / F.size(u)
    return F.when(F.size(x) + F.size(y) == 0, 1.0).otherwise(_let(merge(x, y, s), both))


def containment(x: Column, y: Column, s: Settings = Settings()) -> Column:
    """How much of ``x`` is in ``y`` (1.0 for an empty ``x``, 0.0 where the smallest hashes hold none of it)."""
    def share(own: Column) -> Column:
        return F.when(F.size(own) == 0, 0.0).otherwise(F.size(F.array_intersect(own, y)) / F.size(own))

    return F.when(F.size(x) == 0, 1.0).otherwise(_let(F.array_intersect(merge(x, y, s), x), share))


def distinct_shingles(x: Column, s: Settings = Settings()) -> Column:
    """Distinct shingles of a text, estimated above k - 1 of them from the first 12 digits of the k-th hash."""
    kth = F.conv(F.substring(F.element_at(x, s.k), 1, 12), 16, 10).cast("double")
    return F.when(F.size(x) < s.k, F.size(x).cast("long")).otherwise(F.floor(F.lit(float((s.k - 1) << 48)) / (kth + 1.0)))


def fingerprint(x: Column) -> Column:
    """A sketch as one string."""
    return F.array_join(x, "")


def parsed(fingerprint: Column) -> Column:
    """The sketch that a fingerprint stands for."""
    starts = F.sequence(F.lit(1), F.length(fingerprint), F.lit(DIGITS))
    return F.when(F.length(fingerprint) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(starts, lambda i: F.substring(fingerprint, i, F.lit(DIGITS))))


def _key() -> Column:
    """Ascending: descending doc_id, nulls last, then the MD5 of the text."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.bitwise_not(F.col("doc_id").cast("long")).alias("back"),
                    F.md5("text").alias("digest"))


KEY = "struct<unnamed: boolean, back: bigint, digest: string>"


def _boundaries(keys: DataFrame, buckets: int) -> list[dict]:
    """The first key of each of at most ``buckets`` ranges, ascending."""
    ranged = keys.select("key").repartitionByRange(buckets, "key")
    first = ranged.groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("key"))
    return [r["key"].asDict() for r in first.orderBy("key").collect()]


def _bucket(key: Column, boundaries: list[dict]) -> tuple[Column, Column]:
    """Number of the bucket that a key falls in, and whether the key begins it (two steps of about the root of their number)."""
    width = max(1, math.isqrt(len(boundaries)))
    rows = [boundaries[i : i + width] for i in range(0, len(boundaries), width)]
    table = F.from_json(F.lit(json.dumps(rows)), f"array<array<{KEY}>>")
    heads = F.from_json(F.lit(json.dumps([r[0] for r in rows])), f"array<{KEY}>")
    row = F.size(F.filter(heads, lambda b: b <= key)) - 1
    place = F.size(F.filter(F.get(table, row), lambda b: b <= key)) - 1
    return row * width + place, F.get(F.get(table, row), place) == key


@dataclass(frozen=True)
class _Layout:
    """Documents with their key, the boundaries of the buckets, and rows repeated so often that they are one row with a count."""

    rows: DataFrame
    boundaries: list[dict]
    repeated: DataFrame | None


def _layout(documents: DataFrame, s: Settings) -> _Layout:
    docs = documents.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("key", _key())
    slim = cut(docs.select("key", F.octet_length("text").cast("long").alias("size")))
    counted = cut(slim.groupBy("key").agg(F.count(F.lit(1)).alias("times"), F.first("size").alias("size")))
    total = counted.agg(F.sum("size").alias("bytes"), F.sum("times").alias("rows"), F.max("times").alias("most")).first()
    if not total["rows"]:
        return _Layout(docs, [{"unnamed": True, "back": None, "digest": ""}], None)
    boundaries = _boundaries(counted, min(s.most_buckets, 1 + total["bytes"] // s.bucket_bytes))
    heavy = max(s.heavy, total["rows"] // s.most_buckets)
    if total["most"] <= heavy:
        return _Layout(docs, boundaries, None)
    many = F.broadcast(counted.where(F.col("times") > heavy).select("key", "times"))  # fewer than most_buckets
    one = cut(docs.join(many, "key").groupBy("key", "times").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")))
    rest = docs.join(many, "key", "left_anti")
    return _Layout(rest.unionByName(one.drop("times")), boundaries, one)


def _order() -> WindowSpec:
    return Window.partitionBy("bucket").orderBy("guest", "key")


def _in_buckets(layout: _Layout) -> DataFrame:
    """Rows with their ``bucket``; the first row of a bucket is also a ``guest`` of the one before."""
    own, begins = _bucket(F.col("key"), layout.boundaries)
    before = F.pmod(F.col("own") - 1, F.lit(len(layout.boundaries)))
    host, guest = (F.struct(at.cast("int").alias("bucket"), F.lit(is_guest).alias("guest")) for at, is_guest in ((F.col("own"), False), (before, True)))
    placed = layout.rows.withColumn("own", own).withColumn("begins", begins)
    placed = placed.withColumn("place", F.explode(F.when(F.col("begins"), F.array(host, guest)).otherwise(F.array(host))))
    return placed.select("doc_id", "text", "key", "place.bucket", "place.guest")


def _edited(text: Column, following: Column) -> Column:
    """The last half of the code points (rounded down) replaced by the first as many of another text."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def _drawn(s: Settings) -> list[Column]:
    """Figures and sketches of ``text`` and its edited text ``changed``."""
    return [F.length("text").cast("long").alias("n_chars"), F.sha2("changed", 256).alias("edited_sha256"),
            sketch(F.col("text"), s).alias("own"), F.when(F.col("changed").isNotNull(), sketch(F.col("changed"), s)).alias("edited")]


def compared(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Sketches of every document (``own``) and its edited text (``edited``), and what they tell of each other and the next document."""
    layout = _layout(documents, s)
    near = _in_buckets(layout).withColumn("next", F.lead("text").over(_order()))
    near = near.withColumn("changed", F.when(~F.col("guest"), _edited(F.col("text"), F.col("next"))))
    rows = (near.select("doc_id", "key", "bucket", "guest", *_drawn(s))
            .withColumn("following", F.lead("own").over(_order())).where(~F.col("guest")).drop("key", "bucket", "guest"))
    if layout.repeated is not None:
        copies = layout.repeated.withColumn("changed", _edited(F.col("text"), F.col("text"))).select("doc_id", "times", *_drawn(s))
        copies = copies.withColumn("following", F.col("own")).withColumn("copy", F.explode(F.sequence(F.lit(2).cast("long"), "times")))
        rows = rows.unionByName(copies.drop("times", "copy"))
    own, edited, following = (F.col(c) for c in ("own", "edited", "following"))
    return rows.select("doc_id", "n_chars", "edited_sha256", "own", "edited", resemblance(own, edited, s).alias("near_edited"),
                       resemblance(own, following, s).alias("near_next"), containment(own, edited, s).alias("kept_share"),
                       distinct_shingles(own, s).alias("distinct_shingles"))
