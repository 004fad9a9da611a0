"""Line de-duplication by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as word sequences (white space does not count).  A line is dropped when
an earlier line, by (doc_id, place in the text), is equal, or differs by at most one word
inserted, deleted or replaced.  The bound of one edit holds between lines of ``min_words``
or more; shorter lines are dropped for equality alone.  Lines without a word are never dropped.

1. Equal lines become one, with their earliest place (an aggregation by line hash).
2. A pair one edit apart shares, at the length of its shorter line, either the first half or
   the second half: lines that share no half with another line leave here.
3. Those left emit, for each half they share, the deletion variants of their other words as
   hashed keys: (half, remaining words, place) meets the lines with a word replaced at that
   place, and (half, remaining words) meets the line that lacks the word.  Per key only the
   earliest partner is kept, so a group of n variants costs n rows, never n * n pairs.
4. Each line's earliest partner is verified on the words of both.

A key's members are within one edit of its earliest partner by construction, so the earliest
partner found this way is the earliest there is, unless two 64-bit hashes collide; then the
verification keeps the line.

Defined results: null and empty texts have no lines and stay as they are; null doc_ids come
after all others; repeated rows (same doc_id and text) keep the same lines; lines of rows
that share a doc_id but not the text, at the same place, are equally early, and neither
drops the other; texts of any number and length of lines are read whole, in linear time; an empty table has no
rows.  Extra columns pass through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens.llm.state import cut

WORD = r"[^\x20\x09-\x0D]+"
BLACK = r"[^\x20\x09-\x0D]"  # one character of a word


@dataclass(frozen=True)
class Settings:
    min_words: int = 8


def words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(WORD), F.lit(0))


def _lines(documents: DataFrame, s: Settings) -> DataFrame:
    """Every line with a word: its text, its place, the number and hash of its words, and hashes of its halves."""
    # the text is hashed before it is split, not once a line, and words are taken once: a filter on them would take them again
    named = documents.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", F.xxhash64("text").alias("of")).alias("doc"), "text")
    each = named.select("doc", F.posexplode(F.split("text", "\n", -1)).alias("k", "line")).where(F.col("line").rlike(BLACK))
    worded = each.select("doc", "k", words(F.col("line")).alias("words")).withColumn("m", F.size("words"))
    return worded.select("doc", F.struct("doc.unnamed", "doc.doc_id", "k").alias("rank"), "m",
                         F.xxhash64("words").alias("h"), _halves(s).alias("halves"))


def _halves(s: Settings) -> Column:
    """Hashes of both halves, taken at the line's own length and at one word less."""
    def at(length: Column) -> list[Column]:
        half = F.floor(length / 2).cast("int")
        return [F.xxhash64(length, F.lit(0), F.slice("words", F.lit(1), half)),
                F.xxhash64(length, F.lit(1), F.slice("words", F.col("m") - (length - half) + 1, length - half))]

    own, less = at(F.col("m")), at(F.col("m") - 1)
    return (F.when(F.col("m") > s.min_words, F.array(*own, *less))
            .when(F.col("m") == s.min_words, F.array(*own)).otherwise(F.array().cast("array<long>")))


def _with_words(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of lines named by their earliest place; ``wanted`` has (h, m, first, shared)."""
    by_doc = wanted.groupBy("first.doc_id").agg(F.collect_set("first.k").alias("ks"))  # at most the lines of one text
    named = by_doc.select(F.col("doc_id").alias("wanted_id"), "ks")
    at = _let(F.split("text", "\n", -1), lambda lines: F.transform("ks", lambda k: F.get(lines, k)))
    lines = (documents.select("doc_id", "text").join(named, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
             .select(F.explode(at).alias("line")).where(F.col("line").isNotNull()).select(words(F.col("line")).alias("words")))
    # never null: else the join's own filter on m takes the words again
    found = lines.withColumn("h", F.xxhash64("words")).withColumn("m", F.coalesce(F.size("words"), F.lit(0)))
    # a doc_id that stands for several texts may bring other lines along: the join leaves them out
    return (found.join(wanted, ["h", "m"]).groupBy("h", "m", "first")
            .agg(F.first("words").alias("words"), F.first("shared").alias("shared")))


def _variants(lines: DataFrame) -> DataFrame:
    """Hashed keys of the words outside a shared half: whole (kind 1) against those of a line with a word
    more (kind 2), and without the word at one place against the same (kind 0)."""
    each = lines.select("h", "first", "m", "words", F.explode("shared").alias("s"))
    more = F.floor(F.col("s.at") / 2).cast("int")  # 1: as the longer line of a pair
    half = F.floor((F.col("m") - more) / 2).cast("int")
    other = F.when(F.col("s.at") % 2 == 0, F.slice("words", half + 1, F.col("m") - half)).otherwise(
        F.slice("words", F.lit(1), half + more))
    each = each.select("h", "first", F.col("s.half").alias("half"), more.alias("more"), other.alias("other"))
    each = each.select("h", "first", "half", "more", "other", F.explode(F.sequence(F.col("more"), F.size("other"))).alias("i"))
    rest = F.when(F.col("i") == 0, F.col("other")).otherwise(F.concat(
        F.slice("other", F.lit(1), F.greatest(F.col("i") - 1, F.lit(0))), F.slice("other", F.col("i") + 1, F.size("other"))))
    kind = F.when(F.col("more") == 1, 2).when(F.col("i") == 0, 1).otherwise(0)
    place = F.when(F.col("more") == 1, 0).otherwise(F.col("i"))
    return each.select("h", "first", kind.alias("kind"), F.xxhash64("half", place, rest).alias("key"))


def _earliest_partner(lines: DataFrame) -> DataFrame:
    """``h``, ``m`` and the verified earliest partner's place, for lines that have one before their own."""
    rows = _variants(lines)
    one = lambda kind: F.min(F.when(F.col("kind") == kind, F.struct("first", "h")))
    # a whole line and the longer lines see each other, lines with a replaced word their own kind
    best = rows.groupBy("key").agg(one(0).alias("swap"), one(1).alias("whole"), one(2).alias("more"), F.count("*").alias("n")).where("n > 1")
    other = (F.when(F.col("kind") == 0, F.col("swap")).when(F.col("kind") == 1, F.col("more")).otherwise(F.col("whole")))
    near = (rows.join(best, "key").withColumn("partner", other).where("partner.first < first")
            .groupBy("h", "first").agg(F.min("partner").alias("partner")))
    x = lines.select("h", "first", F.col("words").alias("x"), "m")
    y = lines.select(F.struct("first", "h").alias("partner"), F.col("words").alias("y"))
    return (near.join(x, ["h", "first"]).join(y, "partner").where(one_edit(F.col("x"), F.col("y")))
            .select("h", "m", F.col("partner.first").alias("partner")))


def one_edit(x: Column, y: Column) -> Column:
    """At most one word inserted, deleted or replaced."""
    n, m = F.size(x), F.size(y)
    differ = F.filter(F.sequence(F.lit(1), F.least(n, m)), lambda k: F.element_at(x, k) != F.element_at(y, k))
    p = F.when(F.size(differ) > 0, F.element_at(differ, F.lit(1))).otherwise(F.least(n, m) + 1)
    tail = lambda v, at: F.slice(v, at, F.greatest(F.size(v) - at + 1, F.lit(0)))
    return (F.when(n == m, tail(x, p + 1) == tail(y, p + 1)).when(n + 1 == m, tail(x, p) == tail(y, p + 1))
            .when(n == m + 1, tail(x, p + 1) == tail(y, p)).otherwise(False))


def _decided(documents: DataFrame, s: Settings) -> DataFrame:
    """``row``, and the places of its dropped lines (null: none)."""
    lines = cut(_lines(documents, s))
    distinct = cut(lines.groupBy("h", "m").agg(F.min("rank").alias("first"), F.count("*").alias("times"), F.first("halves").alias("halves")))
    halves = distinct.select("h", "m", F.posexplode("halves").alias("at", "half"))
    several = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    in_play = halves.join(several, "half", "left_semi").groupBy("h", "m").agg(
        F.collect_list(F.struct("half", "at")).alias("shared"))  # at most four
    wanted = distinct.select("h", "m", "first").join(in_play, ["h", "m"])
    partner = _earliest_partner(cut(_with_words(documents, wanted)))
    limits = (distinct.join(partner, ["h", "m"], "left").where("times > 1 OR partner IS NOT NULL")
              .select("h", "m", F.coalesce("partner", "first").alias("limit")))
    drops = (lines.select("doc", "rank", "h", "m").join(limits, ["h", "m"]).where("limit < rank")
             .groupBy("doc").agg(F.collect_list("rank.k").alias("dropped")))  # at most the lines of one text
    named = drops.select(F.col("doc.doc_id").alias("at_id"), F.col("doc.of").alias("at_of"), "dropped")
    row = documents.select(F.struct(*documents.columns).alias("row"))
    return row.join(named, F.col("row.doc_id").eqNullSafe(F.col("at_id")) & (F.xxhash64("row.text") == F.col("at_of")), "left").select(
        "row", F.array_distinct("dropped").alias("dropped"))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _kept_text() -> Column:
    """The lines that stay, joined; linear in the lines, of which there may be very many."""
    def kept(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
        return F.array_join(F.transform(places, lambda k: F.get(lines, k)), "\n")

    return F.when(F.col("dropped").isNull(), F.col("row.text")).otherwise(_let(F.split("row.text", "\n", -1), kept))


def deduplicated(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id``, ``dropped`` (ascending places of dropped lines, from 0) and ``clean_text`` for every row."""
    return _decided(documents, s).select("row.doc_id", F.sort_array(F.coalesce("dropped", F.array().cast("array<int>"))).alias("dropped"),
                                         _kept_text().alias("clean_text"))


def cleaned(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The input with dropped lines taken out of ``text``, same columns; a text that loses its last word goes as a row.

    ``n_chars``, where there is such a column, follows the new text.
    """
    new = _decided(documents, s).withColumn("clean", _kept_text()).where(
        F.col("dropped").isNull() | F.col("clean").rlike(WORD))
    fresh = {"text": F.col("clean")}
    if "n_chars" in documents.columns:
        fresh["n_chars"] = F.when(F.col("dropped").isNull(), F.col("row.n_chars")).otherwise(
            F.length("clean")).cast(documents.schema["n_chars"].dataType)
    return new.select(*(fresh.get(c, F.col("row")[c]).alias(c) for c in documents.columns))
