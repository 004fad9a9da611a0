"""Mixing sources to target weights: hierarchical budgeting over a domain / language / source tree.

A token budget goes down the tree: at each node its children share the amount by weight, no
child getting more than it can hold (its tokens times ``most_epochs``).  What a full child cannot
take goes to its siblings first, by their weights; only what a whole family cannot hold is
left to the family's own siblings, because a node's capacity caps its amount one level up.

A leaf then reads its documents in whole epochs and one partial epoch.  Each epoch has its
own seeded order (by md5 of seed, epoch and doc_id); the partial one takes the longest prefix
whose tokens stay within the amount left.  The prefix ends at one md5 value for each leaf,
so every row's copies follow from its own md5 and a table of leaves.

Scale: the leaf that holds a third of all rows is never sorted whole.  Its order is cut into
buckets of about ``bucket_rows`` by the md5's leading digits; bucket sums find the bucket in
which the prefix ends, and only that bucket is sorted.

All amounts are integers (a share's remainder of less than a token is left unspent).
Defined results: a null language or source is a node of its own; a null or empty text has 0
tokens and is never selected; rows that share a doc_id share their place in every order;
null doc_ids count as one id; a node of weight 0 gets nothing; a very long text is taken whole or not at
all; an empty table gives an empty result.  ``mixed`` carries all columns as one struct, so they may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm.state import cut

LEVELS = ["domain", "lang", "source"]
TOKENS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """``weights``: SQL for a node's weight, by level, over its name and its ``tokens``."""

    domain: str = "concat('d', ascii(md5(coalesce(source, ''))) % 4)"
    weights: tuple[str, str, str] = (
        "cast(floor(sqrt(tokens)) as bigint)",
        "cast(case when lang = 'en' then 4 else 2 end as bigint)",
        "cast(floor(sqrt(tokens)) as bigint)",
    )
    budget_percent: int = 100  # of all tokens
    most_epochs: int = 2
    seed: int = 17
    bucket_rows: int = 4096


def _amounts(nodes: DataFrame, parents: list[str], name: str, weight: str) -> DataFrame:
    """Share each family's ``amount`` among its rows (name, tokens, capacity, amount): adds ``share``."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy(F.try_divide(F.col("capacity").cast("double"), F.col("weight").cast("double")), name)
    wide = nodes.withColumn("weight", F.expr(weight)).withColumn(
        "held", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0))
    dec = lambda c: F.col(c).cast("decimal(19,0)")
    wide = (wide.withColumn("held_before", F.coalesce(F.sum("held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("weight_left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))))
    full = dec("held") * dec("weight_left") <= dec("weight") * (F.col("amount") - F.col("held_before")).cast("decimal(19,0)")
    wide = wide.withColumn("full", (F.col("weight") > 0) & full)
    wide = (wide.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("held"))).over(family), F.lit(0)))
            .withColumn("open_weight", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(family), F.lit(0))))
    part = F.expr("cast(weight as decimal(19,0)) * cast(amount - taken as decimal(19,0)) div nullif(open_weight, 0)")
    share = F.when(F.col("weight") <= 0, F.lit(0)).when(F.col("full"), F.col("held")).otherwise(part)
    return wide.withColumn("share", share.cast("long")).drop(
        "weight", "held", "held_before", "weight_left", "full", "taken", "open_weight")


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    on = F.lit(True)
    for c in columns:
        on = on & left[c].eqNullSafe(right[c])
    return on


def budgets(leaves: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``quota`` for every leaf (domain, lang, source, tokens, rows)."""
    holds = F.col("tokens") * s.most_epochs
    above = leaves.groupBy().agg(F.expr(f"coalesce(sum(tokens), 0) * {s.budget_percent} div 100").alias("amount"))
    path: list[str] = []
    for level, weight in zip(LEVELS, s.weights, strict=True):
        nodes = leaves.groupBy(*path, level).agg(F.sum("tokens").alias("tokens")).withColumn("capacity", holds)
        if path:
            named = above.select(*(F.col(c).alias(f"up_{c}") for c in path), "amount")
            on = F.lit(True)
            for c in path:
                on = on & nodes[c].eqNullSafe(named[f"up_{c}"])
            nodes = nodes.join(named, on).drop(*(f"up_{c}" for c in path))
        else:
            nodes = nodes.join(F.broadcast(above))  # one row
        shared = _amounts(nodes, path, level, weight)
        path = [*path, level]
        above = shared.select(*path, F.col("share").alias("amount"))
    quota = above.select(*(F.col(c).alias(f"up_{c}") for c in path), F.col("amount").alias("quota"))
    on = F.lit(True)
    for c in path:
        on = on & leaves[c].eqNullSafe(quota[f"up_{c}"])
    return leaves.join(quota, on).drop(*(f"up_{c}" for c in path))


def _place(epoch: Column, s: Settings) -> Column:
    return F.md5(F.concat_ws("/", F.lit(str(s.seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def plan(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """A row for every leaf: quota, whole epochs, and ``last``, the md5 at which the partial epoch's prefix ends (null: empty)."""
    rows = cut(documents.select(F.col("doc_id"), F.expr(s.domain).alias("domain"), "lang", "source",
                                _tokens(F.col("text")).alias("n_tokens")))
    leaves = budgets(cut(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))), s)
    leaves = cut(leaves.withColumn("epochs", F.when(F.col("tokens") > 0, F.expr("quota div nullif(tokens, 0)")).otherwise(F.lit(0)))
                 .withColumn("part", F.col("quota") - F.col("epochs") * F.col("tokens"))
                 .withColumn("buckets", F.ceil(F.col("rows") / s.bucket_rows)))
    some = rows.where("n_tokens > 0").alias("r").join(
        leaves.where("part > 0").alias("l"),
        F.expr(" and ".join(f"r.{c} <=> l.{c}" for c in LEVELS))).select(
        *(F.col(f"l.{c}").alias(c) for c in LEVELS), "n_tokens", "part", "buckets", _place(F.col("epochs"), s).alias("place"))
    some = some.withColumn("bucket", F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(1 << 32)))
    sums = some.groupBy(*LEVELS, "bucket", "part").agg(F.sum("n_tokens").alias("tokens"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket")
    ends = (sums.withColumn("upto", F.sum("tokens").over(running)).where("upto - tokens <= part and upto > part")
            .select(*(F.col(c).alias(f"end_{c}") for c in LEVELS), F.col("bucket").alias("end_bucket"),
                    (F.col("upto") - F.col("tokens")).alias("before")))
    within = some.join(ends, F.expr(" and ".join(f"{c} <=> end_{c}" for c in LEVELS)) & (F.col("bucket") <= F.col("end_bucket")))
    # earlier buckets are whole: their greatest md5 stands in where the last bucket gives nothing
    earlier = within.where("bucket < end_bucket").groupBy(*LEVELS).agg(F.max("place").alias("last"))
    by_place = Window.partitionBy(*LEVELS).orderBy("place")
    inside = (within.where("bucket = end_bucket").withColumn("upto", F.sum("n_tokens").over(by_place))
              .where("before + upto <= part").groupBy(*LEVELS).agg(F.max("place").alias("last")))
    # without an end the whole leaf fits (its rows sum to the part exactly only if the part is a whole epoch)
    last = earlier.unionByName(inside).groupBy(*(F.col(c).alias(f"at_{c}") for c in LEVELS)).agg(F.max("last").alias("last"))
    return cut(leaves.join(last, F.expr(" and ".join(f"{c} <=> at_{c}" for c in LEVELS)), "left")
               .select(*LEVELS, "tokens", "quota", "epochs", "last"))


def _tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKENS)), F.lit(0)).cast("long")


def _decided(documents: DataFrame, s: Settings) -> DataFrame:
    """``row`` (all columns), its leaf, tokens and copies."""
    leaves = plan(documents, s)
    row = documents.select(F.struct(*documents.columns).alias("row"), F.col("doc_id"), F.expr(s.domain).alias("domain"),
                           F.col("lang"), F.col("source"), _tokens(F.col("text")).alias("n_tokens")).alias("r")
    both = row.join(leaves.alias("l"), F.expr(" and ".join(f"r.{c} <=> l.{c}" for c in LEVELS)))
    partial = F.coalesce(_place(F.col("epochs"), s) <= F.col("last"), F.lit(False)).cast("int")
    copies = F.when(F.col("n_tokens") > 0, F.col("epochs").cast("int") + partial).otherwise(F.lit(0))
    return both.select("row", "doc_id", *(F.col(f"r.{c}").alias(c) for c in LEVELS), "n_tokens", "quota", copies.alias("copies"))


def mix(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, leaf, tokens, the leaf's quota, and how many copies of every row the mixture holds."""
    return _decided(documents, s).drop("row")


def mixed(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of the mixture: the input's columns, each row as often as it was selected."""
    return (_decided(documents, s).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("row.*"))
