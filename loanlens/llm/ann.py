"""Approximate nearest neighbours by largest inner product, with an adaptive dimension scan.

Vectors are lifted by one component so that the largest inner product is the smallest
distance (x gets sqrt(M^2 - |x|^2) - M, a query -M: with M, the longest norm, taken off on both
sides, one long vector doesn't swamp the others), and sorted into lists around centroids.  In
each probed list the vectors (not lifted) are rotated by one random orthogonal matrix and compared in
column blocks: after d of D columns, the distance so far times D / d estimates the whole
distance, and a hypothesis test abandons a candidate whose estimate passes the distance at which
its inner product would be the query's k-th best by more than a factor 1 + epsilon / sqrt(d).  Few
candidates reach the last block; these are ranked by inner product, and those that remain best get
theirs on the original vectors.  All of it is in double precision.

Spark does the dealing: equal vectors are one (with their k + 1 smallest ids: no more can
be in a result of k), a list with many vectors is cut into cells of about ``cell_rows``, and
each query goes to every cell of its probed lists.  A task holds one cell and, in blocks, at most about
``slice_rows`` of its queries: a list with more queries sends its cells to several tasks.  The centroids are fitted on a sample of at most about ``sample_rows`` vectors, chosen
by hash; every vector is indexed.  The number of probed lists is what ``target_recall`` takes by brute
force on the sample; a query whose lists hold fewer than k + 1 vectors goes on to its next nearest
ones until they do, or to all lists, so that it gets k rows if there are as many.  Centroids and list sizes (at most ``max_lists``) are all that the driver holds.

Defined results: vectors that are null, zero, hold a null or non-finite component, or have
another length than most, take no part, neither as query nor as candidate; a null id takes
no part.  Rows repeating an id and a vector count once.  Ties go to the smaller id.  An empty
table gives an empty result.  Vectors may have any length.  Only vec_id and embedding are read, beside what
the query condition needs, so other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanlens.llm.state import cut


@dataclass(frozen=True)
class Settings:
    k: int = 20
    target_recall: float = 0.95  # 1: probe every list
    max_lists: int = 4096
    sample_rows: int = 40_000
    iterations: int = 8
    cell_rows: int = 2048
    slice_rows: int = 16_384
    block: int = 16  # columns compared between two tests
    epsilon: float = 2.1
    seed: int = 7


@dataclass(frozen=True)
class Index:
    """What every task needs: centroids of the lifted vectors, the rotation, the square of the longest
    norm, and how many lists a query probes."""

    centroids: np.ndarray
    rotation: np.ndarray
    longest2: float
    probes: int

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        longest = math.sqrt(self.longest2)
        if query:
            extra = np.full(len(x), -longest)
        else:
            square = np.einsum("ij,ij->i", x, x)
            # sqrt(M^2 - |x|^2) - M without a difference of large numbers
            extra = -square / np.maximum(longest + np.sqrt(np.maximum(0.0, self.longest2 - square)), np.finfo(float).tiny)
        return np.concatenate([x, extra[:, None]], axis=1)

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        """To the centroids, less a term that is the same for all of them."""
        return np.einsum("ij,ij->i", self.centroids, self.centroids) - 2 * lifted @ self.centroids.T


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equally long vectors as a matrix."""
    if len(column) == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def usable(vector: str, size: int | None = None) -> Column:
    fine = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(
        vector, lambda x: x != 0.0)
    return fine if size is None else fine & (F.size(vector) == size)


def fit(vectors: DataFrame, rows: int, longest2: float, s: Settings) -> Index:
    """Centroids by k-means (numpy, on the sample) and a random rotation."""
    share = min(1.0, s.sample_rows / max(1, rows))
    drawn = vectors if share == 1 else vectors.where(F.pmod(F.xxhash64("vkey", F.lit(s.seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = matrix(drawn.select("vec").limit(2 * s.sample_rows).toArrow().column("vec").combine_chunks())
    rng = np.random.default_rng(s.seed)
    bare = Index(np.zeros((1, sample.shape[1] + 1)), np.eye(1), longest2, 1)
    points = bare.lift(sample, query=False)
    points = points[np.lexsort(points.T)]  # the result doesn't hang on the order of rows
    lists = max(1, min(s.max_lists, round(math.sqrt(rows)), len(points)))
    centers = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(s.iterations):
        near = np.concatenate([np.argmin((centers * centers).sum(1) - 2 * part @ centers.T, axis=1)
                               for part in np.array_split(points, max(1, len(points) // 2048))])
        count = np.bincount(near, minlength=lists)
        total = np.zeros((lists, points.shape[1]))
        np.add.at(total, near, points)
        filled = count > 0
        centers[filled] = total[filled] / count[filled, None]
        centers[~filled] = points[rng.choice(len(points), int((~filled).sum()))]
    rotation = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
    index = Index(centers, rotation, longest2, lists)
    return replace(index, probes=_probes(index, points, rng, s))


def _probes(index: Index, points: np.ndarray, rng: np.random.Generator, s: Settings) -> int:
    """The fewest lists that hold ``target_recall`` of the true neighbours, by brute force on some of the sample.

    A sample is thinner than the table: its neighbours lie farther off, in more lists, so that the
    whole table's recall is not below the target for want of density.
    """
    lists = len(index.centroids)
    if s.target_recall >= 1 or len(points) < 2:
        return lists
    bare, some = points[:, :-1], rng.choice(len(points), min(200, len(points)), replace=False)
    score = bare[some] @ bare.T
    score[np.arange(len(some)), some] = -np.inf
    k = min(s.k, len(points) - 1)
    near = np.argpartition(-score, k - 1, axis=1)[:, :k]
    home = np.concatenate([np.argmin(index.distances(part), axis=1) for part in np.array_split(points, max(1, len(points) // 4096))])
    order = np.argsort(index.distances(index.lift(bare[some], query=True)), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None].repeat(len(some), 0), 1)
    needed = np.sort(np.take_along_axis(place, home[near], 1).ravel())
    return int(needed[math.ceil(s.target_recall * len(needed)) - 1]) + 1


def _reach(far: np.ndarray, probes: int, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``probes`` nearest lists by ``far``, and the next nearest until they hold ``least`` vectors: bounds and lists."""
    near = np.argmin(far, axis=1)[:, None] if probes == 1 else np.argpartition(far, probes - 1, axis=1)[:, :probes]
    reach = np.full(len(far), probes)
    short = np.flatnonzero(sizes[near].sum(axis=1) < least)
    order = np.argsort(far[short], axis=1)
    held = np.cumsum(sizes[order], axis=1)
    reach[short] = np.minimum((held < least).sum(axis=1) + 1, far.shape[1])
    bounds = np.concatenate([[0], np.cumsum(reach)])
    lists = np.empty(bounds[-1], dtype=np.int32)
    whole = np.ones(len(far), dtype=bool)
    whole[short] = False
    lists[(bounds[:-1][whole, None] + np.arange(probes)).ravel()] = near[whole].ravel()
    for row, few in zip(short, order, strict=True):
        lists[bounds[row] : bounds[row + 1]] = few[: reach[row]]
    return bounds, lists


def _near_lists(vectors: DataFrame, index: Index, probes: int, query: bool, sizes: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """Each vector with the ``probes`` nearest lists, and with more until they hold ``least`` vectors by ``sizes``."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)
    held = np.zeros(len(index.centroids), dtype=np.int64) if sizes is None else sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                far = ix.distances(ix.lift(matrix(part.column("vec")), query))
                bounds, near = _reach(far, probes, held, least)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(near))
                yield pa.RecordBatch.from_arrays([part.column("vkey"), part.column("vec"), lists], ["vkey", "vec", "lists"])

    return vectors.select("vkey", "vec").mapInArrow(run, "vkey long, vec array<double>, lists array<int>")


def scan(queries: np.ndarray, cell: np.ndarray, k: int, block: int, epsilon: float, inner: bool = False) -> np.ndarray:
    """Indices into ``cell`` of each query's k nearest found (-1: none), by the adaptive dimension scan.

    Both are rotated.  Nearest by distance, or with ``inner`` by largest inner product.  Vectors are ranked by
    |x|^2 - 2qx, or -2qx; from the k-th best of that follows the |q - x|^2 beyond which x is abandoned.
    The first ``head`` vectors are compared whole and give the first k-th best.
    """
    m, (n, dims) = len(queries), cell.shape
    head = min(n, max(4 * k, 128))
    norm_q, norm_x = np.einsum("ij,ij->i", queries, queries), np.einsum("ij,ij->i", cell, cell)
    own = np.zeros_like(norm_x) if inner else norm_x
    far = own[:head] - 2 * queries @ cell[:head].T
    best_at = np.tile(np.arange(head), (m, 1))
    best, best_at = _least(far, best_at, k)
    ends = [*range(block, dims, block), dims]
    for lo in range(head, n, 512):
        part = cell[lo : lo + 512]
        worst = best.max(axis=1) if best.shape[1] == k else np.full(m, np.inf)
        q = np.repeat(np.arange(m), len(part))
        x = np.tile(np.arange(len(part)), m)
        so_far, begin = None, 0
        for end in ends:
            if so_far is None:
                a, b = queries[:, :end], part[:, :end]
                so_far = (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b) - 2 * a @ b.T).ravel()
            else:
                gap = queries[q, begin:end] - part[x, begin:end]
                so_far = so_far + np.einsum("ij,ij->i", gap, gap)
            limit = worst[q] + norm_q[q] + (norm_x - own)[lo + x]
            if end < dims:
                limit = limit * ((1 + epsilon / math.sqrt(end)) ** 2 * end / dims)
            # the second term is beyond the rounding error of so_far
            alive = so_far <= limit + 1e-6 * (norm_q[q] + norm_x[lo + x])
            q, x, so_far, begin = q[alive], x[alive], so_far[alive], end
            if len(q) == 0:
                break
        if len(q):
            rows, slot = np.unique(q, return_inverse=True)
            wide = np.full((len(rows), len(part)), np.inf, dtype=best.dtype)
            wide[slot, x] = own[lo + x] - 2 * np.einsum("ij,ij->i", queries[q], part[x])
            at = np.broadcast_to(np.arange(lo, lo + len(part)), wide.shape)
            merged, merged_at = np.concatenate([best[rows], wide], axis=1), np.concatenate([best_at[rows], at], axis=1)
            least, least_at = _least(merged, merged_at, k)
            if best.shape[1] < k:  # a cell with fewer than k vectors in its head has no rest
                raise AssertionError("the head holds at least k vectors where there is a rest")
            best[rows], best_at[rows] = least, least_at
    return best_at


def _least(far: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if far.shape[1] <= k:
        return far.copy(), at.copy()
    pick = np.argpartition(far, k - 1, axis=1)[:, :k]
    return np.take_along_axis(far, pick, 1), np.take_along_axis(at, pick, 1)


def _search(cells: DataFrame, index: Index, s: Settings) -> DataFrame:
    """Rows (cell, kind, vkey, vec), sorted by cell and kind: a cell's vectors (0), then its queries (1)."""
    shared = cells.sparkSession.sparkContext.broadcast(index)
    k = s.k + 1  # the query's own vector may be among them

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, held, parts, ready = shared.value, None, [], None
        for batch in batches:
            cell, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((cell[1:] != cell[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *edges], [*edges, len(cell)], strict=True):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if cell[lo] != held:
                    held, parts, ready = cell[lo], [], None
                if kind[lo] == 0:
                    parts.append((part.column("vkey").to_numpy(), matrix(part.column("vec"))))
                    continue
                if not parts:
                    continue
                if ready is None:
                    keys, vectors = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                    order = np.argsort(keys)
                    keys, vectors = keys[order], vectors[order]
                    ready = keys, vectors, vectors @ ix.rotation
                keys, vectors, rotated = ready
                for at in range(0, part.num_rows, 256):
                    few = part.slice(at, 256)
                    names, asked = few.column("vkey").to_numpy(), matrix(few.column("vec"))
                    found = scan(asked @ ix.rotation, rotated, k, s.block, s.epsilon, inner=True)
                    score = np.einsum("ij,ikj->ik", asked, vectors[found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(names, found.shape[1])), pa.array(keys[found].ravel()), pa.array(score.ravel())],
                        ["qkey", "vkey", "score"])

    ordered = cells.repartition("cell").sortWithinPartitions("cell", "kind")
    return ordered.mapInArrow(run, "qkey long, vkey long, score double")


def nearest(embeddings: DataFrame, is_query: Column, s: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for every row of (vec_id, embedding) that ``is_query`` marks."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"),
                             F.coalesce(is_query, F.lit(False)).alias("asks")).where(F.col("vec_id").isNotNull() & usable("vec"))
    size = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vec") == size["size"]).withColumn("vkey", F.xxhash64("vec"))
    by_vector = Window.partitionBy("vkey").orderBy("vec_id")
    few = rows.select("vkey", "vec", "vec_id").distinct().withColumn("nth", F.row_number().over(by_vector)).where(F.col("nth") <= s.k + 1)
    square = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    # a vector's smallest ids (k + 1 at most) as one row
    vectors = cut(few.groupBy("vkey").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
                  .withColumn("square", square))
    about = vectors.agg(F.count("*").alias("n"), F.max("square").alias("longest2")).first()
    index = fit(vectors, about["n"], about["longest2"], s)

    listed = cut(_near_lists(vectors, index, 1, query=False).select("vkey", "vec", F.col("lists")[0].alias("list")))
    counts = cut(listed.groupBy("list").count().withColumn(
        "cells", F.ceil(F.col("count") / s.cell_rows).cast("int")))  # at most max_lists rows
    sizes = np.zeros(len(index.centroids), dtype=np.int64)
    for r in counts.collect():
        sizes[r["list"]] = r["count"]
    asked = vectors.join(rows.where("asks").select("vkey").distinct(), "vkey", "left_semi")
    asked = cut(_near_lists(asked, index, index.probes, True, sizes, s.k + 1))
    asking = asked.select(F.explode("lists").alias("list")).groupBy("list").agg(
        F.ceil(F.count(F.lit(1)) / s.slice_rows).cast("int").alias("slices"))  # at most max_lists rows, as counts
    dealt = F.broadcast(counts.join(asking, "list"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cell = (F.col("list").cast("long") * (1 << 50) + F.col("part").cast("long") * (1 << 20) + F.col("slice")).alias("cell")
    held = (listed.join(dealt, "list").withColumn("part", F.pmod(F.xxhash64("vkey", F.lit(1)), F.col("cells")))
            .withColumn("slice", upto("slices")).select(cell, F.lit(0).alias("kind"), "vkey", "vec"))
    probing = (asked.select("vkey", "vec", F.explode("lists").alias("list")).join(dealt, "list")
               .withColumn("slice", F.pmod(F.xxhash64("vkey", F.lit(2)), F.col("slices"))).withColumn("part", upto("cells"))
               .select(cell, F.lit(1).alias("kind"), "vkey", "vec"))
    found = _search(held.unionByName(probing), index, s)

    best = Window.partitionBy("qkey").orderBy(F.desc("score"))
    # k + 1 vectors hold the k + 1 best rows, except that equal scores are told by id only below
    found = found.withColumn("nth", F.rank().over(best)).where(F.col("nth") <= s.k + 1)
    by_id = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    named = (found.join(vectors.select("vkey", "ids"), "vkey").select("qkey", "score", F.explode("ids").alias("vec_id"))
             .withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= s.k + 1))
    answers = named.groupBy("qkey").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("vkey").alias("qkey")).distinct()
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, s.k)
    return (asking.join(answers, "qkey").select("query_id", F.posexplode(others).alias("pos", "hit"))
            .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                    F.col("hit.score").alias("score")))
