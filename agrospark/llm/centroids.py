"""Centroid clustering with equal-average equal-variance nearest-neighbour search.

Vectors become integers, so every sum and squared distance is exact. For vectors x, c of K components with component
sums S and scaled deviations V = sqrt(K * sum(x^2) - S^2), K * |x - c|^2 >= (S_x - S_c)^2 + (V_x - V_c)^2. Centroids are
sorted by S (their mean); each vector starts at its own mean and scans outward in both directions. The mean term alone ends a
direction, both terms together spare a centroid, and only what is left is measured in full. V is
irrational: the bound uses whole numbers below and above it, so nothing is rejected by rounding. A bound that
equals the best distance does not reject, since a tie goes to the smaller centroid number.

A round is one pass over the vectors: a task assigns its Arrow batches and gives back k sums of its own, so at most k rows a
task are shuffled whatever the skew. The k centroids (k * K integers, both parameters) are the only thing that
passes through the driver.

Defined results: vectors that are null, have another number of components, or hold a null or a non-finite component are left out;
integers beyond 2^24 in size count as that bound, so that all products fit 64 bits; a null id counts as empty text in the
starting order, equal ids are ordered by their components; repeated rows are vectors of their own; fewer vectors than k give
as many centroids; a sum of distances beyond 64 bits is null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrospark.llm.common import ship, written

#: largest size of an integer component
LARGEST = 1 << 24
#: vectors that are measured at once; bounds a task's memory
AT_ONCE = 4096


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, size: int, scale: int) -> DataFrame:
    """``id, v``: the vectors that count, as arrays of integers floor(scale * x)."""
    x = F.col(vec_col).cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(math.inf))
    whole = lambda e: F.floor(F.greatest(F.least(e * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")
    kept = rows.select(F.col(id_col).alias("id"), x.alias("x")).filter((F.size("x") == size) & F.forall("x", finite))
    return kept.select("id", F.transform("x", whole).alias("v"))


def first_centroids(vecs: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors of smallest SHA-256 of ``<seed>:<id>``, in that order."""
    h = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = vecs.select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()      # k rows, a parameter
    return np.array([r["v"] for r in rows], np.int64)


class Search:
    """Nearest centroid of whole batches, with the counts of what was rejected."""

    def __init__(self, centroids: np.ndarray):
        c = np.asarray(centroids, np.int64)
        sums = c.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")                 # position in mean order -> centroid number
        self.c, self.s = c[self.order], sums[self.order]
        self.low, self.high = self._deviation(self.c, self.s)
        self.measured = self.by_mean = self.by_deviation = 0

    @staticmethod
    def _deviation(x: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whole numbers at most and at least sqrt(K * sum(x^2) - S^2)."""
        square = x.shape[1] * (x * x).sum(axis=1) - s * s
        root = np.floor(np.sqrt(square.astype(np.float64))).astype(np.int64)
        root -= root * root > square
        root += (root + 1) * (root + 1) <= square
        return root, root + (root * root < square)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) per row of ``x``."""
        n, size = x.shape
        k = len(self.c)
        s = x.sum(axis=1)
        low, high = self._deviation(x, s)
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.full(n, k)
        left = np.searchsorted(self.s, s) - 1                        # next centroid to look at on either side
        right = left + 1
        todo = np.arange(n)
        while len(todo):
            # the side whose mean is nearer; a side is over at the end of the list
            a, b = left[todo], right[todo]
            gap_a = np.where(a >= 0, s[todo] - self.s[np.maximum(a, 0)], np.iinfo(np.int64).max)
            gap_b = np.where(b < k, self.s[np.minimum(b, k - 1)] - s[todo], np.iinfo(np.int64).max)
            take_left = gap_a <= gap_b
            at = np.where(take_left, a, b)
            gap = np.where(take_left, gap_a, gap_b)
            # means farther out are farther still: the vector is done when the nearer side is over or rejected
            bound = np.where(best[todo] == np.iinfo(np.int64).max, best[todo], best[todo] * size)
            open_ = (gap != np.iinfo(np.int64).max)
            gap = np.where(open_, gap, 0)
            far = open_ & (gap * gap > bound)
            self.by_mean += int(far.sum())
            go = open_ & ~far
            todo, at, gap, bound, take_left = todo[go], at[go], gap[go], bound[go], take_left[go]
            left[todo[take_left]] -= 1
            right[todo[~take_left]] += 1
            apart = np.maximum(np.maximum(low[todo] - self.high[at], self.low[at] - high[todo]), 0)
            near = gap * gap + apart * apart <= bound
            self.by_deviation += int((~near).sum())
            rows, c = todo[near], at[near]
            self.measured += len(rows)
            d = x[rows] - self.c[c]
            d = np.einsum("ij,ij->i", d, d)
            number = self.order[c]
            better = (d < best[rows]) | ((d == best[rows]) & (number < who[rows]))
            best[rows[better]], who[rows[better]] = d[better], number[better]
        return who, best


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, AT_ONCE):
            yield b.slice(at, AT_ONCE)


def _sums(vecs: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, sums of their components) per centroid."""
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, count, total = Search(centroids), np.zeros(k, np.int64), np.zeros((k, size), np.int64)
        for b in _pieces(batches):
            x = _matrix(b.column("v"), size)
            who, _ = search.nearest(x)
            count += np.bincount(who, minlength=k)
            one = np.zeros((len(who), k))
            one[np.arange(len(who)), who] = 1
            total += (one.T @ x.astype(np.float64)).astype(np.int64)          # exact: AT_ONCE * LARGEST < 2^53
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    part = vecs.select("v").mapInArrow(run, "cluster int, n long, total array<long>")
    got = part.select("cluster", F.posexplode(F.concat(F.array("n"), "total")).alias("at", "x")).groupBy("cluster", "at").agg(F.sum("x").alias("x"))
    table = np.zeros((k, size + 1), np.int64)
    for r in got.collect():                                           # k * (components + 1) rows at most
        table[r["cluster"], r["at"]] = r["x"]
    return table[:, 0], table[:, 1:]


def _assigned(vecs: DataFrame, centroids: np.ndarray) -> DataFrame:
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        for b in _pieces(batches):
            who, d = search.nearest(_matrix(b.column("v"), size))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(who.astype(np.int32)), pa.array(d)], names=["id", "cluster", "distance"])

    return vecs.mapInArrow(run, f"id {vecs.schema['id'].dataType.simpleString()}, cluster int, distance long")


def centroid_clusters(rows: DataFrame, k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, seed: str = "2",
                      id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``(assigned, centroids)``: per vector ``id, cluster, distance, cluster_inertia, inertia`` and the final k x size integers."""
    ship(rows.sparkSession)
    vecs = written(whole_vectors(rows, id_col, vec_col, size, scale), "vectors")
    centroids = first_centroids(vecs, k, seed)
    if not len(centroids):
        none = vecs.select("id", F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return none, np.zeros((0, size), np.int64)
    for _ in range(rounds):
        n, total = _sums(vecs, centroids)
        centroids = np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], centroids)      # // rounds down
    got = written(_assigned(vecs, centroids), "assigned")
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = got.groupBy("cluster").agg(total.alias("d"))                                     # at most k rows
    per = per.crossJoin(F.broadcast(got.agg(total.alias("all"))))
    per = per.select("cluster", F.col("d").try_cast("long").alias("cluster_inertia"), F.col("all").try_cast("long").alias("inertia"))
    return got.join(F.broadcast(per), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia"), centroids


def digest_of(centroids: np.ndarray, cluster: str = "cluster") -> Column:
    """SHA-256 of a row's final centroid: its components as decimal integers, joined by commas."""
    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return F.element_at(F.array(*[F.lit(x) for x in shas]) if shas else F.array(F.lit("")), F.col(cluster) + 1)
