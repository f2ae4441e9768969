"""Centroid clustering in exact integers; nearest centroids by a threshold algorithm.

Lloyd rounds over whole numbers. For every dimension the centroids stand in a list
sorted by their value there. A vector walks all lists outward from its own values at
once; each centroid it meets is measured exactly. A centroid not met so far is at
least as far away, in every dimension, as that list's frontier, so the walk ends as
soon as the sum of the squared frontier distances strictly exceeds the best distance
(or every centroid has been met). Only equal distances make it go on, because then an
unmet centroid with a smaller number could still win.

A round sends one row of sums for each centroid and task; the driver holds the
centroids alone (``k`` vectors), never vectors of the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

SCALE = 1024
LIMIT = 1 << 27  # scaled components are held within this bound, so that a squared distance fits a long
BLOCK = 1 << 18  # vector-centroid cells that one numpy step looks at
FAR = np.int64(1) << np.int64(60)


class SortedLists:
    """The centroids, and for every dimension their values in ascending order with their numbers."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, dtype=np.int64)
        self.numbers = np.argsort(self.centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(self.centroids.T, self.numbers, axis=1)


def nearest(vectors: np.ndarray, lists: SortedLists) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of every vector's nearest centroid; of equally near ones the smaller number."""
    k = len(lists.centroids)
    step = max(1, BLOCK // max(k, vectors.shape[1]))
    parts = [_walk(vectors[at : at + step], lists) for at in range(0, len(vectors), step)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _walk(vectors: np.ndarray, lists: SortedLists) -> tuple[np.ndarray, np.ndarray]:
    (n, dims), k = vectors.shape, len(lists.centroids)
    number, best = np.full(n, k), np.full(n, np.iinfo(np.int64).max)
    met = np.zeros((n, k), dtype=bool)
    above = np.stack([np.searchsorted(lists.values[d], vectors[:, d]) for d in range(dims)], axis=1)
    below = above - 1
    dim, active = np.arange(dims), np.arange(n)
    for _ in range(k):
        x, low, high = vectors[active], below[active], above[active]
        down = np.where(low >= 0, x - lists.values[dim, np.maximum(low, 0)], FAR)
        up = np.where(high < k, lists.values[dim, np.minimum(high, k - 1)] - x, FAR)
        left = down <= up
        found = lists.numbers[dim, np.where(left, low, high)]
        below[active], above[active] = low - left, high + ~left
        fresh = np.zeros((len(active), k), dtype=bool)
        fresh[np.arange(len(active))[:, None], found] = True
        fresh &= ~met[active]
        met[active] |= fresh
        row, centroid = np.nonzero(fresh)
        distance = ((x[row] - lists.centroids[centroid]) ** 2).sum(axis=1)
        order = np.lexsort((centroid, distance, row))
        row, first = np.unique(row[order], return_index=True)
        centroid, distance, spot = centroid[order][first], distance[order][first], active[row]
        closer = (distance < best[spot]) | ((distance == best[spot]) & (centroid < number[spot]))
        number[spot[closer]], best[spot[closer]] = centroid[closer], distance[closer]
        frontier = (np.minimum(down, up) ** 2).sum(axis=1)
        active = active[(frontier <= best[active]) & ~met[active].all(axis=1)]
        if not len(active):
            break
    return number, best


def whole_vectors(df: DataFrame, dims: int) -> DataFrame:
    """``vec_id, v``: vectors of exactly ``dims`` finite components, as whole numbers ``floor(1024 * x)``."""
    usable = (F.size("embedding") == dims) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))

    def scaled(x: Column) -> Column:
        held = F.least(F.greatest(x.cast("double") * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))
        return F.floor(held).cast("long")

    kept = df.select("vec_id", "embedding").where(F.col("embedding").isNotNull()).where(usable)
    return kept.select("vec_id", F.transform("embedding", scaled).alias("v"))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dims)


def _sums(centroids: list[list[int]], dims: int):
    """Count and sum of each centroid's vectors, one row for each centroid and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch, dims)
                number, _ = nearest(vectors, lists)
                count += np.bincount(number, minlength=len(count))
                np.add.at(total, number, vectors)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(count[held]), pa.array(list(total[held]), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    return run


def _places(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_matrix(batch, dims), lists)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return run


def start(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The ``k`` vectors with the smallest hash of ``salt`` and their id, by hash, then by components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r["v"]) for r in vectors.withColumn("_key", key).orderBy("_key", "v").limit(k).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]], dims: int) -> list[list[int]]:
    """The centroids after one round: floors of the means of their vectors; those without vectors stay."""
    sums = vectors.select("v").mapInArrow(_sums(centroids, dims), "cluster int, n long, total array<long>")
    totals = [F.sum(F.col("total")[d]).alias(f"t{d}") for d in range(dims)]
    after = [list(c) for c in centroids]
    for row in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *totals).collect():  # k rows at most
        after[row["cluster"]] = [row[f"t{d}"] // row["n"] for d in range(dims)]
    return after


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, salt: str = "3:") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every usable vector.

    Takes ``vec_id`` and ``embedding`` (an array of numbers); other columns are ignored. Vectors
    that are null, have another length, or hold null or non-finite components are left out.
    Components are taken as ``floor(1024 * x)``, held within 2**27 either way. Ties go to the
    smaller centroid number. Repeated rows count as often as they stand; rows that share an id
    (or have none, which hashes like an empty one) start in the order of their components. With
    fewer than ``k`` vectors there are that many centroids; an empty table gives an empty result.
    Rows are of fixed length, so no row needs more memory than another.
    """
    vectors = common.stored(whole_vectors(df, dims), "whole-vectors")
    centroids = start(vectors, k, salt)
    for _ in range(rounds if centroids else 0):
        after = moved(vectors, centroids, dims)
        if after == centroids:  # no later round changes anything
            break
        centroids = after
    placed = common.stored(
        vectors.mapInArrow(_places(centroids, dims), "vec_id long, cluster int, distance long")
        if centroids else vectors.selectExpr("vec_id", "0 as cluster", "0L as distance"), "placed-vectors")
    within = {r["cluster"]: r["inertia"] for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    each = F.array(*(F.lit(int(within.get(c, 0))).try_cast("long") for c in range(len(centroids))))
    named = F.array(*(F.lit(m) for m in marks))
    if not centroids:
        each, named = F.array().cast("array<long>"), F.array().cast("array<string>")
    return placed.select(
        "vec_id", "cluster", "distance", F.get(each, "cluster").alias("cluster_inertia"),
        F.lit(int(sum(within.values()))).try_cast("long").alias("inertia"), F.get(named, "cluster").alias("centroid_sha256"))
