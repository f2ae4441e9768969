"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in features of its text: how often byte pairs occur,
hashed into buckets, and shares of byte classes. All pairs of a good and a bad labelled
document are fitted by logistic loss on the difference of their features, in tasks that
add up what the rounds need. The strength at the quantile that the bad documents make up
becomes the threshold, to which the score 0.3 is fixed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

BUCKETS = 512
BLOCK = 1 << 18  # bytes that are counted in one step
THRESHOLD = 0.3
ROUNDS, RIDGE = 6, 0.01
BINS, REACH = 1024, 16.0  # of the strengths that a row meets in a gradient
ROWS = 16384  # rows of a task that adds up, at least about

_PAIR = ((np.arange(65536, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 9)).astype(np.int64)
_CLASS = np.full(256, 5, dtype=np.int64)  # other punctuation
_CLASS[:33] = 0
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[97:123] = 3
_CLASS[128:] = 4
CLASSES = 6
WIDTH = BUCKETS + CLASSES * CLASSES + 2


def features(texts: pa.Array) -> np.ndarray:
    """One row of features for each text; null and empty texts have zeros."""
    raw, ends = common.text_bytes(texts)
    size = np.diff(ends)
    rows = len(size)
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    counts, kinds = np.zeros(rows * BUCKETS, np.int64), np.zeros(rows * CLASSES**2, np.int64)
    for at in range(0, len(raw) - 1, BLOCK):  # pairs that begin in a block
        first, second = raw[at : min(at + BLOCK, len(raw) - 1)].astype(np.int64), raw[at + 1 : at + 1 + BLOCK].astype(np.int64)
        place = np.arange(at, at + len(first))
        owner = np.searchsorted(ends, place, side="right") - 1
        inside = place + 1 < ends[owner + 1]
        owner, first, second = owner[inside], first[inside], second[inside]
        low, high = (owner[0], owner[-1] + 1) if len(owner) else (0, 0)
        near = owner - low
        counts[low * BUCKETS : high * BUCKETS] += np.bincount(
            near * BUCKETS + _PAIR[first * 256 + second], minlength=(high - low) * BUCKETS)
        kinds[low * CLASSES**2 : high * CLASSES**2] += np.bincount(
            near * CLASSES**2 + _CLASS[first] * CLASSES + _CLASS[second], minlength=(high - low) * CLASSES**2)
    total = np.maximum(size - 1, 1)[:, None]
    out[:, :BUCKETS] = np.sqrt(counts.reshape(rows, BUCKETS) / total)
    out[:, BUCKETS:-2] = np.sqrt(kinds.reshape(rows, CLASSES**2) / total)
    out[:, -2] = np.log1p(size) / 10
    out[:, -1] = (counts.reshape(rows, BUCKETS) > 0).mean(axis=1)
    return out


@dataclass
class Ranker:
    weights: np.ndarray
    threshold: float  # the strength that has score 0.3
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.scale:
            return np.full(len(x), 0.5)
        at = np.clip((x @ self.weights - self.threshold) / self.scale, -30, 30)
        return 1 / (1 + np.exp(-(at + np.log(THRESHOLD / (1 - THRESHOLD)))))


def _grams(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Counts, sums and products of the features of bad (0) and of good (1) rows."""
    whole = np.column_stack([np.ones(len(x)), x])
    return np.stack([whole[good == kind].T @ whole[good == kind] for kind in (False, True)])


def _places(strength: Callable[[np.ndarray], np.ndarray], edges: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """How many bad and good rows have their strength in each bin; rows beyond the edges are left out."""
    def part(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        at = np.searchsorted(edges, strength(x), side="right") - 1
        inside = (at >= 0) & (at < len(edges) - 1)
        return np.stack([np.bincount(at[inside & (good == kind)], minlength=len(edges) - 1) for kind in (False, True)])

    return part


def _pulls(strength: Callable[[np.ndarray], np.ndarray], middles: np.ndarray, beaten: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Features of bad and of good rows, each times the share of the other kind's rows that it stands wrongly to."""
    def part(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        at = strength(x)
        return np.stack([np.interp(at[good == kind], middles, beaten[int(kind)]) @ x[good == kind] for kind in (False, True)])

    return part


def _extremes(strength: Callable[[np.ndarray], np.ndarray], beyond: float = -np.inf) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Smallest strength above ``beyond`` and largest of all, the latter negated: both are minima."""
    def part(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        at = strength(x)
        return np.array([at[at > beyond].min(initial=np.inf), -at.max(initial=-np.inf)])

    return part


def _quantile(total: Callable, strength: Callable[[np.ndarray], np.ndarray], shares: np.ndarray, wanted: float) -> float:
    """Midway between the strength up to which rows make up the share ``wanted`` and the next larger one.

    ``shares`` is what a bad and a good row count. The bin that holds the strength is cut again
    until it is as narrow as numbers allow.
    """
    low, high = total(_extremes(strength), np.minimum) * (1, -1)
    high, below = np.nextafter(high, np.inf), 0.0
    while True:
        edges = np.unique(np.linspace(low, high, BINS + 1))
        sums = below + np.cumsum(shares @ total(_places(strength, edges)))
        at = min(int(np.searchsorted(sums, wanted * (1 - 1e-9))), len(sums) - 1)
        below = sums[at - 1] if at else below
        if edges[at + 1] - edges[at] <= 1e-12 * max(1.0, abs(high)) or len(edges) == 2:
            break
        low, high = edges[at], edges[at + 1]
    above = total(_extremes(strength, edges[at + 1]), np.minimum)[0]
    return float((edges[at] + above) / 2) if np.isfinite(above) else float(edges[at])


def _learn(total: Callable, bad_share: float | None = None) -> Ranker:
    """Fit strengths on all pairs of a good and a bad row; without both kinds every score is 0.5.

    ``total(part, add)`` puts ``part(x, good)`` of all blocks of rows together, so no row leaves its task. The
    curvature of the loss is at most a quarter of the pairs' mean product of differences, which the
    products of both kinds give, so a step against it never overshoots. In a gradient every row
    meets the other kind's strengths in bins.
    """
    grams = total(_grams)
    count = grams[:, 0, 0]
    if not count.all():
        return Ranker(np.zeros(WIDTH), 0.0, 0.0)
    means, products = grams[:, 0, 1:] / count[:, None], grams[:, 1:, 1:] / count[:, None, None]
    center = grams[:, 0, 1:].sum(axis=0) / count.sum()
    variance = grams[:, 1:, 1:].diagonal(axis1=1, axis2=2).sum(axis=0) / count.sum() - center**2
    spread = np.sqrt(np.maximum(variance, 0)) + 1e-3
    cross = np.outer(means[0], means[1])
    apart = (products.sum(axis=0) - cross - cross.T) / np.outer(spread, spread)
    bound = apart / 4 + RIDGE * np.eye(WIDTH)
    edges = np.linspace(-REACH, REACH, BINS + 1)
    middles = (edges[1:] + edges[:-1]) / 2
    wins = 1 / (1 + np.exp(np.clip(middles[:, None] - middles, -30, 30)))  # of the second over the first
    weights = np.zeros(WIDTH)
    for _ in range(ROUNDS):
        strength = _strength(weights / spread, center)
        held = total(_places(lambda x: np.clip(strength(x), -REACH, np.nextafter(REACH, 0)), edges)) / count[:, None]
        # a bad row is wrong where it beats good ones, a good row where bad ones beat it
        pulls = total(_pulls(strength, middles, np.einsum("ka,kab->kb", held[::-1], np.stack([wins, wins.T])))) / count[:, None]
        gradient = (pulls[0] - pulls[1]) / spread + RIDGE * weights
        weights -= _solved(bound, gradient)
    strength = _strength(weights / spread, center)
    if bad_share is None:
        bad_share = count[0] / count.sum()
    # the rows hold both labels in other shares than all labels: weight them back
    threshold = _quantile(total, strength, np.array([bad_share, 1 - bad_share]) / count, bad_share)
    scaled = weights / spread
    pooled = np.einsum("k,kab,a,b->", count / count.sum(), products, scaled, scaled) - float((center * scaled).sum()) ** 2
    return Ranker(scaled, float(threshold + (center * scaled).sum()), max(float(pooled), 0.0) ** 0.5 or 1e-6)


def _solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a positive definite system by conjugate gradients."""
    out, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), float((rest * rest).sum())
    for _ in range(4 * len(right)):
        if size <= 1e-20 * float((right * right).sum()):
            break
        turned = np.einsum("ab,b->a", matrix, way)
        step = size / float((way * turned).sum())
        out, rest = out + step * way, rest - step * turned
        size, before = float((rest * rest).sum()), size
        way = rest + size / before * way
    return out


def _strength(weights: np.ndarray, center: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda x: (x - center) @ weights


def train(x: np.ndarray, good: np.ndarray, bad_share: float) -> Ranker:
    """Fit on rows in memory."""
    return _learn(lambda part, add=np.add: part(x, good), bad_share)


def _features():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", 1 << 20):
            x = features(batch.column("text")).astype(np.float16)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([row.tobytes() for row in x], pa.binary())], names=["doc_id", "x"])

    return run


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of a batch, 512 rows at a time."""
    for at in range(0, batch.num_rows, 512):
        part = batch.slice(at, 512)
        x = np.frombuffer(b"".join(part.column("x").to_pylist()), np.float16).reshape(-1, WIDTH)
        yield x.astype(np.float64), part.column("quality").to_numpy() == 1


def _partial(part: Callable[[np.ndarray, np.ndarray], np.ndarray], add: np.ufunc, pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for x, good in _blocks(batch):
                sums = part(x, good) if sums is None else add(sums, part(x, good))
        if sums is not None:
            cut = np.array_split(np.asarray(sums, np.float64).ravel(), pieces)
            yield pa.RecordBatch.from_arrays([pa.array(range(pieces), pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary())], names=["piece", "sums"])

    return run


def _totals(rows: DataFrame) -> Callable:
    """The ``total`` of ``_learn`` over ``rows(x, quality)``: tasks add their rows up.

    Long sums of many tasks are added by tasks again, a piece each; short ones, of some KB a task, by the driver.
    """
    def total(part: Callable[[np.ndarray, np.ndarray], np.ndarray], add: np.ufunc = np.add) -> np.ndarray:
        like = part(np.zeros((0, WIDTH)), np.zeros(0, dtype=bool))
        pieces = -(-like.size // 65536)
        sums = common.in_workers(rows, _partial(part, add, pieces), "piece int, sums binary")
        if pieces > 1:
            sums = sums.groupBy("piece").applyInArrow(_added, "piece int, sums binary")
        out = [np.zeros(0)] * pieces
        for row in sums.toLocalIterator() if pieces > 1 else sums.collect():
            own = np.frombuffer(row["sums"])
            out[row["piece"]] = add(out[row["piece"]], own) if len(out[row["piece"]]) else own
        return np.concatenate(out).reshape(like.shape)

    return total


def _added(group: pa.Table) -> pa.Table:
    sums = sum(np.frombuffer(value) for value in group.column("sums").to_pylist())
    return pa.table({"piece": group.column("piece").slice(0, 1).combine_chunks(), "sums": pa.array([sums.tobytes()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Fit on all texts of ``docs(doc_id, text)`` that ``labels(doc_id, quality)`` marks 1 or 0.

    Rows that repeat id, text and label count once; the labels' shares are counted over all of ``labels``. Features
    are stored once, at two bytes each, and read again by every round; only sums reach the driver.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").select("doc_id", F.col("quality").cast("int"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return Ranker(np.zeros(WIDTH), 0.0, 0.0)
    found = common.in_workers(docs.where("doc_id is not null").select("doc_id", "text"), _features(), "doc_id long, x binary")
    # features are shuffled in place of texts, which are longer
    rows = found.join(known.distinct(), "doc_id").dropDuplicates(["doc_id", "x", "quality"]).select("x", "quality")
    rows = common.stored(rows, "quality-features")
    size = rows.groupBy("quality").count().collect()
    if len(size) < 2:
        return Ranker(np.zeros(WIDTH), 0.0, 0.0)
    tasks = -(-sum(r["count"] for r in size) // ROWS)
    ranker = _learn(_totals(rows.coalesce(tasks)), counts[0] / sum(counts.values()))
    common.forget(rows)
    return ranker


def _scores(ranker: Ranker, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.chunks(batches, "text", 1 << 20):
            score = ranker.score(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array(score)], names=[*keep, "quality_score"])

    return run


def score(docs: DataFrame, ranker: Ranker, keep: list[str]) -> DataFrame:
    """``docs`` reduced to ``keep``, with ``quality_score`` from 0 to 1; good ones have 0.3 or more.

    Only the text counts, so repeated rows agree; null and empty texts are scored like
    any text, from zero features; columns not in ``keep`` are ignored; an empty table
    gives an empty result. A score of exactly 0.3 is good. A very long text is counted in blocks, so
    it needs little more than its own bytes in one worker.
    """
    names = [f.name for f in docs.schema if f.name in keep]
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    wanted = list(dict.fromkeys([*names, "text"]))
    return common.in_workers(docs.select(*wanted), _scores(ranker, names), f"{spec}, quality_score double")
