"""Language identification by a byte convolutional network trained in numpy.

The network reads windows of ``WINDOW`` bytes: an embedding of every byte, filters of
several widths at every second byte, maximum over the window, softmax. A text's
language is that of the mean logits of all its windows, so whole texts count. The
trained filters are folded into one table for the first and one for the last two bytes
of a filter, so applying them is two look-ups, an addition and a maximum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import common

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # for each width
EMBEDDING = 8
SPAN, STRIDE = 4, 2
UNKNOWN = "und"
STEPS, BATCH, RATE = 500, 96, 0.01
ROUNDS, TASK_ROWS = 4, 9600  # after which tasks' parameters are averaged; texts of a task, at least about
DEVIATIONS = 6  # by which the bytes of a short text may be less usual than those of a long one
MARGIN = 9  # deviations of a language's long texts from their mean that other texts may be off
TRAINED_ROWS, TRAINED_BYTES = 10_000, 64 << 20  # texts that a task draws its windows from at once, at most about
LONG = 256  # bytes of a text whose mean counts for its language
BLOCK = 1 << 18  # bytes that are looked up in one step


@dataclass
class Habits:
    """How usual byte pairs are in each learned language, to tell texts that are in none of them.

    ``usual`` holds, for every pair and language, the log-probability of the second byte after
    the first, less the lowest mean that texts of the language may have (``MARGIN`` deviations
    below the mean of its texts); ``spread`` is the deviation of one byte.
    """

    usual: np.ndarray  # (65536, languages)
    spread: np.ndarray

    def foreign(self, raw: np.ndarray, ends: np.ndarray, language: np.ndarray) -> np.ndarray:
        """Which rows' bytes are too unusual for their language; short rows need to be more so."""
        out = np.zeros(len(ends) - 1, dtype=bool)
        for row, own in enumerate(language):
            first, last = ends[row], ends[row + 1]
            total, n = 0.0, max(last - first - 1, 0)
            for at in range(first, last - 1, BLOCK):
                part = raw[at : min(at + BLOCK + 1, last)].astype(np.int32)
                total += float(self.usual[part[:-1] * 256 + part[1:], own].sum())
            out[row] = n > 0 and total < -DEVIATIONS * self.spread[own] * n**0.5
        return out


def _pairs(text: np.ndarray) -> np.ndarray:
    return text[:-1].astype(np.int32) * 256 + text[1:]


def _pair_counts(languages: list[str]):
    """Byte pairs of each language's texts, counted by tasks; only pairs that occur go on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 65536), np.int64)
        for batch in batches:
            raw, ends = common.text_bytes(batch.column("text"))
            for row, own in enumerate(batch.column("lang").to_pylist()):
                for at in range(ends[row], ends[row + 1] - 1, BLOCK):
                    counts[languages.index(own)] += np.bincount(_pairs(raw[at : min(at + BLOCK + 1, ends[row + 1])]), minlength=65536)
        own, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own, pa.int32()), pa.array(pair, pa.int32()), pa.array(counts[own, pair], pa.int64())], names=["own", "pair", "n"])

    return run


def _means(languages: list[str], tables: np.ndarray):
    """Each text's mean log-probability, and whether it is long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = common.text_bytes(batch.column("text"))
            own = np.array([languages.index(x) for x in batch.column("lang").to_pylist()])
            out = np.full(len(own), np.nan)
            for row in range(len(own)):
                total, n = 0.0, int(ends[row + 1] - ends[row]) - 1
                for at in range(ends[row], ends[row + 1] - 1, BLOCK):
                    total += float(tables[own[row]][_pairs(raw[at : min(at + BLOCK + 1, ends[row + 1])])].sum())
                out[row] = total / n if n > 0 else np.nan
            seen, size = ~np.isnan(out), np.diff(ends)
            yield pa.RecordBatch.from_arrays(
                [pa.array(own[seen], pa.int32()), pa.array(size[seen] > LONG), pa.array(out[seen])], names=["own", "long", "mean"])

    return run


def habits(rows: DataFrame, languages: list[str]) -> Habits:
    """Byte pairs of all texts of ``rows(text, lang)``, counted by tasks, and how much each language's texts differ."""
    usual, spread = np.zeros((65536, len(languages)), np.float32), np.zeros(len(languages))
    counts = np.zeros((len(languages), 65536), np.int64)
    pairs = common.in_workers(rows, _pair_counts(languages), "own int, pair int, n long")
    for r in pairs.groupBy("own", "pair").agg(F.sum("n").alias("n")).collect():
        counts[r["own"], r["pair"]] = r["n"]
    smooth = counts.reshape(-1, 256, 256) + 0.01
    tables = np.log(smooth / smooth.sum(axis=2, keepdims=True)).reshape(-1, 65536)
    found = common.in_workers(rows, _means(languages, tables), "own int, long boolean, mean double")
    found = {(r["own"], r["long"]): r for r in found.groupBy("own", "long").agg(F.avg("mean").alias("mean"), F.stddev_pop("mean").alias("off")).collect()}
    for i in range(len(languages)):
        each = found.get((i, True)) or found.get((i, False))
        if each is None:
            continue
        n, table = counts[i], tables[i]
        mean = (n * table).sum() / n.sum()
        usual[:, i] = table - (each["mean"] - MARGIN * each["off"])
        spread[i] = ((n * (table - mean) ** 2).sum() / n.sum()) ** 0.5
    return Habits(usual, spread)


@dataclass
class Network:
    languages: list[str]
    first: np.ndarray  # (65536, filters): first two bytes of a filter, bias included
    last: np.ndarray  # (65536, filters): its last two bytes
    weights: np.ndarray
    bias: np.ndarray
    habits: Habits | None = None

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Logits of windows of bytes, one row each."""
        out = np.empty((len(windows), len(self.languages)), dtype=np.float32)
        for at in range(0, len(windows), 128):
            pairs = np.ascontiguousarray(windows[at : at + 128]).view("<u2")
            found = self.first[pairs[:, :-1]]
            found += self.last[pairs[:, 1:]]
            out[at : at + 128] = np.maximum(found.max(axis=1), 0) @ self.weights + self.bias
        return out


def cut(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All windows of each row's bytes, the last one padded with 0, and their bounds by row."""
    bounds = np.concatenate(([0], np.cumsum(-(-np.diff(ends) // WINDOW))))
    out = np.zeros(bounds[-1] * WINDOW, dtype=np.uint8)
    for row in range(len(ends) - 1):
        at = bounds[row] * WINDOW
        out[at : at + ends[row + 1] - ends[row]] = raw[ends[row] : ends[row + 1]]
    return out.reshape(-1, WINDOW), bounds


def _start(languages: int, seed: int) -> list[np.ndarray]:
    """Parameters before the first step."""
    rng = np.random.default_rng(seed)
    filters = FILTERS * len(WIDTHS)
    embed = rng.normal(0, 0.3, (256, EMBEDDING))
    kernel = rng.normal(0, 0.3, (SPAN, EMBEDDING, filters)) * _used()[:, None, :]
    return [embed, kernel, np.zeros(filters), rng.normal(0, 0.2, (filters, languages)), np.zeros(languages)]


def _used() -> np.ndarray:
    """Which of its places a filter reads."""
    return np.array([[step < width for width in WIDTHS for _ in range(FILTERS)] for step in range(SPAN)], dtype=float)


class _Descent:
    """Parameters on their way down, by Adam."""

    def __init__(self, params: list[np.ndarray]) -> None:
        self.params, self.steps = list(params), 0
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def step(self, windows: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float) -> None:
        """One step on a batch of windows, of which each counts ``weight``."""
        self.steps += 1
        embed, kernel, offset, weights, bias = self.params
        size, filters, places = len(windows), FILTERS * len(WIDTHS), (WINDOW - SPAN) // STRIDE + 1
        flat = np.lib.stride_tricks.sliding_window_view(embed[windows], SPAN, axis=1)[:, ::STRIDE]
        flat = flat.transpose(0, 1, 3, 2).reshape(size * places, SPAN * EMBEDDING)
        raw = (flat @ kernel.reshape(-1, filters)).reshape(size, places, filters) + offset
        best = raw.argmax(axis=1)
        top = np.take_along_axis(raw, best[:, None], axis=1)[:, 0]
        hidden = np.maximum(top, 0)
        logits = hidden @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        error = odds / odds.sum(axis=1, keepdims=True)
        error[np.arange(size), target] -= 1
        error *= (weight / weight.sum())[:, None]
        back = (error @ weights.T) * (top > 0)
        rows, cols = np.repeat(np.arange(size), filters), np.tile(np.arange(filters), size)
        chosen = flat.reshape(size, places, -1)[rows, best.ravel()].reshape(size, filters, SPAN, EMBEDDING)
        d_kernel = np.einsum("bf,bfse->sef", back, chosen) * _used()[:, None, :]
        d_embed = np.zeros_like(embed)
        for s in range(SPAN):
            byte = windows[rows, best.ravel() * STRIDE + s]
            np.add.at(d_embed, byte, back.ravel()[:, None] * kernel[s][:, cols].T)
        for i, grad in enumerate((d_embed, d_kernel, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
            mean, square = self.moments[i]
            mean += 0.1 * (grad - mean)
            square += 0.01 * (grad * grad - square)
            self.params[i] = self.params[i] - rate * (mean / (1 - 0.9**self.steps)) / (np.sqrt(square / (1 - 0.99**self.steps)) + 1e-8)


def _folded(languages: list[str], params: list[np.ndarray]) -> Network:
    embed, kernel, offset, weights, bias = params
    filters, halves = FILTERS * len(WIDTHS), []
    for s in (0, 2):  # a little-endian pair is low byte + 256 * high byte
        low, high = embed @ kernel[s], embed @ kernel[s + 1]
        halves.append((high[:, None, :] + low[None, :, :]).reshape(65536, filters))
    return Network(languages, (halves[0] + offset).astype(np.float32), halves[1].astype(np.float32),
                   weights.astype(np.float32), bias.astype(np.float32))


def train(texts: list[str], labels: list[str], seed: int = 7) -> Network:
    """Fit the network on random windows of texts in memory, every language equally often."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    pools = [[t.encode() for t, own in zip(texts, labels) if own == language and t] for language in languages]
    known = [i for i, pool in enumerate(pools) if pool]
    down = _Descent(_start(len(languages), seed))
    for _ in range(STEPS if known else 0):
        target = np.array([known[i % len(known)] for i in range(BATCH)])
        picked = [pools[own][rng.integers(len(pools[own]))] for own in target]
        down.step(np.stack([_window(np.frombuffer(text, np.uint8), rng) for text in picked]), target, np.ones(BATCH), RATE)
    return _folded(languages, down.params)


def _window(text: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A window at a random place, padded with 0."""
    out = np.zeros(WINDOW, np.uint8)
    at = int(rng.integers(max(1, len(text) - WINDOW // 2)))
    part = text[at : at + WINDOW]
    out[: len(part)] = part
    return out


def _drawn_from(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], list[str]]]:
    """Texts and languages of so many rows at once, wherever batches end."""
    texts, own, size = [], [], 0
    for batch in batches:
        raw, ends = common.text_bytes(batch.column("text"))
        for row, name in enumerate(batch.column("lang").to_pylist()):
            texts.append(raw[ends[row] : ends[row + 1]])
            own.append(name)
            size += len(texts[-1])
            if len(texts) >= TRAINED_ROWS or size >= TRAINED_BYTES:
                yield texts, own
                texts, own, size = [], [], 0
    if texts:
        yield texts, own


def _descended(languages: list[str], params: list[np.ndarray], weights: np.ndarray, passes: int, round_: int):
    """A task's parameters after ``passes`` windows of each of its texts, from the common ones on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        down, seen = _Descent(params), 0
        for texts, names in _drawn_from(batches):
            own = np.array([languages.index(x) for x in names], dtype=np.int64)
            size = np.array([len(text) for text in texts])
            rng = np.random.default_rng([round_, len(own), int(size.sum())])
            for _ in range(passes):
                rows = rng.permutation(np.flatnonzero(size > 0))
                for some in np.array_split(rows, max(1, len(rows) // BATCH)):
                    if len(some):
                        windows = np.stack([_window(texts[r], rng) for r in some])
                        down.step(windows, own[some], weights[own[some]], RATE / (round_ + 1))
                        seen += len(some)
        if seen:
            flat = np.concatenate([p.ravel() for p in down.params]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([flat.tobytes()], pa.binary())], names=["seen", "params"])

    return run


def _apply(network: Network, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(network.languages, dtype=object)
        for batch in common.chunks(batches, "text", 1 << 20):
            raw, ends = common.text_bytes(batch.column("text"))
            windows, bounds = cut(raw, ends)
            sums = np.zeros((len(windows) + 1, len(names)))
            np.cumsum(network.logits(windows), axis=0, out=sums[1:])
            mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)[:, None]
            odds = np.exp(mean - mean.max(axis=1, keepdims=True))
            odds /= odds.sum(axis=1, keepdims=True)
            has = batch.column("_letter").to_numpy(zero_copy_only=False)
            lang = np.where(has, names[odds.argmax(axis=1)], UNKNOWN)
            foreign = network.habits.foreign(raw, ends, odds.argmax(axis=1)) if network.habits else ~has
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(lang, pa.string()),
                 pa.array(np.where(has, odds.max(axis=1), 0.0)), pa.array(foreign | ~has)],
                names=[*keep, "lang_pred", "lang_score", "lang_foreign"])

    return run


def fit(labelled: DataFrame) -> Network:
    """Train on all texts of ``labelled(text, lang)``, every language with the same weight.

    In each round every task descends from the common parameters through windows of all its texts, at
    random places, and the means of the tasks' parameters (by windows) are the next ones. Byte pairs are
    counted over whole texts. Parameters and counts of pairs are all that reaches the driver.
    """
    usable = labelled.where("lang is not null and text is not null").select("text", "lang")
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    languages = sorted(counts)
    params = _start(len(languages), seed=7)
    if languages:
        total = sum(counts.values())
        weights = np.array([total / counts[language] for language in languages])
        # tasks large enough for steps of their own
        dealt, passes = usable.coalesce(max(1, total // TASK_ROWS)), max(1, -(-TASK_ROWS // total))
        for round_ in range(ROUNDS):
            found = common.in_workers(dealt, _descended(languages, params, weights, passes, round_), "seen long, params binary").collect()
            if not found:
                break
            flat = sum(np.frombuffer(r["params"], np.float32) * float(r["seen"]) for r in found) / sum(r["seen"] for r in found)
            parts = np.split(flat, np.cumsum([p.size for p in params])[:-1])
            params = [part.reshape(p.shape) for part, p in zip(parts, params)]
    network = _folded(languages, params)
    network.habits = habits(usable, languages) if languages else None
    return network


def identify(docs: DataFrame, network: Network, keep: list[str]) -> DataFrame:
    """``docs`` reduced to ``keep``, with ``lang_pred``, ``lang_score`` and ``lang_foreign``.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if
    no language was learned. ``lang_foreign`` tells texts whose bytes are much less usual than
    their language's texts (those that are ``und`` too): the network always names one of the learned languages.
    Of languages with equal logits the first by name is taken. A very long text is read in windows. Every row is judged by its text alone, so repeated rows
    agree; columns not in ``keep`` are ignored; an empty table gives an empty result.
    """
    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    spec += ", lang_pred string, lang_score double, lang_foreign boolean"
    names = [f.name for f in docs.schema if f.name in keep]
    if not network.languages:
        return docs.select(*names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("lang_score"), F.lit(True).alias("lang_foreign"))
    letter = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)).alias("_letter")
    wanted = list(dict.fromkeys([*names, "text"]))
    return common.in_workers(docs.select(*wanted, letter), _apply(network, names), spec)
