"""Best-fit packing of token sequences by a linear grouping scheme.

Pieces are ranked by length, longest first, across the cluster; the driver sees only
how many pieces have each length (at most ``capacity`` numbers, whatever the input).
From these counts it makes a plan of runs: "the pieces ranked i..j go, one each, to
the sequences k..". The plan has thousands of runs, not one entry for each piece.

1. Large pieces (longer than ``small``) are cut into groups of equal cardinality and
   rounded up to the longest of their group.
2. A linear programme over the few rounded sizes finds the configurations (how many
   pieces of each size share a sequence) by column generation; whole multiples of
   them are opened.
3. Actual pieces take the places of the rounded sizes in rank order, which leaves
   more room than planned.
4. Large pieces left over by rounding down, then all small ones, longest first, each
   go where the least room remains (best fit), else to a new sequence.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm import common

CAPACITY = 2048
GROUPS = 48  # rounded sizes of the programme
SMALL = (160, 512, 1024)  # pieces up to this length are left to best fit; the shortest plan counts
CACHED_WORDS = 1 << 18  # words whose ids a worker remembers (about 40 MB)

# ------------------------------------------------------------------ tokens


#: The tokenizer's own split of a word into parts, for the letters of ``_PLAIN``.
_PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")
_PLAIN = re.compile("[!-~\u00c0-\u00ff]+")
_END = b"\xff"  # marks a word's end: no UTF-8 text holds this byte


class WordIds(dict):
    """Little-endian ids of each word, made on demand and remembered.

    The tokenizer never joins what white space separates, so a text's ids are those of
    its words in a row. Words of ASCII and Latin-1 letters are merged by a rank table
    made from the tokenizer's own vocabulary, whose ids follow the order of its
    merges; the tokenizer itself encodes all others.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = _merger(path)

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        if self.merge and _PLAIN.fullmatch(word):
            ids = []
            for part in _PART.findall(word.lower()):
                ids += self.merge(part.encode() + _END)
        else:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        self[word] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out


def _merger(path: str):
    """A function from bytes to ids by the vocabulary's ranks; None where ids do not follow the merges."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, merges = model["vocab"], model["merges"]
    names = ("".join(m if isinstance(m, list) else m.split(" ")) for m in merges)
    if model.get("end_of_word_suffix") != "</w>" or any(vocabulary.get(n) != 512 + i for i, n in enumerate(names)):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies write as themselves
    letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
    ranks = {}
    for name, made in vocabulary.items():
        ends = name.endswith("</w>") and name != "</w>"
        ranks[bytes(letters[c] for c in (name[:-4] if ends else name)) + _END * ends] = made
    return tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


_READY: dict[str, WordIds] = {}
# split() parts words at the first, the tokenizer does not; the other may begin a special token
_UNSPLIT = ("\x1c", "\x1d", "\x1e", "\x1f", "<|")


def word_ids(path: str) -> WordIds:
    if path not in _READY:
        _READY[path] = WordIds(path)
    return _READY[path]


def token_bytes(text: str | None, ids: WordIds) -> bytes:
    """The text's ids and the closing id 0, as little-endian 32-bit numbers."""
    if not text:
        return bytes(4)
    if any(c in text for c in _UNSPLIT):
        made = ids.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(made) + 1}I", *made, 0)
    return b"".join(map(ids.__getitem__, text.split())) + bytes(4)


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        for batch in common.chunks(batches, "text", 2 << 20):
            out = defaultdict(list)
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                made = token_bytes(text, ids)
                for piece, at in enumerate(range(0, len(made), 4 * capacity)):
                    part = made[at : at + 4 * capacity]
                    for name, value in (("doc_id", doc_id), ("piece", piece), ("start", at // 4),
                                        ("length", len(part) // 4), ("ids_crc32", zlib.crc32(part))):
                        out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_PIECES)

    return run


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64())])

# ------------------------------------------------------------------ plan


def _best_pattern(sizes: np.ndarray, limits: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """The configuration of greatest worth: a bounded knapsack over few sizes."""
    best = np.zeros(capacity + 1)
    taken = np.zeros((len(sizes), capacity + 1), dtype=np.int64)
    for i, (size, limit) in enumerate(zip(sizes, limits)):
        base = best.copy()
        for n in range(1, int(min(limit, capacity // size)) + 1):
            tried = np.full(capacity + 1, -1.0)
            tried[n * size :] = base[: capacity + 1 - n * size] + n * worth[i]
            better = tried > best + 1e-12
            best[better] = tried[better]
            taken[i, better] = n
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    for i in range(len(sizes) - 1, -1, -1):
        pattern[i] = taken[i, room]
        room -= pattern[i] * sizes[i]
    return pattern


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to open each, from the linear programme, rounded down.

    Revised simplex with column generation: the basis has one configuration for each
    size, a knapsack finds the next column, and it ends when no configuration helps.
    """
    k = len(sizes)
    if not k:
        return []
    basis = np.diag(np.minimum(capacity // sizes, counts)).astype(float)
    columns = [basis[:, i].copy() for i in range(k)]
    for _ in range(60 * k):
        prices = np.linalg.solve(basis.T, np.ones(k))
        pattern = _best_pattern(sizes, counts, np.maximum(prices, 0), capacity)
        if pattern @ prices <= 1 + 1e-7:
            break
        level, change = np.linalg.solve(basis, counts.astype(float)), np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(change > 1e-9, level / np.where(change > 1e-9, change, 1), np.inf)
        leave = int(ratio.argmin())
        basis[:, leave] = pattern
        columns[leave] = pattern
    level = np.linalg.solve(basis, counts.astype(float))
    return [(np.asarray(c, dtype=np.int64), int(x + 1e-6)) for c, x in zip(columns, level) if x >= 1 - 1e-6]


class Room:
    """Sequences by the room that is left in them, as intervals of sequence numbers."""

    def __init__(self):
        self.by_room: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, room: int, first: int, n: int) -> None:
        if n and room:
            if not self.by_room[room]:
                self.rooms.insert(bisect_right(self.rooms, room), room)
            self.by_room[room].append((first, n))

    def take(self, least: int, most: int) -> tuple[int, int, int] | None:
        """Up to ``most`` sequences of the smallest sufficient room: room, first, number."""
        at = bisect_right(self.rooms, least - 1)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        first, n = self.by_room[room].pop()
        if n > most:
            self.by_room[room].append((first + most, n - most))
            n = most
        if not self.by_room[room]:
            self.rooms.pop(at)
        return room, first, n


def plan(lengths: list[tuple[int, int]], capacity: int, groups: int = GROUPS, small=SMALL) -> list[tuple[int, int, int]]:
    """The shortest of the plans for each bound in ``small``."""
    plans = [plan_with(lengths, capacity, groups, min(bound, capacity // 2)) for bound in small]
    return min(plans, key=lambda runs: max((first + n for _, first, n in runs), default=0))


def plan_with(lengths: list[tuple[int, int]], capacity: int, groups: int, small: int) -> list[tuple[int, int, int]]:
    """Runs ``(first rank, sequence of that rank, number)`` for ``(length, count)`` in descending length."""
    sizes = np.array([n for n, _ in lengths], dtype=np.int64)
    ends = np.cumsum([c for _, c in lengths]).astype(np.int64)
    total, large = int(ends[-1]), int(sum(c for n, c in lengths if n > small))
    length_at = lambda rank: int(sizes[np.searchsorted(ends, rank, side="right")])
    end_at = lambda rank: int(ends[np.searchsorted(ends, rank, side="right")])
    runs: list[tuple[int, int, int]] = []
    room, opened = Room(), 0

    # group bounds by rank; groups that round to one size are joined
    cuts = sorted({large * i // groups for i in range(groups + 1)})
    merged: list[list[int]] = []
    for first, stop in zip(cuts, cuts[1:]):
        size = length_at(first)
        if merged and merged[-1][0] == size:
            merged[-1][2] = stop
        else:
            merged.append([size, first, stop])
    rounded = np.array([m[0] for m in merged], dtype=np.int64)
    cursor = [m[1] for m in merged]
    counts = np.array([m[2] - m[1] for m in merged], dtype=np.int64)
    for pattern, times in configurations(rounded, counts, capacity):
        slots = []
        for group in np.flatnonzero(pattern):
            for _ in range(int(pattern[group])):
                n = min(times, merged[group][2] - cursor[group])
                if n > 0:
                    slots.append((cursor[group], n))
                    runs.append((cursor[group], opened, n))
                    cursor[group] += n
        at = 0
        while at < times:  # stretches where every place holds one actual length
            step, used = times - at, 0
            for first, n in slots:
                if at < n:
                    step = min(step, n - at, end_at(first + at) - (first + at))
                    used += length_at(first + at)
            room.add(capacity - used, opened + at, step)
            at += step
        opened += times
    rest = [(c, m[2]) for c, m in zip(cursor, merged) if c < m[2]] + [(large, total)] * (large < total)
    for rank, stop in rest:
        while rank < stop:
            size, n = length_at(rank), min(stop, end_at(rank)) - rank
            got = room.take(size, n)
            if got is None:
                each = min(n, -(-n // (capacity // size)))  # so many new ones hold them all
                got = (capacity, opened, each)
                opened += each
            left, first, n = got
            runs.append((rank, first, n))
            room.add(left - size, first, n)
            rank += n
    return sorted(runs)


def _placed(runs: list[tuple[int, int, int]]):
    starts, targets, _ = (np.array(c, dtype=np.int64) for c in zip(*runs)) if runs else (np.zeros(0, np.int64),) * 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(starts, rank, side="right") - 1
            sequence = pa.array(targets[at] + rank - starts[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in _PIECES.names), sequence], names=[*_PIECES.names, "sequence_id"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of each row of ``docs(doc_id, text)``, with its place in a sequence.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Null and
    empty texts are the closing id alone. Texts longer than ``capacity`` ids are cut into
    pieces of that length and a last one; nothing else is cut. Repeated rows, and rows
    with a null doc_id, are packed each for itself; other columns are ignored; an empty
    table gives an empty result.
    """
    spec = "doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = common.stored(common.in_workers(docs.select("doc_id", "text"), _pieces(tokenizer, capacity), spec), "pieces")
    counts = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    lengths = sorted(((r["length"], r["count"]) for r in counts), reverse=True)
    order = [F.desc("length"), F.asc("doc_id"), F.asc("piece"), F.asc("ids_crc32")]
    numbered = common.ranked(pieces, order, "rank", "ranked-pieces")
    runs = plan(lengths, capacity) if lengths else []
    placed = common.in_workers(numbered, _placed(runs), f"{spec}, sequence_id long")
    # a sequence holds at most ``capacity`` pieces
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
    ahead = ahead.rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0)))
