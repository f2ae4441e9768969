"""Hashed word shingles of whole text columns, computed batch by batch with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tradelake.llm.common import text_bytes

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 2**64))
_BYTES = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BLOCK = 1 << 16  # bytes that are hashed in one step


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_ODD, BLOCK + 1), _powers(_INVERSE, BLOCK + 1)


def _edges(word: np.ndarray, edge: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a block begin and end; ``inside``: the byte before the block is a word's."""
    start, stop = word.copy(), word.copy()
    start[1:] &= ~word[:-1] | edge[1:]
    start[0] &= not inside or edge[0]
    stop[:-1] &= ~word[1:] | edge[1:]
    return np.flatnonzero(start), np.flatnonzero(stop) + 1


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z lowered, split at ASCII space) and the words' bounds by row.

    A word's hash is a polynomial in its bytes modulo 2**64, taken as a difference
    of running sums and brought to a common power, then mixed. The bytes are taken block
    by block; a word that crosses into the next block is carried over as its sum and length.
    """
    raw, ends = text_bytes(texts)
    sums_of, starts_of = [], []
    carried = length = None  # sum and length of the word that the last block ended in
    inside = False
    for at in range(0, len(raw), BLOCK):
        lowered = _LOWER[raw[at : at + BLOCK]]
        size = len(lowered)
        edge = np.zeros(size, dtype=bool)
        own = ends[np.searchsorted(ends, at) : np.searchsorted(ends, at + size)]
        edge[own - at] = True
        word = ~_SPACE[lowered]
        starts, stops = _edges(word, edge, inside)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTES[lowered] * _UP[:size], out=sums[1:])
        if inside and word[0] and not edge[0]:  # the first stretch goes on with the carried word
            carried = carried + sums[stops[:1]] * np.array([pow(int(_ODD), length, 2**64)], dtype=np.uint64)
            length += int(stops[0])
            stops = stops[1:]
            if len(stops) or not word[-1]:
                sums_of.append(carried)
                carried = None
        elif inside:
            sums_of.append(carried)
            carried = None
        found = (sums[stops] - sums[starts]) * _DOWN[starts]
        starts_of.append(starts + at)
        inside = bool(word[-1])
        if inside and len(starts) and stops[-1] == size:
            carried, length = found[-1:], int(size - starts[-1])
            found = found[:-1]
        sums_of.append(found)
    if carried is not None:
        sums_of.append(carried)
    hashes = mix(np.concatenate(sums_of)) if sums_of else np.zeros(0, np.uint64)
    starts = np.concatenate(starts_of) if starts_of else np.zeros(0, np.int64)
    return hashes, np.searchsorted(starts, ends)


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingle hashes, sorted, as one array and its bounds by row.

    A row with fewer words than ``width`` has its whole sequence as one shingle, a
    row without words (or null) has none.
    """
    hashes, bounds = word_hashes(texts)
    counts = np.diff(bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes)) - bounds[:-1][owner]
    left = counts[owner] - place
    value = np.full(len(hashes), np.uint64(width), dtype=np.uint64)
    for step in range(width):
        there = left > step
        follow = np.zeros(len(hashes), dtype=np.uint64)
        follow[: len(hashes) - step] = hashes[step:]
        value = np.where(there, mix(value ^ follow) + np.uint64(step + 1), value)
    whole = left >= np.minimum(width, counts[owner])
    owner, value = owner[whole], value[whole]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(counts) + 1))
