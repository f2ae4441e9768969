"""Fill-in-the-middle by secondary sort: pieces, not texts, are shuffled and put in order.

Every text is cut into prefix, middle and suffix at unit bounds, and these into pieces
of whole units (a unit longer than a piece is cut itself). A piece carries its document and
its place in the output; ``repartitionAndSortWithinPartitions`` deals pieces by document and
sorts them by place, so that outputs stream by, piece by piece, into running digests.
For the way back the output's pieces get their place in the text, told from the form and the
sentinels in the output alone, and are sorted again: the partitioner is the same, so Spark
sorts (and spills) within the partitions without a second exchange.

A document's key is a hash of its id and text, its task and its number among equal rows
there: equal rows stay apart, however many there are, and a task that runs again deals out
the same keys whatever the order of its rows.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 64 << 10
PARTITION_BYTES = 32 << 20  # text that a partition sorts, on average
BLOCK_BYTES = 1 << 20  # text that one numpy step looks at

# Fixed values of the interface.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100

#: Order of the segments in the output, as (sentinel, rank in the text).
ORDERS = {"psm": ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), "spm": ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
SENTINEL = re.compile(b"<[PSM]>")

Key = tuple[bytes, int]


def draws(doc_id: int | None, salt: str = "1:") -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a document; no id draws as an empty one."""
    digest = hashlib.sha256(f"{salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def unit_starts(data: np.ndarray, first: int, last: int) -> np.ndarray:
    """Where units begin in ``data[first:last]``, as byte offsets: runs of A-Za-z, other code points."""
    part = data[max(0, first - 1) : last]
    letter = ((part | 32) - 97).astype(np.uint8) < 26
    begins = ~letter & ((part & 0xC0) != 0x80)
    begins[1:] |= letter[1:] & ~letter[:-1]
    begins[0] |= letter[0]
    if first:
        begins = begins[1:]
    return np.flatnonzero(begins) + first


def cuts(data: np.ndarray, draw: tuple[int, ...]) -> tuple[int, int, int]:
    """Number of units, and the bytes where prefix and middle end; a block at a time."""
    blocks = range(0, len(data), BLOCK_BYTES)
    starts = None
    counts = []
    for at in blocks:
        starts = unit_starts(data, at, at + BLOCK_BYTES)
        counts.append(len(starts))
    n = sum(counts)
    bounds = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    found = []
    for unit in bounds:
        offset = len(data)
        for at, count in zip(blocks, counts):
            if unit < count:
                own = starts if len(counts) == 1 else unit_starts(data, at, at + BLOCK_BYTES)
                offset = int(own[unit])
                break
            unit -= count
        found.append(offset)
    return n, found[0], found[1]


def pieces_of(data: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """``data[first:last]`` in pieces of whole units."""
    while last - first > PIECE_BYTES:
        starts = unit_starts(data, first, first + PIECE_BYTES + 1)
        end = int(starts[-1]) if len(starts) and starts[-1] > first else first + PIECE_BYTES
        yield data[first:end].tobytes()
        first = end
    yield data[first:last].tobytes()


def _chars(data: np.ndarray, first: int, last: int) -> int:
    return sum(int(np.count_nonzero((data[at : min(last, at + BLOCK_BYTES)] & 0xC0) != 0x80)) for at in range(first, last, BLOCK_BYTES))


def cut(doc_id: int | None, raw: bytes) -> tuple[tuple, list[tuple[bytes, int, int]]]:
    """Head ``(doc_id, n, form, prefix_chars, middle_chars)`` of a text, and its output as (sentinel, first, last) bytes."""
    data, draw = np.frombuffer(raw, np.uint8), draws(doc_id)
    n, a, b = cuts(data, draw)
    if not raw or SENTINEL.search(raw) or draw[2] % 100 >= PLAIN_FROM:
        return (doc_id, n, "plain", None, None), [(b"", 0, len(raw))]
    form = "spm" if draw[3] % 100 < SPM_BELOW else "psm"
    bounds = ((0, a), (a, b), (b, len(raw)))
    return (doc_id, n, form, _chars(data, 0, a), _chars(data, a, b)), [(mark, *bounds[rank]) for mark, rank in ORDERS[form]]


def _emit(rows: Iterator) -> Iterator[tuple[Key, object]]:
    """A head at place -1, then the output's pieces, for every row."""
    task, seen = TaskContext.get().partitionId(), Counter()
    for doc_id, text in rows:
        raw = (text or "").encode()
        own = hashlib.blake2b(f"{doc_id}:".encode(), digest_size=16)
        own.update(raw)
        row = own.digest()
        document = row + task.to_bytes(4, "big") + seen[row].to_bytes(4, "big")
        seen[row] += 1
        head, segments = cut(doc_id, raw)
        yield (document, -1), head
        place, data = 0, np.frombuffer(raw, np.uint8)
        for mark, first, last in segments:
            for piece in pieces_of(data, first, last):
                yield (document, place), mark + piece
                mark, place = b"", place + 1


def by_document(key: Key) -> int:
    return zlib.crc32(key[0])


def assembled(docs: DataFrame) -> RDD:
    """The outputs of ``docs(doc_id, text)`` as sorted ``((document, place), piece)``; place -1 holds the head."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    wide = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    return docs.select("doc_id", "text").rdd.mapPartitions(_emit).repartitionAndSortWithinPartitions(wide, by_document)


def _placed_back(pieces: Iterator[tuple[Key, object]]) -> Iterator[tuple[Key, object]]:
    """Pieces of outputs with their place in the text, without sentinels; heads with the output's digest."""
    document = head = digest = None
    order, segment, place = (), -1, 0
    for (own, _), piece in pieces:
        if own != document:
            if document is not None:
                yield (document, -1), (*head, digest.hexdigest())
            document, head, digest = own, piece, hashlib.sha256()
            order, segment, place = ORDERS.get(head[2], ((b"", 0),)), -1, 0
            continue
        digest.update(piece)
        mark = order[segment + 1][0] if segment + 1 < len(order) else None
        if mark is not None and piece.startswith(mark):  # only a segment's first piece begins so
            segment, piece = segment + 1, piece[len(mark) :]
        yield (own, order[segment][1] << 40 | place), piece
        place += 1
    if document is not None:
        yield (document, -1), (*head, digest.hexdigest())


def restored(outputs: RDD) -> RDD:
    """The texts again, from ``assembled`` outputs: sorted ``((document, place), piece)``.

    The head at place -1 has the digest of the output behind its fields.
    """
    back = outputs.mapPartitions(_placed_back, preservesPartitioning=True)
    return back.repartitionAndSortWithinPartitions(outputs.getNumPartitions(), by_document)


def _digests(pieces: Iterator[tuple[Key, object]]) -> Iterator[tuple]:
    document = head = digest = None
    for (own, _), piece in pieces:
        if own != document:
            if document is not None:
                yield (*head, digest.hexdigest())
            document, head, digest = own, piece, hashlib.sha256()
        else:
            digest.update(piece)
    if document is not None:
        yield (*head, digest.hexdigest())


def _joined(pieces: Iterator[tuple[Key, object]]) -> Iterator[tuple]:
    document, head, held = None, None, []
    for (own, _), piece in pieces:
        if own != document:
            if document is not None:
                yield (*head[:5], b"".join(held).decode())
            document, head, held = own, piece, []
        else:
            held.append(piece)
    if document is not None:
        yield (*head[:5], b"".join(held).decode())


HEAD = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def transformed(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``: the texts to train on.

    Takes ``doc_id`` and ``text``; other columns are ignored. A null text is an empty one, a null
    doc_id draws as an empty one; repeated rows come as often as they stand. Plain outputs have no
    prefix_chars and middle_chars. An empty table gives an empty result. A text needs about its own
    size some three times in the worker that cuts it, and once where its output is joined.
    """
    return docs.sparkSession.createDataFrame(assembled(docs).mapPartitions(_joined), HEAD + ", output string", verifySchema=False)


def digested(docs: DataFrame) -> DataFrame:
    """The columns of ``transformed`` with ``output_sha256, restored_sha256`` in place of the output.

    Both are taken as the pieces stream by, so no output or restored text is ever held whole;
    the restored text is rebuilt from the output and its form. Rows as in ``transformed``.
    """
    rows = restored(assembled(docs)).mapPartitions(_digests)
    return docs.sparkSession.createDataFrame(rows, HEAD + ", output_sha256 string, restored_sha256 string", verifySchema=False)
