"""Sharding by Karmarkar-Karp differencing: near-equal bytes for indivisible groups.

Rows with equal texts are one group and go to one shard. A partial partition gives each
of the shards some bytes; two of them are combined by adding the most of one to the
least of the other and so on. Combining always the two of largest spread, until one is
left, is the differencing method.

Three kinds of groups follow each other. The largest, a bounded number, are differenced
on the driver. The others are dealt into cells of bounded size and differenced there;
a cell starts from a partial partition that is its share of the imbalance so far, so
together the cells even it out. A share of the smaller groups is kept to the end and
evens out what the cells before left. What a task or the driver holds does not grow
with the input.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.llm import common

CELL = 256  # groups that one task step differences, on average
LARGE = 32  # a group of at least one part in so many of a shard's share is large
FILLER = 8  # one in so many of the groups of at most average size is kept to the end


def difference(partials: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Combine partial partitions: the sums of the result, and where each input's places went.

    ``went[i][p]`` is the shard of the result that holds place ``p`` of input ``i``.
    """
    shards = len(partials[0])
    heap, counter = [], len(partials)
    for i, sums in enumerate(partials):
        order = sorted(range(shards), key=lambda p: (sums[p], p), reverse=True)
        heap.append((min(sums) - max(sums), i, [sums[p] for p in order], [(i, order)]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, x, of_x = heapq.heappop(heap)
        _, _, y, of_y = heapq.heappop(heap)
        if len(of_x) < len(of_y):
            x, y, of_x, of_y = y, x, of_y, of_x
        # the largest of x meets the smallest of y
        total = [a + b for a, b in zip(x, reversed(y))]
        order = sorted(range(shards), key=lambda p: (total[p], p), reverse=True)
        sums = [total[p] for p in order]
        # each member keeps its places by the order of the partition that holds it
        of_x.append((None, (of_y, order)))
        heapq.heappush(heap, (sums[-1] - sums[0], counter, sums, of_x))
        counter += 1
    sums, members = heap[0][2], heap[0][3]
    went: list[list[int]] = [[0] * shards for _ in partials]
    pending = [(members, list(range(shards)))]
    while pending:  # unfold from the last combination to the first
        members, place = pending.pop()
        for i, what in reversed(members):
            if i is None:
                other, order = what
                before = [0] * shards  # position before the combination's sort
                for position, p in enumerate(order):
                    before[p] = place[position]
                pending.append((other, before[::-1]))
                place = before
            else:
                for position, p in enumerate(what):
                    went[i][p] = place[position]
    return sums, went


def assign(items: list[int], loads: list[int]) -> list[int]:
    """The shard of each item, when the shards hold ``loads`` already."""
    alone = [0] * (len(loads) - 1)
    _, went = difference([loads, *([size, *alone] for size in items)])
    shard_at = {place: own for own, place in enumerate(went[0])}
    return [shard_at[places[0]] for places in went[1:]]


def _cell_step(loads: list[int]):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "item"], kind="stable")
        placed = assign([int(n) for n in rows["bytes"]], loads)
        return pd.DataFrame({"item": rows["item"], "bytes": rows["bytes"], "shard": placed})

    return run


_PLACED = "item long, bytes long, shard int"


def _fill(groups: DataFrame, loads: list[int], cell: int) -> DataFrame:
    """Stored ``item, bytes, shard`` for all groups, evening out ``loads``."""
    cells = max(1, -(-groups.count() // cell))
    share = [(n - min(loads)) // cells for n in loads]
    dealt = groups.withColumn("cell", F.pmod(F.xxhash64("item", F.lit("cell")), F.lit(cells)))
    return common.stored(dealt.groupBy("cell").applyInPandas(_cell_step(share), _PLACED), "filled")


def _added(loads: list[int], placed: DataFrame) -> list[int]:
    total = list(loads)
    for r in placed.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect():  # one row for each shard
        total[r["shard"]] += r["bytes"]
    return total


def shard(docs: DataFrame, shards: int = 16, cell: int = CELL) -> DataFrame:
    """``doc_id, size, text_crc32, shard`` for every row of ``docs(doc_id, text)``, equal texts together.

    Size is the text's UTF-8 bytes plus 1; a null text counts as an empty one and groups
    with it. Repeated rows and null ids are rows like others; other columns are ignored;
    an empty table gives an empty result. A group larger than a shard's share makes that
    shard larger, as it may not be divided. Groups are told apart by 64-bit hashes.
    """
    text = F.coalesce("text", F.lit(""))
    slim = common.stored(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("item")), "sized")
    groups = common.stored(slim.groupBy("item").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count("*").alias("n")).first()
    if not total["n"]:
        return slim.select("doc_id", "size", "text_crc32", "item", F.lit(0).alias("shard"))
    large = F.col("bytes") * (shards * LARGE) >= total["bytes"]  # so at most shards * LARGE groups
    filler = ~large & (F.col("bytes") * total["n"] <= total["bytes"]) & (F.pmod(F.xxhash64("item", F.lit("end")), F.lit(FILLER)) == 0)
    first = sorted((r["bytes"], r["item"]) for r in groups.where(large).collect())
    loads = [0] * shards
    placed = assign([n for n, _ in first], loads)
    for (n, _), own in zip(first, placed):
        loads[own] += n
    spark = docs.sparkSession
    place = spark.createDataFrame([(item, n, own) for (n, item), own in zip(first, placed)], _PLACED)
    for part in (~large & ~filler, filler):
        filled = _fill(groups.where(part), loads, cell)
        loads = _added(loads, filled)
        place = place.union(filled)
    place = place.select("item", "shard")
    return slim.join(place, "item").select("doc_id", "size", "text_crc32", "item", "shard")


def with_slots(sharded: DataFrame) -> DataFrame:
    """``sharded`` with ``slot``, each row's number in its shard, equal texts side by side."""
    order = [F.col("shard"), F.col("item"), F.col("doc_id"), F.col("size")]
    numbered = common.ranked(sharded, order, "rank", "slotted")
    sizes = numbered.groupBy("shard").count()  # one row for each shard
    starts = sizes.select("shard", (F.sum("count").over(Window.orderBy("shard")) - F.col("count")).alias("first"))
    return numbered.join(F.broadcast(starts), "shard").withColumn("slot", F.col("rank") - F.col("first"))
