"""Manifests: what readers see between the steps of a commit, who wins, what is cleaned away."""

import os

import pytest
from conftest import at
from pyspark.sql import functions as F
from trades import payload, payloads

from tradelake.functions.ranges import merged, outside, ranges_of
from tradelake.plans import bronze, silver
from tradelake.schemas import SILVER
from tradelake.sources import snapshots
from tradelake.sources.files import delete, names
from tradelake.sources.tables import read_silver

SCHEMA = "n long, moment timestamp, day date"


def rows(spark, numbers, day):
    return spark.createDataFrame([(n, at(day, n % 24), at(day).date()) for n in numbers], SCHEMA)


def put(spark, root, before, numbers, day=10, replaced=()):
    pieces = snapshots.write(rows(spark, numbers, day), root, "day", ["moment"], "moment")
    return snapshots.commit(spark, root, before, pieces, replaced)


def seen(spark, root, snapshot=None):
    schema = rows(spark, [1], 10).schema
    return sorted(r.n for r in snapshots.read(spark, root, schema, snapshot).collect())


def test_readers_see_all_of_a_commit_or_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    assert snapshots.current(spark, root) is None and seen(spark, root) == []
    pieces = snapshots.write(rows(spark, [1, 2], 10), root, "day", ["moment"], "moment")
    assert seen(spark, root) == []  # written, not committed
    first = snapshots.commit(spark, root, None, pieces)
    assert seen(spark, root) == [1, 2] and first.rows == 2
    snapshots.write(rows(spark, [7, 8], 10), root, "day", ["moment"], "moment")  # a run that dies here
    assert seen(spark, root) == [1, 2]
    second = put(spark, root, first, [3], replaced=["day=2026-04-10"])
    assert seen(spark, root) == [3] and seen(spark, root, first) == [1, 2]  # who began before reads on
    third = put(spark, root, second, [4], day=11)
    assert seen(spark, root) == [3, 4]
    assert third.changed_since(second.number) == ["day=2026-04-11"]
    assert third.changed_since(0) == ["day=2026-04-10", "day=2026-04-11"]
    emptied = snapshots.commit(spark, root, third, {}, None)
    assert seen(spark, root) == [] and emptied.rows == 0 and len(emptied.changed_since(third.number)) == 2
    assert snapshots.commit(spark, root, emptied, {}, None).changed_since(emptied.number) == []


def test_the_second_of_two_writers_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    first = put(spark, root, None, [1])
    put(spark, root, first, [2])
    with pytest.raises(snapshots.Conflict):
        put(spark, root, first, [3])
    assert seen(spark, root) == [1, 2]
    assert not [n for n in names(spark, f"{root}/_manifests") if n.startswith(".") and not n.endswith(".crc")]


def test_old_commits_and_their_files_go(spark, tmp_path):
    root = str(tmp_path / "t")
    now = put(spark, root, None, [100], day=12)
    for n in range(snapshots.KEPT + 4):
        now = put(spark, root, now, [n], replaced=["day=2026-04-10"])
    assert seen(spark, root) == [snapshots.KEPT + 3, 100]
    assert len(snapshots.manifests(spark, root)) == snapshots.KEPT
    versions = [name for name in os.listdir(root) if name.startswith("v=")]
    assert len(versions) == snapshots.KEPT + 1  # the first day's, and one for each manifest that is kept


def test_a_table_made_anew_at_the_same_place_is_read_anew(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, None, [1])
    assert seen(spark, root) == [1]
    delete(spark, root)
    put(spark, root, None, [2])
    assert seen(spark, root) == [2]


def test_ranges_of_many_batches_are_few(spark):
    numbers = spark.range(1, 100_001).where("id not in (5, 4095, 4096, 4097, 70000)").withColumnRenamed("id", "batch")
    ranges = ranges_of(numbers.union(numbers), "batch")
    assert len(ranges) <= 30  # runs are joined block by block
    assert merged(ranges) == [(1, 4), (6, 4094), (4098, 69999), (70001, 100_000)]
    left = spark.range(0, 100_010).withColumnRenamed("id", "batch").where(outside("batch", merged(ranges)))
    assert [r.batch for r in left.orderBy("batch").collect()] == [0, 5, 4095, 4096, 4097, 70000, *range(100_001, 100_010)]
    assert merged([(1, 2), (9, 9)], [(3, 5)], [(2, 4)]) == [(1, 5), (9, 9)] and merged([]) == []


def test_numbers_of_batches_are_never_given_twice(spark, layout):
    given = [bronze.next_batch(spark, layout) for _ in range(5)]
    assert given == [1, 2, 3, 4, 5] and len([n for n in names(spark, layout.bronze_batches) if n.isdigit()]) <= 2


def test_a_batch_that_commits_after_a_later_one_is_taken(spark, layout):
    slow = bronze.next_batch(spark, layout)  # another writer has its number, but has not written yet
    bronze.append(spark, layout, payloads(spark, [payload("b")]), at(20))
    silver.upsert(spark, layout, at(20))
    assert snapshots.current(spark, layout.silver).notes["taken"] == [[slow + 1, slow + 1]]
    late = bronze.stamp(payloads(spark, [payload("a")]), at(19)).withColumn("batch", F.lit(slow).cast("long"))
    late.write.mode("append").partitionBy("received_date", "batch").parquet(layout.bronze)
    assert silver.upsert(spark, layout, at(21)).inserted_or_changed == 1
    assert sorted(r.trade_id for r in read_silver(spark, layout.silver).collect()) == ["a", "b"]
    assert snapshots.current(spark, layout.silver).notes["taken"] == [[slow, slow + 1]]


def test_days_of_many_pieces_are_written_as_one(spark, layout, monkeypatch):
    monkeypatch.setattr(silver, "MOST_PIECES", 3)
    for i in range(6):
        bronze.append(spark, layout, payloads(spark, [payload(f"t{i}", time=at(10, 1, i))]), at(20, i))
        silver.upsert(spark, layout, at(20, i))
    (day,) = snapshots.current(spark, layout.silver).days.values()
    assert len(day.pieces) <= 3 and read_silver(spark, layout.silver).count() == 6
    assert snapshots.read(spark, layout.silver, SILVER, keep=lambda _, piece: piece.high < snapshots.current(spark, layout.silver).days["trade_date=2026-04-10"].pieces[-1].low).count() < 6
