"""Small batches gathered into large files."""

import pytest
from conftest import at
from pyspark.sql import functions as F
from trades import payload, payloads, sorted_rows

from tradelake.plans import bronze, silver
from tradelake.plans.packing import pack_arrivals, pack_bronze, pack_quarantine
from tradelake.plans.quarantine import quarantine
from tradelake.sources import packed, snapshots
from tradelake.sources.tables import read_batches, read_bronze, read_quarantine, read_silver


def fill(spark, layout, first, last, day=10):
    for n in range(first, last + 1):
        bronze.append(spark, layout, payloads(spark, [payload(f"t{n}"), payload(f"u{n}", price=n)]), at(day + n % 2, 1))


def held(spark, layout):
    return sorted_rows(read_bronze(spark, layout.bronze))


def test_batches_are_read_once_around_packings(spark, layout):
    assert pack_arrivals(spark, layout)["bronze"].batches == 0  # nothing there yet
    fill(spark, layout, 1, 5)
    assert pack_bronze(spark, layout).batches == 0  # silver has not taken them
    silver.upsert(spark, layout, at(12))
    fill(spark, layout, 6, 6)
    before = held(spark, layout)
    report = pack_bronze(spark, layout)
    assert (report.rows, report.batches, report.removed) == (10, 5, 0)
    assert held(spark, layout) == before and len(before) == 12
    again = pack_bronze(spark, layout)
    assert (again.rows, again.batches, again.removed) == (0, 0, 5)
    assert held(spark, layout) == before
    assert packed.folders(spark, layout.bronze) == 1 and packed.folders(spark, packed.packed_root(layout.bronze)) == 2
    # known ids stay known, silver goes on, and a rebuild reads both
    assert bronze.append(spark, layout, payloads(spark, [payload("t1"), payload("t6"), payload("x")]), at(13)).inserted == 1
    silver.upsert(spark, layout, at(14))
    after = sorted_rows(read_silver(spark, layout.silver))
    assert len(after) == 13
    assert pack_bronze(spark, layout).batches == 2
    silver.rebuild(spark, layout, at(15))
    assert sorted_rows(read_silver(spark, layout.silver)) == after


def test_taken_batches_are_not_opened(spark, layout):
    fill(spark, layout, 1, 4)
    silver.upsert(spark, layout, at(12))
    pack_bronze(spark, layout)
    pack_bronze(spark, layout)
    fill(spark, layout, 5, 5)
    files = bronze.batches(spark, layout, [(1, 4)]).inputFiles()
    assert files and not [file for file in files if "_packed" in file]
    assert read_batches(spark, layout.bronze, [(1, 3)]).select("batch").distinct().count() == 2


def test_a_packing_that_dies_is_run_again(spark, layout, monkeypatch):
    fill(spark, layout, 1, 3)
    silver.upsert(spark, layout, at(12))
    before = held(spark, layout)

    def dies(*args, **kwargs):
        raise OSError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(snapshots, "commit", dies)
        with pytest.raises(OSError, match="lost"):
            pack_bronze(spark, layout)
    assert held(spark, layout) == before
    assert pack_bronze(spark, layout).rows == 6 and held(spark, layout) == before
    with monkeypatch.context() as patch:
        patch.setattr(packed, "delete", dies)
        with pytest.raises(OSError, match="lost"):
            pack_bronze(spark, layout)
    assert held(spark, layout) == before and pack_bronze(spark, layout).removed == 3


def test_days_of_many_pieces_become_one(spark, layout, monkeypatch):
    monkeypatch.setattr(packed, "MOST_PIECES", 2)
    for n in range(1, 5):
        bronze.append(spark, layout, payloads(spark, [payload(f"t{n}")]), at(10, n))
        silver.upsert(spark, layout, at(12))
        pack_bronze(spark, layout)
    (day,) = snapshots.current(spark, packed.packed_root(layout.bronze)).days.values()
    assert len(day.pieces) == 2 and [r.trade_id for r in read_bronze(spark, layout.bronze).orderBy("trade_id").collect()] == ["t1", "t2", "t3", "t4"]


def test_quarantine_keeps_the_batch_that_may_come_again(spark, layout):
    def aside(name, number, *texts):
        rows = spark.createDataFrame([(t, ["bad"]) for t in texts], "raw string, reasons array<string>")
        quarantine(rows.withColumns({"received_at": F.lit(at(10)), "batch_id": F.lit(f"{name}-{number:012d}")}), layout)

    for n in range(3):
        aside("tape", n, f"a{n}", f"b{n}")
        aside("other-tape", n, f"c{n}")
    quarantine(spark.createDataFrame([("z", None, None, "by hand")], "raw string, reasons array<string>, received_at timestamp, batch_id string"), layout)
    rows = lambda: sorted(r.raw for r in read_quarantine(spark, layout.quarantine).collect())
    before = rows()
    assert len(before) == 10
    report = pack_quarantine(spark, layout)
    assert (report.rows, report.batches) == (6, 4) and rows() == before
    aside("tape", 2, "new")  # the last batch is replayed with other rows
    aside("tape", 1, "a1", "b1")  # an older one is written again
    assert rows() == sorted([r for r in before if r not in ("a2", "b2")] + ["new"])
    assert pack_quarantine(spark, layout).removed == 4
    assert packed.folders(spark, layout.quarantine) == 3 and len(rows()) == 9
