"""Many small batch folders gathered into few large files.

Ingest gives every batch a folder of its own. ``pack`` writes the rows of finished
batches into a day-partitioned dataset beside them (``snapshots``), whose manifest notes
which batches it holds. Readers take those from there and the others from their
folders, so a batch is read once before, during and after a packing and when one dies.
A batch's folder is removed by the packing after the one that took it, for the sake of
readers who began before.

A batch is a number (``batch``), or a text of a name and a number (``batch_id``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.dates import day_of
from tradelake.functions.ranges import Ranges, merged, outside, ranges_of
from tradelake.sources import snapshots
from tradelake.sources.files import delete, hadoop
from tradelake.sources.snapshots import Snapshot

# A day of so many pieces is written anew as one when it gains rows.
MOST_PIECES = 16
NAMED = r"^(.*)-(\d+)$"  # a batch id: name, number
DAY = "received_date"


@dataclass(frozen=True)
class PackReport:
    rows: int  # packed by this run
    batches: int
    removed: int  # folders of batches that earlier runs packed


def packed_root(root: str) -> str:
    return f"{root}_packed"


def name_of(column: str) -> Column:
    return F.lit("") if column == "batch" else F.regexp_extract(column, NAMED, 1)


def number_of(column: str) -> Column:
    return F.col(column) if column == "batch" else F.regexp_extract(column, NAMED, 2).try_cast("long")


def among(column: str, batches: dict[str, Ranges]) -> Column:
    """Partition predicate: batches of these names and numbers. Ids without a number are none of them."""
    found = F.lit(False)
    for name, ranges in batches.items():
        found = found | ((name_of(column) == name) & ~outside(number_of(column), ranges))
    return F.coalesce(found, F.lit(False))


def _current(spark: SparkSession, root: str) -> Snapshot:
    return snapshots.current(spark, packed_root(root)) or snapshots.EMPTY


def _schema(loose: DataFrame) -> T.StructType:
    fields = [f for f in loose.schema.fields if f.name != DAY]
    return T.StructType([*fields, T.StructField(DAY, T.DateType())])


def with_packed(spark: SparkSession, root: str, loose: DataFrame, column: str, beyond: Ranges = ()) -> DataFrame:
    """All rows, packed or in the folders (``loose``), of batches outside ``beyond``.

    When all packed batches are in ``beyond`` the packed files are not opened.
    """
    pack = _current(spark, root)
    held = pack.notes.get("batches", {})
    rows = loose.filter(outside(column, beyond) & ~among(column, held)) if held else loose.filter(outside(column, beyond))
    if not held or (beyond and merged(beyond, *held.values()) == merged(beyond)):
        return rows
    packed = snapshots.read(spark, packed_root(root), _schema(loose), pack)
    return rows.unionByName(packed.select(*loose.columns).filter(outside(column, beyond)))


def _finished(loose: DataFrame, column: str, ready: dict[str, Ranges] | None) -> dict[str, Ranges]:
    """The batches found among ``ready``; without it all but the last of each name, which may be replayed."""
    ids = loose.select(name_of(column).alias("name"), number_of(column).alias("number")).where("number is not null").distinct()
    names = [(row.name, row.last) for row in ids.groupBy("name").agg(F.max("number").alias("last")).collect()]
    found = {}
    for name, last in names:
        keep = F.col("number") < last if ready is None else ~outside("number", ready.get(name, []))
        ranges = ranges_of(ids.where((F.col("name") == name) & keep), "number")
        if ranges:
            found[name] = ranges
    return found


def _removed(loose: DataFrame, root: str, column: str, batches: dict[str, Ranges]) -> int:
    """Remove the folders of packed batches, whose rows nobody takes from there any more."""
    spark, done = loose.sparkSession, 0
    parts = [DAY, column] if DAY in loose.columns else [column]
    folders = loose.filter(among(column, batches)).select(*parts).distinct()
    for row in folders.toLocalIterator():
        delete(spark, "/".join([root, *(f"{part}={row[part]}" for part in parts)]))
        done += 1
    return done


def pack(spark: SparkSession, root: str, loose: DataFrame, column: str, ready: dict[str, Ranges] | None = None) -> PackReport:
    """Pack the batches of ``ready`` that are still in folders of their own.

    Safe to repeat: rows and the batches they come from become visible in one commit, and a
    run that died before it is run again. One packing at a time; of two, one gets a ``Conflict``.
    """
    before = _current(spark, root)
    held = before.notes.get("batches", {})
    removed = _removed(loose, root, column, held) if held else 0
    if removed:
        loose.sparkSession.catalog.refreshByPath(root)
    left = loose.filter(~among(column, held))
    found = _finished(left, column, ready)
    if not found:
        return PackReport(0, 0, removed)
    rows = left.filter(among(column, found))
    fresh = (rows if DAY in loose.columns else rows.withColumn(DAY, day_of("received_at"))).select(*_schema(loose).names)
    expected = rows.count()
    target = packed_root(root)
    days = {r.key for r in fresh.select(F.concat(F.lit(f"{DAY}="), F.col(DAY).cast("string")).alias("key")).distinct().collect()}
    crowded = {key for key in days if key in before.days and len(before.days[key].pieces) >= MOST_PIECES}
    again = snapshots.on_keys(spark, target, _schema(loose), crowded, before)
    pieces = snapshots.write(fresh.unionByName(again), target, DAY, [column], "received_at")
    kept = sum(piece.rows for key in crowded for piece in before.days[key].pieces)
    if sum(piece.rows for piece in pieces.values()) != expected + kept:
        raise RuntimeError(f"{root}: a batch changed while it was packed")
    names = {**held, **found}
    notes = {"batches": {name: merged(held.get(name, []), found.get(name, [])) for name in names}}
    snapshots.commit(spark, target, before, pieces, crowded, notes)
    return PackReport(expected, sum(last - first + 1 for ranges in found.values() for first, last in ranges), removed)


def folders(spark: SparkSession, root: str) -> int:
    """Folders that hold files directly: what a reader has to list."""
    fs, path = hadoop(spark, root)
    if not fs.exists(path):
        return 0
    files, seen = fs.listFiles(path, True), set()
    while files.hasNext():
        file = files.next().getPath()
        if file.getName().endswith(".parquet"):
            seen.add(file.getParent().toString())
    return len(seen)
