"""Where each trade id stands: its newest version and the day it lies on, found without a scan.

The ledger holds a row for every id that silver has taken, dealt by hash into buckets and
sorted by id inside them, with Parquet Bloom filters on the id. The ids of a batch are
looked up in the buckets they hash to; as literals they reach the row groups, of which
those without a match are not read. The stored side is never shuffled for that. Larger batches
meet the buckets in a semi join, whose other side is broadcast by measured size.

Every refresh adds a piece to the buckets it touches; a later row of an id overrides
earlier ones by version, and buckets of many pieces are written anew. The ledger follows
silver's commits and notes the one it has seen. If a run dies in between, the
next one first makes up for the days that silver changed since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.ranges import outside
from tradelake.operators.absent import mentioned_ids
from tradelake.plans.bronze import batches
from tradelake.schemas import SILVER, Layout
from tradelake.sources import snapshots
from tradelake.sources.snapshots import Snapshot

BUCKETS = 16
LITERAL_IDS = 10_000  # ids of a batch that are looked up as literals, at most
MOST_PIECES = 16
# Latest-wins order; the columns after the stamp settle equal stamps.
RECENCY = ("ingested_at", "traded_at", "price", "size", "side", "product_id")

VERSION = T.StructType([SILVER[name] for name in RECENCY])
LEDGER = T.StructType([SILVER["trade_id"], SILVER["trade_date"], T.StructField("version", VERSION), T.StructField("bucket", T.IntegerType())])
BLOOM = {
    "parquet.bloom.filter.enabled#trade_id": "true", "parquet.bloom.filter.fpp#trade_id": "0.0001",
    "parquet.bloom.filter.adaptive.enabled": "true", "parquet.block.size": str(16 << 20),
}


def bucket():
    return F.pmod(F.xxhash64("trade_id"), F.lit(BUCKETS)).cast("int")


def entries(trades: DataFrame) -> DataFrame:
    """Ledger rows of silver rows."""
    return trades.select("trade_id", "trade_date", F.struct(*RECENCY).alias("version"), bucket().alias("bucket"))


def bare(ids: DataFrame) -> DataFrame:
    """Ledger rows of ids that have no silver row."""
    none = [F.lit(None).cast(LEDGER[name].dataType).alias(name) for name in ("trade_date", "version")]
    return ids.where("trade_id is not null").select("trade_id").distinct().select("trade_id", *none, bucket().alias("bucket"))


def newest(rows: DataFrame) -> DataFrame:
    """One row for each id: the newest version, a bare one only if there is no other."""
    top = rows.groupBy("trade_id").agg(F.max(F.struct("version", "trade_date")).alias("top"))
    return top.select("trade_id", "top.trade_date", "top.version")


def looked_up(spark: SparkSession, layout: Layout, batch: DataFrame, count: int, size: int) -> DataFrame:
    """``trade_id, trade_date, version`` of those ids of ``batch`` that the ledger knows.

    ``count`` and ``size`` are the rows and the bytes of the ids as measured; they choose how, not what.
    """
    if count > LITERAL_IDS:
        rows = snapshots.read(spark, layout.ledger, LEDGER)
        return newest(rows.join(mentioned_ids(batch, size), "trade_id", "left_semi"))
    wanted = batch.where("trade_id is not null").select("trade_id", bucket().alias("bucket")).distinct().collect()
    keys = {f"bucket={row.bucket}" for row in wanted}
    rows = snapshots.on_keys(spark, layout.ledger, LEDGER, keys)
    return newest(rows.where(F.col("trade_id").isin([row.trade_id for row in wanted])))


def holds_nothing(spark: SparkSession, layout: Layout) -> bool:
    """Whether there is neither a ledger nor a bronze batch."""
    return snapshots.current(spark, layout.ledger) is None and batches(spark, layout).isEmpty()


def known_ids(spark: SparkSession, layout: Layout, batch: DataFrame, count: int, size: int) -> DataFrame:
    """Ids of ``batch`` that bronze holds: the ledger's, and those of batches that it has not seen."""
    seen = (snapshots.current(spark, layout.ledger) or snapshots.EMPTY).notes.get("taken", [])
    recent = batches(spark, layout, seen).select("trade_id")
    return looked_up(spark, layout, batch, count, size).select("trade_id").union(recent)


def _add(spark: SparkSession, layout: Layout, rows: DataFrame, silver: Snapshot, before: Snapshot | None, replaced: list[str] | None) -> None:
    pieces = snapshots.write(rows.select(*LEDGER.names), layout.ledger, "bucket", ["trade_id"], "version.ingested_at", BLOOM)
    notes = {"silver": silver.number, "taken": silver.notes["taken"]}
    snapshots.commit(spark, layout.ledger, before, pieces, replaced, notes)


def rebuild(spark: SparkSession, layout: Layout, silver: Snapshot, all_placed: bool = False) -> None:
    """The ledger of all of silver and bronze, as one piece for each bucket.

    ``all_placed`` says that every id taken has a silver row, so none is looked for.
    """
    trades = snapshots.read(spark, layout.silver, SILVER, silver)
    if all_placed:
        _add(spark, layout, entries(trades), silver, snapshots.current(spark, layout.ledger), None)
        return
    taken = batches(spark, layout).filter(~outside("batch", silver.notes["taken"])).select("trade_id")
    unplaced = bare(taken.join(trades.select("trade_id"), "trade_id", "left_anti"))
    _add(spark, layout, entries(trades).union(unplaced), silver, snapshots.current(spark, layout.ledger), None)


def follow(spark: SparkSession, layout: Layout, silver: Snapshot, since: Snapshot | None = None, changed: DataFrame | None = None, unplaced: DataFrame | None = None) -> None:
    """Bring the ledger to a silver commit.

    ``changed`` are the rows that the commit brought and ``unplaced`` the ids without one, if the ledger has
    seen the commit ``since`` before it; else the days changed since its own are read.
    """
    before = snapshots.current(spark, layout.ledger)
    if before is None or before.notes["silver"] > silver.number:
        rebuild(spark, layout, silver)
        return
    seen = before.notes["silver"]
    if seen == silver.number:
        return
    if since is not None and changed is not None and seen == since.number:
        rows = entries(changed) if unplaced is None else entries(changed).union(bare(unplaced))
    else:
        trades = snapshots.on_keys(spark, layout.silver, SILVER, silver.changed_since(seen), silver)
        fresh = batches(spark, layout, before.notes["taken"]).filter(~outside("batch", silver.notes["taken"]))
        rows = entries(trades).union(bare(fresh))
    crowded = [key for key, day in before.days.items() if len(day.pieces) >= MOST_PIECES]
    if crowded:
        held = snapshots.on_keys(spark, layout.ledger, LEDGER, crowded, before)
        rows = newest(held.union(rows)).withColumn("bucket", bucket())
    _add(spark, layout, rows, silver, before, crowded)
