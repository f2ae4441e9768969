"""Typed layer: one row per trade, kept up to date incrementally."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.dates import day_of
from tradelake.functions.ranges import merged, ranges_of
from tradelake.operators.absent import id_bytes
from tradelake.operators.dedup import keep_one
from tradelake.operators.merge import merged_rows
from tradelake.plans import ledger
from tradelake.plans.bronze import batches
from tradelake.plans.ledger import RECENCY
from tradelake.plans.quarantine import quarantine
from tradelake.plans.repeats import once_and_again
from tradelake.schemas import PAYLOAD, PRICE, SILVER, Layout
from tradelake.sources import snapshots
from tradelake.sources.tables import distinct_days, staged

# A day of so many pieces is written anew as one when it gains rows.
MOST_PIECES = 16


@dataclass(frozen=True)
class UpsertReport:
    days: list[date]
    inserted_or_changed: int
    quarantined: int
    full: bool


def _known(mode: str) -> None:
    if mode not in ("strict", "quarantine"):
        raise ValueError(f"unknown mode: {mode!r}")


def parse(bronze: DataFrame, mode: str = "strict", keep: Sequence[str] = ()) -> DataFrame:
    """payload -> typed trade columns, for rows that have a trade_id.

    ``strict`` raises on a value that does not cast. ``quarantine`` keeps such
    rows, with the broken members listed in ``reasons`` (NULL for a good row).
    The id test uses the stored column, so it reaches the scan; the inline keeps
    the payload from being parsed more than once per row. ``keep`` names bronze columns
    to carry along.
    """
    _known(mode)
    fields = T.StructType([f for f in PAYLOAD.fields if f.name != "trade_id"])
    rows = bronze.filter(F.col("trade_id").isNotNull()).select(
        "trade_id", F.col("received_at").alias("ingested_at"), "payload", *keep, F.inline(F.array(F.from_json("payload", fields)))
    )
    typed = {"price": PRICE, "size": PRICE, "time": "timestamp"}
    values = {n: F.col(n).cast(t) if mode == "strict" else F.col(n).try_cast(t) for n, t in typed.items()}
    trades = [
        "trade_id", "product_id", values["price"].alias("price"), values["size"].alias("size"), "side",
        values["time"].alias("traded_at"), "ingested_at", *keep,
    ]
    if mode == "strict":
        return rows.select(*trades)
    broken = F.concat_ws(",", *[
        F.when(F.col(n).isNotNull() & values[n].isNull(), f"{n}_not_castable") for n in typed
    ])
    return rows.select(*trades, "payload", F.when(broken != "", F.split(broken, ",")).alias("reasons"))


def latest_trades(trades: DataFrame) -> DataFrame:
    """One row per trade_id: the most recently received version."""
    return keep_one(trades, "trade_id", [F.desc(c) for c in RECENCY])


@contextmanager
def _latest_typed(arrivals: DataFrame, mode: str, seen: Observation, small: bool = False) -> Iterator[DataFrame]:
    """Latest version of each trade; of many arrivals in strict mode only those of ids that come again are compared."""
    if small or mode != "strict":  # broken rows are counted on one way through the parse
        yield latest_trades(_typed(arrivals, mode, seen))
        return
    with once_and_again(arrivals) as (once, again):
        parts = [] if once is None else [_typed(once, mode, seen)]
        if again is not None:
            parts.append(latest_trades(_typed(again, mode, seen)))
        yield reduce(DataFrame.unionByName, parts)


def _silver_columns(trades: DataFrame) -> DataFrame:
    return trades.withColumn("trade_date", day_of("traded_at")).select(*SILVER.names)


def _stamps(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count(F.lit(1)).alias("rows"), id_bytes().alias("bytes"))


def _typed(arrivals: DataFrame, mode: str, seen: Observation) -> DataFrame:
    """Castable trades; broken ones are only counted on the way."""
    if mode == "strict":
        return parse(arrivals, mode)
    parsed = parse(arrivals, mode).observe(seen, F.count_if(F.col("reasons").isNotNull()).alias("broken"))
    return parsed.filter("reasons is null").drop("reasons", "payload")


def _set_broken_aside(arrivals: DataFrame, layout: Layout, mode: str, seen: Observation) -> int:
    """A second pass over the payloads, only when the first one met broken rows.

    A bronze batch is a quarantine batch. It is taken as a whole, so when a run that
    died takes it again, its rows replace themselves.
    """
    if mode == "strict" or not seen.get.get("broken"):
        return 0
    numbered = F.concat(F.lit("silver-"), F.lpad(F.col("batch").cast("string"), 12, "0")).alias("batch_id")
    broken = parse(arrivals, mode, ["batch"]).filter("reasons is not null").select(
        F.col("payload").alias("raw"), "reasons", F.col("ingested_at").alias("received_at"), numbered)
    with staged(broken, "broken") as rows:
        quarantine(rows, layout)
        return rows.count()


def rebuild(spark: SparkSession, layout: Layout, run_at: datetime, mode: str = "strict") -> UpsertReport:
    """Full refresh from all of bronze, in one commit; empty bronze empties silver."""
    _known(mode)
    bronze = batches(spark, layout)
    before = snapshots.current(spark, layout.silver)
    seen = Observation()
    with _latest_typed(bronze, mode, seen) as table:
        pieces = snapshots.write(_silver_columns(table), layout.silver, "trade_date", ["traded_at"], "traded_at")
    broken = _set_broken_aside(bronze, layout, mode, seen)
    after = snapshots.commit(spark, layout.silver, before, pieces, None, {"taken": ranges_of(bronze, "batch")})
    ledger.rebuild(spark, layout, after, all_placed=not broken)
    changed = after.changed_since(after.number - 1)
    return UpsertReport([snapshots.key_day(key) for key in changed], after.rows, broken, True)


def upsert(spark: SparkSession, layout: Layout, run_at: datetime, mode: str = "strict") -> UpsertReport:
    """Bring silver up to date with the bronze batches not taken yet.

    The result equals a full rebuild, whatever the stamps of the rows and the order
    in which they were committed. Rows and the numbers of the batches behind them become visible in one
    commit, so a run that dies is simply run again. Days that only gain trades get a
    further piece; days that hold an older version of a trade, also when
    the newer version moved to another day, and days of many pieces are written anew.
    Older versions are found by the ledger, so silver itself is read on those days only.
    """
    _known(mode)
    before = snapshots.current(spark, layout.silver)
    if before is None:
        return rebuild(spark, layout, run_at, mode)
    taken = before.notes.get("taken", [])
    arrivals = batches(spark, layout, taken)
    measured = _stamps(arrivals).first()
    if not measured.rows:
        return UpsertReport([], 0, 0, False)

    seen = Observation()
    ledger.follow(spark, layout, before)  # does nothing, unless the last run died before it
    stored = ledger.looked_up(spark, layout, arrivals, measured.rows, measured.bytes).select(
        "trade_id", F.col("trade_date").alias("_old_date"), F.col("version").alias("_old")
    )
    newer = F.col("_old").isNull() | (F.struct(*RECENCY) > F.col("_old"))

    with ExitStack() as steps:
        incoming = _silver_columns(steps.enter_context(_latest_typed(arrivals, mode, seen, measured.rows <= ledger.LITERAL_IDS)))
        changed = incoming.join(stored, "trade_id", "left").filter(newer).drop("_old")
        rows = steps.enter_context(staged(changed, "silver-changed"))
        key = lambda day: snapshots.day_key("trade_date", day)
        touched = {key(day) for day in distinct_days(rows, "trade_date")}
        crowded = {k for k in touched if k in before.days and len(before.days[k].pieces) >= MOST_PIECES}
        rewrite = crowded | {key(day) for day in distinct_days(rows, "_old_date")}
        fresh = rows.drop("_old_date")
        held = snapshots.on_keys(spark, layout.silver, SILVER, rewrite, before)
        pieces = snapshots.write(merged_rows(held, fresh, "trade_id"), layout.silver, "trade_date", ["traded_at"], "traded_at")
        count = rows.count()
        broken = _set_broken_aside(arrivals, layout, mode, seen)
        notes = {"taken": merged(taken, ranges_of(arrivals, "batch"))}
        after = snapshots.commit(spark, layout.silver, before, pieces, rewrite, notes)
        ledger.follow(spark, layout, after, before, fresh, arrivals if broken else None)
    days = [snapshots.key_day(k) for k in after.changed_since(before.number)]
    return UpsertReport(days, count, broken, False)
