"""Export, bookmark, views and dashboards."""

from datetime import UTC, datetime, timedelta

import duckdb
import pytest
from conftest import at
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_silver_gold import deliver, held_days
from trades import payload, sorted_rows

from tradelake.plans import dashboards, export, gold, state
from tradelake.schemas import DATE_PARTS, PUBLISHED, STATS_TABLE, VWAP_TABLE, Layout, safe_name
from tradelake.sources.catalog import register_views
from tradelake.sources import snapshots
from tradelake.sources.tables import common_type, read_gold, union_by_name


def lake_rows(spark, layout, table=VWAP_TABLE):
    return sorted_rows(read_gold(spark, layout.lake(table), table).drop(*DATE_PARTS))


def gold_rows(spark, layout, table=VWAP_TABLE):
    return sorted_rows(gold.published(spark, layout, table))


def test_export_follows_gold(spark, layout):
    deliver(spark, layout, [payload("a", time=at(9, 23, 59)), payload("b", time=at(10)), payload("c", time=at(12))], at(20))
    first = export.run_export(spark, layout)
    assert [(r.ok, r.full, r.rows_written, r.rows_total, r.days) for r in first] == [(True, True, 3, 3, 3)] * 2
    assert held_days(spark, layout.lake(VWAP_TABLE)) == {f"year=2026/month=04/day={d}" for d in ("09", "10", "12")}
    files = read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE).inputFiles()
    assert len(files) == 3 and all(f.endswith(".snappy.parquet") for f in files)

    again = export.run_export(spark, layout)
    assert [(r.full, r.rows_written, r.rows_total) for r in again] == [(False, 0, 3)] * 2
    assert sorted(read_gold(spark, layout.lake(VWAP_TABLE), VWAP_TABLE).inputFiles()) == sorted(files)

    # a late trade, an open minute that grows, and a trade that moves to another day
    deliver(spark, layout, [payload("d", time=at(9, 1)), payload("e", price=7, time=at(10)), payload("c", time=at(10, 5))], at(21))
    third = export.run_export(spark, layout)
    assert [(r.full, r.rows_written, r.rows_total, r.days) for r in third] == [(False, 4, 4, 2)] * 2
    for table in PUBLISHED:
        assert lake_rows(spark, layout, table) == gold_rows(spark, layout, table)
    assert "year=2026/month=04/day=12" not in held_days(spark, layout.lake(VWAP_TABLE))
    rows = {r.table_name: r for r in state.read_export_state(spark, layout).collect()}
    assert rows[VWAP_TABLE].rows_exported == 4 and rows[VWAP_TABLE].rows_total == 4 and len(rows) == 2
    assert state.export_bookmark(spark, layout, VWAP_TABLE) == at(21, 0, 1)


def test_failure_is_isolated_and_named(spark, layout, monkeypatch):
    deliver(spark, layout, [payload("a")], at(20))
    real = export.full_export

    def failing(spark, layout, table):
        if table == VWAP_TABLE:
            raise OSError("disk full")
        return real(spark, layout, table)

    monkeypatch.setattr(export, "full_export", failing)
    with pytest.raises(export.ExportFailed, match=VWAP_TABLE) as caught:
        export.run_export(spark, layout)
    assert [(r.table, r.ok) for r in caught.value.reports] == [(VWAP_TABLE, False), (STATS_TABLE, True)]
    assert state.export_bookmark(spark, layout, VWAP_TABLE) is None
    assert state.export_bookmark(spark, layout, STATS_TABLE) is not None
    assert spark.table("vw_trade_stats_1min").count() == 1 and spark.table("vw_vwap_1min").count() == 0


def test_replica_copies_touched_days_and_may_fail(spark, layout, tmp_path):
    deliver(spark, layout, [payload("a", time=at(9)), payload("b", time=at(10))], at(20))
    replica = str(tmp_path / "replica")
    assert all(r.replica_error is None for r in export.run_export(spark, layout, replica=replica))
    copied = read_gold(spark, Layout(replica).lake(VWAP_TABLE), VWAP_TABLE).drop(*DATE_PARTS)
    assert sorted_rows(copied) == lake_rows(spark, layout)
    deliver(spark, layout, [payload("c", time=at(10, 1))], at(21))
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    reports = export.run_export(spark, layout, replica=str(blocked))
    assert all(r.ok and r.rows_written == 2 and r.replica_error for r in reports)
    # the next good run makes up for it, and days that went away go away there
    deliver(spark, layout, [payload("a", time=at(12))], at(22))
    assert all(r.replica_error is None for r in export.run_export(spark, layout, replica=replica))
    for table in PUBLISHED:
        copied = read_gold(spark, Layout(replica).lake(table), table).drop(*DATE_PARTS)
        assert sorted_rows(copied) == lake_rows(spark, layout, table)
    assert held_days(spark, Layout(replica).lake(VWAP_TABLE)) == held_days(spark, layout.lake(VWAP_TABLE))
    before = snapshots.current(spark, Layout(replica).lake(VWAP_TABLE)).number
    export.run_export(spark, layout, replica=replica)
    assert snapshots.current(spark, Layout(replica).lake(VWAP_TABLE)).number == before


def test_missing_source_leaves_no_output(spark, layout):
    reports = export.run_export(spark, layout)
    assert all(r.ok and r.rows_written == 0 for r in reports)
    assert export.row_count(spark, layout, VWAP_TABLE) == 0
    assert state.export_bookmark(spark, layout, VWAP_TABLE) is None


@pytest.mark.parametrize("name", ["a;drop table b", "a b", "../x", "1a", "", "a\n"])
def test_unsafe_names_are_refused(spark, layout, name):
    with pytest.raises(ValueError, match="unsafe"):
        export.full_export(spark, layout, name)
    assert safe_name("gold_vwap_1min") == "gold_vwap_1min"


def test_bookmark_upsert(spark, layout):
    with pytest.raises(ValueError, match="timezone-aware"):
        state.upsert_export_state(spark, layout, VWAP_TABLE, datetime(2026, 4, 1), 1, 1)
    state.upsert_export_state(spark, layout, VWAP_TABLE, at(1), 1, 1)
    state.upsert_export_state(spark, layout, STATS_TABLE, at(2), 2, 2)
    state.upsert_export_state(spark, layout, VWAP_TABLE, at(3, 1, 2, 3), 5, 9)
    rows = sorted_rows(state.read_export_state(spark, layout), "table_name", "rows_exported", "rows_total")
    assert rows == [(STATS_TABLE, 2, 2), (VWAP_TABLE, 5, 9)]
    assert state.export_bookmark(spark, layout, VWAP_TABLE) == at(3, 1, 2, 3)
    assert state.export_bookmark(spark, layout, "other") is None


def test_views_over_nothing_have_columns_and_are_replaceable(spark, layout):
    assert register_views(spark, layout) == ["vw_vwap_1min", "vw_trade_stats_1min"]
    register_views(spark, layout)
    assert spark.sql("select window_start, vwap, total_volume, trade_count, high_price, low_price from vw_vwap_1min").collect() == []
    assert spark.sql("select window_start, volatility, buy_count, sell_count, buy_volume_pct from vw_trade_stats_1min").collect() == []


def test_files_of_an_older_schema_read_as_null(spark, layout):
    deliver(spark, layout, [payload("a", time=at(9)), payload("b", time=at(10))], at(20))
    export.run_export(spark, layout)
    root = layout.lake(VWAP_TABLE)
    old = spark.sql("select timestamp'2026-04-01 10:00:00' window_start, 5.0D vwap, '2026' year, '04' month, '01' day")
    pieces = snapshots.write(old, root, DATE_PARTS, [], "window_start")
    snapshots.commit(spark, root, snapshots.current(spark, root), pieces)
    df = read_gold(spark, root, VWAP_TABLE)
    assert df.count() == 3 and df.filter("trade_count is null").select("vwap").first().vwap == 5.0


def test_union_by_name_widens_types(spark, tmp_path):
    """Files of three versions, against the same reader of DuckDB."""
    root = str(tmp_path / "versions")
    for i, columns in enumerate([
        "1 id, cast(7 as int) n, cast(1.25 as decimal(10,2)) price, cast(3 as smallint) k, date'2026-04-01' at",
        "2 id, cast(5000000000 as bigint) n, cast(2.12345678 as decimal(18,8)) price, cast(0.5 as float) k, timestamp'2026-04-02 03:04:05' at",
        "3 id, cast(9 as tinyint) n, 'late' extra, cast(2.5 as double) k",
    ]):
        spark.sql(f"select {columns}").coalesce(1).write.parquet(f"{root}/part={i}")
    df = union_by_name(spark, root)
    assert dict(df.dtypes) == {"id": "int", "n": "bigint", "price": "decimal(18,8)", "k": "double", "at": "timestamp", "extra": "string", "part": "int"}
    rows = sorted(tuple(r) for r in df.select("id", "n", "price", "k", "extra").collect())
    con = duckdb.connect()
    want = con.execute(f"SELECT id, n, price, k, extra FROM read_parquet('{root}/*/*.parquet', union_by_name = true) ORDER BY id").fetchall()
    assert rows == want and [r.at for r in df.orderBy("id").collect()] == [datetime(2026, 4, 1), datetime(2026, 4, 2, 3, 4, 5), None]


def test_common_types():
    pairs = {("int", "bigint"): "bigint", ("decimal(10,2)", "decimal(18,8)"): "decimal(18,8)", ("bigint", "decimal(4,2)"): "decimal(21,2)",
             ("decimal(38,2)", "decimal(38,30)"): "double", ("int", "float"): "double", ("int", "string"): "string", ("date", "string"): "string"}
    for (a, b), want in pairs.items():
        types = [T._parse_datatype_string(t) if hasattr(T, "_parse_datatype_string") else T.DataType.fromDDL(t) for t in (a, b)]
        assert common_type(*types).simpleString() == common_type(*types[::-1]).simpleString() == want


# Windows around an hour that ends at half past one, and whether the chart of that hour shows them.
AROUND = {
    at(10, 0, 29): False, at(10, 0, 30): False,  # before the bound, and on it
    at(10, 0, 31): True, at(10, 1, 0): True, at(10, 1, 29): True,
    at(10, 1, 30): True, at(10, 1, 31): False,  # the moment asked for, and after it
    at(9, 23, 59): False, at(11, 0, 0): False,  # the days next to it
}

# The chart queries as a dashboard user writes them.
CHARTS = {
    "vwap": "SELECT window_start, vwap FROM vw_vwap_1min {}",
    "volume": "SELECT window_start, total_volume FROM vw_vwap_1min {}",
    "pressure": "SELECT window_start, buy_volume_pct, (100 - buy_volume_pct) AS sell_volume_pct FROM vw_trade_stats_1min {}",
    "volatility": "SELECT window_start, volatility FROM vw_trade_stats_1min {}",
}


def test_charts(spark, layout):
    as_of = at(10, 1, 30)
    texts = []
    for n, moment in enumerate(AROUND):
        for m in range(n % 3 + 1):
            texts.append(payload(f"{n}-{m}", 50 + 3 * n + m, 1 + (n + m) % 4, "sell" if m % 2 else "buy", moment + timedelta(seconds=59 * (m % 2))))
    deliver(spark, layout, texts, at(20))
    export.run_export(spark, layout)
    bounds = "WHERE window_start > timestamp'2026-04-10 00:30:00' AND window_start <= timestamp'2026-04-10 01:30:00' ORDER BY window_start"
    for name, sql in CHARTS.items():
        recent = dashboards.recent(spark, layout, name, as_of=as_of)
        want = spark.sql(sql.format(bounds))
        assert recent.columns == want.columns and recent.collect() == want.collect()
        assert [r.window_start.replace(tzinfo=UTC) for r in recent.collect()] == sorted(m for m, shown in AROUND.items() if shown)
        for n in (1, 4, 20):
            assert dashboards.latest(spark, layout, name, n).collect() == spark.sql(sql.format(f"ORDER BY window_start DESC LIMIT {n}")).collect()
    shares = dashboards.recent(spark, layout, "pressure", as_of=as_of)
    assert shares.filter(F.abs(F.col("buy_volume_pct") + F.col("sell_volume_pct") - 100) > 0.001).count() == 0
    assert dashboards.recent(spark, layout, "vwap", as_of=as_of, minutes=61).count() == 5
    assert dashboards.recent(spark, layout, "vwap").count() == 0
    assert {m for m in held_days(spark, layout.lake(VWAP_TABLE))} == {f"year=2026/month=04/day={d}" for d in ("09", "10", "11")}
