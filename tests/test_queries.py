"""Registered queries against their SQL; all of them with MICROBOOK_ALL=1 (or use tools/check.py)."""

import os

import pytest

import __spark_entry__ as contract
from microbook.plans import ordered
from microbook.queries import tables
from tools.check import compare

SF = "/root/testdata/sf0.001"
SOME = ["bars_trades", "book_snapshots_blocks", "clean_flags", "quality_report", "features_v2_blocks", "scaler_transform",
        "split_by_segment", "pnl_blocks", "envelope_parse", "stream_bars"]
NAMES = list(contract.queries()) if os.environ.get("MICROBOOK_ALL") else SOME

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    ok, note = compare(spark, SF, name)
    assert ok, note


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["symbol", "bucket", "open", "high", "low", "close", "volume", "vwap", "number_of_trades"]


def test_decisions_and_sql_compare_the_move_itself(spark, tmp_path):
    """Moves just past the threshold, which the six digits of the error do not show."""
    import duckdb

    prices = [1000.0, 1001.0002, 1000.0, 998.9998, 1000.0, 1001.0, 0.0, 5.0]
    rows = [(i, f"2024-01-01 00:00:{i:02d}", 2 * i, "a", p, '{"k": 1}') for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    df.selectExpr("event_id", "cast(ts as timestamp_ntz) as ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    got = contract.queries()["decisions"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    found = con.execute(contract.oracle_sql()["decisions"])
    names = [d[0] for d in found.description]
    assert sorted(map(tuple, got.select(names).collect()), key=str) == sorted(found.fetchall(), key=str)
    actions = [r.action for r in got.orderBy("seq").collect()]
    assert actions == ["BUY", "HOLD", "SELL", "BUY", "HOLD", "SELL", "HOLD", "HOLD"]


def test_snapshots_measure_the_changes_once(spark, monkeypatch):
    taken, layout = [], ordered.layout
    monkeypatch.setattr(ordered, "layout", lambda df, *more: taken.append(df.columns) or layout(df, *more))
    assert tables.build_snapshots(spark, SF).count() > 0 and len(taken) == 1
