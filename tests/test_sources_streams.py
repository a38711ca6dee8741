"""Files written and read back, and streams against batches."""

import json

import pytest
from pyspark.sql import functions as F

from microbook.operators import bars, features, normalize
from microbook.sources import clean, raw
from microbook.sources import features as feature_files
from microbook.streaming import feature_stream, ingest, windows

BASE = 1_705_320_000_000_000


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def write_lines(path, name, *records):
    with open(f"{path}/{name}", "w") as out:
        out.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def trade(i, symbol="A", **more):
    return {"exchange_ts": BASE + i, "local_ts": BASE + i + 5, "type": "trade", "symbol": symbol,
            "trade": {"trade_id": i, "price": str(100 + i), "quantity": "2", "buyer_is_maker": i % 2 == 0}, **more}


def test_raw_scan(spark, folder):
    footer = {"_footer": {"closed_at": "x", "bytes_written": 1, "stats": {"depth_messages": 0, "trade_messages": 2}}}
    write_lines(folder, "A_20240101_000000.jsonl", {"_header": {"version": "2.0"}}, trade(1), "{broken", trade(2), footer)
    write_lines(folder, "B_20240101_000000.jsonl", trade(3, "B"))
    every = raw.scan(spark, folder)
    assert raw.records(every).count() == 3 and raw.rejects(every).count() == 1 and raw.controls(every).count() == 2
    assert {r.symbol for r in raw.records(raw.scan(spark, folder, "B")).collect()} == {"B"}
    done = {r.file[-24:]: (r.complete, r.matches, r.records, r.broken_lines) for r in raw.reconcile(every).collect()}
    assert done == {"/A_20240101_000000.jsonl": (True, True, 2, 1), "/B_20240101_000000.jsonl": (False, False, 1, 0)}
    assert [r.n_lines for r in raw.list_files(every).collect()] == [5, 1]


def test_envelope(spark):
    message = {"stream": "btcusdt@depth@100ms", "data": {"e": "depthUpdate", "E": 9, "T": 7, "s": "BTCUSDT", "U": 1, "u": 2, "pu": 0, "b": [["1", "2"]], "a": []}}
    df = spark.createDataFrame([(json.dumps(message), 5), ('{"stream": "x", "data": {}}', 6)], "value string, local_ts bigint")
    good, bad = raw.parse_envelopes(df).orderBy("local_ts").collect()
    assert (good.type, good.exchange_ts, good.first_update_id, good.last_update_id, good.bids) == ("depth", 7000, 1, 2, [["1", "2"]])
    assert good._corrupt is None and bad._corrupt is not None


def test_land_by_hour(spark, folder):
    df = spark.createDataFrame([("A", BASE + i * 1_800_000_000, "trade") for i in range(4)], "symbol string, exchange_ts bigint, type string")
    raw.land(df, folder + "/landed")
    back = spark.read.parquet(folder + "/landed")
    assert back.count() == 4 and back.select("date", "hour").distinct().count() == 2


def test_clean_range_prunes_dates(spark, folder):
    df = spark.range(10).select(F.lit("A").alias("symbol"), (F.lit(BASE) + F.col("id") * 43_200_000_000).alias("ts"), F.col("id").alias("seq"))
    clean.write(df, folder + "/clean")
    part = clean.read_range(spark, folder + "/clean", BASE, BASE + 86_400_000_000)
    assert part.count() == 3
    plan = part._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan or "date#" in plan.split("PartitionFilters")[1][:200]


def test_feature_sink_observes(spark, folder):
    df = spark.createDataFrame([("A", BASE, 20_000.0)], "symbol string, ts bigint, spread_bps double")
    stats = feature_files.write(df, folder + "/f")
    assert stats["rows"] == 1 and stats["warnings"] == ["midprice missing", "spread above limit"]
    assert feature_files.schema(spark, folder + "/f")["spread_bps"] == "double"


def test_manifest_files(spark, folder):
    manifest = normalize.fit_standard(spark.createDataFrame([(1.0,), (3.0,)], "ofi double"), ["ofi"])
    feature_files.save_manifest(manifest, folder + "/m", {"normalize": "zscore"})
    loaded, config = feature_files.load_manifest(spark, folder + "/m")
    assert loaded.collect() == manifest.collect() and config == {"normalize": "zscore"}


def stream_trades(spark, folder, late):
    return ingest.with_event_time(ingest.stream_table(spark, folder + "/in", 1), late=late)


def test_bars_of_stream_and_batch(spark, folder):
    rows = spark.range(600).select(
        F.lit("A").alias("symbol"), (F.lit(BASE) + F.col("id") * 1_000_000).alias("ts"), F.col("id").alias("seq"),
        (100 + F.col("id") % 7).cast("double").alias("price"), F.lit(1.0).alias("qty"))
    assert ingest.land_in_slices(rows, folder + "/in", "ts", at_least=5) == 5
    query = windows.stream_bars(stream_trades(spark, folder, "1 second"), "1 minute")
    ingest.drain(query, folder + "/out", folder + "/cp")
    got = spark.read.parquet(folder + "/out")
    wanted = bars.trade_bars(rows, 60_000_000)
    assert got.count() >= 9
    assert got.select(sorted(got.columns)).exceptAll(wanted.select(sorted(got.columns))).count() == 0
    # nothing new: a second run adds nothing
    ingest.drain(windows.stream_bars(stream_trades(spark, folder, "1 second"), "1 minute"), folder + "/out", folder + "/cp")
    assert spark.read.parquet(folder + "/out").count() == got.count()


def test_late_rows_are_dropped(spark, folder):
    def add(i, ts):
        spark.createDataFrame([("A", BASE + ts, i, 1.0, 1.0)], "symbol string, ts bigint, seq bigint, price double, qty double").coalesce(1).write.mode("append").parquet(folder + "/in")

    for i, ts in enumerate([0, 600_000_000, 700_000_000, 1_000_000, 1_200_000_000]):
        add(i, ts)
    ingest.drain(windows.stream_bars(stream_trades(spark, folder, "10 seconds"), "1 minute"), folder + "/out", folder + "/cp")
    assert {r.number_of_trades for r in spark.read.parquet(folder + "/out").collect()} == {1}


def test_streamed_features_equal_batch(spark, folder):
    i = F.col("id")
    rows = spark.range(700).select(
        F.when(i % 4 == 0, "A").otherwise("B").alias("symbol"), (F.lit(BASE) + i * 100_000).alias("ts"), i.alias("seq"),
        *[(100 + F.lit(s) * j + i * 13 % 5 * 0.1).alias(f"{n}_px_{j:02d}") for n, s in (("bid", -1), ("ask", 1)) for j in range(1, 6)],
        *[(i * (j + 3) % 11 + 1).cast("double").alias(f"{n}_sz_{j:02d}") for n in ("bid", "ask") for j in range(1, 6)],
        (i * 2.0).alias("taker_buy_vol"), (i * 1.5).alias("taker_sell_vol"))
    ingest.land_in_slices(rows, folder + "/in", "ts", at_least=3)
    ingest.drain_batches(
        ingest.stream_table(spark, folder + "/in", 1),
        lambda b, n: feature_stream.feature_batch(b, n, folder + "/out", folder + "/history"), folder + "/cp")
    names = ["ofi", "ofi_10", "ofi_cumulative", "volatility_100", "kyle_lambda", "vpin"]
    a = features.all_features(rows).select("seq", *names).orderBy("seq").toPandas()
    b = spark.read.parquet(folder + "/out").select("seq", *names).orderBy("seq").toPandas()
    assert len(a) == len(b) == 700
    for name in names:
        assert (a[name].isna() == b[name].isna()).all() and (a[name] - b[name]).abs().max() < 1e-9, name
