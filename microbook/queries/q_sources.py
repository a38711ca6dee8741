"""Queries that write derived data to the shared folder and read it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from microbook.operators import bars, features, normalize, quality
from microbook.plans.ordered import DEFAULT, over_rows
from microbook.queries.q_features import MICRO, MID
from microbook.queries.q_training import STANDARD, TRAIN, scaling_table, training_table
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import CLEAN, DELTAS, HOUR, PREDICTIONS, SNAPSHOTS, TRADES, clean_rows, deltas, predictions, snapshots, trades
from microbook.session import shared_dir
from microbook.sources import clean, raw
from microbook.sources import features as feature_files


def fresh(spark, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def trade_records(spark, sf):
    """Trades as raw records."""
    t = trades(spark, sf)
    trade = F.struct(
        F.col("seq").alias("trade_id"), F.col("price").cast("string").alias("price"),
        F.col("qty").cast("string").alias("quantity"), F.col("buyer_is_maker").alias("buyer_is_maker"),
    )
    return t.select(
        F.col("ts").alias("exchange_ts"), (F.col("ts") + F.col("seq") % 1000).alias("local_ts"), F.lit("trade").alias("type"),
        "symbol", trade.alias("trade"),
    )


def _line_files(spark, sf) -> str:
    """JSON-line files: every 50th line cut short, a footer with the trade count per symbol."""
    path = fresh(spark, "lines")
    r = trade_records(spark, sf)
    text = F.to_json(F.struct("exchange_ts", "local_ts", "type", "symbol", "trade"))
    cut = F.when(F.col("trade.trade_id") % 50 == 0, F.substring(text, 1, 30)).otherwise(text)
    lines = r.select("symbol", cut.alias("value"))
    stats = F.struct(F.struct(F.struct(F.lit(0).alias("depth_messages"), F.col("n").alias("trade_messages")).alias("stats")).alias("_footer"))
    whole = F.count_if(F.col("trade.trade_id") % 50 != 0).alias("n")
    footers = r.groupBy("symbol").agg(whole).select("symbol", F.to_json(stats).alias("value"))
    heads = r.select("symbol").distinct().select("symbol", F.to_json(F.struct(F.struct(F.lit("2.0").alias("version"), "symbol").alias("_header"))).alias("value"))
    every = lines.unionByName(footers).unionByName(heads).withColumnRenamed("symbol", "grp")
    every.write.partitionBy("grp").option("compression", "gzip").text(path)
    return path


def _scanned(spark, sf):
    return raw.scan(spark, _line_files(spark, sf), pattern="*")


@query("raw_scan", with_ctes(TRADES, "select seq, symbol, ts as exchange_ts, price, qty, buyer_is_maker from trades where seq % 50 <> 0"))
def raw_scan(spark, sf):
    """Compressed line files to trades; headers, footers and broken lines left out."""
    r = raw.records(_scanned(spark, sf))
    return raw.trade_view(r).select(F.col("trade_id").alias("seq"), "symbol", "exchange_ts", "price", "qty", "buyer_is_maker")


@query("raw_rejects", "select count(*) filter (where event_id % 50 = 0) as rejected, count(distinct event_type) * 2 as controls from events")
def raw_rejects(spark, sf):
    """Broken lines and control lines."""
    s = _scanned(spark, sf)
    broken = raw.rejects(s).agg(F.count(F.lit(1)).alias("rejected")).withColumn("k", F.lit(1))
    control = raw.controls(s).agg(F.count(F.lit(1)).alias("controls")).withColumn("k", F.lit(1))
    return broken.join(F.broadcast(control), "k").drop("k")


@query("raw_reconcile", with_ctes(TRADES, """select symbol as grp, count(*) filter (where seq % 50 <> 0) as records, count(*) filter (where seq % 50 = 0) as broken_lines,
 count(*) filter (where seq % 50 <> 0) as trade_stated, true as complete, true as matches from trades group by 1"""))
def raw_reconcile(spark, sf):
    """Records counted against the footer of their group of files."""
    s = _scanned(spark, sf).withColumn("grp", F.regexp_extract("file", "grp=([^/]+)/", 1))
    return raw.reconcile(s, "grp").select("grp", "records", "broken_lines", "trade_stated", "complete", "matches")


@query("raw_files", "select event_type as grp, count(*) + 2 as n_lines from events group by 1")
def raw_files(spark, sf):
    """Lines per group of files."""
    files = raw.list_files(_scanned(spark, sf))
    return files.groupBy(F.regexp_extract("file", "grp=([^/]+)/", 1).alias("grp")).agg(F.sum("n_lines").alias("n_lines"))


ENV = DELTAS + """, env as (select *, ['depth', 'trade', 'liquidation', 'kline', null][seq % 5 + 1] as kind, ts // 1000 as ms from deltas)"""


def envelopes(spark, sf):
    """Exchange messages made from level changes, five kinds in turn, the last one unknown."""
    d = deltas(spark, sf).withColumns({"ms": F.floor(F.col("ts") / 1000).cast("bigint"), "kind": F.col("seq") % 5})
    text = lambda c: F.col(c).cast("string")
    level = F.array(F.array(text("price"), text("size")))
    none = F.array().cast("array<array<string>>")
    bid = F.col("side") == "bid"
    event = F.col("ms").alias("E")

    def message(stream: str, *fields):
        return F.to_json(F.struct(F.concat(F.lower("symbol"), F.lit("@" + stream)).alias("stream"), F.struct(*fields).alias("data")))

    depth = message(
        "depth@100ms", F.lit("depthUpdate").alias("e"), event, F.col("ms").alias("T"), F.col("symbol").alias("s"), F.col("u").alias("U"),
        F.col("u").alias("u"), (F.col("u") - 1).alias("pu"), F.when(bid, level).otherwise(none).alias("b"), F.when(bid, none).otherwise(level).alias("a"),
    )
    trade = message(
        "trade", F.lit("trade").alias("e"), event, F.col("ms").alias("T"), F.col("symbol").alias("s"), F.col("seq").alias("t"),
        text("trade_px").alias("p"), text("trade_qty").alias("q"), F.col("buyer_is_maker").alias("m"),
    )
    order = F.struct(
        F.col("symbol").alias("s"), F.when(bid, "BUY").otherwise("SELL").alias("S"), text("trade_qty").alias("q"), text("price").alias("p"),
        text("trade_px").alias("ap"), F.lit("FILLED").alias("X"), F.col("ms").alias("T"),
    )
    forced = message("forceOrder", F.lit("forceOrder").alias("e"), event, order.alias("o"))
    bar = F.struct(
        F.lit("1m").alias("i"), text("price").alias("o"), text("trade_px").alias("c"), text("price").alias("h"), text("price").alias("l"),
        text("trade_qty").alias("v"), F.col("u").alias("n"), (F.col("seq") % 2 == 0).alias("x"),
    )
    kline = message("kline_1m", F.lit("kline").alias("e"), event, F.col("symbol").alias("s"), bar.alias("k"))
    other = message("bookTicker", event)
    value = F.when(F.col("kind") == 0, depth).when(F.col("kind") == 1, trade).when(F.col("kind") == 2, forced).when(F.col("kind") == 3, kline).otherwise(other)
    return raw.parse_envelopes(d.select(value.alias("value"), F.col("ts").alias("local_ts")))


@query("envelope_parse", with_ctes(ENV, """select ts as local_ts, kind as type, case when kind is not null then symbol end as symbol, case when kind is not null then ms * 1000 end as exchange_ts,
 case when kind = 'depth' then u end as last_update_id, case when kind = 'depth' then u - 1 end as prev_update_id,
 case when kind = 'depth' then (case when side = 'bid' then 1 else 0 end)::int end as n_bids, kind is null as rejected from env"""))
def envelope_parse(spark, sf):
    """Messages to typed records; unknown streams rejected."""
    return envelopes(spark, sf).select(
        "local_ts", "type", "symbol", "exchange_ts", "last_update_id", "prev_update_id",
        F.when(F.col("bids").isNotNull(), F.size("bids")).alias("n_bids"), F.col("_corrupt").isNotNull().alias("rejected"),
    )


@query("view_depth", with_ctes(ENV, "select symbol, ms * 1000 as exchange_ts, u as first_update_id, case when side = 'bid' then price end as bid, case when side = 'ask' then size end as ask_size from env where kind = 'depth'"))
def view_depth(spark, sf):
    v = raw.depth_view(envelopes(spark, sf))
    first = lambda c, i: F.try_element_at(c, F.lit(1))[i].cast("double")
    return v.select("symbol", "exchange_ts", "first_update_id", first("bids", 0).alias("bid"), first("asks", 1).alias("ask_size"))


@query("view_trades", with_ctes(ENV, "select symbol, ms * 1000 as exchange_ts, seq as trade_id, trade_px as price, trade_qty as qty, buyer_is_maker from env where kind = 'trade'"))
def view_trades(spark, sf):
    return raw.trade_view(envelopes(spark, sf)).drop("local_ts")


@query("view_liquidations", with_ctes(ENV, "select symbol, ms * 1000 as exchange_ts, case when side = 'bid' then 'BUY' else 'SELL' end as side, price, trade_qty as quantity, trade_px as avg_price, 'FILLED' as status from env where kind = 'liquidation'"))
def view_liquidations(spark, sf):
    return raw.liquidation_view(envelopes(spark, sf)).drop("local_ts")


@query("view_bars", with_ctes(ENV, "select symbol, ms * 1000 as exchange_ts, '1m' as interval, price as open, price as high, price as low, trade_px as close, trade_qty as volume, u as trades, seq % 2 = 0 as is_final from env where kind = 'kline'"))
def view_bars(spark, sf):
    return raw.bar_view(envelopes(spark, sf)).drop("local_ts")


@query("bars_exchange_final", with_ctes(ENV, "select symbol, ms * 1000 as exchange_ts, '1m' as interval, price as open, price as high, price as low, trade_px as close, trade_qty as volume, u as number_of_trades from env where kind = 'kline' and seq % 2 = 0"))
def bars_exchange_final(spark, sf):
    """Closed bars supplied by the exchange."""
    return bars.final_bars(envelopes(spark, sf))


@query("bars_reconciled", with_ctes(TRADES + """, a as (select symbol, ts - ts % 3600000000 as bucket, arg_max(price, (ts, seq)) as close, sum(qty) as volume from trades where price > 0 group by 1, 2),
 b as (select symbol, ts - ts % 3600000000 as bucket, arg_max(price, (ts, seq)) as close, sum(qty) as volume from trades where price > 0 and seq % 9 <> 0 group by 1, 2)""",
 "select symbol, bucket, a.close as close_a, a.volume as volume_a, b.close as close_b, b.volume as volume_b, a.close - b.close as close_diff, a.volume - b.volume as volume_diff from a full join b using (symbol, bucket)"))
def bars_reconciled(spark, sf):
    """Bars of all trades against bars that miss some."""
    t = trades(spark, sf)
    return bars.reconcile_bars(bars.trade_bars(t, HOUR), bars.trade_bars(t.filter(F.col("seq") % 9 != 0), HOUR))


@query("land_raw", with_ctes(TRADES, """select symbol, strftime(make_timestamp(ts), '%Y-%m-%d') as date, hour(make_timestamp(ts))::int as hour, count(*) as n, min(ts) as first_ts
 from trades where ts >= 1704844800000000 group by 1, 2, 3"""))
def land_raw(spark, sf):
    """Landing by symbol and date; the read prunes to dates from 10 January."""
    path = fresh(spark, "landed")
    raw.land(trade_records(spark, sf), path, by=("symbol", "date"))
    landed = spark.read.parquet(path).filter(F.col("date") >= "2024-01-10")
    return landed.groupBy("symbol", F.col("date").cast("string").alias("date"), "hour").agg(F.count(F.lit(1)).alias("n"), F.min("exchange_ts").alias("first_ts"))


START, END = 1_704_672_000_000_000, 1_705_276_800_000_000


@query("clean_write_range", with_ctes(CLEAN, f"select symbol, ts, seq, bid_px_01, ask_sz_10, last_trade_px from book where ts between {START} and {END}"))
def clean_write_range(spark, sf):
    """Write the clean table, read a week back with pruned partitions."""
    path = fresh(spark, "clean")
    clean.write(clean_rows(spark, sf), path)
    out = clean.read_range(spark, path, START, END)
    return out.select(F.col("symbol").cast("string").alias("symbol"), "ts", "seq", "bid_px_01", "ask_sz_10", "last_trade_px")


@query("clean_nested_round_trip", with_ctes(SNAPSHOTS, "select * exclude (pos) from snaps"))
def clean_nested_round_trip(spark, sf):
    """Wide rows to nested snapshots and back."""
    from microbook.operators.book import to_nested, to_wide

    return to_wide(to_nested(snapshots(spark, sf).drop("pos")))


@query("clean_manifest", with_ctes(CLEAN, f"""select symbol, min(ts) as start_ts, max(ts) as end_ts, count(*) as row_count, '2.0' as version, 3600000 as snapshot_interval_ms, 10 as order_book_depth,
 {snap_sql('(max(ts) - min(ts)) / 1e6::double', 'duration_sec', 3)} from book group by 1"""))
def clean_manifest(spark, sf):
    """The table's metadata rows."""
    return snapped(clean.manifest(clean_rows(spark, sf), 3_600_000, 10), "duration_sec", digits=3)


@query("features_write_read", with_ctes(CLEAN, f"select symbol, ts, {MID} as midprice, {snap_sql(MICRO, 'microprice')} from book where ts between {START} and {END}"))
def features_write_read(spark, sf):
    """Write features with their checks, read a range back."""
    path = fresh(spark, "features")
    feature_files.write(training_table(spark, sf), path)
    out = feature_files.read_range(spark, path, START, END)
    return snapped(out.select(F.col("symbol").cast("string").alias("symbol"), "ts", "midprice", "microprice"), "microprice")


@query("features_discover", with_ctes(CLEAN, f"select symbol, ts, {MID} as midprice from book"))
def features_discover(spark, sf):
    """Normalised files are preferred to plain ones, at depths 1, 2 and 4; plain ones in the folder itself are passed over."""
    path = fresh(spark, "mixed")
    df = training_table(spark, sf).select("symbol", "ts", "midprice")
    part = F.pmod(F.xxhash64("symbol", "ts"), F.lit(3))
    for i, folder in enumerate(("a", "b/c", "b/c/d/e")):
        df.filter(part == i).write.parquet(f"{path}/{folder}/normalized_features_{i}.parquet")
    df.filter(F.col("ts") < START).write.parquet(f"{path}/features_1.parquet")
    return feature_files.discover(spark, path)


@query("features_concat", with_ctes(CLEAN, f"select symbol, ts, {MID} as midprice, case when ts < {START} then bid_px_01 end as bid_px_01 from book"))
def features_concat(spark, sf):
    """Files with different columns, one table."""
    df = training_table(spark, sf)
    a = df.filter(F.col("ts") < START).select("symbol", "ts", "midprice", "bid_px_01")
    return feature_files.sorted_by_time(feature_files.concat(a, df.filter(F.col("ts") >= START).select("symbol", "ts", "midprice")))


@query("schema_drift", with_ctes(CLEAN + ", " + TRAIN, """select unnest(['midprice', 'ofi', 'ofi']) as name, unnest(['double', 'double', 'bigint']) as dtype, unnest(['removed', 'removed', 'added']) as change,
 unnest([count(midprice), count(ofi), count(ofi)]) as n_values from tr"""))
def schema_drift(spark, sf):
    """Two versions of the feature table's schema compared, with the values each changed column holds."""
    df = training_table(spark, sf)
    new = df.drop("midprice").withColumn("ofi", F.col("ofi").cast("bigint"))
    drift = feature_files.schema_drift(feature_files.schema_entries(df, "1"), feature_files.schema_entries(new, "2"))
    held = df.select("midprice", "ofi").unpivot([], ["midprice", "ofi"], "name", "value").groupBy("name").agg(F.count("value").alias("n_values"))
    return drift.join(F.broadcast(held), "name")


@query("manifest_round_trip", with_ctes(CLEAN + ", " + TRAIN, " union all ".join(
    f"select '{c}' as feature, 'standard' as scaler, {snap_sql(f'avg({c})', 'mean')}, {snap_sql(f'stddev_samp({c})', 'std')} from tr" for c in STANDARD)))
def manifest_round_trip(spark, sf):
    """Scaler statistics saved as JSON and loaded."""
    path = fresh(spark, "manifest")
    feature_files.save_manifest(normalize.fit_standard(scaling_table(spark, sf), STANDARD), path, {"normalize": "zscore"})
    loaded, _ = feature_files.load_manifest(spark, path)
    return snapped(loaded.select("feature", "scaler", "mean", "std"), "mean", "std")


@query("predictions_saved", with_ctes(PREDICTIONS, f"select symbol, ts, y as y_true, y_pred, {snap_sql('y - y_pred', 'residual')} from preds"))
def predictions_saved(spark, sf):
    """Predictions written and read."""
    path = fresh(spark, "predictions")
    feature_files.save_predictions(predictions(spark, sf), path)
    return snapped(spark.read.parquet(path), "residual")


@query("inspect_tail", with_ctes(CLEAN, f"select symbol, ts, {MID} as midprice from book order by ts desc, seq desc limit 5"))
def inspect_tail(spark, sf):
    """The last five rows by time."""
    return feature_files.inspect(training_table(spark, sf))["tail"].select("symbol", "ts", "midprice")


@query("inspect_describe", with_ctes(CLEAN, f"""select 'count' as summary, count(*)::double as midprice from book union all select 'min', min({MID}) from book union all select 'max', max({MID}) from book
 union all select 'mean', {snap_sql(f'avg({MID})', 'm')} from book union all select 'stddev', {snap_sql(f'stddev_samp({MID})', 's')} from book"""))
def inspect_describe(spark, sf):
    """Summary statistics of a column."""
    out = feature_files.inspect(training_table(spark, sf).select("ts", "midprice"))["describe"].select("summary", "midprice")
    value = F.col("midprice").cast("double")
    exact = F.col("summary").isin("count", "min", "max")
    from microbook.functions.expr import snap

    return out.select("summary", F.when(exact, value).otherwise(snap(value)).alias("midprice"))
