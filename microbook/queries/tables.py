"""The given tables presented as market data, in Spark and as SQL common table expressions."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.functions.timeutil import to_micros
from microbook.operators import book
from microbook.plans.ordered import DEFAULT, Order, over_rows, row_index
from microbook.session import configure, cut_lineage, shared_dir

HOUR = 3_600_000_000
DEPTH = 10
# lineitem as a trade table: equal days are ordered by the order key and its line
LINES = Order(("symbol",), "ts", ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), None, 31 * 24 * HOUR)


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def trades(spark: SparkSession, sf: str) -> DataFrame:
    """One trade per event."""
    e = read(spark, sf, "events")
    return e.select(
        F.col("event_type").alias("symbol"), to_micros(F.col("ts")).alias("ts"), F.col("event_id").alias("seq"),
        F.col("value").alias("price"), F.get_json_object("props", "$.k").cast("double").alias("qty"),
        (F.col("user_id") % 2 == 0).alias("buyer_is_maker"),
    )


TRADES = """trades as (
  select event_type as symbol, epoch_us(ts) as ts, event_id as seq, value as price,
         cast(json_extract_string(props, '$.k') as double) as qty, (user_id % 2 = 0) as buyer_is_maker
  from events)"""


def deltas(spark: SparkSession, sf: str, order: Order = DEFAULT, price: Column | None = None) -> DataFrame:
    """One level change per event; `u` numbers the changes of a symbol. `price` replaces the twelve prices a side."""
    return row_index(changes(spark, sf, price), order, "u")


def changes(spark: SparkSession, sf: str, price: Column | None = None) -> DataFrame:
    """The rows of `deltas` without their number."""
    e = read(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    slot = F.col("user_id") % 12
    bid = F.col("event_id") % 2 == 0
    side = F.when(bid, "bid").otherwise("ask")
    away = slot.cast("double") * 0.5
    gone = (k % 7 == 0) | ((slot == 0) & (k % 3 != 0))
    return e.select(
        F.col("event_type").alias("symbol"), to_micros(F.col("ts")).alias("ts"), F.col("event_id").alias("seq"),
        side.alias("side"),
        (F.when(bid, F.lit(100.0) - away).otherwise(F.lit(100.0) + away) if price is None else price).alias("price"),
        F.when(gone, 0.0).otherwise(k.cast("double")).alias("size"),
        F.col("value").alias("trade_px"), k.cast("double").alias("trade_qty"),
        (F.col("user_id") % 2 == 0).alias("buyer_is_maker"),
    )


DELTAS = """deltas as (
  select *, row_number() over (partition by symbol order by ts, seq) as u from (
    select event_type as symbol, epoch_us(ts) as ts, event_id as seq,
      case when event_id % 2 = 0 then 'bid' else 'ask' end as side,
      case when event_id % 2 = 0 then 100.0::double - (user_id % 12) * 0.5::double
           else 100.0::double + (user_id % 12) * 0.5::double end as price,
      case when k % 7 = 0 or (user_id % 12 = 0 and k % 3 <> 0) then 0.0::double else k::double end as size,
      value as trade_px, k::double as trade_qty, (user_id % 2 = 0) as buyer_is_maker
    from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)))"""


_STORED: dict[tuple[str, str, str], str] = {}


def stored_path(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> str:
    """Folder of a derived table, written once per application to the shared folder.

    Feature and quality queries start from the clean table, as a pipeline of stages would.
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _STORED[key] = path
    return _STORED[key]


def stored(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, read from where `stored_path` put it."""
    return spark.read.parquet(stored_path(spark, sf, name, build))


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """The stored form of `build_snapshots`."""
    return stored(spark, sf, "snapshots", lambda: build_snapshots(spark, sf))


def build_snapshots(
    spark: SparkSession, sf: str, depth: int = DEPTH, block: int = book.BLOCK, order: Order = DEFAULT, emit: str = "grid",
) -> DataFrame:
    """The book at the first event of each symbol-hour with two open sides, with that event's trade state.

    `emit` may also be greedy (an hour from the last one taken), or any (the first event of the hour whatever its book).
    """
    d = cut_lineage(book.trade_state(changes(spark, sf), order, more={"pos": ("count", F.lit(1))}))
    events = d.select("symbol", "ts", "seq", "pos", "last_trade_px", "last_trade_qty", "taker_buy_vol", "taker_sell_vol")
    if emit == "any":
        ticks = book.grid_ticks(events, HOUR, order)
    else:
        ticks = (book.greedy_ticks if emit == "greedy" else book.two_sided_ticks)(events, d, HOUR, order, block=block)
    return book.book_at(d, ticks, depth, block=block)


def _wide_sql(depth: int = DEPTH) -> str:
    parts = []
    for side in ("bid", "ask"):
        for i in range(1, depth + 1):
            for what, value in (("px", "price"), ("sz", "size")):
                parts.append(f"max(case when side = '{side}' and lvl = {i} then {value} end) as {side}_{what}_{i:02d}")
    return ",\n    ".join(parts)


_BOOK = DELTAS + """,
spans as (
  select symbol, side, price, size, u as lo, lead(u) over (partition by symbol, side, price order by u) as hi from deltas),
flow as (
  select *, sum(case when not buyer_is_maker then trade_qty else 0 end) over w as taker_buy_vol,
            sum(case when buyer_is_maker then trade_qty else 0 end) over w as taker_sell_vol
  from deltas window w as (partition by symbol order by u rows between unbounded preceding and current row)),
steps as (
  select symbol, u, side, (size <> 0)::int - coalesce(lag(size) over (partition by symbol, side, price order by u) <> 0, false)::int as step from deltas),
sides as (
  select symbol, u, sum(case when side = 'bid' then step else 0 end) over w > 0 and sum(case when side = 'ask' then step else 0 end) over w > 0 as two_sided
  from steps window w as (partition by symbol order by u)),
ticks as (
  select symbol, ts, seq, u as pos, trade_px as last_trade_px, trade_qty as last_trade_qty, taker_buy_vol, taker_sell_vol
  from (select flow.*, row_number() over (partition by symbol, ts - ts % 3600000000 order by ts, seq) as rn
    from flow join sides using (symbol, u) where two_sided) where rn = 1),
held as (
  select t.*, s.side, s.price, s.size,
    row_number() over (partition by t.symbol, t.pos, s.side
      order by case when s.side = 'bid' then -s.price else s.price end) as lvl
  from ticks t left join spans s on s.symbol = t.symbol and s.size <> 0 and s.lo <= t.pos and (s.hi is null or t.pos < s.hi)),
snaps as (
  select symbol, ts, seq, pos, last_trade_px, last_trade_qty, taker_buy_vol, taker_sell_vol,
    """ + _wide_sql() + """
  from held group by all)"""
# the book at the first event of each hour, whether it has two sides or not
EVERY_HOUR = _BOOK.replace("join sides using (symbol, u) where two_sided", "")
SNAPSHOTS = _BOOK


def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots with both sides: the input of the feature operators."""
    return book.initialised(snapshots(spark, sf)).drop("pos")


CLEAN = SNAPSHOTS + """,
book as (select * exclude (pos) from snaps where bid_px_01 is not null and ask_px_01 is not null)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Integer targets (next price change in cents) and pseudo-random predictions per trade."""
    t = trades(spark, sf).withColumn("cents", F.floor(F.col("price") * 100 + F.lit(0.5)).cast("bigint"))
    t = over_rows(
        t, lambda d, w: d.withColumn("y", (F.lead("cents").over(w) - F.col("cents")).cast("double")), DEFAULT, ahead=1
    )
    guess = ((F.col("seq") * 7919) % 2001 - 1000) / F.lit(100.0)
    return t.filter(F.col("y").isNotNull()).select("symbol", "ts", "seq", "price", "y", guess.alias("y_pred"))


PREDICTIONS = TRADES + """,
preds as (
  select symbol, ts, seq, price, y, ((seq * 7919) % 2001 - 1000) / 100.0::double as y_pred from (
    select *, cast(lead(cents) over (partition by symbol order by ts, seq) - cents as double) as y
    from (select *, cast(floor(price * 100 + 0.5) as bigint) as cents from trades)) where y is not null)"""


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as a large table of trades."""
    li = read(spark, sf, "lineitem")
    return li.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"), to_micros(F.col("l_shipdate")).alias("ts"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )


LINES_SQL = """lines as (
  select l_returnflag || l_linestatus as symbol, epoch_us(l_shipdate) as ts, l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_extendedprice as price, l_quantity as qty, l_discount as discount, l_tax as tax from lineitem)"""
LINE_ORDER = "ts, l_orderkey, l_linenumber, l_partkey, l_suppkey"
