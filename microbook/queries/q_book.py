"""Queries on order-book reconstruction."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.functions.names import ladder_block
from microbook.operators import book, trimming
from microbook.plans.ordered import DEFAULT, Order, over_rows, row_index
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import DELTAS, EVERY_HOUR, HOUR, SNAPSHOTS, TRADES, _wide_sql, build_snapshots, deltas, snapshots, trades

LEVELS = ladder_block(10)


@query("book_snapshots", with_ctes(SNAPSHOTS, "select * from snaps"))
def book_snapshots(spark, sf):
    """Top ten levels at the first event of each symbol-hour with a two-sided book, with the trade state."""
    return build_snapshots(spark, sf)


@query("book_snapshots_blocks", with_ctes(SNAPSHOTS, "select * from snaps"))
def book_snapshots_blocks(spark, sf):
    """The same through small blocks: numbering by blocks of 512 rows, levels carried over blocks of 64 changes."""
    return build_snapshots(spark, sf, block=64, order=DEFAULT.blocks(512))


# one event after the other: the next two-sided event an hour or more after the last one taken
GREEDY = "recursive " + SNAPSHOTS.replace("ticks as (", """walk as (
  select symbol, min(ts) as ts from deltas join sides using (symbol, u) where two_sided group by 1
  union all
  select w.symbol, min(d.ts) from walk w join deltas d on d.symbol = w.symbol and d.ts >= w.ts + 3600000000
    join sides s on s.symbol = d.symbol and s.u = d.u where s.two_sided group by w.symbol, w.ts),
ticks as (""").replace("where two_sided) where rn = 1)", "join (select symbol as ws, ts as wt from walk) on ws = flow.symbol and wt = flow.ts where two_sided) where rn = 1)")


@query("book_snapshots_greedy", with_ctes(GREEDY, "select * from snaps"))
def book_snapshots_greedy(spark, sf):
    """Top ten levels at the first two-sided event, then at the next one an hour or more after the last."""
    return build_snapshots(spark, sf, emit="greedy")


@query("book_level_intervals", with_ctes(DELTAS, """select * from (select symbol, side, price, size, u as valid_from,
 lead(u) over (partition by symbol, side, price order by u) as valid_to from deltas) where size <> 0"""))
def book_level_intervals(spark, sf):
    """Upserts and deletes as the intervals in which a level is open."""
    return book.level_intervals(deltas(spark, sf))


# a wide book: 150 prices a side and more. One event after the other: the open prices of a side, best first, and the one that falls off
WIDE = "recursive " + DELTAS.replace("(user_id % 12) * 0.5::double", "user_id * 0.5::double") + """,
numbered as (select symbol, side, u, price, size, case when side = 'bid' then -price else price end as away,
  row_number() over (partition by symbol, side order by u) as n from deltas),
walk as (
  select symbol, side, u, n, case when size <> 0 then [away] else [] end::double[] as open, []::double[] as pushed from numbered where n = 1
  union all
  select symbol, side, u, n, everything[:100], everything[101:] from (
    select w.symbol, w.side, d.u, d.n, list_sort(case when d.size = 0 then list_filter(w.open, lambda x: x <> d.away)
      else list_append(list_filter(w.open, lambda x: x <> d.away), d.away) end) as everything
    from walk w join numbered d on d.symbol = w.symbol and d.side = w.side and d.n = w.n + 1)),
pushed as (select symbol, side, u, case when side = 'bid' then -away else away end as price from (select symbol, side, u, unnest(pushed) as away from walk)),
trimmed as (
  select d.symbol, d.side, d.u, d.price, case when p.u is null then d.size else 0.0 end as size
  from deltas d left join pushed p on p.symbol = d.symbol and p.side = d.side and p.u = d.u and p.price = d.price
  union all
  select p.symbol, p.side, p.u, p.price, 0.0 from pushed p anti join deltas d on p.symbol = d.symbol and p.side = d.side and p.u = d.u and p.price = d.price)"""


@query("book_trimmed_intervals", with_ctes(WIDE, """select * from (select symbol, side, price, size, u as valid_from,
 lead(u) over (partition by symbol, side, price order by u) as valid_to from trimmed) where size <> 0"""))
def book_trimmed_intervals(spark, sf):
    """The intervals in which a level is open in a book that forgets what falls behind the best hundred levels of its side."""
    away = F.col("user_id").cast("double") * 0.5
    price = F.when(F.col("event_id") % 2 == 0, 100.0 - away).otherwise(100.0 + away)
    wide = deltas(spark, sf, price=price).withColumnRenamed("u", "pos")
    trimmed = trimming.trim_levels(wide, 100, block=512, idle=False)
    return book.level_intervals(trimmed.withColumnRenamed("pos", "u"))


@query("book_initialised", with_ctes(EVERY_HOUR, """select symbol, count(*) as n_snapshots,
 sum(case when bid_px_01 is not null and ask_px_01 is not null then 1 else 0 end)::bigint as n_initialised from snaps group by 1"""))
def book_initialised(spark, sf):
    """Hours with events, and those whose first event finds both sides open."""
    s = build_snapshots(spark, sf, depth=1, emit="any")
    ready = book.initialised(s).groupBy("symbol").agg(F.count(F.lit(1)).alias("n_initialised"))
    return s.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_snapshots")).join(ready, "symbol", "left").fillna(0)


@query("book_top", with_ctes(SNAPSHOTS, """select symbol, ts, seq, bid_px_01 as best_bid, ask_px_01 as best_ask,
 coalesce(bid_px_01 >= ask_px_01, false) as book_crossed from snaps"""))
def book_top(spark, sf):
    """Best prices and the crossed flag."""
    return book.with_top(build_snapshots(spark, sf, depth=1)).select("symbol", "ts", "seq", "best_bid", "best_ask", "book_crossed")


EVERY = DELTAS + """,
spans as (select symbol, side, price, size, u as lo, lead(u) over (partition by symbol, side, price order by u) as hi from deltas),
best as (select d.symbol, d.u, max(case when s.side = 'bid' then s.price end) as best_bid, min(case when s.side = 'ask' then s.price end) as best_ask
  from deltas d left join spans s on s.symbol = d.symbol and s.size <> 0 and s.lo <= d.u and (s.hi is null or d.u < s.hi) group by 1, 2)"""


@query("book_top_every_event", with_ctes(EVERY, "select symbol, u, best_bid, best_ask, coalesce(best_bid >= best_ask, false) as book_crossed from best"))
def book_top_every_event(spark, sf):
    """Best prices and the crossed flag after every level change."""
    d = deltas(spark, sf).withColumnRenamed("u", "pos")
    top = book.with_top(book.book_at(d, d.select("symbol", "pos"), 1, block=512))
    return top.select("symbol", F.col("pos").alias("u"), "best_bid", "best_ask", "book_crossed")


@query("book_trade_state", with_ctes(DELTAS, """select symbol, u, trade_px as last_trade_px, trade_qty as last_trade_qty,
 sum(case when not buyer_is_maker then trade_qty else 0 end) over w as taker_buy_vol,
 sum(case when buyer_is_maker then trade_qty else 0 end) over w as taker_sell_vol
 from deltas window w as (partition by symbol order by u rows between unbounded preceding and current row)"""))
def book_trade_state(spark, sf):
    """Last trade and cumulative taker volumes."""
    out = book.trade_state(deltas(spark, sf))
    return out.select("symbol", "u", "last_trade_px", "last_trade_qty", "taker_buy_vol", "taker_sell_vol")


@query("book_event_order", with_ctes(DELTAS, """select seq, symbol, row_number() over (partition by symbol order by ts // 60000000, seq % 3 = 0, seq) as pos from deltas"""))
def book_event_order(spark, sf):
    """Events of the same minute: depth updates first, then trades, then by sequence."""
    d = deltas(spark, sf).select(
        "symbol", "seq", (F.floor(F.col("ts") / 60_000_000)).cast("bigint").alias("exchange_ts"),
        F.when(F.col("seq") % 3 == 0, "trade").otherwise("depth").alias("type"),
    )
    out = row_index(book.with_event_seq(d), Order(("symbol",), "exchange_ts", ("event_seq",), cell=60), "pos")
    return out.select("seq", "symbol", "pos")


GAPPED = DELTAS + """,
upd as (select symbol, ts, seq, u as first_update_id, u as last_update_id, lag(u) over (partition by symbol order by ts, seq) as prev_update_id from deltas),
kept as (select *, coalesce(prev_update_id, 0) as pu from upd where seq % 97 <> 0)"""


def _updates(spark, sf):
    """Level changes as update ids; some are lost after numbering, which leaves gaps."""
    d = deltas(spark, sf).select("symbol", "ts", "seq", F.col("u").alias("first_update_id"), F.col("u").alias("last_update_id"))
    d = over_rows(d, lambda x, w: x.withColumn("prev_update_id", F.coalesce(F.lag("last_update_id").over(w), F.lit(0))), back=1)
    return d.filter(F.col("seq") % 97 != 0)


@query("sequence_connection_gaps", with_ctes(GAPPED, """select symbol, seq, coalesce(pu <> before, false) as sequence_gap,
 case when pu <> before then before end as expected_prev_id
 from (select *, lag(last_update_id) over (partition by symbol order by ts, seq) as before from kept)"""))
def sequence_connection_gaps(spark, sf):
    """Previous id differs from the one applied before."""
    out = book.connection_gaps(_updates(spark, sf))
    return out.select("symbol", "seq", "sequence_gap", "expected_prev_id")


# every 50th update arrives again 20 rows late, as an old one
LATE = GAPPED + """,
late as (select symbol, first_update_id, last_update_id, pu, last_update_id * 2 as arrival from kept
  union all select symbol, first_update_id, last_update_id, pu, last_update_id * 2 + 41 as arrival from kept where last_update_id % 50 = 0),
seen as (select *, max(last_update_id) over (partition by symbol order by arrival rows between unbounded preceding and 1 preceding) as m from late)"""


def _late(spark, sf):
    k = _updates(spark, sf).select("symbol", "first_update_id", "last_update_id", "prev_update_id")
    a = k.withColumn("arrival", F.col("last_update_id") * 2)
    return a.unionByName(k.filter(F.col("last_update_id") % 50 == 0).withColumn("arrival", F.col("last_update_id") * 2 + 41))


ARRIVAL = Order(("symbol",), "arrival", ())


@query("sequence_status_apply", with_ctes(LATE, """select symbol, arrival, case when m is null then 'first' when pu = m then 'ok'
 when last_update_id <= m then 'old' else 'gap' end as status,
 case when m is null or pu = m or last_update_id > m then true else false end as applied from seen"""))
def sequence_status_apply(spark, sf):
    """Gaps are applied, old updates are not."""
    return book.sequence_status(_late(spark, sf), "apply", ARRIVAL).select("symbol", "arrival", "status", "applied")


# the id applied last goes from row to row
PATH = LATE.replace("with ", "") + """,
numbered as (select *, row_number() over (partition by symbol order by arrival) as rn from late),
path as (
  select symbol, arrival, rn, last_update_id as done, 'first' as status from numbered where rn = 1
  union all
  select n.symbol, n.arrival, n.rn, case when pu = done or first_update_id <= done + 1 and last_update_id > done then last_update_id else done end,
    case when pu = done then 'ok' when first_update_id > done + 1 then 'gap' when last_update_id <= done then 'old' else 'overlap' end
  from path p join numbered n on n.symbol = p.symbol and n.rn = p.rn + 1)"""


@query("sequence_status_reject", with_ctes("recursive " + PATH, "select symbol, arrival, status, status not in ('gap', 'old') as applied from path"))
def sequence_status_reject(spark, sf):
    """Updates that leave a hole after the last applied one are rejected."""
    return book.sequence_status(_late(spark, sf), "reject", ARRIVAL).select("symbol", "arrival", "status", "applied")


RUNS = DELTAS + """, g as (select symbol, ts, seq, (trade_qty::bigint % 3 <> 0) as gap, row_number() over (partition by symbol order by ts, seq) as rn from deltas),
h as (select *, max(case when not gap then rn end) over (partition by symbol order by ts, seq rows unbounded preceding) as ok from g)"""


@query("sequence_resync", with_ctes(RUNS, """select symbol, seq, case when gap then rn - coalesce(ok, 0) else 0 end as consecutive_gaps,
 case when gap then rn - coalesce(ok, 0) else 0 end >= 5 as needs_resync from h"""))
def sequence_resync(spark, sf):
    """Runs of gaps and the resync flag from the fifth on."""
    d = deltas(spark, sf).select("symbol", "ts", "seq", "trade_qty")
    gap = F.col("trade_qty").cast("bigint") % 3 != 0
    return book.consecutive_gaps(d, gap).select("symbol", "seq", "consecutive_gaps", "needs_resync")


# in stretches every other update is lost, which leaves runs of gaps; some lost ones and some others arrive late; snapshots come with seq % 200 = 0
BURSTS = DELTAS + """,
bu as (select symbol, seq, u as first_update_id, u as last_update_id, u - 1 as pu, seq % 200 = 0 as is_full, u % 2 = 0 and (u // 40) % 5 = 3 as lost from deltas),
ba as (select *, last_update_id * 2 as arrival from bu where not lost or is_full
  union all select *, last_update_id * 2 + 31 from bu where lost and not is_full and last_update_id % 10 = 0
  union all select * replace (last_update_id + 2 as last_update_id), last_update_id * 2 + 41 from bu where not lost and not is_full and last_update_id % 50 = 0),
bn as (select *, row_number() over (partition by symbol order by arrival) as rn from ba),
bp as (
  select symbol, arrival, rn, last_update_id as done, case when is_full then last_update_id end as snap, 0::bigint as gaps, case when is_full then 'snapshot' else 'first' end as status, true as applied
  from bn where rn = 1
  union all
  select symbol, arrival, rn, case when applied then last_update_id else done end, case when status = 'snapshot' then last_update_id else snap end,
    case when status in ('snapshot', 'ok', 'bridge') then 0 when status = 'gap' then gaps + 1 else gaps end, status, applied
  from (select *, status not in ('old', 'gap') or status = 'gap' and gaps + 1 < 5 as applied from (
    select n.symbol, n.arrival, n.rn, n.last_update_id, p.done, p.snap, p.gaps, case when n.is_full then 'snapshot' when pu = done then 'ok'
      when n.first_update_id <= snap and snap <= n.last_update_id then 'bridge' when n.last_update_id <= done then 'old' else 'gap' end as status
    from bp p join bn n on n.symbol = p.symbol and n.rn = p.rn + 1)))"""


def _bursts(spark, sf):
    u = F.col("u")
    d = deltas(spark, sf).select(
        "symbol", F.when(F.col("seq") % 200 == 0, "snapshot").otherwise("depth").alias("type"), u.alias("first_update_id"), u.alias("last_update_id"),
        (u - 1).alias("prev_update_id"), (u * 2).alias("arrival"), ((u % 2 == 0) & (F.floor(u / 40) % 5 == 3)).alias("lost"))
    full, lost, i = F.col("type") == "snapshot", F.col("lost"), F.col("last_update_id")
    late = d.where(lost & ~full & (i % 10 == 0)).withColumn("arrival", i * 2 + 31)
    again = d.where(~lost & ~full & (i % 50 == 0)).withColumn("arrival", i * 2 + 41).withColumn("last_update_id", i + 2)
    return d.where(~lost | full).unionByName(late).unionByName(again)


@query("sequence_status_resync", with_ctes("recursive " + BURSTS, "select symbol, arrival, status, applied, gaps as consecutive_gaps, gaps >= 5 as needs_resync from bp"))
def sequence_status_resync(spark, sf):
    """Updates under resynchronisation: gaps from the fifth on are not applied until one goes on from the last applied id or a snapshot comes."""
    return book.resync_status(_bursts(spark, sf), 5, ARRIVAL).select("symbol", "arrival", "status", "applied", "consecutive_gaps", "needs_resync")


# a full snapshot arrives at every change with seq % 200 = 0: it empties the book and sets one level a side
EPOCHS = DELTAS + """,
ep as (select *, sum(case when seq % 200 = 0 then 1 else 0 end) over (partition by symbol order by u rows unbounded preceding) as epoch from deltas),
lev as (select symbol, epoch, u, side, price, size from ep where seq % 200 <> 0
  union all select symbol, epoch, u, 'bid', 99.0::double, 5.0::double from ep where seq % 200 = 0
  union all select symbol, epoch, u, 'ask', 101.0::double, 7.0::double from ep where seq % 200 = 0),
spans as (select *, lead(u) over (partition by symbol, epoch, side, price order by u) as hi from lev),
open as (select e.symbol, e.u from ep e join spans s on s.symbol = e.symbol and s.epoch = e.epoch and s.size <> 0 and s.u <= e.u and (s.hi is null or e.u < s.hi)
  group by 1, 2 having count(distinct s.side) = 2),
ticks as (select symbol, epoch, u from (select ep.*, row_number() over (partition by symbol, ts - ts % 3600000000 order by ts, seq) as rn
  from ep join open using (symbol, u)) where rn = 1),
held as (select t.symbol, t.epoch, t.u, s.side, s.price, s.size, row_number() over (partition by t.symbol, t.u, s.side
   order by case when s.side = 'bid' then -s.price else s.price end) as lvl
  from ticks t left join spans s on s.symbol = t.symbol and s.epoch = t.epoch and s.size <> 0 and s.u <= t.u and (s.hi is null or t.u < s.hi))"""


def _epoch_records(spark, sf):
    """Level changes as raw records; some are full snapshots."""
    d = deltas(spark, sf)
    full = F.col("seq") % 200 == 0
    none = F.array().cast("array<array<string>>")
    level = F.array(F.array(F.col("price").cast("string"), F.col("size").cast("string")))
    fixed = {"bid": F.array(F.array(F.lit("99.0"), F.lit("5.0"))), "ask": F.array(F.array(F.lit("101.0"), F.lit("7.0")))}
    sides = {s: F.when(full, fixed[s]).when(F.col("side") == s, level).otherwise(none) for s in ("bid", "ask")}
    trade = F.struct(F.col("seq").alias("trade_id"), F.lit("1").alias("price"), F.lit("1").alias("quantity"), F.lit(True).alias("buyer_is_maker"))
    return d.select(
        "symbol", F.col("ts").alias("exchange_ts"), F.col("ts").alias("local_ts"), "seq",
        F.when(full, "snapshot").otherwise("depth").alias("type"),
        F.col("u").alias("first_update_id"), F.col("u").alias("last_update_id"), (F.col("u") - 1).alias("prev_update_id"),
        sides["bid"].alias("bids"), sides["ask"].alias("asks"), F.when(F.lit(False), trade).alias("trade"),
    )


@query("book_resync_snapshots", with_ctes(EPOCHS, f"""select * exclude (u, epoch) from (select upper(symbol) as symbol, u, epoch, u as last_update_id, {_wide_sql(5)} from held group by all)"""))
def book_resync_snapshots(spark, sf):
    """Raw records to clean rows; full snapshots close all levels before them."""
    out = book.reconstruct(_epoch_records(spark, sf), HOUR, 5)
    return out.drop("ts", "seq", "local_ts", "last_trade_px", "last_trade_qty", "taker_buy_vol", "taker_sell_vol")


@query("book_properties", with_ctes(SNAPSHOTS, f"""select symbol, ts, seq, (bid_px_01 + ask_px_01) / 2 as mid, ask_px_01 - bid_px_01 as spread, b as bid_volume, a as ask_volume,
 {snap_sql('coalesce((b - a) / nullif(b + a, 0), 0)', 'imbalance')} from (select *,
 coalesce(bid_sz_01, 0) + coalesce(bid_sz_02, 0) + coalesce(bid_sz_03, 0) + coalesce(bid_sz_04, 0) + coalesce(bid_sz_05, 0) as b,
 coalesce(ask_sz_01, 0) + coalesce(ask_sz_02, 0) + coalesce(ask_sz_03, 0) + coalesce(ask_sz_04, 0) + coalesce(ask_sz_05, 0) as a from snaps)"""))
def book_properties(spark, sf):
    """Derived properties of nested snapshots, five levels deep."""
    out = book.book_properties(book.to_nested(snapshots(spark, sf)), 5)
    return snapped(out.select("symbol", "ts", "seq", "mid", "spread", "bid_volume", "ask_volume", "imbalance"), "imbalance")


@query("book_health", with_ctes(GAPPED + EVERY[len(DELTAS):] + ", " + TRADES, f"""select symbol, count(*) as events_processed,
 count(*) filter (type = 'depth') as depth_updates, count(*) filter (type = 'trade') as trades_processed, count(*) filter (gap) as sequence_gaps,
 count(*) filter (crossed) as crossed_books, count(*) filter (snap) as snapshots_emitted,
 max(greatest(seq % 1000 - 10, 0))::bigint as max_latency_us, max(ts) as last_event_ts from (
  select k.symbol, 'depth' as type, ts, seq, coalesce(pu <> before, false) as gap, coalesce(best_bid >= best_ask, false) as crossed, rn = 1 as snap
  from (select *, lag(last_update_id) over (partition by symbol order by ts, seq) as before,
    row_number() over (partition by symbol, ts - ts % {HOUR} order by ts, seq) as rn from kept) k
  join best b on b.symbol = k.symbol and b.u = k.last_update_id
  union all select symbol, 'trade', ts, seq, false, false, false from trades where price > 0) group by 1"""))
def book_health(spark, sf):
    """Health counters per symbol: updates with gaps, the crossed books after them, a snapshot each hour, and the trades."""
    d = book.connection_gaps(_updates(spark, sf)).select("symbol", "ts", "seq", "last_update_id", "sequence_gap")
    change = deltas(spark, sf).withColumnRenamed("u", "pos")
    top = book.with_top(book.book_at(change, change.select("symbol", "pos"), 1, block=512))
    top = top.select("symbol", F.col("pos").alias("last_update_id"), "book_crossed")
    first = book.grid_ticks(d.select("symbol", "ts", "seq"), HOUR).select("symbol", "seq", F.lit(True).alias("snapshot"))
    updates = d.join(top, ["symbol", "last_update_id"]).join(first, ["symbol", "seq"], "left")
    updates = updates.select("symbol", "ts", "seq", F.lit("depth").alias("type"), "sequence_gap", "book_crossed", F.coalesce("snapshot", F.lit(False)).alias("snapshot"))
    no = F.lit(False)
    sold = trades(spark, sf).where("price > 0").select("symbol", "ts", "seq", F.lit("trade"), no, no, no)
    late = (F.col("ts") + F.col("seq") % 1000 - 10).alias("local_ts")
    return book.health(updates.union(sold).select("*", F.col("ts").alias("exchange_ts"), late))
