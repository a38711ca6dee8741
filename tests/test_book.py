"""Books rebuilt by joins against plain folds."""

import random

import pytest
from pyspark.sql import functions as F

from microbook.operators import book, thinning
from microbook.plans.ordered import Order


@pytest.fixture(scope="module")
def changes():
    rng = random.Random(11)
    rows = []
    for symbol in ("A", "B"):
        for pos in range(1, 401):
            side = rng.choice(["bid", "ask"])
            price = (100.0 - rng.randrange(15)) if side == "bid" else (100.0 + rng.randrange(15))
            rows.append((symbol, pos, side, price, float(rng.choice([0, 0, 1, 5, 9]))))
    return rows


def fold(changes, ticks, depth):
    books, out = {}, {}
    for symbol, pos, side, price, size in changes:
        levels = books.setdefault((symbol, side), {})
        levels.pop(price, None)
        if size:
            levels[price] = size
        if (symbol, pos) in ticks:
            out[symbol, pos] = [
                sorted(books.get((symbol, s), {}).items(), reverse=s == "bid")[:depth] for s in ("bid", "ask")
            ]
    return out


@pytest.mark.parametrize("block", [8, 64, 16_384])
def test_book_at_equals_fold(spark, changes, block):
    df = spark.createDataFrame(changes, "symbol string, pos bigint, side string, price double, size double")
    ticks = df.filter(F.col("pos") % 7 == 0).select("symbol", "pos")
    wanted = fold(changes, {(s, p) for s, p, *_ in changes if p % 7 == 0}, 5)
    got = book.to_nested(book.book_at(df, ticks, 5, block=block), 5).collect()
    assert len(got) == len(wanted)
    for r in got:
        bids, asks = ([(x.px, x.sz) for x in side] for side in (r.bids, r.asks))
        assert [bids, asks] == wanted[r.symbol, r.pos]


@pytest.mark.parametrize("block", [8, 64])
def test_best_level_and_other_columns_of_ticks(spark, changes, block):
    df = spark.createDataFrame(changes, "symbol string, pos bigint, side string, price double, size double")
    ticks = df.withColumnRenamed("size", "note")
    wanted = fold(changes, {(s, p) for s, p, *_ in changes}, 1)
    got = book.book_at(df, ticks, 1, block=block)
    assert got.columns == [*ticks.columns, "bid_px_01", "bid_sz_01", "ask_px_01", "ask_sz_01"]
    rows = {(s, p): (side, price, size) for s, p, side, price, size in changes}
    got = got.collect()
    assert len(got) == len(wanted)
    for r in got:
        assert (r.side, r.price, r.note) == rows[r.symbol, r.pos]
        bid, ask = ((x or [(None, None)])[0] for x in wanted[r.symbol, r.pos])
        assert (r.bid_px_01, r.bid_sz_01, r.ask_px_01, r.ask_sz_01) == (*bid, *ask)


def test_bad_sizes_do_not_delete(spark):
    rows = [("A", 1, [["100", "5"], ["99", "x"]], [["101", "0"], ["101", "3"]])]
    raw = spark.createDataFrame(rows, "symbol string, pos bigint, bids array<array<string>>, asks array<array<string>>")
    got = {(r.side, r.price, r["size"]) for r in book.explode_levels(raw, "symbol", "pos").collect()}
    assert got == {("bid", 100.0, 5.0), ("ask", 101.0, 3.0)}


def test_sequence_status(spark):
    rows = [("A", i, i, f, u, p) for i, (f, u, p) in enumerate([(1, 1, 0), (2, 2, 1), (5, 5, 4), (3, 3, 2), (4, 7, 3)])]
    df = spark.createDataFrame(rows, "symbol string, ts bigint, seq bigint, first_update_id bigint, last_update_id bigint, prev_update_id bigint")
    apply = [r.status for r in book.sequence_status(df).orderBy("seq").collect()]
    reject = [r.status for r in book.sequence_status(df, "reject").orderBy("seq").collect()]
    assert apply == ["first", "ok", "gap", "old", "gap"]
    assert reject == ["first", "ok", "gap", "ok", "ok"]  # 3 follows the last applied id 2, and 4-7 follows 3


def test_rejecting_path_equals_replay(spark):
    rng, rows, wanted = random.Random(5), [], {}
    for symbol in "AB":
        ids, done = 0, None
        for i in range(160):
            ids = max(0, ids + rng.choice([1, 1, 1, 1, 0, 2, -3, -9, 5]))
            size = rng.choice([1, 1, 2, 4])
            first, last, prev = ids + 1, ids + size, ids if rng.random() < 0.9 else ids - 1
            rows.append((symbol, i, i, first, last, prev))
            if done is None:
                status = "first"
            elif prev == done:
                status = "ok"
            else:
                status = "gap" if first > done + 1 else "old" if last <= done else "overlap"
            done = last if status in ("first", "ok", "overlap") else done
            wanted[symbol, i] = status
            ids = last
    df = spark.createDataFrame(rows, "symbol string, ts bigint, seq bigint, first_update_id bigint, last_update_id bigint, prev_update_id bigint")
    got = {(r.symbol, r.seq): r.status for r in book.sequence_status(df, "reject").collect()}
    assert got == wanted


def test_health_and_symbols(spark):
    df = spark.createDataFrame([(None,), ("eth",)], "symbol string")
    assert {r.symbol for r in book.with_symbol(df).collect()} == {"BTCUSDT", "ETH"}


DELTA = "symbol string, ts bigint, seq bigint, pos bigint, side string, price double, size double"


def test_tick_is_the_first_event_with_both_sides(spark):
    rows = [("A", 10, 1, 1, "bid", 1.0, 5.0), ("A", 20, 2, 2, "ask", 2.0, 5.0), ("A", 30, 3, 3, "bid", 1.5, 5.0),
            ("A", 1010, 4, 4, "bid", 1.0, 0.0), ("A", 2010, 5, 5, "bid", 1.5, 0.0), ("A", 2020, 6, 6, "ask", 3.0, 1.0), ("B", 5, 1, 1, "bid", 1.0, 1.0)]
    df = spark.createDataFrame(rows, DELTA)
    for block in (1, 64):
        assert [r.ts for r in book.two_sided_ticks(df, df, 1000, block=block).orderBy("ts").collect()] == [20, 1010]


def raw(rows):
    none = [[]] * 2
    return [("A", ts, ts, i, "depth", i, i, i - 1, *(([[str(p), str(q)]], []) if side == "bid" else ([], [[str(p), str(q)]]) if side else none)) for i, (ts, side, p, q) in enumerate(rows, 1)]


RAW = ("symbol string, exchange_ts bigint, local_ts bigint, seq bigint, type string, first_update_id bigint, last_update_id bigint, prev_update_id bigint, "
       "bids array<array<string>>, asks array<array<string>>, trade struct<trade_id:bigint,price:string,quantity:string,buyer_is_maker:boolean>")


def test_reconstruction_keeps_an_interval_whose_book_opens_late(spark):
    df = spark.createDataFrame([(*r, None) for r in raw([(10, "bid", 1.0, 5.0), (20, "ask", 2.0, 5.0), (30, "bid", 1.5, 5.0)])], RAW)
    got = book.reconstruct(df, 1000, 2).collect()
    assert [(r.ts, r.bid_px_01, r.ask_px_01) for r in got] == [(20, 1.0, 2.0)]
    with pytest.raises(ValueError):
        book.reconstruct(df, 1000, 2, emit="sometimes")


@pytest.mark.parametrize("block,width", [(4, 1), (16_384, 256)])
def test_gated_ticks_equal_a_fold(spark, changes, block, width):
    rows = [(s, 37 * p + p % 5, p, p, side, price, size) for s, p, side, price, size in changes]
    df = spark.createDataFrame(rows, DELTA)
    open_, grid, path, last = {}, {}, [], {}
    for s, ts, _, pos, side, price, size in rows:
        levels = open_.setdefault(s, {"bid": set(), "ask": set()})
        (levels[side].add if size else levels[side].discard)(price)
        if levels["bid"] and levels["ask"]:
            grid.setdefault((s, ts // 200), (s, pos))
            if s not in last or ts >= last[s] + 200:
                last[s] = ts
                path.append((s, pos))
    assert sorted((r.symbol, r.pos) for r in book.two_sided_ticks(df, df, 200, block=block).collect()) == sorted(grid.values())
    assert sorted((r.symbol, r.pos) for r in book.greedy_ticks(df, df, 200, block=block, width=width).collect()) == sorted(path)


@pytest.mark.parametrize("width,block_rows", [(1, None), (4, 32)])
def test_greedy_thinning_equals_a_loop(spark, width, block_rows):
    rng = random.Random(6)
    rows, want = [], []
    for key, gaps in (("a", [0, 0, 1, 3, 7, 40]), ("b", [1, 500, 9]), ("c", [10])):
        ts = last = None
        for pos in range(1, 700):
            ts = 1000 if ts is None else ts + rng.choice(gaps)
            rows.append((key, ts, pos))
            if last is None or ts >= last + 20:
                last = ts
                want.append((key, pos))
    df = spark.createDataFrame(rows, "k string, t bigint, pos bigint")
    got = thinning.greedy(df, 20, Order(("k",), "t", (), block_rows, 1000), width)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def resync_fold(rows, threshold):
    """The rule update by update, per key."""
    out, state = [], {}
    for key, _, kind, u, v, pu, crossed in rows:
        done, snap, gaps = state.get(key, (None, None, 0))
        if kind == "snapshot":
            done, snap, gaps, status, applied = v, v, 0, "snapshot", True
        else:
            status = ("first" if done is None else "ok" if pu == done else "bridge" if snap is not None and u <= snap <= v
                      else "old" if v <= done else "gap")
            gaps += status == "gap"
            applied = status != "old" and not (status == "gap" and gaps >= threshold)
            if applied:
                done = v
            if status in ("first", "ok", "bridge") and not crossed:
                gaps = 0
        state[key] = (done, snap, gaps)
        out.append((key, _, status, applied, gaps, gaps >= threshold))
    return out


@pytest.mark.parametrize("threshold,block_rows,seed", [(3, None, 1), (2, 64, 8)])
def test_resync_equals_a_fold(spark, threshold, block_rows, seed):
    rng, rows = random.Random(seed), []
    for key in ("A", "B", "C", "D", "E"):
        last = 100
        for i in range(18):
            jump, back = rng.choice([0, 0, 0, 0, 1, 3, 9, 9]), rng.choice([0] * 9 + [4, 12])
            u = max(last + 1 + jump - back, 1)
            v = u + rng.randrange(3) + (15 if rng.random() < 0.05 else 0)
            kind = "snapshot" if rng.random() < (0.12 if key != "C" else 0) else "depth"
            pu = rng.choice([last] * 6 + [u - 1, u - 1, last - 3])
            rows.append((key, i, kind, u, v, pu, rng.random() < 0.1))
            last = v if rng.random() < 0.8 else last
    df = spark.createDataFrame(rows, "symbol string, i bigint, type string, first_update_id bigint, last_update_id bigint, prev_update_id bigint, x boolean")
    got = book.resync_status(df, threshold, Order(("symbol",), "i", (), block_rows, 16), "x")
    got = got.select("symbol", "i", "status", "applied", "consecutive_gaps", "needs_resync").collect()
    want = resync_fold(rows, threshold)
    assert {w[2] for w in want} >= {"snapshot", "first", "ok", "old", "gap"}
    assert sorted(map(tuple, got)) == sorted(want)


def test_gaps_with_neutral_rows(spark):
    kinds = "ggnngrnggg"
    df = spark.createDataFrame([("A", i, i, k) for i, k in enumerate(kinds)], "symbol string, ts bigint, seq bigint, k string")
    got = book.consecutive_gaps(df, F.col("k") == "g", 3, reset=F.col("k") == "r").orderBy("ts").collect()
    assert [r.consecutive_gaps for r in got] == [1, 2, 2, 2, 3, 0, 0, 1, 2, 3] and [r.needs_resync for r in got] == [n >= 3 for n in [1, 2, 2, 2, 3, 0, 0, 1, 2, 3]]


def test_reconstruction_leaves_out_old_updates_and_gaps_past_the_threshold(spark):
    rows = raw([(10, "bid", 1.0, 5.0), (20, "ask", 2.0, 5.0), (1030, "bid", 1.5, 5.0), (2040, "bid", 1.7, 5.0), (3050, "bid", 1.8, 5.0)])
    jumped = [(*r[:5], r[5] + 100 * max(i - 1, 0), r[6] + 100 * max(i - 1, 0), r[7] + 100 * max(i - 1, 0), *r[8:], None) for i, r in enumerate(rows)]
    df = spark.createDataFrame(jumped, RAW)
    best = [r.bid_px_01 for r in book.reconstruct(df, 1000, 2, threshold=2).orderBy("ts").collect()]
    assert best == [1.0, 1.5, 1.5, 1.5]
    assert [r.bid_px_01 for r in book.reconstruct(df, 1000, 2, threshold=None).orderBy("ts").collect()] == [1.0, 1.5, 1.7, 1.8]


@pytest.mark.parametrize("block_rows", [None, 64])
def test_reconstruction_reads_the_records_once(spark, block_rows):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(*r, None) for r in raw([(10 * i, "bid" if i % 2 else "ask", (1.0 if i % 2 else 2.0) + i % 5 / 10, 5.0) for i in range(1, 301)])]
    df = spark.createDataFrame(rows, RAW)
    out = book.reconstruct(df.mapInArrow(counted, df.schema), 100, 2, block=64, block_rows=block_rows, max_depth=None)
    assert len(out.collect()) == 31 and read.value == 300
