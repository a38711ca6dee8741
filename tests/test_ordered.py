"""Blocked windows give what plain windows give, on skewed keys and equal times."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from microbook.plans.ordered import NO_TIE, Order, floor_to, layout, over_rows, row_index, running


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for seq in range(3000):
        symbol = "HOT" if rng.random() < 0.6 else rng.choice(["A", "B", "C"])
        # a third of the rows share one time, others come in bursts
        ts = 5_000_000_000 if rng.random() < 0.33 else rng.randrange(0, 40_000_000_000)
        x = None if rng.random() < 0.3 else float(rng.randrange(100))
        data.append((symbol, ts, seq, x))
    return spark.createDataFrame(data, "symbol string, ts bigint, seq bigint, x double").cache()


BLOCKS = Order(block_rows=64)


def plain():
    return Window.partitionBy("symbol").orderBy("ts", "seq")


def same(a, b):
    key = lambda r: tuple((v is None, v) for v in r)
    left, right = (sorted(map(tuple, d.select(sorted(d.columns)).collect()), key=key) for d in (a, b))
    assert left == right


def test_layout_splits_hot_times(rows):
    plan = layout(rows, BLOCKS)
    assert not plan.single and plan.hot
    sizes = plan.cells.agg(F.max("_n")).first()[0]
    assert sizes <= 4
    blocks = plan.cells.groupBy("symbol", "_blk").agg(F.sum("_n").alias("n"))
    assert blocks.agg(F.max("n")).first()[0] <= 64 + 4
    assert plan.cells.filter(F.col("_c0") != NO_TIE).count() > 0


def test_small_tables_use_plain_windows(rows):
    assert layout(rows).single


@pytest.mark.parametrize("back,ahead", [(5, 0), (0, 5), (20, 20)])
def test_rolling_and_offsets(rows, back, ahead):
    def build(d, w):
        return d.withColumns({
            "a": F.lag("x", back).over(w) if back else F.lit(0.0),
            "b": F.lead("x", ahead).over(w) if ahead else F.lit(0.0),
            "c": F.sum("x").over(w.rowsBetween(-back, ahead)),
        })

    same(over_rows(rows, build, BLOCKS, back, ahead), build(rows, plain()))


def test_frame_must_fit_block(rows):
    with pytest.raises(ValueError):
        over_rows(rows, lambda d, w: d, BLOCKS, back=64)


def test_row_index(rows):
    expected = rows.withColumn("rn", F.row_number().over(plain()).cast("bigint"))
    expected = expected.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("symbol")))
    same(row_index(rows, BLOCKS, "rn", total="n"), expected)


@pytest.mark.parametrize("exclusive", [False, True])
def test_running(rows, exclusive):
    kinds = {k: (k, F.col("x")) for k in ("sum", "count", "min", "max", "last", "first")}
    edge = 1 if exclusive else 0
    upto = plain().rowsBetween(Window.unboundedPreceding, -edge)
    after = plain().rowsBetween(edge, Window.unboundedFollowing)
    expected = rows.withColumns({
        "sum": F.sum("x").over(upto), "count": F.count("x").over(upto), "min": F.min("x").over(upto),
        "max": F.max("x").over(upto), "last": F.last("x", True).over(upto), "first": F.first("x", True).over(after),
    })
    same(running(rows, kinds, BLOCKS, exclusive), expected)
    same(running(rows, kinds, Order(), exclusive), expected)


def test_wide_rows_keep_their_columns(rows):
    wide = rows.withColumns({f"c{i}": F.col("x") + i for i in range(12)})
    out = over_rows(wide, lambda d, w: d.withColumn("y", F.lag("x").over(w)), BLOCKS, back=1, uses=["x"])
    assert out.columns == [*wide.columns, "y"]
    same(out, wide.withColumn("y", F.lag("x").over(plain())))


def test_duplicates_that_cannot_be_cut_raise(spark):
    twins = spark.range(500).select(F.lit("A").alias("symbol"), F.lit(1).cast("bigint").alias("ts"), F.lit(1).cast("bigint").alias("seq"))
    with pytest.raises(ValueError):
        layout(twins, BLOCKS)


def test_floor_to_below_zero(spark):
    assert spark.range(1).select(floor_to(F.lit(-1).cast("bigint"), 10)).first()[0] == -10


@pytest.fixture(scope="module")
def cut(rows):
    return layout(rows, BLOCKS)


@pytest.mark.parametrize("back,ahead", [(500, 0), (130, 270)])
def test_frames_longer_than_a_block(rows, cut, back, ahead):
    def build(d, w):
        return d.withColumns({
            "a": F.lag("x", back).over(w) if back else F.lit(0.0),
            "b": F.lead("x", ahead).over(w) if ahead else F.lit(0.0),
            "c": F.sum("x").over(w.rowsBetween(-back, ahead)), "d": F.count(F.lit(1)).over(w.rowsBetween(-back, ahead)),
        })

    same(over_rows(rows, build, BLOCKS, back=back, ahead=ahead, plan=cut), build(rows, plain()))


def test_equal_times_and_first_ties_are_cut_by_the_next(spark):
    data = [("HOT", 7, i % 2, i) for i in range(900)] + [("B", i, 0, i) for i in range(50)]
    df = spark.createDataFrame(data, "symbol string, ts bigint, kind int, seq bigint")
    order = Order(ties=("kind", "seq"), block_rows=64, cell=1)
    plan = layout(df, order)
    assert plan.cells.agg(F.max("_n")).first()[0] <= 4
    w = Window.partitionBy("symbol").orderBy("ts", "kind", "seq")
    same(row_index(df, order, "rn", plan=plan), df.withColumn("rn", F.row_number().over(w).cast("bigint")))
    total = F.sum("seq").over(w.rowsBetween(-200, 0))
    same(over_rows(df, lambda d, v: d.withColumn("t", F.sum("seq").over(v.rowsBetween(-200, 0))), order, back=200, plan=plan), df.withColumn("t", total))


@pytest.mark.parametrize("block_rows", [None, 400])
def test_next_value_needs_no_frame_to_the_last_row(spark, rows, block_rows):
    """Such a frame is walked anew from every row: the square of a block's rows."""
    order = Order(block_rows=block_rows)
    x = F.when(F.col("seq") % 3 == 0, F.col("x"))
    got = running(rows, {"nxt": ("first", x), "later": ("first", x)}, order).drop("later")
    got = running(got, {"past": ("first", x)}, order, exclusive=True)
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()
    w = Window.partitionBy("symbol").orderBy("ts", "seq")
    after = F.first(x, ignorenulls=True)
    wanted = rows.withColumns({"nxt": after.over(w.rowsBetween(0, Window.unboundedFollowing)), "past": after.over(w.rowsBetween(1, Window.unboundedFollowing))})
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(got.columns).collect()))


def test_cells_follow_the_rows_not_the_range(spark):
    """Days as in lineitem: one microsecond of each has all its rows, whose order keys lie far apart."""
    df = spark.range(6000).selectExpr("'A' as symbol", "id % 5 * 86400000000 as ts", "id * 1000003 as seq")
    plan = layout(df, Order(block_rows=160, cell=31 * 86_400_000_000))
    assert len(plan.hot) <= 3
    assert 6000 / 10 <= plan.n_cells <= 6000 / 10 * 4
    assert plan.cells.agg(F.max("_n")).first()[0] <= 10
    assert sorted(r.rn for r in row_index(df, plan.order, plan=plan).collect()) == list(range(1, 6001))


def test_null_ties_come_first_in_hot_cells(spark):
    df = spark.range(300).selectExpr("'A' as symbol", "bigint(7) as ts", "case when id % 50 <> 0 then id - 9223372036854775807 + (id % 2) * 9000000000000000000 end as seq", "id")
    df = df.where("seq is not null or id < 3")
    got = {r.id: r.rn for r in row_index(df, Order(block_rows=32)).collect()}
    wanted = df.withColumn("rn", F.row_number().over(plain())).collect()
    assert got == {r.id: r.rn for r in wanted}
