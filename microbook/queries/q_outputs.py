"""Queries on what is written beside the main tables: rejected levels, metadata with quality, profit curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from microbook.operators import book, quality
from microbook.queries.q_backtest import FOLDS, _folded
from microbook.queries.q_quality import REPORT, _dirty, _report
from microbook.queries.q_sources import fresh
from microbook.queries.registry import query, snap_sql, snapped, with_ctes
from microbook.queries.tables import DELTAS, deltas
from microbook.sources import clean
from microbook.sources import features as feature_files


# every event brings its level and one more; some texts are broken
BROKEN = DELTAS + """,
two as (select symbol, seq, side, 0 as i, seq % 17 <> 0 as whole, seq % 11 <> 0 as px, seq % 13 <> 0 as sz from deltas
  union all select symbol, seq, side, 1, true, true, seq % 7 <> 0 from deltas)"""


@query("level_rejects", with_ctes(BROKEN, """select symbol, seq, side, i, case when not whole then 'shape' when not px then 'price' else 'size' end as reason
 from two where not (whole and px and sz)"""))
def level_rejects(spark, sf):
    """Levels of raw messages that cannot be read, each with its message, place and reason."""
    s, price, size = F.col("seq"), F.col("price").cast("string"), F.col("size").cast("string")
    one = F.when(s % 17 == 0, F.array(price)).otherwise(
        F.array(F.when(s % 11 == 0, "12,5").otherwise(price), F.when(s % 13 == 0, F.lit(None)).otherwise(size)))
    both = F.array(one, F.array(price, F.when(s % 7 == 0, "").otherwise(size)))
    none = F.array().cast("array<array<string>>")
    raw = deltas(spark, sf).select("symbol", "seq", *[F.when(F.col("side") == side, both).otherwise(none).alias(side + "s") for side in ("bid", "ask")])
    return book.level_rejects(raw, "symbol", "seq")


@query("clean_manifest_saved", with_ctes(REPORT, f"""select d.symbol, min(ts) as start_ts, max(ts) as end_ts, count(*) as row_count, '2.0' as version, 3600000 as snapshot_interval_ms,
 10 as order_book_depth, {snap_sql('(max(ts) - min(ts)) / 1e6::double', 'duration_sec', 3)}, bool_and(ok) as all_passed, {snap_sql('max(score)', 'quality_score')}
 from dirty d join (select symbol, bool_and(f = 0 or info) as ok, avg((n - f) / n::double) as score from checks group by 1) s on s.symbol = d.symbol group by 1"""))
def clean_manifest_saved(spark, sf):
    """Metadata of a table with its quality score, written twice and read back: the latest rows."""
    path, table = fresh(spark, "clean-manifest"), _dirty(spark, sf)
    clean.write_manifest(clean.manifest(table.limit(1), 1, 1).withColumns({"all_passed": F.lit(False), "quality_score": F.lit(0.0)}), path)
    score = quality.report_score(_report(spark, sf), "symbol")
    clean.write_manifest(clean.manifest(table, 3_600_000, 10, score), path)
    return snapped(snapped(clean.read_manifest(spark, path).drop("created_at"), "duration_sec", digits=3), "quality_score")


@query("pnl_curve_saved", with_ctes(FOLDS + """, ft as (select symbol, fold, sum(net_return) as e from fnet group by 1, 2),
 fo as (select *, coalesce(sum(e) over (partition by symbol order by fold rows between unbounded preceding and 1 preceding), 0) as o from ft)""",
 "select fc.symbol, fc.fold + 1 as split, rn - 1 as idx, c + o as cumulative_pnl from fc join fo on fo.symbol = fc.symbol and fo.fold = fc.fold"))
def pnl_curve_saved(spark, sf):
    """The profit curve of four folds as a CSV file, read back."""
    path = fresh(spark, "curve")
    feature_files.save_curve(_folded(spark, sf), path)
    return spark.read.csv(path, header=True, schema="symbol string, split bigint, idx bigint, cumulative_pnl double")
