"""Cleaning and data-quality checks.

Checks on neighbouring rows first add their differences (`over_rows`), then every check of a report
is computed by one aggregate and unfolded into one row per check.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from microbook.functions import names
from microbook.functions.expr import add_rolling, any_of, div, step
from microbook.functions.quantiles import exact_quantiles
from microbook.functions.timeutil import unit_of
from microbook.plans.ordered import DEFAULT, Order, floor_to, layout, over_rows, running
from microbook.session import cut_lineage

# --- cleaning ---------------------------------------------------------------------------------


def clean_flags(
    df: DataFrame, max_spread_pct: float = 0.1, min_price: float = 0.0, max_price: float | None = None,
    max_staleness_us: int = 60_000_000, order: Order = DEFAULT, time: str | None = None,
) -> DataFrame:
    """Add `reject_reason` (null when valid) and `stale`; the first failing check names the reason.

    A row below the last valid time is out of order. That time is the running maximum over rows that
    pass all other checks, because a rejected row never raises it. Rows are taken in `order`; `time`
    names the checked time if that order is one of arrival.
    """
    ts, bid, ask = F.col(time or order.ts), F.col("bid_px_01"), F.col("ask_px_01")
    bad_price = bid.isNull() | ask.isNull() | (bid < min_price) | (ask < min_price)
    if max_price is not None:
        bad_price = bad_price | (bid > max_price) | (ask > max_price)
    wide = (bid == 0) | (div(ask - bid, bid) > max_spread_pct)
    static = (
        F.when(ts <= 0, "timestamp").when(bad_price, "price").when(bid >= ask, "spread").when(wide, "spread")
    )
    df = df.withColumn("_static", static)
    df = running(df, {"_valid_ts": ("max", F.when(F.col("_static").isNull(), ts))}, order, exclusive=True)
    seen = F.col("_valid_ts")
    reason = F.when(ts <= 0, "timestamp").when(ts < seen, "timestamp").otherwise(F.col("_static"))
    stale = F.coalesce((ts > 0) & (ts - seen > max_staleness_us), F.lit(False))
    return df.withColumns({"reject_reason": reason, "stale": stale}).drop("_static", "_valid_ts")


def clean(df: DataFrame, **options) -> DataFrame:
    """Rows that pass `clean_flags`."""
    return clean_flags(df, **options).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def cleaning_stats(flagged: DataFrame, *keys: str) -> DataFrame:
    """Counts by reason and the acceptance rate."""
    reason = F.col("reject_reason")
    total, valid = F.count(F.lit(1)), F.count_if(reason.isNull())
    return flagged.groupBy(*keys).agg(
        total.alias("total_snapshots"),
        valid.alias("valid_snapshots"),
        F.count_if(reason == "timestamp").alias("invalid_timestamps"),
        F.count_if(reason == "price").alias("invalid_prices"),
        F.count_if(reason == "spread").alias("invalid_spreads"),
        F.count_if(F.col("stale")).alias("stale_snapshots"),
        F.coalesce(div(valid.cast("double"), total.cast("double")), F.lit(0.0)).alias("acceptance_rate"),
    )


def outlier_mask(df: DataFrame, column: str, method: str = "iqr", threshold: float = 3.0) -> DataFrame:
    """Add `is_valid`: inside the quartile fences, or within `threshold` population deviations."""
    x = F.col(column)
    if method == "iqr":
        q = exact_quantiles(df, column, {"_q1": 0.25, "_q3": 0.75})
        spread = F.lit(threshold) * (F.col("_q3") - F.col("_q1"))
        stats = q.select((F.col("_q1") - spread).alias("_a"), (F.col("_q3") + spread).alias("_b"))
        ok = (x >= F.col("_a")) & (x <= F.col("_b"))
    elif method == "zscore":
        stats = df.agg(F.avg(x).alias("_a"), F.stddev_pop(x).alias("_b"))
        ok = F.when(F.col("_b") == 0, True).otherwise(F.abs(div(x - F.col("_a"), F.col("_b"))) <= threshold)
    else:
        raise ValueError(f"unknown method {method!r}")
    one = stats.withColumn("_one", F.lit(1))
    out = df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one")
    return out.withColumn("is_valid", ok).drop("_one", "_a", "_b")


def forward_fill_gaps(df: DataFrame, column: str, max_gap_us: int = 1_000_000, order: Order = DEFAULT) -> DataFrame:
    """Fill nulls (and NaN) from the last value while every step in between is at most `max_gap_us`."""
    x = F.when(~F.isnan(column), F.col(column))
    plan = layout(df, order)
    df = over_rows(
        df, lambda d, w: d.withColumn("_break", step(F.col(order.ts), w) > max_gap_us), order, back=1, plan=plan
    )
    df = running(df, {
        "_known": ("last", F.when(x.isNotNull(), F.struct(x.alias("v"), order.stamp().alias("at")))),
        "_broke": ("last", F.when(F.col("_break"), order.stamp())),
    }, order, plan=plan)
    alive = F.col("_broke").isNull() | (F.col("_broke") <= F.col("_known.at"))
    filled = F.coalesce(x, F.when(alive, F.col("_known.v")))
    return df.withColumn(column, filled).drop("_break", "_known", "_broke")


# --- report on book rows ----------------------------------------------------------------------

def _unfold(one: DataFrame, keys: list[str], checks: list[dict]) -> DataFrame:
    """Turn a row of aggregates into one row per check."""
    rows = []
    for check in checks:
        failed = F.coalesce(check["failed"], F.lit(0)).cast("bigint")
        total = F.col("_total").cast("bigint")
        valid = F.lit(True) if check.get("informational") else failed == 0
        counted = F.lit(0).cast("bigint") if check.get("informational") else failed
        rate = F.when(total == 0, 1.0).otherwise((total - counted) / F.nullif(total, F.lit(0).cast("bigint")))
        details = [F.lit(None).cast("map<string,double>")]
        if check.get("details"):
            pairs = [p for k, v in check["details"].items() for p in (F.lit(k), v.cast("double"))]
            details = [F.create_map(*pairs)]
        rows.append(F.struct(
            F.lit(check["name"]).alias("check_name"), valid.alias("valid"),
            F.when(failed > 0, F.concat(F.lit("found "), failed.cast("string"), F.lit(" " + check["what"])))
            .otherwise("ok").alias("message"),
            counted.alias("failed_count"), total.alias("total_count"), rate.alias("pass_rate"),
            details[0].alias("details"),
        ))
    return one.select(*keys, F.inline(F.array(*rows)))


def book_report(
    df: DataFrame, order: Order = DEFAULT, arrival: Order | None = None, depth: int = 10,
    max_spread_bps: float = 100.0, max_jump_pct: float = 5.0, max_gap_us: int = 60_000_000,
    min_delta_us: int = 0, window: int = 10,
) -> DataFrame:
    """Seven checks per key: crossed, negative volumes, time order, jumps, spread, ladder, spoofing.

    Rows are taken in the order `arrival` (default: the time order). One pass over the data.
    """
    arrival = arrival or order
    has = set(df.columns)
    bid, ask = F.col("bid_px_01"), F.col("ask_px_01")
    mid = (bid + ask) / 2
    prices = {"bid_px_01", "ask_px_01"} <= has
    sizes = {"bid_sz_01", "ask_sz_01"} <= has

    def build(d, w):
        new = {"_dt": step(F.col(order.ts), w)}
        if prices:
            before = F.lag(mid).over(w)
            new["_jump"] = F.abs(div(mid - before, before) * 100)
        d = d.withColumns(new)
        if sizes:
            d = d.withColumns({"_db": step(F.col("bid_sz_01"), w), "_da": step(F.col("ask_sz_01"), w)})
            d = add_rolling(d, w, {"_sb": ("sum", F.col("_db"), window), "_sa": ("sum", F.col("_da"), window)})
        return d

    touch = ["bid_px_01", "ask_px_01", "bid_sz_01", "ask_sz_01", order.ts]
    rows = over_rows(df, build, arrival, back=window, uses=touch)
    volumes = [c for c in df.columns if "sz" in c or "vol" in c.lower()]
    negative = any_of([F.coalesce(F.col(c) < 0, F.lit(False)) for c in volumes])
    inverted: list[Column] = []
    for side, worse in (("bid", lambda a, b: a < b), ("ask", lambda a, b: a > b)):
        levels = names.ladder(side, "px", depth)
        for a, b in zip(levels, levels[1:]):
            if {a, b} <= has:
                inverted.append(F.count_if(worse(F.col(a), F.col(b)) & (F.col(b) > 0)))
    spread = div(ask - bid, mid) * 10000
    aggs = {
        "_total": F.count(F.lit(1)), "_negative": F.count_if(negative),
        "_back": F.count_if(F.col("_dt") < min_delta_us), "_gaps": F.count_if(F.col("_dt") > max_gap_us),
        "_max_gap": F.max("_dt"),
        "_inverted": reduce(lambda a, b: a + b, inverted, F.count_if(F.lit(False))),
    }
    if prices:
        crossed = bid >= ask
        aggs |= {
            "_crossed": F.count_if(crossed),
            "_first_crossed": F.min_by(F.when(crossed, F.col(order.ts)), F.when(crossed, arrival.stamp())),
            "_jumps": F.count_if(F.col("_jump") > max_jump_pct), "_max_jump": F.max("_jump"),
            "_wide": F.count_if(spread > max_spread_bps), "_max_spread": F.max(spread), "_mean_spread": F.avg(spread),
        }
    if sizes:
        odd = (F.abs("_sb") > F.col("bid_sz_01") * 2) | (F.abs("_sa") > F.col("ask_sz_01") * 2)
        aggs["_odd"] = F.count_if(odd)
    one = rows.groupBy(*order.keys).agg(*[c.alias(n) for n, c in aggs.items()])

    def got(name: str) -> Column:
        return F.col(name) if name in aggs else F.lit(None).cast("bigint")

    return _unfold(one, list(order.keys), [
        {"name": "no_crossed_book", "failed": got("_crossed"), "what": "crossed rows",
         "details": {"first_crossed_ts": got("_first_crossed")}},
        {"name": "no_negative_volumes", "failed": got("_negative"), "what": "rows with negative volumes"},
        {"name": "monotonic_timestamps", "failed": got("_back"), "what": "steps back in time",
         "details": {"large_gaps": got("_gaps"), "max_gap_us": got("_max_gap")}},
        {"name": "midprice_stability", "failed": got("_jumps"), "what": "large jumps",
         "details": {"max_jump_pct": got("_max_jump"), "threshold_pct": F.lit(max_jump_pct)}},
        {"name": "spread_bounds", "failed": got("_wide"), "what": "wide spreads",
         "details": {"max_spread_bps": got("_max_spread"), "mean_spread_bps": got("_mean_spread")}},
        {"name": "price_levels_ordered", "failed": got("_inverted"), "what": "inverted level pairs"},
        {"name": "spoofing_detection", "failed": got("_odd"), "what": "odd patterns", "informational": True,
         "details": {"suspicious_patterns": F.coalesce(got("_odd"), F.lit(0)), "window_size": F.lit(window)}},
    ])


def report_score(report: DataFrame, *keys: str) -> DataFrame:
    """All-passed flag and quality score (mean pass rate)."""
    return report.groupBy(*keys).agg(
        F.bool_and("valid").alias("all_passed"),
        F.avg("pass_rate").alias("quality_score"),
        F.max("total_count").alias("total_rows"),
    )


# --- raw messages -----------------------------------------------------------------------------

# Fields a record must carry.
DEPTH_FIELDS = ("exchange_ts", "local_ts", "type", "symbol", "bids", "asks")
TRADE_FIELDS = ("exchange_ts", "local_ts", "type", "symbol", "trade")
TRADE_PARTS = ("trade_id", "price", "quantity")


def message_reason(text: Column) -> Column:
    """Why a JSON line is not a valid record; null when it is. Header and footer lines are valid.

    A line is parsed once. Levels are checked one after the other, bids before asks: the first faulty one gives the reason.
    """
    return F.get(F.transform(F.array(F.try_parse_json(text)), _record_reason), F.lit(0))


def _record_reason(record: Column) -> Column:
    def field(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(record, "$." + path, kind)

    def present(path: str) -> Column:
        return F.try_variant_get(record, "$." + path, "variant").isNotNull()

    def bad_level(side: str) -> Column:
        name = side[:-1]
        levels = field(side, "array<array<string>>")
        faults = F.transform(levels, lambda v: F.when(F.size(v) != 2, F.lit(f"invalid {name} format")).when(
            F.exists(v, lambda x: x.try_cast("double").isNull()), F.lit(f"invalid {name} values")))
        return F.when(levels.isNull(), F.lit(f"invalid {name} values")).otherwise(F.get(F.array_compact(faults), F.lit(0)))

    def first_missing(fields: tuple[str, ...], prefix: str, label: str) -> Column:
        return F.coalesce(*[F.when(~present(prefix + f), F.lit(f"{label}: {f}")) for f in fields])

    kind = field("type")
    depth = F.coalesce(first_missing(DEPTH_FIELDS, "", "missing required field"), bad_level("bids"), bad_level("asks"))
    trade = F.coalesce(
        first_missing(TRADE_FIELDS, "", "missing required field"),
        first_missing(TRADE_PARTS, "trade.", "missing trade field"),
    )
    return (
        F.when(record.isNull(), "JSON parse error")
        .when(kind == "depth", depth).when(kind == "trade", trade)
        .when(present("_header") | present("_footer"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("unknown message type: "), F.coalesce(kind, F.lit("none"))))
    )


def message_stats(checked: DataFrame, reason: str = "reason") -> DataFrame:
    """Valid and invalid counts, valid rate and number of distinct reasons."""
    ok = F.count_if(F.col(reason).isNull())
    total = F.count(F.lit(1))
    return checked.agg(
        ok.alias("valid_count"), F.count(reason).alias("invalid_count"), total.alias("total_count"),
        F.coalesce(div(ok.cast("double"), total.cast("double")), F.lit(1.0)).alias("valid_rate"),
        F.count_distinct(reason).alias("unique_errors"),
    )


# --- feature and training files ---------------------------------------------------------------

def schema_findings(df: DataFrame) -> list[tuple[str, str]]:
    """Missing columns and unexpected types of a feature table, from its schema alone."""
    types = dict(df.dtypes)
    found = [("missing", c) for family in names.REQUIRED.values() for c in family if c not in types]
    found += [("type", c) for c, ok in names.EXPECTED_TYPES.items() if c in types and types[c] not in ok]
    return found


def file_report(df: DataFrame, interval_us: int | None = None, by: tuple[str, ...] = ("symbol",), order: Order = DEFAULT) -> DataFrame:
    """Row, time-order, bucket, null and sign statistics per group (symbol, or file path)."""
    ts = F.col(order.ts)
    keyed = order.by(*by)
    rows = over_rows(df, lambda d, w: d.withColumn("_dt", step(ts, w)), keyed, back=1)
    has = set(df.columns)
    n = F.count(F.lit(1))
    aggs = [
        n.alias("rows"), F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
        F.count_if(F.col("_dt") < 0).alias("ts_violations"),
    ]
    if "midprice" in has:
        aggs.append((F.count_if(F.col("midprice").isNull()) / n * 100).alias("midprice_null_pct"))
    if "spread" in has:
        aggs += [F.avg("spread").alias("spread_mean"), F.count_if(F.col("spread") < 0).alias("negative_spreads")]
    for c in ("taker_buy_volume", "taker_sell_volume", "volume"):
        if c in has:
            aggs.append(F.count_if(F.col(c) < 0).alias(f"negative_{c}"))
    out = rows.groupBy(*by).agg(*aggs)
    if interval_us:
        buckets = df.groupBy(*by, floor_to(ts, interval_us).alias("_b")).agg(F.lit(1).alias("_one"))
        counted = buckets.groupBy(*by).agg(F.count(F.lit(1)).alias("actual_buckets"))
        out = out.join(counted, list(by), "left")
        span = F.col("ts_max") - F.col("ts_min")
        expected = ((span - F.pmod(span, F.lit(interval_us))) / interval_us).cast("bigint") + 1
        out = out.withColumn("expected_buckets", expected)
        out = out.withColumn("too_many_buckets", F.col("actual_buckets") > F.col("expected_buckets") * 10)
    out = out.withColumn("ts_unit", unit_of(F.col("ts_min")))
    negatives = [F.col(c) > 0 for c in out.columns if c.startswith("negative_")]
    return out.withColumn("valid", ~any_of(negatives))


def directory_summary(reports: DataFrame) -> DataFrame:
    """Roll-up of `file_report`: files, valid files, rows, warnings."""
    warn = F.when(F.col("ts_violations") > 0, 1).otherwise(0)
    return reports.agg(
        F.count(F.lit(1)).alias("total_files"), F.count_if("valid").alias("valid_files"),
        F.sum("rows").alias("total_rows"), F.sum(warn).cast("bigint").alias("total_warnings"),
    )


# What a training table must have, and its expected step.
OHLC = ["open", "high", "low", "close"]
BOOK = ["midprice", "spread", "bid_px_01", "ask_px_01"]
TIME_COLUMNS = ["ts", "bucket"]
STEP_US = 60_000_000
SEQUENCE_ROWS = 70


def training_readiness(df: DataFrame, min_hours: float = 6.0, order: Order = DEFAULT, step_us: int = STEP_US) -> DataFrame:
    """One row per key: quantity, order, nulls, price range, median step, and the verdicts."""
    columns = set(df.columns)
    family = OHLC if set(OHLC) <= columns else BOOK if set(BOOK) <= columns else []
    if order.ts not in columns or not family:
        raise ValueError(f"needs a time column and {OHLC} or {BOOK}")
    price = "close" if "close" in columns else "midprice"
    ts = F.col(order.ts)
    rows = over_rows(df, lambda d, w: d.withColumn("_dt", step(ts, w)), order, back=1)
    rows = cut_lineage(rows.select(*dict.fromkeys([*order.keys, order.ts, *family, price, "_dt"])))
    out = rows.groupBy(*order.keys).agg(
        F.count(F.lit(1)).alias("rows"),
        ((F.max(ts) - F.min(ts)) / F.lit(3.6e9)).alias("hours"),
        F.count_if(any_of([F.col(c).isNull() for c in family])).alias("rows_with_nulls"),
        F.count_if(F.col("_dt") < 0).alias("steps_back"),
        F.min(price).alias("price_min"), F.max(price).alias("price_max"),
    )
    medians = exact_quantiles(rows, "_dt", {"median_step_us": 0.5}, order.keys)
    out = out.join(medians, list(order.keys), "left")
    off = F.abs(F.col("median_step_us") - step_us) / step_us
    return out.withColumns({
        "enough_rows": F.col("rows") >= SEQUENCE_ROWS,
        "enough_hours": F.col("hours") >= min_hours,
        "price_ok": (F.col("price_min") > 0) & (div(F.col("price_max"), F.col("price_min")) <= 100),
        "step_ok": F.coalesce(off < 0.1, F.lit(False)),
    })


def bar_report(df: DataFrame) -> DataFrame:
    """Per bar column: present, null count, min, max, mean."""
    present = [c for c in names.BAR_COLUMNS if c in df.columns]
    stats = []
    for c in present:
        x = F.col(c).cast("double")
        stats += [F.count_if(F.isnull(c)).alias(f"n_{c}"), F.min(x).alias(f"lo_{c}"), F.max(x).alias(f"hi_{c}"), F.avg(x).alias(f"avg_{c}")]
    one = df.agg(F.count(F.lit(1)).alias("_total"), *stats)
    rows = []
    for c in names.BAR_COLUMNS:
        ok = c in present
        none = F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(ok).alias("present"),
            (F.col(f"n_{c}") if ok else F.lit(None).cast("bigint")).alias("nulls"),
            (F.col(f"lo_{c}") if ok else none).alias("min"), (F.col(f"hi_{c}") if ok else none).alias("max"),
            (F.col(f"avg_{c}") if ok else none).alias("mean"),
        ))
    return one.select(F.inline(F.array(*rows)))


# --- diagnostics ------------------------------------------------------------------------------

def direction_shares(df: DataFrame, price: str = "microprice", horizons: tuple[int, ...] = (1, 5, 10), flat: float = 1e-4, order: Order = DEFAULT) -> DataFrame:
    """Share of up, down and flat returns per horizon, with mean and population deviation in bps."""
    def build(d, w):
        p = F.col(price)
        return d.withColumns({f"_r{h}": div(F.lead(p, h).over(w) - p, p) for h in horizons})

    rows = over_rows(df, build, order, ahead=max(horizons))
    returns = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"_r{h}").alias("r")) for h in horizons]))
    r = F.col("x.r")
    return rows.select(returns.alias("x")).filter(r.isNotNull()).groupBy(F.col("x.horizon").alias("horizon")).agg(
        F.count_if(r > flat).alias("up"), F.count_if(r < -flat).alias("down"),
        F.count_if(F.abs(r) <= flat).alias("flat"),
        (F.avg(r) * 10000).alias("mean_bps"), (F.stddev_pop(r) * 10000).alias("std_bps"),
    )


def target_correlations(df: DataFrame, features: list[str], price: str = "microprice", order: Order = DEFAULT) -> DataFrame:
    """Correlation of each feature with the next return of `price`."""
    p = F.col(price)
    rows = over_rows(df, lambda d, w: d.withColumn("_r", div(F.lead(p).over(w) - p, p)), order, ahead=1)
    features = [f for f in features if f in df.columns]
    one = rows.agg(*[F.corr(f, "_r").alias(f) for f in features])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("correlation")) for f in features
    ])))


def column_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: nulls, deviation, largest magnitude, and whether constant or extreme."""
    stats = []
    for c in columns:
        x = F.col(c).cast("double")
        stats += [F.count_if(F.isnull(c)).alias(f"n_{c}"), F.stddev_samp(x).alias(f"s_{c}"), F.max(F.abs(x)).alias(f"m_{c}")]
    one = df.agg(*stats)
    return one.select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col(f"n_{c}").alias("nulls"), F.col(f"s_{c}").alias("std"),
            F.col(f"m_{c}").alias("max_abs"),
            F.coalesce(F.col(f"s_{c}") < 1e-10, F.lit(False)).alias("is_constant"),
            F.coalesce(F.col(f"m_{c}") > 100, F.lit(False)).alias("is_extreme"),
        )
        for c in columns
    ])))


def null_counts(df: DataFrame) -> DataFrame:
    """Columns that have nulls, with the count."""
    one = df.agg(*[F.count_if(F.isnull(c)).alias(c) for c in df.columns])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns]))
    return one.select(rows).filter(F.col("nulls") > 0)


def unsorted_rows(df: DataFrame, arrival: Order, ts: str = "ts") -> DataFrame:
    """Per key, the number of rows below their predecessor in arrival order, and the sorted flag."""
    rows = over_rows(df, lambda d, w: d.withColumn("_dt", step(F.col(ts), w)), arrival, back=1)
    out = rows.groupBy(*arrival.keys).agg(F.count_if(F.col("_dt") < 0).alias("unsorted"))
    return out.withColumn("is_sorted", F.col("unsorted") == 0)


def dataset_info(df: DataFrame, order: Order = DEFAULT, expected: list[str] | None = None) -> DataFrame:
    """Rows, time range, median step, and which training features are there."""
    expected = expected or names.TRAINING_FEATURES
    ts = F.col(order.ts)
    rows = over_rows(df, lambda d, w: d.withColumn("_dt", step(ts, w)), order, back=1)
    rows = cut_lineage(rows.select(*order.keys, order.ts, "_dt"))
    out = rows.groupBy(*order.keys).agg(
        F.count(F.lit(1)).alias("total_rows"), F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"),
    )
    medians = exact_quantiles(rows, "_dt", {"_m": 0.5}, order.keys)
    out = out.join(medians, list(order.keys), "left")
    have = [f for f in expected if f in df.columns]
    lack = [f for f in expected if f not in df.columns]
    text = "array<string>"
    return out.select(
        *order.keys, "total_rows", "start_ts", "end_ts",
        ((F.col("end_ts") - F.col("start_ts")) / F.lit(3.6e9)).alias("time_range_hours"),
        F.coalesce(F.floor("_m").cast("bigint"), F.lit(100_000)).alias("bucket_size_us"),
        F.array(*map(F.lit, have)).cast(text).alias("available_features"),
        F.array(*map(F.lit, lack)).cast(text).alias("missing_features"),
    )
