"""Microstructure features over clean order-book rows.

Pointwise features are plain projections. Features with history are functions of (df, window) run by
`over_rows`, so all of them share one exchange and sort, and a long symbol is split into blocks with
`HISTORY` rows of overlap. Only the cumulative order-flow sum needs block totals (`running`).

Arithmetic that other engines answer with inf or NaN gives null here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from microbook.functions.expr import add_rolling, div, step
from microbook.functions.names import ladder
from microbook.plans.ordered import DEFAULT, Layout, Order, layout, over_rows, running

SCHEMA_VERSION = "2.0.0"
DEPTHS = (1, 5, 10)
TINY = 1e-10
KYLE_WINDOW = 100
VPIN_WINDOW = 50
VOL_OF_VOL_WINDOW = 50


def _px(side: str) -> Column:
    return F.col(f"{side}_px_01")


def _sz(side: str) -> Column:
    return F.col(f"{side}_sz_01")


def _depth_sum(df: DataFrame, side: str, depth: int) -> Column | None:
    has = set(df.columns)
    present = [c for c in ladder(side, "sz", depth) if c in has]
    return F.expr(" + ".join(present)) if present else None


def basic(df: DataFrame) -> DataFrame:
    """midprice, spread, spread_bps."""
    mid = (_px("bid") + _px("ask")) / 2
    spread = _px("ask") - _px("bid")
    return df.withColumns({"midprice": mid, "spread": spread, "spread_bps": div(spread, mid) * 10000})


def imbalance(df: DataFrame, depths: tuple[int, ...] = DEPTHS, depth: int = 10) -> DataFrame:
    """Book volume per side and (bid-ask)/(bid+ask) at several depths; null if a level is missing."""
    new: dict[str, Column] = {}
    for n in depths:
        bid, ask = _depth_sum(df, "bid", n), _depth_sum(df, "ask", n)
        if n > depth or bid is None or ask is None:
            continue
        new[f"bid_vol_{n}"], new[f"ask_vol_{n}"] = bid, ask
        new[f"imbalance_{n}"] = div(bid - ask, bid + ask)
        if n == 1:
            new["imbalance"] = new["imbalance_1"]
    return df.withColumns(new) if new else df


def microprice(df: DataFrame) -> DataFrame:
    """Mid price weighted by the opposite side's size."""
    weighted = _sz("bid") * _px("ask") + _sz("ask") * _px("bid")
    return df.withColumn("microprice", div(weighted, _sz("bid") + _sz("ask")))


def liquidity(df: DataFrame, depths: tuple[int, ...] = DEPTHS, depth: int = 10) -> DataFrame:
    """Resting size per side and in total at several depths."""
    new: dict[str, Column] = {}
    for n in depths:
        bid, ask = _depth_sum(df, "bid", n), _depth_sum(df, "ask", n)
        if n > depth or bid is None or ask is None:
            continue
        new[f"liquidity_bid_{n}"], new[f"liquidity_ask_{n}"] = bid, ask
        new[f"liquidity_{n}"] = bid + ask
    return df.withColumns(new) if new else df


def trade_flow(df: DataFrame) -> DataFrame:
    """Taker volumes under their long names, signed volume, and imbalance (0 without volume)."""
    for c in ("taker_buy_vol", "taker_sell_vol"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0))
    buy, sell = F.col("taker_buy_vol"), F.col("taker_sell_vol")
    return df.withColumns({
        "taker_buy_volume": buy,
        "taker_sell_volume": sell,
        "signed_volume": buy - sell,
        "volume_imbalance": F.when(buy + sell > 0, (buy - sell) / (buy + sell)).otherwise(0.0),
    })


def ladder_slope(df: DataFrame, levels: int = 5, depth: int = 10) -> DataFrame:
    """Size at the touch against size at level `levels`, as ratio and log ratio."""
    levels = min(levels, depth)
    needed = [c for s in ("bid", "ask") for w in ("px", "sz") for c in ladder(s, w, levels)]
    if any(c not in df.columns for c in needed if c.startswith("bid")):
        return df
    new = {}
    for side in ("bid", "ask"):
        ratio = div(_sz(side), F.col(f"{side}_sz_{levels:02d}") + F.lit(TINY))
        new[f"{side}_slope_ratio"], new[f"{side}_ladder_slope"] = ratio, F.ln(ratio)
    return df.withColumns(new)


def queue_imbalance(df: DataFrame, depth: int = 10) -> DataFrame:
    """(bid-ask)/(bid+ask) level by level, levels 1 to 5."""
    new = {}
    for i in range(1, min(6, depth + 1)):
        b, a = f"bid_sz_{i:02d}", f"ask_sz_{i:02d}"
        if b in df.columns and a in df.columns:
            new[f"queue_imb_{i}"] = div(F.col(b) - F.col(a), F.col(b) + F.col(a) + F.lit(TINY))
    return df.withColumns(new) if new else df


# --- features with history: (df, window) -> df -----------------------------------------------
# Each is made of steps to the row before, rolling aggregates, and arithmetic on them, so that the
# whole pipeline can share its passes.

Rolls = dict[str, tuple[str, Column, int]]


def _flow_steps(df: DataFrame, w: WindowSpec, price_aware: bool) -> DataFrame:
    new = {"delta_bid_sz": step(_sz("bid"), w), "delta_ask_sz": step(_sz("ask"), w)}
    if price_aware:
        new |= {"delta_bid_px": step(_px("bid"), w), "delta_ask_px": step(_px("ask"), w)}
    df = df.withColumns(new).withColumn("ofi", F.col("delta_bid_sz") - F.col("delta_ask_sz"))
    if price_aware:
        up = F.when(F.col("delta_bid_px") > 0, _sz("bid")).otherwise(0.0)
        down = F.when(F.col("delta_ask_px") < 0, _sz("ask")).otherwise(0.0)
        df = df.withColumn("ofi_enhanced", F.col("ofi") + up - down)
    return df


def _flow_rolls(window: int) -> Rolls:
    return {f"ofi_{window}": ("sum", F.col("ofi"), window)} if window > 1 else {}


def order_flow(df: DataFrame, w: WindowSpec, window: int = 10, price_aware: bool = True) -> DataFrame:
    """Size changes at the touch, their difference (ofi), its price-aware form and rolling sum."""
    return add_rolling(_flow_steps(df, w, price_aware), w, _flow_rolls(window))


def returns(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Log return of the mid price."""
    return df.withColumn("returns", step(F.ln("midprice"), w))


def _volatility_rolls(windows: tuple[int, ...]) -> Rolls:
    return {f"volatility_{n}": ("std", F.col("returns"), n) for n in windows}


def _of_vol_rolls() -> Rolls:
    return {"vol_of_vol": ("std", F.col("volatility_20"), VOL_OF_VOL_WINDOW)}


def volatility(df: DataFrame, w: WindowSpec, windows: tuple[int, ...] = (20, 50, 100), of_vol: bool = True) -> DataFrame:
    """Rolling sample deviation of returns, and of the 20-row volatility itself."""
    df = add_rolling(df, w, _volatility_rolls(windows))
    return add_rolling(df, w, _of_vol_rolls()) if of_vol and 20 in windows else df


def _kyle_steps(df: DataFrame, w: WindowSpec) -> DataFrame:
    df = df.withColumn("price_change", step(F.col("midprice"), w))
    if "signed_volume" in df.columns:
        return df
    if "taker_buy_vol" in df.columns and "taker_sell_vol" in df.columns:
        return df.withColumn("signed_volume", F.col("taker_buy_vol") - F.col("taker_sell_vol"))
    return df.withColumn("signed_volume", F.col("ofi") if "ofi" in df.columns else F.lit(0.0))


def _kyle_means(window: int) -> Rolls:
    return {"_mp": ("mean", F.col("price_change"), window), "_mv": ("mean", F.col("signed_volume"), window)}


def _kyle_products(window: int) -> Rolls:
    change = F.col("price_change") - F.col("_mp")
    volume = F.col("signed_volume") - F.col("_mv")
    return {"_cov": ("mean", change * volume, window), "_var": ("mean", volume * volume, window)}


def _kyle_ratio(df: DataFrame) -> DataFrame:
    impact = F.when(F.col("_var") > 0, F.col("_cov") / F.col("_var")).otherwise(0.0)
    return df.withColumn("kyle_lambda", impact).drop("_mp", "_mv", "_cov", "_var")


def kyle_lambda(df: DataFrame, w: WindowSpec, window: int = KYLE_WINDOW) -> DataFrame:
    """Price impact: rolling mean of the product of deviations over that of the squared volume one.

    Each deviation is taken from its own row's rolling mean. Warm-up rows and zero variance give 0.
    """
    df = add_rolling(_kyle_steps(df, w), w, _kyle_means(window))
    return _kyle_ratio(add_rolling(df, w, _kyle_products(window)))


def _vpin_rolls(window: int) -> Rolls:
    return {"_buys": ("sum", F.col("taker_buy_vol"), window), "_sells": ("sum", F.col("taker_sell_vol"), window)}


def _vpin_ratio(df: DataFrame) -> DataFrame:
    b, s = F.col("_buys"), F.col("_sells")
    return df.withColumn("vpin", F.when(b + s > 0, F.abs(b - s) / (b + s)).otherwise(0.0)).drop("_buys", "_sells")


def vpin(df: DataFrame, w: WindowSpec, window: int = VPIN_WINDOW) -> DataFrame:
    """|buys - sells| / (buys + sells) over the last rows; 0 in warm-up and without volume."""
    if "taker_buy_vol" not in df.columns:
        return df.withColumn("vpin", F.lit(0.0))
    return _vpin_ratio(add_rolling(df, w, _vpin_rolls(window)))


def ofi_cumulative(df: DataFrame, order: Order = DEFAULT, plan: Layout | None = None) -> DataFrame:
    """Running sum of ofi per key; null where ofi is null."""
    df = running(df, {"ofi_cumulative": ("sum", F.col("ofi"))}, order, plan=plan)
    return df.withColumn("ofi_cumulative", F.when(F.col("ofi").isNotNull(), F.col("ofi_cumulative")))


# --- whole pipelines --------------------------------------------------------------------------

def all_features(df: DataFrame, order: Order = DEFAULT, version: int = 2, depth: int = 10, ofi_window: int = 10) -> DataFrame:
    """Every feature of version 1 or 2; `order.keys` decides where windows restart.

    Add a file, date or segment column to the keys to restart them there.
    """
    df = trade_flow(basic(df))

    def history(d: DataFrame, w: WindowSpec) -> DataFrame:
        d = returns(_flow_steps(d, w, price_aware=version == 2), w)
        if version == 1:
            return add_rolling(d, w, _flow_rolls(ofi_window) | _volatility_rolls((20, 100)))
        d = _kyle_steps(d, w)
        d = add_rolling(d, w, (
            _flow_rolls(ofi_window) | _volatility_rolls((20, 50, 100)) | _kyle_means(KYLE_WINDOW) | _vpin_rolls(VPIN_WINDOW)
        ))
        d = add_rolling(d, w, _of_vol_rolls() | _kyle_products(KYLE_WINDOW))
        return _vpin_ratio(_kyle_ratio(d))

    plan = layout(df, order)
    touch = [f"{side}_{what}_01" for side in ("bid", "ask") for what in ("px", "sz")]
    needed = [*touch, "midprice", "taker_buy_vol", "taker_sell_vol", "signed_volume"]
    df = over_rows(df, history, order, back=2 * KYLE_WINDOW - 1, plan=plan, uses=needed)
    df = ofi_cumulative(df, order, plan)
    df = liquidity(microprice(imbalance(df, depth=depth)), depth=depth)
    if version == 2:
        df = queue_imbalance(ladder_slope(df, depth=depth), depth=depth)
        df = df.withColumn("_schema_version", F.lit(SCHEMA_VERSION))
    return df


def lag_features(df: DataFrame, columns: list[str], lags: tuple[int, ...] = (1, 2, 5, 10, 20), order: Order = DEFAULT) -> DataFrame:
    """Earlier values as `<column>_lag_<k>`; absent columns are skipped."""
    columns = [c for c in columns if c in df.columns]

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        return d.withColumns({f"{c}_lag_{k}": F.lag(c, k).over(w) for c in columns for k in lags})

    return over_rows(df, build, order, back=max(lags))


def rolling_features(
    df: DataFrame, columns: list[str], windows: tuple[int, ...] = (10, 30, 60, 120),
    kinds: tuple[str, ...] = ("mean", "std"), order: Order = DEFAULT,
) -> DataFrame:
    """Rolling aggregates as `<column>_<kind>_<n>`; kinds are mean, std, sum, min, max."""
    columns = [c for c in columns if c in df.columns]

    def build(d: DataFrame, w: WindowSpec) -> DataFrame:
        return add_rolling(d, w, {
            f"{c}_{k}_{n}": (k, F.col(c), n) for c in columns for n in windows for k in kinds
        })

    return over_rows(df, build, order, back=max(windows) - 1)


def forward_fill(df: DataFrame, columns: list[str], order: Order = DEFAULT, plan=None) -> DataFrame:
    """Replace nulls by the last known value of the key."""
    filled = running(df, {f"_f_{c}": ("last", F.col(c)) for c in columns}, order, plan=plan)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])


def backward_fill(df: DataFrame, columns: list[str], order: Order = DEFAULT, plan=None) -> DataFrame:
    """Replace nulls by the next known value of the key."""
    filled = running(df, {f"_f_{c}": ("first", F.col(c)) for c in columns}, order, plan=plan)
    return filled.withColumns({c: F.col(f"_f_{c}") for c in columns}).drop(*[f"_f_{c}" for c in columns])
