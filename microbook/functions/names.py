"""Column names and fixed lists of the data model."""

from __future__ import annotations


def ladder(side: str, what: str, depth: int) -> list[str]:
    """Names such as bid_px_01 .. bid_px_NN."""
    return [f"{side}_{what}_{i:02d}" for i in range(1, depth + 1)]


def ladder_block(depth: int) -> list[str]:
    """Four columns per level, level by level."""
    rows = []
    for i in range(1, depth + 1):
        rows += [f"bid_px_{i:02d}", f"bid_sz_{i:02d}", f"ask_px_{i:02d}", f"ask_sz_{i:02d}"]
    return rows


# Result columns and feature lists users select by name.
BAR_COLUMNS = ["open", "high", "low", "close", "volume", "vwap", "number_of_trades"]
IMBALANCE = ["imbalance", "imbalance_1", "imbalance_5", "imbalance_10"]
SLOPES = ["bid_ladder_slope", "ask_ladder_slope", "bid_slope_ratio", "ask_slope_ratio"]
QUEUES = [f"queue_imb_{i}" for i in range(1, 6)]
LIQUIDITY = ["liquidity_bid_{0}", "liquidity_ask_{0}", "liquidity_{0}"]
TRADE_VOLUMES = ["taker_buy_volume", "taker_sell_volume", "signed_volume", "volume_imbalance"]

FEATURE_OUTPUT = (
    ["midprice", "spread", "spread_bps"] + IMBALANCE + ["ofi", "ofi_10", "ofi_cumulative", "microprice"]
    + TRADE_VOLUMES + ["last_trade_px", "last_trade_qty"]
    + [name.format(n) for n in (1, 5, 10) for name in LIQUIDITY]
    + ["returns", "volatility_20", "volatility_100", "kyle_lambda", "vpin"]
    + SLOPES + QUEUES + ["vol_of_vol"] + BAR_COLUMNS
)

TRAINING_FEATURES = (
    ladder_block(5)
    + ["midprice", "spread", "spread_bps", "microprice"] + IMBALANCE
    + ["ofi", "ofi_10", "ofi_cumulative"] + TRADE_VOLUMES
    + ["volatility_20", "volatility_100", "kyle_lambda", "vpin"]
    + SLOPES + QUEUES + ["vol_of_vol"]
)

FORECAST_FEATURES = [
    "midprice", "spread", "ofi", "imbalance_1", "imbalance_5", "microprice",
    "taker_buy_volume", "taker_sell_volume", "liquidity_1", "liquidity_5",
    "open", "high", "low", "close", "volume", "vwap",
]
FORECAST_TARGETS = ["close"]

# Scaling method per feature; anything else is passed through unscaled.
STANDARD = (
    ["ofi", "ofi_10", "ofi_cumulative"] + IMBALANCE
    + ["spread", "spread_bps", "volatility_20", "volatility_100", "vol_of_vol",
       "signed_volume", "volume_imbalance", "liquidity_1", "liquidity_5", "liquidity_10",
       "kyle_lambda", "vpin"] + SLOPES
)
ROBUST = (
    ladder("bid", "sz", 10) + ladder("ask", "sz", 10)
    + ["taker_buy_volume", "taker_sell_volume"] + QUEUES
)
MINMAX: list[str] = []
PASSTHROUGH = (
    ["ts", "microprice"] + ladder("bid", "px", 10) + ladder("ask", "px", 10)
    + ["midprice", "last_trade_px", "last_trade_qty"]
)

# Columns a feature file must have, by family.
REQUIRED = {
    "core": ["ts", "midprice", "microprice", "spread"],
    "ofi": ["ofi", "ofi_10"],
    "imbalance": ["imbalance_1", "imbalance_5", "imbalance_10"],
    "volume": ["taker_buy_volume", "taker_sell_volume"],
    "liquidity": ["liquidity_1", "liquidity_5", "liquidity_10"],
    "kline": ["open", "high", "low", "close", "volume", "vwap"],
}
EXPECTED_TYPES = {
    "ts": ("bigint",),
    "midprice": ("double", "float"),
    "spread": ("double", "float"),
    "ofi": ("double", "float", "bigint"),
    "open": ("double", "float"),
    "high": ("double", "float"),
    "low": ("double", "float"),
    "close": ("double", "float"),
    "volume": ("double", "float"),
}


def scaling_of(column: str) -> str:
    for method, members in (("standard", STANDARD), ("robust", ROBUST), ("minmax", MINMAX),
                            ("passthrough", PASSTHROUGH)):
        if column in members:
            return method
    return "unknown"


def classify(columns: list[str]) -> dict[str, list[str]]:
    """Columns grouped by scaling method, input order kept."""
    groups: dict[str, list[str]] = {m: [] for m in ("standard", "robust", "minmax", "passthrough", "unknown")}
    for column in columns:
        groups[scaling_of(column)].append(column)
    return groups
