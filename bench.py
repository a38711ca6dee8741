"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 4) choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from microbook.operators import normalize
from microbook.queries import QUERIES
from microbook.queries.tables import lines
from microbook.queries.q_training import LINE_FEATURES
from microbook.session import local_session

HEADLINE = [
    "bars_trades", "bars_lineitem", "bars_joined", "book_snapshots", "book_top_every_event", "book_trade_state",
    "features_v2", "feature_rolling", "clean_flags", "quality_report", "outliers_iqr", "raw_validation",
    "scaler_fit_robust", "scaler_transform_lineitem", "preprocess_zscore", "target_return", "split_chronological_lineitem",
    "split_walk_forward", "pnl", "performance", "trading_metrics", "sequences_labelled",
]
REPEATS = 2


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = local_session(cpus, partitions=cpus)
    drain(QUERIES["bars_trades"](spark, sf))  # start the engine
    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(min(timed(lambda n=name: drain(QUERIES[n](spark, sf))) for _ in range(REPEATS)), 3)

    # rows per second of the scaler's projection alone, the one figure with an outside number
    rows = lines(spark, sf).select(*LINE_FEATURES).cache()
    n = rows.count()
    scaled = normalize.transform(rows, normalize.fit_standard(rows, LINE_FEATURES))
    drain(scaled)
    transform = statistics.median(timed(lambda: drain(scaled)) for _ in range(5))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf.rsplit("sf", 1)[-1], "scaler_transform_rows_per_sec": round(n / transform), "scaler_rows": n,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
