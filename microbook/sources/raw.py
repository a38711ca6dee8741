"""Raw exchange records: scan, parse, reject, reconcile and land.

Files are JSON lines, one record each, a header line first and a footer line last, named
`<symbol>_<time>.jsonl.zst`. A compressed file is one task; land it as Parquet once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from microbook.functions.timeutil import to_timestamp

LEVELS = "array<array<string>>"
TRADE = "struct<trade_id:bigint,price:string,quantity:string,buyer_is_maker:boolean>"
LIQUIDATION = "struct<side:string,price:string,quantity:string,avg_price:string,status:string>"
BAR = (
    "struct<interval:string,open:string,high:string,low:string,close:string,volume:string,"
    "trades:bigint,is_final:boolean>"
)
META = (
    "struct<sequence_gap:boolean,expected_prev_id:bigint,book_crossed:boolean,best_bid:double,best_ask:double>"
)
RECORD = (
    "exchange_ts bigint, local_ts bigint, type string, symbol string, first_update_id bigint, "
    f"last_update_id bigint, prev_update_id bigint, bids {LEVELS}, asks {LEVELS}, trade {TRADE}, "
    f"liquidation {LIQUIDATION}, kline {BAR}, meta {META}"
)
HEADER = "struct<version:string,symbol:string,created_at:string,connection_id:string>"
FOOTER = (
    "struct<closed_at:string,bytes_written:bigint,stats:struct<total_messages:bigint,depth_messages:bigint,"
    "trade_messages:bigint,sequence_gaps:bigint,crossed_books:bigint,dropped_messages:bigint>>"
)
LINE = f"{RECORD}, _header {HEADER}, _footer {FOOTER}, _corrupt string"
FIELDS = [
    "exchange_ts", "local_ts", "type", "symbol", "first_update_id", "last_update_id", "prev_update_id",
    "bids", "asks", "trade", "liquidation", "kline", "meta",
]


def parse_lines(lines: DataFrame, text: str = "value", *keep: str) -> DataFrame:
    """JSON text to the union record; text that does not parse is kept in `_corrupt`."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    return lines.select(F.from_json(text, LINE, options).alias("r"), *keep).select("r.*", *keep)


def scan(spark: SparkSession, path: str, symbol: str | None = None, pattern: str = "*.jsonl*") -> DataFrame:
    """All lines of the matching files, parsed, with `file`; a symbol limits the files by name."""
    glob = f"{symbol}_{pattern}" if symbol else pattern
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return parse_lines(lines.select("value", F.col("_metadata.file_path").alias("file")), "value", "file")


def list_files(scanned: DataFrame) -> DataFrame:
    """Files in name order, which is time order, with their number of lines."""
    return scanned.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines")).orderBy("file")


def records(parsed: DataFrame) -> DataFrame:
    """Data records only: no header, footer or broken lines; adds the sequence that breaks time ties."""
    data = parsed.filter(F.col("_header").isNull() & F.col("_footer").isNull() & F.col("_corrupt").isNull())
    seq = F.coalesce("last_update_id", F.col("trade.trade_id"), F.lit(0).cast("bigint"))
    return data.drop("_header", "_footer", "_corrupt").withColumn("seq", seq)


def rejects(parsed: DataFrame) -> DataFrame:
    """Lines that did not parse."""
    keep = [c for c in ("file",) if c in parsed.columns]
    return parsed.filter(F.col("_corrupt").isNotNull()).select("_corrupt", *keep)


def controls(parsed: DataFrame) -> DataFrame:
    """Header and footer lines."""
    return parsed.filter(F.col("_header").isNotNull() | F.col("_footer").isNotNull()).select("file", "_header", "_footer")


def reconcile(parsed: DataFrame, by: str = "file") -> DataFrame:
    """Per file (or another grouping column), counted records against the footer's counters; `complete` is false without a footer."""
    data = F.col("_header").isNull() & F.col("_footer").isNull() & F.col("_corrupt").isNull()
    counted = parsed.groupBy(by).agg(
        F.count_if(data).alias("records"),
        F.count_if(data & (F.col("type") == "depth")).alias("depth_records"),
        F.count_if(data & (F.col("type") == "trade")).alias("trade_records"),
        F.count("_corrupt").alias("broken_lines"),
        F.count("_footer").alias("footers"),
        F.max("_footer.stats.depth_messages").alias("depth_stated"),
        F.max("_footer.stats.trade_messages").alias("trade_stated"),
    )
    agree = (F.col("depth_records") == F.col("depth_stated")) & (F.col("trade_records") == F.col("trade_stated"))
    return counted.withColumns({"complete": F.col("footers") > 0, "matches": F.coalesce(agree, F.lit(False))})


# --- exchange envelopes -----------------------------------------------------------------------

KINDS = ("depth", "trade", "forceOrder", "kline")


def stream_kind(stream: Column) -> Column:
    """Record kind by stream name; the first match counts, in the order of `KINDS`."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(stream.contains(kind), "liquidation" if kind == "forceOrder" else kind).otherwise(out)
    return out


def parse_envelopes(messages: DataFrame, text: str = "value", received: str = "local_ts") -> DataFrame:
    """`{"stream":…, "data":…}` messages to union records.

    Milliseconds become microseconds. The time is the transaction time, for bars the event time.
    Unknown streams and incomplete messages keep their text in `_corrupt`.
    """
    # one parse into a variant; its paths are case-sensitive, which the field names (e/E, s/S) need
    m = messages.withColumn("_v", F.try_parse_json(F.col(text)))
    m = m.withColumn("_kind", stream_kind(F.try_variant_get("_v", "$.stream", "string")))

    def when(kind: str, value: Column) -> Column:
        return F.when(F.col("_kind") == kind, value)

    def field(path: str, kind: str = "string") -> Column:
        return F.try_variant_get("_v", f"$.data.{path}", kind)

    def levels(path: str) -> Column:
        return field(path, LEVELS)

    time = (
        F.when(F.col("_kind").isin("depth", "trade"), field("T", "bigint"))
        .when(F.col("_kind") == "liquidation", field("o.T", "bigint"))
        .when(F.col("_kind") == "kline", field("E", "bigint"))
    )
    symbol = F.when(F.col("_kind") == "liquidation", field("o.s")).otherwise(field("s"))
    out = m.select(
        (time * 1000).alias("exchange_ts"), F.col(received).alias("local_ts"), F.col("_kind").alias("type"),
        symbol.alias("symbol"),
        when("depth", field("U", "bigint")).alias("first_update_id"),
        when("depth", field("u", "bigint")).alias("last_update_id"),
        when("depth", field("pu", "bigint")).alias("prev_update_id"),
        when("depth", levels("b")).alias("bids"), when("depth", levels("a")).alias("asks"),
        when("trade", F.struct(
            field("t", "bigint").alias("trade_id"), field("p").alias("price"), field("q").alias("quantity"),
            field("m", "boolean").alias("buyer_is_maker"))).alias("trade"),
        when("liquidation", F.struct(
            field("o.S").alias("side"), field("o.p").alias("price"), field("o.q").alias("quantity"),
            field("o.ap").alias("avg_price"), field("o.X").alias("status"))).alias("liquidation"),
        when("kline", F.struct(
            field("k.i").alias("interval"), field("k.o").alias("open"), field("k.h").alias("high"),
            field("k.l").alias("low"), field("k.c").alias("close"), field("k.v").alias("volume"),
            field("k.n", "bigint").alias("trades"), field("k.x", "boolean").alias("is_final"))).alias("kline"),
        F.lit(None).cast(META).alias("meta"), F.col(text).alias("_text"),
    )
    bad = F.col("type").isNull() | F.col("exchange_ts").isNull() | F.col("symbol").isNull()
    return out.withColumn("_corrupt", F.when(bad, F.col("_text"))).drop("_text")


# --- views of the union -----------------------------------------------------------------------

_HEAD = ["symbol", "exchange_ts", "local_ts"]


def depth_view(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("type") == "depth").select(
        *_HEAD, "first_update_id", "last_update_id", "prev_update_id", "bids", "asks"
    )


def trade_view(raw: DataFrame) -> DataFrame:
    t = F.col("trade")
    return raw.filter(F.col("type") == "trade").select(
        *_HEAD, t["trade_id"].alias("trade_id"), t["price"].try_cast("double").alias("price"),
        t["quantity"].try_cast("double").alias("qty"), t["buyer_is_maker"].alias("buyer_is_maker"),
    )


def liquidation_view(raw: DataFrame) -> DataFrame:
    x = F.col("liquidation")
    return raw.filter(F.col("type") == "liquidation").select(
        *_HEAD, x["side"].alias("side"), *[x[c].try_cast("double").alias(c) for c in ("price", "quantity", "avg_price")],
        x["status"].alias("status"),
    )


def bar_view(raw: DataFrame) -> DataFrame:
    k = F.col("kline")
    return raw.filter(F.col("type") == "kline").select(
        *_HEAD, k["interval"].alias("interval"),
        *[k[c].try_cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
        k["trades"].alias("trades"), k["is_final"].alias("is_final"),
    )


# --- landing ----------------------------------------------------------------------------------

def land(
    raw: DataFrame, path: str, max_records: int = 5_000_000, mode: str = "append",
    by: tuple[str, ...] = ("symbol", "date", "hour"),
) -> None:
    """Write records as Parquet by symbol, date and hour; files roll over at `max_records`.

    The rebalance hint gathers a folder's rows in few tasks and splits a folder that is too large.
    """
    at = to_timestamp(F.col("exchange_ts"))
    dated = raw.withColumns({"date": F.date_format(at, "yyyy-MM-dd"), "hour": F.hour(at)})
    writer = dated.hint("rebalance", *by).write.mode(mode).partitionBy(*by)
    writer.option("maxRecordsPerFile", max_records).option("compression", "zstd").parquet(path)


def to_lines(raw: DataFrame) -> DataFrame:
    """Records as JSON text; absent fields are left out."""
    return raw.select(F.to_json(F.struct(*[c for c in FIELDS if c in raw.columns])).alias("value"))
