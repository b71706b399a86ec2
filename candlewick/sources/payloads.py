"""Landed JSON payloads to typed frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Candle fields by position in the payload and the type each is read as.
# The twelfth position is ignored.
CANDLE_POSITIONS = (
    ("open_time_ms", "bigint"),
    ("open", "double"),
    ("high", "double"),
    ("low", "double"),
    ("close", "double"),
    ("volume", "double"),
    ("close_time_ms", "bigint"),
    ("quote_volume", "double"),
    ("trade_count", "bigint"),
    ("taker_buy_base_volume", "double"),
    ("taker_buy_quote_volume", "double"),
)

# Market object fields that are kept, in output order.
MARKET_FIELDS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("current_price", T.DoubleType()),
        T.StructField("market_cap", T.DoubleType()),
        T.StructField("market_cap_rank", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("price_change_percentage_24h", T.DoubleType()),
        T.StructField("circulating_supply", T.DoubleType()),
        T.StructField("last_updated", T.StringType()),
    ]
)

STRICT = {"mode": "FAILFAST"}


def _entries(type_: T.DataType | str) -> Column:
    """Entries of the payload array. What is no array at all must stop the load, not vanish."""
    payload = F.col("payload")
    return F.when(payload.rlike(r"^\s*\["), F.from_json(payload, type_, STRICT)).otherwise(
        F.raise_error(F.concat(F.lit("payload is no JSON array: "), F.coalesce(F.substring(payload, 1, 80), F.lit("NULL"))))
    )


def without_rows(raw: DataFrame) -> DataFrame:
    """Payloads that are arrays without entries: fetched, but nothing to load."""
    return raw.filter(F.size(_entries("array<string>")) == 0)


def read_payloads(spark: SparkSession, path: str, partitions: str = "") -> DataFrame:
    """One row per landed file: its whole text, plus Hive-style path columns.

    `partitions` is a DDL list such as "symbol string"; it keeps path values from being
    re-typed by inference.
    """
    schema = f"payload string, {partitions}" if partitions else "payload string"
    return spark.read.schema(schema).text(path, wholetext=True)


def parse_klines(
    raw: DataFrame, interval: str = "1d", keep: Sequence[str] = ()
) -> DataFrame:
    """(symbol, payload) to one typed row per candle."""
    candles = raw.select(
        "symbol",
        *keep,
        F.explode(_entries("array<array<string>>")).alias("candle"),
    )
    fields = [
        F.col("candle").getItem(position).cast(type_).alias(name)
        for position, (name, type_) in enumerate(CANDLE_POSITIONS)
    ]
    return candles.select(
        *fields,
        F.timestamp_millis(F.col("candle").getItem(0).cast("bigint")).alias("open_time"),
        "symbol",
        F.lit(interval).alias("interval"),
        *keep,
    )


def parse_markets(
    raw: DataFrame,
    snapshot_date: Column,
    vs_currency: str = "usd",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(payload) to one typed row per coin; objects may carry any further keys."""
    coins = raw.select(
        *keep,
        snapshot_date.cast("date").cast("timestamp_ntz").alias("snapshot_date"),
        F.explode(_entries(T.ArrayType(MARKET_FIELDS))).alias("coin"),
    )
    kept = [F.col("coin")[name].alias(name) for name in MARKET_FIELDS.names]
    return coins.select(
        kept[0].alias("coin_id"),
        *kept[1:],
        F.lit(vs_currency).alias("vs_currency"),
        "snapshot_date",
        *keep,
    )


def closed_candles(candles: DataFrame, as_of_ms: int) -> DataFrame:
    """Drop candles still open at `as_of_ms`."""
    return candles.filter(F.col("close_time_ms") <= F.lit(as_of_ms))
