"""Staging and mart models as DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.columns import growth, utc_date
from candlewick.operators.keyed import late_wins, latest_wins
from candlewick.operators.series import over_series

SHORT_ROWS = 7
LONG_ROWS = 30


KLINE_KEY = ("symbol", "open_time_ms")
KLINE_VALUES = (
    "close", "open", "high", "low", "volume", "quote_volume", "trade_count", "interval", "open_time",
)
MARKET_VALUES = (
    "current_price", "market_cap", "market_cap_rank", "total_volume", "price_change_percentage_24h",
    "circulating_supply", "symbol", "name",
)


def _largest(names: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(name) for name in names]


def stg_klines(raw: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Clean candles: the latest ingestion of each (symbol, open_time) wins.

    Between rows of one ingestion the larger values win, column by column, unless `tiebreak` says
    otherwise; rows that tie even then give the same result.
    """
    ties = _largest(KLINE_VALUES) if tiebreak is None else tiebreak
    return clean_klines(latest_wins(raw, KLINE_KEY, [F.col("ingested_date").desc()], ties))


def stg_klines_with_late(history: DataFrame, late: DataFrame) -> DataFrame:
    """The raw rows that stg_klines picks after a late ingestion, from those it picked before.

    With a history bucketed by KLINE_KEY only the late rows are shuffled; `clean_klines` makes the model of it.
    """
    return late_wins(history, late, KLINE_KEY, ["ingested_date", *KLINE_VALUES])


def clean_klines(latest: DataFrame) -> DataFrame:
    """The staging model from the raw rows that won."""
    return latest.select(
        "symbol",
        "interval",
        "open_time",
        utc_date(F.col("open_time_ms")).alias("trade_date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
        "ingested_date",
    )


def stg_markets(raw: DataFrame, tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Clean market snapshot: the latest ingestion of each (coin_id, day) wins; ties as in stg_klines."""
    daily = raw.withColumn("snapshot_date", F.to_date("snapshot_date"))
    ties = _largest(MARKET_VALUES) if tiebreak is None else tiebreak
    latest = latest_wins(daily, ["coin_id", "snapshot_date"], [F.col("ingested_date").desc()], ties)
    return latest.select(
        "coin_id",
        F.lower("symbol").alias("symbol"),
        "name",
        F.col("current_price").alias("price_usd"),
        "market_cap",
        F.bround("market_cap_rank").cast("int").alias("market_cap_rank"),
        F.col("total_volume").alias("volume_24h_usd"),
        F.col("price_change_percentage_24h").alias("pct_change_24h"),
        "circulating_supply",
        "snapshot_date",
        "ingested_date",
    )


def daily_return(bars: DataFrame, *, daily: bool = False) -> DataFrame:
    """Close over previous close minus one, per symbol."""

    def build(df: DataFrame, window) -> DataFrame:
        change = growth(F.col("close"), F.lag("close").over(window))
        return df.withColumn("daily_return", change)

    return over_series(bars, ["symbol"], ["trade_date"], build, before=1, daily=daily)


def mart_daily_ohlcv(
    stg: DataFrame, *, daily: bool = False, block_rows: int | None = None
) -> DataFrame:
    """Return, 7- and 30-row volatility and 30-row mean volume per symbol.

    All frames share one ordering, hence one shuffle and one sort. `daily=True` is held against the
    rows' interval, if they have one; finer candles raise.
    """
    if daily and "interval" in stg.columns:
        finer = F.concat(F.lit("daily=True, but the interval is "), F.coalesce("interval", F.lit("NULL")))
        stg = stg.filter(F.when(F.col("interval") == "1d", True).otherwise(F.raise_error(finer)))

    def build(df: DataFrame, window) -> DataFrame:
        returns = growth(F.col("close"), F.lag("close").over(window))
        short = window.rowsBetween(1 - SHORT_ROWS, 0)
        long = window.rowsBetween(1 - LONG_ROWS, 0)
        return df.withColumn("daily_return", returns).withColumns(
            {
                "volatility_7d": F.stddev_samp("daily_return").over(short),
                "volatility_30d": F.stddev_samp("daily_return").over(long),
                "avg_quote_volume_30d": F.avg("quote_volume").over(long),
            }
        )

    base = stg.select(
        "symbol",
        "trade_date",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
    )
    return over_series(
        base,
        ["symbol"],
        ["trade_date"],
        build,
        before=LONG_ROWS,
        daily=daily,
        block_rows=block_rows,
    )


def market_overview(stg: DataFrame, dominant: str = "bitcoin", top: int = 10) -> DataFrame:
    """Totals, dominance of one coin and concentration of the top ranks per snapshot day.

    Coins without a market cap count nowhere, not even in the volume total.
    """
    cap = F.col("market_cap")
    totals = (
        stg.filter(cap.isNotNull())
        .groupBy("snapshot_date")
        .agg(
            F.sum(cap).alias("total_market_cap"),
            F.sum("volume_24h_usd").alias("total_volume_24h"),
            F.count("*").alias("coins_tracked"),
            F.sum(F.when(F.col("coin_id") == dominant, cap).otherwise(0.0)).alias("_dominant"),
            F.sum(F.when(F.col("market_cap_rank") <= top, cap).otherwise(0.0)).alias("_top"),
        )
    )
    return totals.select(
        "snapshot_date",
        "total_market_cap",
        "total_volume_24h",
        "coins_tracked",
        F.try_divide("_dominant", "total_market_cap").alias("btc_dominance"),
        F.try_divide("_top", "total_market_cap").alias("top10_share"),
    )
