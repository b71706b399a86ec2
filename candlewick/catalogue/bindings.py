"""Market tables derived from the driver's tables.

| logical input | made from |
|---|---|
| event bars | `events` per event type and day |
| user bars | the same per user: many short series |
| supplier bars | `lineitem` per supplier and ship day |
| ticks | `events` one by one: few series, each a fifth of the table |
| market snapshots | `orders` and `customer` per month and nation |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import MS_PER_DAY, day_start_ms

# A payload holds at most this many candles or coins, as in the source requests.
CANDLES_PER_PAYLOAD = 1000
COINS_PER_PAYLOAD = 250


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(_event_trades(table(spark, sf_dir, "events"), "event_type"))


def user_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bars(_event_trades(table(spark, sf_dir, "events"), "user_id"))


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    cents = F.round(price * 100).cast("bigint")
    trades = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        F.to_date("l_shipdate").alias("trade_date"),
        price.alias("price"),
        F.col("l_quantity").alias("size"),
        # Order, line (up to 999), cents: equal places mean equal prices.
        (
            (F.col("l_orderkey").cast("decimal(19,0)") * F.lit(1000) + F.col("l_linenumber")).cast("decimal(22,0)")
            * F.lit(10**15).cast("decimal(16,0)")
            + cents
        ).cast("decimal(38,0)").alias("place"),
        (F.col("l_orderkey") % 2 == 0).alias("taker"),
    )
    return _bars(trades)


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a bar of its own; `open_time_ms` is the event's number, unique per row."""
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("open_time_ms"),
        F.to_date("ts").alias("trade_date"),
        value.alias("open"),
        (value + F.col("user_id") % 7).alias("high"),
        (value * 0.5).alias("low"),
        value.alias("close"),
        (F.col("user_id") + 1.0).alias("volume"),
        (value * (F.col("user_id") + 1.0)).alias("quote_volume"),
        F.lit(1).cast("bigint").alias("trade_count"),
    )


def _event_trades(events: DataFrame, symbol: str) -> DataFrame:
    """Trades in the order (ts, event_id), priced at the event's value.

    The place within the day is one decimal of microseconds and the whole id. A struct key would force
    the aggregate to sort all rows first; with a fixed-width key it stays a hash aggregate with
    map-side partials.
    """
    ts = F.col("ts")
    seconds = (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("bigint") * 1_000_000
    micros = seconds + (F.expr("extract(SECOND FROM ts)") * 1_000_000).cast("bigint")
    price = F.col("value")
    return events.select(
        F.col(symbol).cast("string").alias("symbol"),
        F.to_date(ts).alias("trade_date"),
        price.alias("price"),
        price.alias("size"),
        _place(micros, F.col("event_id")),
        (F.col("event_id") % 2 == 0).alias("taker"),
    )


def _place(first: Column, second: Column) -> Column:
    """One number that orders like (first, second), for first from 0 to 10^17 and any second."""
    return (
        first.cast("decimal(18,0)") * F.lit(str(10**19)).cast("decimal(20,0)") + second.cast("decimal(20,0)")
    ).cast("decimal(38,0)").alias("place")


def _bars(trades: DataFrame) -> DataFrame:
    """Daily bars with the raw candle columns. Sums are rounded to the decimals they can have."""
    price, size, value = F.col("price"), F.col("size"), F.col("price") * F.col("size")
    bars = trades.groupBy("symbol", "trade_date").agg(
        F.min_by("price", "place").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "place").alias("close"),
        F.round(F.sum(size), 2).alias("volume"),
        F.round(F.sum(value), 4).alias("quote_volume"),
        F.count("*").alias("trade_count"),
        F.round(F.sum(F.when(F.col("taker"), size).otherwise(0.0)), 2).alias(
            "taker_buy_base_volume"
        ),
        F.round(F.sum(F.when(F.col("taker"), value).otherwise(0.0)), 4).alias(
            "taker_buy_quote_volume"
        ),
    )
    open_ms = day_start_ms(F.col("trade_date"))
    return bars.select(
        open_ms.alias("open_time_ms"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        (open_ms + (MS_PER_DAY - 1)).alias("close_time_ms"),
        "quote_volume",
        "trade_count",
        "taker_buy_base_volume",
        "taker_buy_quote_volume",
        F.timestamp_millis(open_ms).alias("open_time"),
        "symbol",
        F.lit("1d").alias("interval"),
        "trade_date",
    )


def whole_prices(bars: DataFrame) -> DataFrame:
    """Bars with prices cut to whole units; a trade below 1 makes a low of 0, which the contract rejects."""
    return bars.withColumns({name: F.floor(F.col(name)).cast("double") for name in ("open", "high", "low", "close")})


def candles(bars: DataFrame) -> DataFrame:
    """Bars as a raw candle batch (contract columns only)."""
    return bars.drop("trade_date")


def reingested(bars: DataFrame) -> DataFrame:
    """Each candle ingested twice: one day late with a provisional close, then final."""
    final = F.col("_ingestion") == 2
    return (
        bars.withColumn("_ingestion", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn("ingested_date", F.date_add("trade_date", F.col("_ingestion")))
        .withColumn("close", F.when(final, F.col("close")).otherwise(F.col("open")))
        .drop("_ingestion", "trade_date")
    )


def candle_payloads(bars: DataFrame) -> DataFrame:
    """(symbol, payload): positional JSON arrays with prices as strings.

    Days are unique per symbol, so a chunk of CANDLES_PER_PAYLOAD days bounds a payload.
    """

    def quoted(name: str) -> Column:
        return F.concat(F.lit('"'), F.col(name).cast("string"), F.lit('"'))

    def plain(name: str) -> Column:
        return F.col(name).cast("string")

    positions = [
        plain("open_time_ms"),
        *[quoted(name) for name in ("open", "high", "low", "close", "volume")],
        plain("close_time_ms"),
        quoted("quote_volume"),
        plain("trade_count"),
        quoted("taker_buy_base_volume"),
        quoted("taker_buy_quote_volume"),
        F.lit('"0"'),
    ]
    candle = F.concat(F.lit("["), F.concat_ws(",", *positions), F.lit("]"))
    chunk = F.floor(F.unix_date("trade_date") / CANDLES_PER_PAYLOAD)
    grouped = bars.groupBy("symbol", chunk.alias("chunk")).agg(
        F.concat_ws(",", F.collect_list(candle)).alias("body")
    )
    return grouped.select("symbol", F.concat(F.lit("["), "body", F.lit("]")).alias("payload"))


def market_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw market rows per month and nation, one ingestion each.

    Orders are summed per customer and month before the join, so a customer with very many
    orders brings one row per month to it.
    """
    month = F.trunc("o_orderdate", "month")
    price = F.col("o_totalprice")
    spent = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", month.alias("month"))
        .agg(
            F.sum(price).alias("total"),
            F.min(price).alias("least"),
            F.max(price).alias("most"),
            F.count("*").alias("n"),
        )
    )
    nations = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        spent.join(nations, spent.o_custkey == nations.c_custkey)
        .groupBy("month", F.col("c_nationkey").alias("nation"))
        .agg(
            F.round(F.sum("total"), 2).alias("total"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
            F.sum("n").cast("double").alias("n"),
        )
    )
    nation = F.col("nation")
    # At most one row per nation and month.
    by_total = Window.partitionBy("month").orderBy(F.desc("total"), "nation")
    rank = F.row_number().over(by_total) + F.when(nation % 2 == 1, 0.5).otherwise(0.0)
    coin = nation.cast("string")
    return per_nation.select(
        coin.alias("coin_id"),
        F.concat(F.lit("N"), coin).alias("symbol"),
        F.concat(F.lit("nation "), coin).alias("name"),
        F.col("least").alias("current_price"),
        F.when(nation % 7 != 3, F.col("total")).alias("market_cap"),
        F.when(nation % 5 != 1, rank).alias("market_cap_rank"),
        F.col("most").alias("total_volume"),
        F.round((F.col("most") / F.col("least") - 1) * 100, 6).alias(
            "price_change_percentage_24h"
        ),
        F.col("n").alias("circulating_supply"),
        F.col("month").cast("string").alias("last_updated"),
        F.lit("usd").alias("vs_currency"),
        F.col("month").cast("timestamp_ntz").alias("snapshot_date"),
        F.date_add("month", 2).alias("ingested_date"),
    )


def reingested_markets(markets: DataFrame) -> DataFrame:
    """Each snapshot row ingested twice; the earlier one had double the price."""
    first = F.col("_ingestion") == 1
    return (
        markets.withColumn("_ingestion", F.explode(F.array(F.lit(1), F.lit(2))))
        .withColumn(
            "ingested_date", F.when(first, F.date_sub("ingested_date", 1)).otherwise(
                F.col("ingested_date")
            )
        )
        .withColumn("current_price", F.when(first, F.col("current_price") * 2).otherwise(
            F.col("current_price")
        ))
        .drop("_ingestion")
    )


def market_payloads(markets: DataFrame) -> DataFrame:
    """(snapshot_day, payload): JSON objects with keys the parser must ignore."""
    coin = F.struct(
        F.col("coin_id").alias("id"),
        "symbol",
        "name",
        "current_price",
        "market_cap",
        "market_cap_rank",
        "total_volume",
        "price_change_percentage_24h",
        "circulating_supply",
        "last_updated",
        F.struct(F.col("current_price").alias("times"), F.lit("usd").alias("currency")).alias(
            "roi"
        ),
    )
    page = F.floor(F.regexp_extract("coin_id", "^[0-9]+", 0).cast("bigint") / COINS_PER_PAYLOAD)
    grouped = markets.groupBy(F.to_date("snapshot_date").alias("snapshot_day"), page).agg(
        F.concat_ws(",", F.collect_list(F.to_json(coin))).alias("body")
    )
    return grouped.select("snapshot_day", F.concat(F.lit("["), "body", F.lit("]")).alias("payload"))


def customer_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in the shape of a market batch, with real contract violations."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        F.when(key % 50 == 7, key - 7).otherwise(key).cast("string").alias("coin_id"),
        F.col("c_mktsegment").alias("symbol"),
        F.when(nation != 11, F.col("c_name")).alias("name"),
        balance.alias("current_price"),
        F.when(nation % 7 != 3, balance * 10).alias("market_cap"),
        F.when(nation % 5 != 1, nation.cast("double")).alias("market_cap_rank"),
        F.abs(balance).alias("total_volume"),
        F.when(nation % 2 == 0, balance / 100).alias("price_change_percentage_24h"),
        key.cast("double").alias("circulating_supply"),
        F.lit("2024-01-01").alias("last_updated"),
        F.lit("usd").alias("vs_currency"),
        F.lit("2024-01-01").cast("date").cast("timestamp_ntz").alias("snapshot_date"),
    )


def lineitem_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the shape of a candle batch: repeated keys and crossed highs and lows."""
    price = F.col("l_extendedprice")
    open_ms = F.col("l_linenumber").cast("bigint") * MS_PER_DAY
    return table(spark, sf_dir, "lineitem").select(
        open_ms.alias("open_time_ms"),
        price.alias("open"),
        (price * (1 - F.col("l_tax"))).alias("high"),
        (price * (1 - F.col("l_discount"))).alias("low"),
        price.alias("close"),
        F.col("l_quantity").alias("volume"),
        (open_ms + (MS_PER_DAY - 1)).alias("close_time_ms"),
        (price * F.col("l_quantity")).alias("quote_volume"),
        F.col("l_quantity").cast("bigint").alias("trade_count"),
        F.col("l_tax").alias("taker_buy_base_volume"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("taker_buy_quote_volume"),
        F.timestamp_millis(open_ms).alias("open_time"),
        F.col("l_orderkey").cast("string").alias("symbol"),
        F.lit("1d").alias("interval"),
    )


def middle_bars(bars: DataFrame) -> DataFrame:
    """(symbol, open_time_ms) of each daily series' middle bar."""
    by_time = Window.partitionBy("symbol").orderBy("open_time_ms")
    placed = bars.select(
        "symbol",
        "open_time_ms",
        F.row_number().over(by_time).alias("place"),
        F.count("*").over(Window.partitionBy("symbol")).alias("n"),
    )
    middle = F.floor(F.col("n") / 2) + 1
    return placed.filter(F.col("place") == middle).select("symbol", "open_time_ms")
