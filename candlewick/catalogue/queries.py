"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Computed doubles are rounded here, not in the operators, because engines add floating-point
numbers in different orders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.catalogue import bindings as b
from candlewick.functions.columns import utc_clock, utc_date
from candlewick.operators import checks, contracts, serve
from candlewick.operators.arima import ORDER, arima_forecast
from candlewick.operators.events import event_study, event_windows, rejected_events
from candlewick.operators.features import (
    FEATURE_COLUMNS,
    inject_shock,
    log_returns,
    ohlcv_features,
)
from candlewick.operators.forecast import (
    forecast_eval,
    forecast_metrics,
    naive_forecast,
    series_lengths,
)
from candlewick.operators.iforest import grow_trees, tree_samples
from candlewick.operators.quantile import exact_quantiles
from candlewick.operators.keyed import (
    append_series,
    last_n_per_key,
    latest_wins,
    merge_fresh_wins,
    top_n_per_key,
)
from candlewick.plans import models, research, scorecard, warehouse
from candlewick.plans.ingest import (
    KLINES_DATASET,
    MARKETS_DATASET,
    RAW_SCHEMAS,
    ingest_klines,
    ingest_markets,
)
from candlewick.sources import payloads, raw, reports, snapshot
from candlewick.sources.bucketed import write_bucketed
from candlewick.sources.storage import fresh_path, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PAGE_SYMBOL = "7"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
AS_OF_MS = 1_705_708_800_000  # 2024-01-20 00:00 UTC
SHIPPED_AS_OF_MS = 978_307_200_000  # 2001-01-01 00:00 UTC, within the ship days
INGESTED = dt.date(2024, 2, 1)
FRESH_FROM = dt.date(2024, 1, 15)
PREVIOUS_UNTIL = dt.date(2024, 1, 20)
OVERVIEW_FRESH_FROM = dt.date(1998, 1, 1)
OVERVIEW_PREVIOUS_UNTIL = dt.date(1998, 6, 1)
DOMINANT = "0"
HOLDOUT = 10
# Small enough for borders between blocks and between files in the test tables.
SMALL_BLOCK = 512
NEW_MONTH = dt.date(2001, 1, 1)
SMALL_FILE = 256
SMALL_BUCKETS = 8

MART_DIGITS = {
    "daily_return": 8,
    "volatility_7d": 8,
    "volatility_30d": 8,
    "avg_quote_volume_30d": 4,
}
OVERVIEW_DIGITS = {
    "total_market_cap": 2,
    "total_volume_24h": 2,
    "btc_dominance": 8,
    "top10_share": 8,
}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


# A mean of few amounts with four decimals often ends in an exact 5 at the fifth, where engines
# round differently; this moves such values off the tie on both sides.
OFF_TIE = {"avg_quote_volume_30d": 1e-7}


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns(
        {name: F.round(F.col(name) + OFF_TIE.get(name, 0.0), n) for name, n in digits.items()}
    )


def event_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = models.stg_klines(b.reingested(b.event_bars(spark, sf_dir)))
    return models.mart_daily_ohlcv(staged, daily=True)


def user_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart_daily_ohlcv(b.user_bars(spark, sf_dir), daily=True)


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_markets = b.reingested_markets(b.market_snapshots(spark, sf_dir))
    return models.market_overview(models.stg_markets(raw_markets), dominant=DOMINANT)


# --- sources, raw layer, sinks


@query("parse_klines")
def parse_klines(spark, sf_dir):
    landed = b.candle_payloads(b.event_bars(spark, sf_dir))
    parsed = payloads.parse_klines(landed)
    return parsed.withColumn("open_time", utc_clock(F.col("open_time_ms")))


@query("parse_markets")
def parse_markets(spark, sf_dir):
    landed = b.market_payloads(b.market_snapshots(spark, sf_dir))
    return payloads.parse_markets(landed, F.col("snapshot_day"))


@query("closed_candle_filter")
def closed_candle_filter(spark, sf_dir):
    landed = b.candle_payloads(b.user_bars(spark, sf_dir))
    closed = payloads.closed_candles(payloads.parse_klines(landed), AS_OF_MS)
    return closed.select("symbol", "open_time_ms", "close_time_ms", "close", "trade_count")


@query("ingest_all_symbols")
def ingest_all_symbols(spark, sf_dir):
    landed = b.candle_payloads(b.supplier_bars(spark, sf_dir))
    return ingest_klines(landed, fresh_path(spark, "raw"), SHIPPED_AS_OF_MS, INGESTED)


@query("ingest_all_markets")
def ingest_all_markets(spark, sf_dir):
    # Each month is a batch of its own in the source; here all come at once under distinct ids.
    month = F.date_format("snapshot_date", "yyyy-MM")
    coins = b.market_snapshots(spark, sf_dir).withColumn("coin_id", F.concat("coin_id", F.lit("@"), month))
    landed = b.market_payloads(coins)
    root = fresh_path(spark, "raw")
    ingest_markets(landed, root, F.col("snapshot_day"), INGESTED)
    raw_rows = raw.load_raw(spark, root, {MARKETS_DATASET: RAW_SCHEMAS[MARKETS_DATASET]})
    return raw_rows[MARKETS_DATASET].select(
        "coin_id", "current_price", "market_cap", "snapshot_date", "ingested_date"
    )


@query("write_raw_partition")
def write_raw_partition(spark, sf_dir):
    root = fresh_path(spark, "raw")
    batch = b.candles(b.event_bars(spark, sf_dir))
    # The second write is the re-run of the same day and must replace the first.
    raw.write_raw(batch.withColumn("close", F.lit(0.0)), root, KLINES_DATASET, INGESTED, "symbol")
    raw.write_raw(batch, root, KLINES_DATASET, INGESTED, "symbol")
    landed = raw.load_raw(spark, root, {KLINES_DATASET: RAW_SCHEMAS[KLINES_DATASET]})
    return landed[KLINES_DATASET].select(
        "symbol", "open_time_ms", "open", "high", "low", "close", "volume", "ingested_date"
    )


def _loaded(spark, sf_dir) -> dict[str, DataFrame]:
    root = fresh_path(spark, "raw")
    bars = b.candles(b.event_bars(spark, sf_dir))
    early = payloads.closed_candles(bars, AS_OF_MS)
    raw.write_raw(early, root, "klines", dt.date(2024, 1, 20), "symbol")
    raw.write_raw(bars, root, "klines", INGESTED, "symbol")
    markets = b.reingested_markets(b.market_snapshots(spark, sf_dir))
    raw.write_raw(markets, root, "markets")
    return raw.load_raw(spark, root, {**RAW_SCHEMAS, "never_landed": RAW_SCHEMAS["klines"]})


@query("load_raw")
def load_raw(spark, sf_dir):
    klines = _loaded(spark, sf_dir)["klines"]
    return klines.select("symbol", "open_time_ms", "close", "trade_count", "ingested_date")


@query("load_raw_increment")
def load_raw_increment(spark, sf_dir):
    root, schemas = fresh_path(spark, "raw"), {KLINES_DATASET: RAW_SCHEMAS[KLINES_DATASET]}
    bars = b.candles(b.user_bars(spark, sf_dir))
    raw.write_raw(payloads.closed_candles(bars, AS_OF_MS), root, KLINES_DATASET, dt.date(2024, 1, 20))
    first = raw.load_new(spark, root, schemas, raw.read_marks(spark, root))
    raw.write_marks(spark, root, raw.high_water(first))
    raw.write_raw(bars, root, KLINES_DATASET, INGESTED)
    second = raw.load_new(spark, root, schemas, raw.read_marks(spark, root))
    both = append_series(first[KLINES_DATASET].filter(F.col("ingested_date") < INGESTED), second[KLINES_DATASET])
    return both.select("symbol", "open_time_ms", "close", "trade_count", "ingested_date")


@query("raw_row_counts")
def raw_row_counts(spark, sf_dir):
    return raw.row_counts(_loaded(spark, sf_dir))


@query("export_snapshot")
def export_snapshot(spark, sf_dir):
    root = fresh_path(spark, "snapshot")
    fresh, previous = _overlapping(user_mart(spark, sf_dir))
    days = overview(spark, sf_dir)
    old = days.filter(F.col("snapshot_date") <= F.lit(OVERVIEW_PREVIOUS_UNTIL))
    new = days.filter(F.col("snapshot_date") >= F.lit(OVERVIEW_FRESH_FROM))
    snapshot.export_snapshot({"mart_daily_ohlcv": previous, "mart_market_overview": old}, root, file_rows=SMALL_FILE)
    snapshot.export_snapshot({"mart_daily_ohlcv": fresh, "mart_market_overview": new}, root, file_rows=SMALL_FILE)
    merged = snapshot.read_snapshot(spark, root)["mart_daily_ohlcv"]
    return rounded(merged, {**MART_DIGITS, "close": 4})


@query("export_snapshot_counts")
def export_snapshot_counts(spark, sf_dir):
    root = fresh_path(spark, "snapshot")
    days = overview(spark, sf_dir)
    old = days.filter(F.col("snapshot_date") <= F.lit(OVERVIEW_PREVIOUS_UNTIL))
    new = days.filter(F.col("snapshot_date") >= F.lit(OVERVIEW_FRESH_FROM))
    snapshot.export_snapshot({"mart_market_overview": old}, root)
    return snapshot.export_snapshot({"mart_market_overview": new}, root)


@query("snapshot_extent")
def snapshot_extent(spark, sf_dir):
    root = fresh_path(spark, "snapshot")
    snapshot.publish({"mart_daily_ohlcv": user_mart(spark, sf_dir)}, root, file_rows=SMALL_FILE)
    return snapshot.extent(spark, root, "mart_daily_ohlcv")


@query("report_json")
def report_json(spark, sf_dir):
    summary = scorecard.freshness(event_mart(spark, sf_dir))
    path = reports.write_report(summary, fresh_path(spark, "report"))
    return spark.read.schema("symbols bigint, max_day date, min_day date").json(path)


def _register(spark, sf_dir) -> None:
    staged = models.stg_klines(b.reingested(b.event_bars(spark, sf_dir)))
    staged.createOrReplaceTempView("stg_klines")
    models.mart_daily_ohlcv(staged, daily=True).createOrReplaceTempView("mart_daily_ohlcv")
    overview(spark, sf_dir).createOrReplaceTempView("mart_market_overview")


@query("list_tables")
def list_tables(spark, sf_dir):
    _register(spark, sf_dir)
    names = ("stg_klines", "mart_daily_ohlcv", "mart_market_overview")
    listed = reports.list_tables(spark).filter("is_temporary").select("table_name")
    counts = raw.row_counts(reports.present_tables(spark, names), "table_name")
    return listed.join(counts, "table_name")


# --- staging and marts


@query("stg_klines")
def stg_klines(spark, sf_dir):
    staged = models.stg_klines(b.reingested(b.user_bars(spark, sf_dir)))
    return staged.withColumn("open_time", F.col("trade_date").cast("timestamp_ntz"))


@query("stg_klines_late")
def stg_klines_late(spark, sf_dir):
    bars = b.reingested(b.user_bars(spark, sf_dir))
    in_time = F.datediff("ingested_date", utc_date(F.col("open_time_ms"))) == 1
    history = write_bucketed(bars.filter(in_time), models.KLINE_KEY, SMALL_BUCKETS)
    staged = models.clean_klines(models.stg_klines_with_late(history, bars.filter(~in_time)))
    return staged.withColumn("open_time", F.col("trade_date").cast("timestamp_ntz"))


@query("latest_ingestion_wins")
def latest_ingestion_wins(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        F.to_date("l_shipdate").alias("ingested_date"),
    )
    tiebreak = [F.col(name) for name in ("l_partkey", "l_suppkey", "l_extendedprice")]
    return latest_wins(
        lines, ["l_orderkey", "l_linenumber"], [F.col("ingested_date").desc()], tiebreak
    )


@query("stg_markets")
def stg_markets(spark, sf_dir):
    return models.stg_markets(b.reingested_markets(b.market_snapshots(spark, sf_dir)))


@query("daily_return")
def daily_return(spark, sf_dir):
    returns = models.daily_return(b.user_bars(spark, sf_dir), daily=True)
    return rounded(
        returns.select("symbol", "trade_date", "close", "daily_return"), {"daily_return": 8}
    )


@query("mart_daily_ohlcv")
def mart_daily_ohlcv(spark, sf_dir):
    return rounded(event_mart(spark, sf_dir), MART_DIGITS)


@query("mart_daily_ohlcv_users")
def mart_daily_ohlcv_users(spark, sf_dir):
    return rounded(user_mart(spark, sf_dir), MART_DIGITS)


@query("mart_daily_ohlcv_suppliers")
def mart_daily_ohlcv_suppliers(spark, sf_dir):
    mart = models.mart_daily_ohlcv(b.supplier_bars(spark, sf_dir), daily=True)
    return rounded(mart, MART_DIGITS)


@query("mart_daily_ohlcv_blocked")
def mart_daily_ohlcv_blocked(spark, sf_dir):
    mart = models.mart_daily_ohlcv(b.user_bars(spark, sf_dir), block_rows=SMALL_BLOCK)
    return rounded(mart, MART_DIGITS)


@query("market_overview")
def market_overview(spark, sf_dir):
    return rounded(overview(spark, sf_dir), OVERVIEW_DIGITS)


def _overlapping(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A fresh mart and an older one with other closes, sharing some days."""
    fresh = mart.filter(F.col("trade_date") >= F.lit(FRESH_FROM))
    previous = mart.filter(F.col("trade_date") <= F.lit(PREVIOUS_UNTIL)).withColumn(
        "close", F.col("close") + 1.0
    )
    return fresh, previous


@query("merge_fresh_wins")
def merge_fresh_history(spark, sf_dir):
    fresh, previous = _overlapping(user_mart(spark, sf_dir))
    merged = merge_fresh_wins(fresh, previous, ["symbol", "trade_date"])
    return rounded(merged, {**MART_DIGITS, "close": 4})



@query("append_series")
def append_bars(spark, sf_dir):
    fresh, previous = _overlapping(b.user_bars(spark, sf_dir))
    both = append_series(previous, fresh)
    return rounded(both.select("symbol", "trade_date", "close", "volume"), {"close": 4})



# --- dashboard and notebook


def _served(spark, sf_dir, **equal) -> DataFrame:
    """The user mart as pages read it: from the files of a published snapshot that may hold their rows."""
    root = fresh_path(spark, "pages")
    snapshot.publish({"mart_daily_ohlcv": user_mart(spark, sf_dir)}, root, file_rows=SMALL_FILE)
    return snapshot.read_mart(spark, root, "mart_daily_ohlcv", **equal)


@query("price_history")
def price_history(spark, sf_dir):
    return serve.series(_served(spark, sf_dir), "close")


@query("volatility_series")
def volatility_series(spark, sf_dir):
    rows = serve.series(_served(spark, sf_dir), "volatility_30d", drop_null=True)
    return rounded(rows, {"volatility_30d": 8})


@query("symbol_history")
def symbol_history(spark, sf_dir):
    columns = (
        "open",
        "high",
        "low",
        "close",
        "daily_return",
        "volatility_7d",
        "volatility_30d",
        "quote_volume",
    )
    rows = serve.symbol_view(_served(spark, sf_dir, symbol=PAGE_SYMBOL), PAGE_SYMBOL, columns)
    return rounded(rows, {"daily_return": 8, "volatility_7d": 8, "volatility_30d": 8})


@query("symbol_latest")
def symbol_latest(spark, sf_dir):
    columns = ("close", "daily_return", "volatility_30d", "quote_volume")
    row = serve.latest_row(_served(spark, sf_dir, symbol=PAGE_SYMBOL), "trade_date", columns, PAGE_SYMBOL)
    return rounded(row, {"daily_return": 8, "volatility_30d": 8})


@query("symbol_price_series")
def symbol_price_series(spark, sf_dir):
    return serve.symbol_view(_served(spark, sf_dir, symbol=PAGE_SYMBOL), PAGE_SYMBOL, ["close"])


@query("symbol_vol_series")
def symbol_vol_series(spark, sf_dir):
    columns = ["volatility_7d", "volatility_30d"]
    rows = serve.symbol_view(_served(spark, sf_dir, symbol=PAGE_SYMBOL), PAGE_SYMBOL, columns, columns)
    return rounded(rows, {"volatility_7d": 8, "volatility_30d": 8})


@query("symbol_returns")
def symbol_returns(spark, sf_dir):
    columns = ["daily_return"]
    rows = serve.symbol_view(_served(spark, sf_dir, symbol=PAGE_SYMBOL), PAGE_SYMBOL, columns, columns)
    return rounded(rows, {"daily_return": 8})


@query("symbol_volumes")
def symbol_volumes(spark, sf_dir):
    return serve.symbol_view(_served(spark, sf_dir, symbol=PAGE_SYMBOL), PAGE_SYMBOL, ["quote_volume"])


@query("ordered_marts")
def ordered_marts(spark, sf_dir):
    return rounded(serve.ordered(event_mart(spark, sf_dir), ["symbol", "trade_date"]), MART_DIGITS)


@query("ordered_overview")
def ordered_overview(spark, sf_dir):
    return rounded(serve.ordered(overview(spark, sf_dir), ["snapshot_date"]), OVERVIEW_DIGITS)


@query("latest_overview")
def latest_overview(spark, sf_dir):
    return rounded(serve.latest_row(overview(spark, sf_dir), "snapshot_date"), OVERVIEW_DIGITS)


@query("latest_by_symbol")
def latest_by_symbol(spark, sf_dir):
    digits = {"last_daily_return": 8, "volatility_30d": 8, "avg_quote_volume_30d": 4}
    return rounded(serve.latest_by_symbol(user_mart(spark, sf_dir)), digits)


def _described(mart: DataFrame) -> DataFrame:
    stats = serve.describe_by(mart, "symbol", ("daily_return", "volatility_30d"))
    return rounded(
        stats, {name: 8 for name in stats.columns if name != "symbol" and "_count" not in name}
    )


@query("describe_by_symbol")
def describe_by_symbol(spark, sf_dir):
    return _described(event_mart(spark, sf_dir))


@query("describe_by_symbol_users")
def describe_by_user(spark, sf_dir):
    return _described(user_mart(spark, sf_dir))


@query("close_pivot")
def close_pivot(spark, sf_dir):
    mart = event_mart(spark, sf_dir)
    wide = serve.pivot_mean(mart, "trade_date", "symbol", "close", EVENT_TYPES)
    return rounded(wide, dict.fromkeys(EVENT_TYPES, 8))


@query("top_n_by_market_cap")
def top_n_by_market_cap(spark, sf_dir):
    markets = b.market_snapshots(spark, sf_dir)
    order = [F.desc_nulls_last("market_cap"), F.col("coin_id")]
    top = top_n_per_key(markets, "snapshot_date", order, 10)
    return top.select("snapshot_date", "coin_id", "market_cap", "market_cap_rank")


@query("lookback_last_n")
def lookback_last_n(spark, sf_dir):
    last = last_n_per_key(b.user_bars(spark, sf_dir), "symbol", [F.col("open_time_ms")], 7)
    return last.select("symbol", "trade_date", "open", "close", "volume")


# --- data quality


@query("contract_markets")
def contract_markets(spark, sf_dir):
    return contracts.violations(b.customer_markets(spark, sf_dir), contracts.MARKETS)


@query("contract_klines")
def contract_klines(spark, sf_dir):
    return contracts.violations(b.lineitem_candles(spark, sf_dir), contracts.KLINES)


@query("contract_klines_batches")
def contract_klines_batches(spark, sf_dir):
    batches = b.reingested(b.user_bars(spark, sf_dir))
    return contracts.violations(batches, contracts.KLINES, batch=["ingested_date"])


@query("contract_klines_zero_prices")
def contract_klines_zero_prices(spark, sf_dir):
    return contracts.violations(b.candles(b.whole_prices(b.user_bars(spark, sf_dir))), contracts.KLINES)


@query("contract_rejects")
def contract_rejects(spark, sf_dir):
    broken = contracts.rejects(b.customer_markets(spark, sf_dir), contracts.MARKETS)
    return broken.select(
        F.col("circulating_supply").cast("bigint").alias("c_custkey"),
        "coin_id",
        F.concat_ws("|", "failed").alias("failed"),
        "first_failed",
    )


@query("test_not_null")
def test_not_null(spark, sf_dir):
    staged_markets = models.stg_markets(b.market_snapshots(spark, sf_dir))
    staged = models.stg_klines(b.candles(b.user_bars(spark, sf_dir)).withColumn(
        "ingested_date", F.lit(INGESTED)
    ))
    batch = b.customer_markets(spark, sf_dir)
    return checks.all_results(
        [
            checks.column_tests(staged_markets, "stg_markets", ["coin_id", "price_usd"]),
            checks.column_tests(staged, "stg_klines", ["symbol", "close"]),
            checks.column_tests(user_mart(spark, sf_dir), "mart_daily_ohlcv", ["close"]),
            checks.column_tests(
                overview(spark, sf_dir), "mart_market_overview", ["snapshot_date", "btc_dominance"]
            ),
            checks.column_tests(batch, "customer_markets", ["name", "market_cap"]),
        ]
    )


@query("test_positive_value")
def test_positive_value(spark, sf_dir):
    batch = b.customer_markets(spark, sf_dir)
    staged_markets = models.stg_markets(b.market_snapshots(spark, sf_dir))
    mart = user_mart(spark, sf_dir)
    failing = checks.positive_value(batch, "current_price")
    return checks.all_results(
        [
            checks.column_tests(staged_markets, "stg_markets", positive=["price_usd"]),
            checks.column_tests(mart, "mart_daily_ohlcv", positive=["close"]),
            checks.result_of("customer_markets", "positive_value", "current_price", failing),
        ]
    )


@query("test_unique_combination")
def test_unique_combination(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    staged_markets = models.stg_markets(b.reingested_markets(b.market_snapshots(spark, sf_dir)))
    mart = user_mart(spark, sf_dir)
    results = [
        ("lineitem", lines, keys),
        ("stg_markets", staged_markets, ["coin_id", "snapshot_date"]),
        ("mart_daily_ohlcv", mart, ["symbol", "trade_date"]),
    ]
    return checks.all_results(
        [
            checks.result_of(model, "unique_combination", ",".join(key), checks.unique(df, key))
            for model, df, key in results
        ]
    )


@query("test_unique_increment")
def test_unique_increment(spark, sf_dir):
    """Keys of the last ship days against those of all days before, of which every tenth key occurs again."""
    day, keys = F.to_date("l_shipdate"), ["l_orderkey", "l_linenumber"]
    lines = b.table(spark, sf_dir, "lineitem").select(*keys, F.trunc(day, "month").alias("month"))
    firsts = lines.groupBy(*keys).agg(F.min("month").alias("month"))
    old = stored(firsts.filter(F.col("month") < NEW_MONTH), "old-lines")
    again = old.filter("l_orderkey % 10 = 0").withColumn("month", F.lit(NEW_MONTH))
    new = firsts.filter(F.col("month") >= NEW_MONTH).unionByName(again)
    return checks.unique_since(new, old, checks.key_filters(old, keys, "month"), keys, "month")


@query("test_unique")
def test_unique(spark, sf_dir):
    days = overview(spark, sf_dir)
    batch = b.customer_markets(spark, sf_dir)
    return checks.all_results(
        [
            checks.result_of(
                "mart_market_overview", "unique", "snapshot_date",
                checks.unique(days, ["snapshot_date"]),
            ),
            checks.result_of(
                "customer_markets", "unique", "coin_id", checks.unique(batch, ["coin_id"])
            ),
        ]
    )


def _probes(spark, sf_dir) -> DataFrame:
    # Five probes read each input, so both are written once.
    markets = stored(b.market_snapshots(spark, sf_dir), "markets")
    klines = stored(b.candles(b.supplier_bars(spark, sf_dir)), "klines")
    return scorecard.contract_probes(markets, klines, markets_batch=["ingested_date"])


@query("data_tests")
def data_tests(spark, sf_dir):
    marts = fresh_path(spark, "warehouse")
    relations = warehouse.build_warehouse(_loaded(spark, sf_dir), marts, daily=True)
    return warehouse.data_tests(relations)


@query("contract_probes")
def contract_probes(spark, sf_dir):
    probes = _probes(spark, sf_dir).withColumn("broken", F.concat_ws("; ", "broken"))
    return probes.select("name", "dataset", "expected", "passed", "detail", "broken")


@query("probe_summary")
def probe_summary(spark, sf_dir):
    return scorecard.probe_summary(_probes(spark, sf_dir))


@query("warehouse_freshness")
def warehouse_freshness(spark, sf_dir):
    return scorecard.freshness(user_mart(spark, sf_dir))


@query("warehouse_row_counts")
def warehouse_row_counts(spark, sf_dir):
    _register(spark, sf_dir)
    return raw.row_counts(reports.present_tables(spark, scorecard.SANITY_TABLES), "table_name")


@query("qc_scorecard")
def qc_scorecard(spark, sf_dir):
    _register(spark, sf_dir)
    relations = reports.present_tables(spark, scorecard.SANITY_TABLES)
    card = scorecard.scorecard(_probes(spark, sf_dir), relations)
    counts = F.transform(
        "warehouse.row_counts",
        lambda entry: F.concat_ws("=", entry["table"], entry["n"].cast("string")),
    )
    return card.select(
        F.size("probes").alias("probes"),
        "probe_summary.*",
        "warehouse.available",
        F.array_join("warehouse.tables", ",").alias("tables"),
        "warehouse.reason",
        F.array_join(counts, ",").alias("row_counts"),
        "warehouse.ohlcv.*",
        F.size("caveats").cast("bigint").alias("caveats"),
    )


# --- features and research


QUANTILES = (0.0, 0.05, 0.5, 0.999)


@query("exact_quantiles")
def prices_by_quantile(spark, sf_dir):
    prices = exact_quantiles(b.table(spark, sf_dir, "lineitem"), "l_extendedprice", QUANTILES)
    found = list(zip(QUANTILES, prices, strict=True))
    return rounded(spark.createDataFrame(found, "q double, price double"), {"price": 6})


FEATURE_DIGITS = dict.fromkeys(FEATURE_COLUMNS, 6)


@query("ohlcv_features")
def user_features(spark, sf_dir):
    rows = ohlcv_features(b.user_bars(spark, sf_dir), daily=True)
    return rounded(rows.select("symbol", "open_time_ms", *FEATURE_COLUMNS), FEATURE_DIGITS)



@query("ohlcv_features_suppliers")
def ohlcv_features_suppliers(spark, sf_dir):
    rows = ohlcv_features(b.supplier_bars(spark, sf_dir), daily=True)
    return rounded(rows.select("symbol", "open_time_ms", *FEATURE_COLUMNS), FEATURE_DIGITS)


@query("ohlcv_features_ticks")
def ohlcv_features_ticks(spark, sf_dir):
    columns = ("symbol", "open_time_ms", "open", "high", "low", "close", "volume")
    rows = ohlcv_features(b.ticks(spark, sf_dir).select(*columns), block_rows=SMALL_BLOCK)
    return rounded(rows.select("symbol", "open_time_ms", *FEATURE_COLUMNS), FEATURE_DIGITS)


@query("log_returns")
def user_log_returns(spark, sf_dir):
    rows = log_returns(b.user_bars(spark, sf_dir), daily=True)
    return rounded(rows.select("symbol", "open_time_ms", "log_return"), {"log_return": 8})



@query("log_returns_ticks")
def log_returns_ticks(spark, sf_dir):
    ticks = b.ticks(spark, sf_dir).select("symbol", "open_time_ms", "close")
    rows = log_returns(ticks, block_rows=SMALL_BLOCK)
    return rounded(rows.select("symbol", "open_time_ms", "log_return"), {"log_return": 8})


@query("inject_shock")
def shocked_bars(spark, sf_dir):
    bars = b.event_bars(spark, sf_dir)
    shocked = inject_shock(bars, b.middle_bars(bars), daily=True)
    return rounded(shocked.select("symbol", "trade_date", "high", "close"), {"high": 8, "close": 8})



def _forest_features(spark, sf_dir) -> DataFrame:
    # Rounded, so that both engines put a row on the same side of every threshold.
    return rounded(ohlcv_features(b.user_bars(spark, sf_dir), daily=True), FEATURE_DIGITS)


def _anomalies(spark, sf_dir) -> DataFrame:
    scored = research.detect_anomalies(_forest_features(spark, sf_dir))
    return rounded(scored, {"anomaly_score": 8})


@query("anomaly_fit")
def anomaly_fit(spark, sf_dir):
    features = stored(_forest_features(spark, sf_dir), "features")
    rows = features.count()
    key = ["symbol", "open_time_ms"]
    sampled = tree_samples(features, FEATURE_COLUMNS, key, rows, 100, min(256, rows), 42)
    nodes = grow_trees(sampled, FEATURE_COLUMNS, min(256, rows), 42)
    return rounded(nodes, {"threshold": 6, "path": 6})


@query("anomaly_score")
def anomaly_score(spark, sf_dir):
    scored = _anomalies(spark, sf_dir)
    return scored.select("symbol", "open_time_ms", "close", "anomaly_score", "is_anomaly")


@query("top_anomalies")
def top_anomalies(spark, sf_dir):
    return research.top_anomalies(_anomalies(spark, sf_dir))


@query("anomaly_summary")
def anomaly_summary(spark, sf_dir):
    return research.anomaly_summary(_anomalies(spark, sf_dir))


@query("spike_flagged")
def spike_flagged(spark, sf_dir):
    return research.spike_flagged(_anomalies(spark, sf_dir))


@query("anomaly_report")
def anomaly_report(spark, sf_dir):
    report = research.anomaly_report(_anomalies(spark, sf_dir), source="user bars")
    flags = F.transform(
        "top_flags", lambda f: F.concat_ws("@", f["symbol"], f["open_time_ms"].cast("string"))
    )
    return report.select(
        "source",
        "summary.n_rows",
        "summary.n_anomalies",
        "summary.anomaly_rate",
        "summary.seed",
        F.array_join("summary.feature_columns", ",").alias("feature_columns"),
        F.array_join(flags, ",").alias("top_flags"),
        F.size("caveats").alias("caveats"),
    )


@query("naive_forecast")
def last_value_forecast(spark, sf_dir):
    rows = naive_forecast(b.user_bars(spark, sf_dir), HOLDOUT)
    return rows.select("symbol", "step", "actual", "pred")



@query("forecast_metrics")
def naive_metrics(spark, sf_dir):
    predictions = naive_forecast(b.user_bars(spark, sf_dir), HOLDOUT)
    return rounded(
        forecast_metrics(predictions), {"mae": 6, "rmse": 6, "directional_accuracy": 4}
    )



@query("forecast_eligibility")
def forecast_eligibility(spark, sf_dir):
    return series_lengths(b.user_bars(spark, sf_dir), HOLDOUT)


@query("arima_forecast")
def rolling_arima(spark, sf_dir):
    rows = arima_forecast(b.user_bars(spark, sf_dir), HOLDOUT, block_rows=SMALL_BLOCK)
    return rounded(rows, {"pred": 4})



def _evaluated(spark, sf_dir) -> DataFrame:
    bars = b.user_bars(spark, sf_dir)
    model = arima_forecast(bars, HOLDOUT).drop("converged")
    predictions = naive_forecast(bars, HOLDOUT).unionByName(model)
    return forecast_eval(bars, predictions, HOLDOUT, digits=4, order=ORDER)


@query("forecast_eval")
def model_comparison(spark, sf_dir):
    rows = _evaluated(spark, sf_dir)
    return rows.withColumn("arima_order", F.concat_ws(",", "arima_order"))



@query("forecast_report")
def forecast_report(spark, sf_dir):
    report = research.research_report(_evaluated(spark, sf_dir), "forecast", source="user bars")
    return report.select(
        "symbol",
        "source",
        F.size("limitations").alias("limitations"),
        "evidence.n_train",
        "evidence.naive_mae",
        "evidence.arima_mae",
        "evidence.arima_beats_naive_mae",
    )


WINDOW_DIGITS = {"event_return": 8, "pre_mean": 8, "post_mean": 8}
STUDY_DIGITS = {
    "pre_mean_log_return": 6,
    "event_log_return": 6,
    "post_mean_log_return": 6,
    "diff_event_minus_pre": 6,
    "null_p2_5": 6,
    "null_p97_5": 6,
    "p_event_vs_pre": 4,
    "abs_price_jump_pct": 4,
}


@query("event_study_windows")
def event_study_windows(spark, sf_dir):
    windows = event_windows(b.event_bars(spark, sf_dir), daily=True)
    columns = ("symbol", "open_time_ms", "n_pre", "n_post", "complete", *WINDOW_DIGITS)
    return rounded(windows.select(*columns), WINDOW_DIGITS)


@query("event_study_windows_ticks")
def event_study_windows_ticks(spark, sf_dir):
    windows = event_windows(b.ticks(spark, sf_dir), block_rows=SMALL_BLOCK)
    columns = ("symbol", "open_time_ms", "n_pre", "n_post", "complete", *WINDOW_DIGITS)
    return rounded(windows.select(*columns), WINDOW_DIGITS)


@query("event_study_rejects")
def event_study_rejects(spark, sf_dir):
    return rejected_events(b.event_bars(spark, sf_dir), daily=True)


@query("event_study_exact")
def event_study_exact(spark, sf_dir):
    return rounded(event_study(b.event_bars(spark, sf_dir), daily=True), STUDY_DIGITS)


@query("event_study_users")
def event_study_users(spark, sf_dir):
    study = event_study(b.user_bars(spark, sf_dir), pre=5, post=5, daily=True)
    return rounded(study, STUDY_DIGITS)


@query("event_study_bootstrap")
def event_study_bootstrap(spark, sf_dir):
    study = event_study(b.event_bars(spark, sf_dir), null="bootstrap", daily=True)
    return rounded(study, STUDY_DIGITS)


@query("event_study_report")
def event_study_report(spark, sf_dir):
    bars = b.event_bars(spark, sf_dir)
    events = b.middle_bars(bars)
    study = event_study(
        inject_shock(bars, events, daily=True), events, 12, 12, null="bootstrap", daily=True
    )
    report = research.research_report(
        study, "event_study", ["symbol", "open_time_ms"], source="event bars"
    )
    flat = report.select(
        "symbol",
        utc_date(F.col("open_time_ms")).alias("event_day"),
        "source",
        F.size("limitations").alias("limitations"),
        "evidence.*",
    )
    return rounded(flat, STUDY_DIGITS)
