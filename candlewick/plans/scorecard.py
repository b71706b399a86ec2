"""Quality scorecard: contract probes plus warehouse sanity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.contracts import KLINES, MARKETS, Contract, violations
from candlewick.sources.raw import row_counts

# Relations the sanity check counts (fixed values).
SANITY_TABLES = ("mart_daily_ohlcv", "mart_market_overview", "stg_klines")
# Fixed value: length of the readable detail; `broken` holds every broken rule.
DETAIL_LENGTH = 200
NO_WAREHOUSE = "No warehouse"


def contract_probes(
    markets: DataFrame,
    klines: DataFrame,
    markets_batch: Sequence[str] = (),
    klines_batch: Sequence[str] = (),
) -> DataFrame:
    """Good frames must pass their contract and three broken copies must fail.

    A broken copy differs in one row, found by key: price -1 in the first market row, the key
    of the first market row copied onto the second, and a high below the low in the first
    candle. Returns (name, dataset, expected, passed, detail, broken).
    """
    market_key = [*markets_batch, *MARKETS.unique]
    kline_key = [*klines_batch, *KLINES.unique]
    coins = markets.select(*market_key).orderBy(*market_key).limit(2).collect()
    candles = klines.select(*kline_key).orderBy(*kline_key).limit(1).collect()

    def at(row, key: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(name) == F.lit(row[name]) for name in key])

    def changed(df: DataFrame, where: Column, values: Mapping[str, Column]) -> DataFrame:
        return df.select(
            *[
                F.when(where, values[name]).otherwise(F.col(name)).alias(name)
                if name in values
                else F.col(name)
                for name in df.columns
            ]
        )

    probes = [("markets_valid", "pass", MARKETS, markets_batch, markets)]
    if coins:
        cheap = changed(markets, at(coins[0], market_key), {"current_price": F.lit(-1.0)})
        probes.append(("markets_reject_negative_price", "fail", MARKETS, markets_batch, cheap))
    if len(coins) > 1:
        first = {name: F.lit(coins[0][name]) for name in market_key}
        copied = changed(markets, at(coins[1], market_key), first)
        probes.append(("markets_reject_duplicate_coin", "fail", MARKETS, markets_batch, copied))
    probes.append(("klines_valid", "pass", KLINES, klines_batch, klines))
    if candles:
        low = {"high": F.col("low") - 1.0}
        crossed = changed(klines, at(candles[0], kline_key), low)
        probes.append(("klines_reject_high_below_low", "fail", KLINES, klines_batch, crossed))
    return reduce(DataFrame.unionByName, [_probe(*probe) for probe in probes])


def _probe(
    name: str, expected: str, contract: Contract, batch: Sequence[str], df: DataFrame
) -> DataFrame:
    broken = F.col("n") > 0
    label = F.concat_ws(":", "rule", "column", F.col("n").cast("string"))
    result = violations(df, contract, batch).agg(
        F.coalesce(F.max(broken), F.lit(False)).alias("rejected"),
        F.sort_array(F.collect_list(F.when(broken, label))).alias("broken"),
    )
    quiet = "validated" if expected == "pass" else "expected a rejection, but all rows passed"
    detail = F.when(F.col("rejected"), F.concat_ws("; ", "broken")).otherwise(F.lit(quiet))
    return result.select(
        F.lit(name).alias("name"),
        F.lit(contract.dataset).alias("dataset"),
        F.lit(expected).alias("expected"),
        (F.col("rejected") == F.lit(expected == "fail")).alias("passed"),
        F.substring(detail, 1, DETAIL_LENGTH).alias("detail"),
        "broken",
    )


def probe_summary(probes: DataFrame) -> DataFrame:
    """Total, passed and failed probes and the pass rate (0 without probes)."""
    total, passed = F.count("*"), F.count_if("passed")
    rate = F.round(F.try_divide(passed, total), 4)
    return probes.agg(
        total.alias("total"),
        passed.alias("passed"),
        (total - passed).alias("failed"),
        F.coalesce(rate, F.lit(0.0)).alias("pass_rate"),
    )


def freshness(mart: DataFrame) -> DataFrame:
    """Number of symbols and the first and last day."""
    return mart.agg(
        F.countDistinct("symbol").alias("symbols"),
        F.max("trade_date").alias("max_day"),
        F.min("trade_date").alias("min_day"),
    )


def scorecard(
    probes: DataFrame, relations: Mapping[str, DataFrame], generated_at: str = ""
) -> DataFrame:
    """One row: probes, summary, warehouse figures and caveats.

    `relations` holds the warehouse tables that exist; empty means no warehouse. All parts
    are one-row aggregates before they meet, so putting them side by side costs nothing.
    """
    # The probe table has one row per probe, whatever the size of the data.
    rows = probes.agg(
        F.sort_array(
            F.collect_list(F.struct("name", "dataset", "expected", "passed", "detail", "broken"))
        ).alias("probes")
    )
    total = F.size("probes").cast("bigint")
    passed = F.size(F.filter("probes", lambda probe: probe["passed"])).cast("bigint")
    rate = F.coalesce(F.round(F.try_divide(passed, total), 4), F.lit(0.0))
    card = rows.withColumn(
        "probe_summary",
        F.struct(
            total.alias("total"),
            passed.alias("passed"),
            (total - passed).alias("failed"),
            rate.alias("pass_rate"),
        ),
    )
    counted = {name: relations[name] for name in SANITY_TABLES if name in relations}
    if counted:
        counts = row_counts(counted, "table").agg(
            F.sort_array(F.collect_list(F.struct("table", "n"))).alias("row_counts")
        )
        card = _beside(card, counts)
    else:
        card = card.withColumn(
            "row_counts", F.lit(None).cast("array<struct<table:string,n:bigint>>")
        )
    span = "struct<symbols:bigint,max_day:date,min_day:date>"
    if "mart_daily_ohlcv" in relations:
        ohlcv = freshness(relations["mart_daily_ohlcv"])
        card = _beside(card, ohlcv.select(F.struct(*ohlcv.columns).cast(span).alias("ohlcv")))
    else:
        card = card.withColumn("ohlcv", F.lit(None).cast(span))
    failed = F.col("probe_summary.failed")
    symbols = F.coalesce(F.col("ohlcv.symbols"), F.lit(0))
    caveats = [
        F.when(
            failed > 0,
            F.concat(failed.cast("string"), F.lit(" probe(s) failed: the contracts need a look.")),
        ),
        F.lit(None if relations else f"{NO_WAREHOUSE}: only the contract probes were run."),
        F.when(F.lit(bool(relations)) & (symbols == 0), F.lit("The daily mart has no rows.")),
    ]
    return card.select(
        F.lit(generated_at).alias("generated_at"),
        "probes",
        "probe_summary",
        F.struct(
            F.lit(bool(relations)).alias("available"),
            F.lit(None if relations else NO_WAREHOUSE).cast("string").alias("reason"),
            F.array(*map(F.lit, sorted(relations))).cast("array<string>").alias("tables"),
            "row_counts",
            "ohlcv",
        ).alias("warehouse"),
        F.array_compact(F.array(*caveats)).alias("caveats"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join two one-row frames on a constant key."""
    joined = left.withColumn("_one", F.lit(1)).join(right.withColumn("_one", F.lit(1)), "_one")
    return joined.drop("_one")
