"""Dashboard and notebook queries over the marts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.operators.series import sorted_rows
from candlewick.sources.storage import stored


def ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(key) for key in keys])


def series(mart: DataFrame, value: str, drop_null: bool = False) -> DataFrame:
    """(trade_date, symbol, value) of every symbol, in chart order."""
    rows = mart.filter(F.col(value).isNotNull()) if drop_null else mart
    return ordered(rows.select("trade_date", "symbol", value), ["trade_date", "symbol"])


def symbol_view(
    mart: DataFrame, symbol: str, columns: Sequence[str], any_not_null: Sequence[str] = ()
) -> DataFrame:
    """Some columns of one symbol by date; the symbol predicate reaches the scan.

    With `any_not_null`, only rows where at least one of those columns is set.
    """
    rows = mart.filter(F.col("symbol") == F.lit(symbol))
    if any_not_null:
        rows = rows.filter(reduce(or_, [F.col(name).isNotNull() for name in any_not_null]))
    return ordered(rows.select("trade_date", *columns), ["trade_date"])


def latest_row(
    df: DataFrame, by: str, columns: Sequence[str] = ("*",), symbol: str | None = None
) -> DataFrame:
    """The newest row, optionally of one symbol."""
    rows = df if symbol is None else df.filter(F.col("symbol") == F.lit(symbol))
    return rows.orderBy(F.desc_nulls_last(by)).limit(1).select(*columns)


def latest_by_symbol(mart: DataFrame) -> DataFrame:
    """Last known figures of each symbol, largest mean volume first.

    Each figure is its last non-null value, so the dates behind two figures may differ.
    """
    day = F.col("trade_date")

    def last_known(name: str):
        return F.max_by(name, F.when(F.col(name).isNotNull(), day))

    latest = mart.groupBy("symbol").agg(
        last_known("close").alias("last_close"),
        last_known("daily_return").alias("last_daily_return"),
        last_known("volatility_30d").alias("volatility_30d"),
        last_known("avg_quote_volume_30d").alias("avg_quote_volume_30d"),
        F.max(day).alias("last_trade_date"),
    )
    link = F.concat(F.lit("/symbols/"), "symbol").alias("symbol_link")
    return latest.select("symbol", link, *latest.columns[1:]).orderBy(
        F.desc_nulls_last("avg_quote_volume_30d"), "symbol"
    )


QUARTILES = (25, 50, 75)


def describe_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per key and column, NULLs skipped.

    The quartiles are exact. The values of all columns are sorted together, by key and column, in ranges that split
    a key of any size between tasks; a quartile is then two row numbers, picked by join.
    """
    entries = F.array(*[F.struct(F.lit(name).alias("name"), F.col(name).alias("value")) for name in columns])
    # Sorting by range reads its input twice.
    given = stored(df.select(F.col(key).alias("key"), *columns), "described")
    long = given.select("key", F.inline(entries))
    # A key without values has a row all the same.
    rows = sorted_rows(long, ["key", "name"], ["value"])
    value = F.col("value")
    stats = rows.groupBy("key", "name").agg(
        F.min("_row").alias("first"),
        F.count_if(value.isNull()).alias("nulls"),
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    places = [(q, pick((F.col("count") - 1) * q / 100)) for q in QUARTILES for pick in (F.floor, F.ceil)]
    wanted = stats.filter("count > 0").select(
        "key",
        "name",
        F.posexplode(F.array(*[F.col("first") + F.col("nulls") + place for _, place in places])).alias("slot", "_row"),
    )
    picked = (
        wanted.join(rows.select("_row", "value"), "_row")
        .groupBy("key", "name")
        .agg(*[F.max(F.when(F.col("slot") == i, value)).alias(f"v{i}") for i in range(len(places))])
    )
    other = picked.withColumnsRenamed({"key": "_key", "name": "_name"})
    found = stats.join(other, F.col("key").eqNullSafe(F.col("_key")) & (F.col("name") == F.col("_name")), "left")
    for i, q in enumerate(QUARTILES):
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        share = (F.col("count") - 1) * q / 100
        found = found.withColumn(f"p{q}", low + (share - F.floor(share)) * (high - low))
    parts = ("count", "mean", "std", "min", *[f"p{q}" for q in QUARTILES], "max")
    return found.groupBy(F.col("key").alias(key)).agg(
        *[F.max(F.when(F.col("name") == c, F.col(part))).alias(f"{c}_{part}") for c in columns for part in parts]
    )


def pivot_mean(
    df: DataFrame, index: str, column: str, value: str, values: Sequence[str]
) -> DataFrame:
    """Mean of `value` with one output column per entry of `values`."""
    return df.groupBy(index).pivot(column, list(values)).agg(F.avg(value))
