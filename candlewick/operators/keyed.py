"""Operators that pick or combine rows by natural key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_wins(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[Column],
    tiebreak: Sequence[Column] = (),
) -> DataFrame:
    """Keep one row per key: the first by `newest`, then `tiebreak`.

    `rn = 1` becomes a partial and a final WindowGroupLimit, so each task forwards at most
    one row per key and a hot key cannot pile up behind the shuffle.
    """
    return _first_rows(df, keys, [*newest, *tiebreak], 1)


def late_wins(history: DataFrame, late: DataFrame, keys: Sequence[str], rank: Sequence[str]) -> DataFrame:
    """`latest_wins` of history and late rows together, where history has one row per key.

    Of two rows the one with the larger `rank`, compared column by column, wins; NULL is smallest. Keys are not
    NULL. History that is bucketed by the keys meets the late rows bucket by bucket: only these are shuffled.
    """
    best = latest_wins(late.select(*history.columns), keys, [F.desc_nulls_last(name) for name in rank])
    named = best.select(*keys, F.struct(*best.columns).alias("_late"))
    old = history.select(*keys, F.struct(*history.columns).alias("_old"))

    def order(row: str) -> Column:
        return F.struct(*[F.col(row)[name] for name in rank])

    newer = F.col("_old").isNull() | (F.col("_late").isNotNull() & (order("_late") > order("_old")))
    both = old.join(named, list(keys), "full_outer")
    return both.select(F.when(newer, F.col("_late")).otherwise(F.col("_old")).alias("_row")).select("_row.*")


def last_n_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """The last `n` rows of each key; `order` is ascending time."""
    if n < 1:
        raise ValueError("lookback must be at least 1")
    return _first_rows(df, [key], [column.desc() for column in order], n)


def top_n_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first `n` rows of each key by `order`."""
    if n < 1:
        raise ValueError("top n must be at least 1")
    return _first_rows(df, [key], order, n)


def _first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def merge_fresh_wins(fresh: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All fresh rows plus the previous rows whose key the fresh side does not hold."""
    kept = previous.join(fresh.select(*keys), list(keys), "left_anti")
    return append_series(fresh, kept.select(*fresh.columns))


def append_series(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both frames, matched by column name."""
    return first.unionByName(second)
