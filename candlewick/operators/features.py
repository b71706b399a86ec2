"""Bar features, log returns and counterfactual shocks, per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.columns import floored_ln, growth, or_zero, z_score
from candlewick.operators.series import over_series

# The feature columns, in model order.
FEATURE_COLUMNS = (
    "return_1d",
    "log_volume",
    "hl_range_pct",
    "close_open_pct",
    "volume_z",
    "return_z",
)

KEY = ["symbol"]
TIME = ["open_time_ms"]


def ohlcv_features(
    bars: DataFrame, roll: int = 7, *, daily: bool = False, block_rows: int | None = None
) -> DataFrame:
    """Add FEATURE_COLUMNS. Rolling statistics include the current row."""

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        close, open_ = F.col("close"), F.col("open")
        frame = window.rowsBetween(1 - roll, 0)
        per_bar = df.withColumns(
            {
                "return_1d": or_zero(growth(close, F.lag("close").over(window))),
                "log_volume": floored_ln(F.col("volume")),
                "hl_range_pct": or_zero(F.try_divide(F.col("high") - F.col("low"), close)),
                "close_open_pct": or_zero(F.try_divide(close - open_, open_)),
            }
        )

        def rolling_z(name: str):
            return z_score(F.col(name), F.avg(name).over(frame), F.stddev_samp(name).over(frame))

        return per_bar.withColumns(
            {"volume_z": rolling_z("log_volume"), "return_z": rolling_z("return_1d")}
        )

    return over_series(bars, KEY, TIME, build, before=roll, daily=daily, block_rows=block_rows)


def log_returns(
    bars: DataFrame, *, daily: bool = False, block_rows: int | None = None
) -> DataFrame:
    """Add log_return = ln(close) - ln(previous close); a symbol's first bar has none."""

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        return df.withColumn("log_return", log_return(window))

    returns = over_series(bars, KEY, TIME, build, before=1, daily=daily, block_rows=block_rows)
    return returns.filter(F.col("log_return").isNotNull())


def log_return(window: WindowSpec):
    price = floored_ln(F.col("close"))
    return price - F.lag(price).over(window)


def inject_shock(
    bars: DataFrame, events: DataFrame, factor: float = 1.12, *, daily: bool = False
) -> DataFrame:
    """Bars in which the close of each (symbol, open_time_ms) in `events` is the previous close
    times `factor`, with the high raised to hold it. Other bars, and first bars, are unchanged.
    """
    marks = events.select(*KEY, *TIME, F.lit(True).alias("_shocked")).distinct()
    marked = bars.join(marks, [*KEY, *TIME], "left")

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        shocked = F.lag("close").over(window) * F.lit(factor)
        return df.withColumn("_target", F.when(F.col("_shocked"), shocked))

    shocked = over_series(marked, KEY, TIME, build, before=1, daily=daily)
    target = F.col("_target")
    return shocked.withColumns(
        {
            "close": F.coalesce(target, "close"),
            "high": F.greatest("high", target),
        }
    ).select(*bars.columns)
