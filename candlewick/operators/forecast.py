"""One-step forecasts on a holdout tail: last value against ARIMA, and their metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions.columns import or_zero
from candlewick.operators.features import KEY, TIME

# A series must be longer than the holdout by more than this many rows (fixed value).
MIN_EXTRA_ROWS = 5


def series_lengths(bars: DataFrame, holdout: int = 10) -> DataFrame:
    """(symbol, n, eligible): whether a series is long enough for this holdout."""
    lengths = bars.groupBy(*KEY).agg(F.count("*").alias("n"))
    return lengths.withColumn("eligible", F.col("n") > holdout + MIN_EXTRA_ROWS)


def holdout_tail(bars: DataFrame, holdout: int, lead_in: int = 1) -> DataFrame:
    """The last `holdout` rows of each eligible series plus `lead_in` rows before them.

    `from_end` counts 1.. back from the newest row. The rank limit is applied map-side, so a
    long series sends only its tail; a tail that reaches the shortest eligible length also
    settles eligibility without counting the series.
    """
    shortest = holdout + MIN_EXTRA_ROWS + 1
    newest_first = Window.partitionBy(*KEY).orderBy(*[F.desc(name) for name in TIME])
    return (
        bars.select(*KEY, *TIME, "close")
        .withColumn("from_end", F.row_number().over(newest_first))
        .filter(F.col("from_end") <= shortest)
        .withColumn("_rows", F.count("*").over(Window.partitionBy(*KEY)))
        .filter((F.col("_rows") == shortest) & (F.col("from_end") <= holdout + lead_in))
        .drop("_rows")
    )


def naive_forecast(bars: DataFrame, holdout: int = 10) -> DataFrame:
    """(symbol, model, step, actual, pred, fit_failed): each prediction is the close before it."""
    by_time = Window.partitionBy(*KEY).orderBy(F.desc("from_end"))
    return (
        holdout_tail(bars, holdout)
        .withColumn("pred", F.lag("close").over(by_time))
        .filter(F.col("from_end") <= holdout)
        .select(
            *KEY,
            F.lit("naive").alias("model"),
            (F.lit(holdout + 1) - F.col("from_end")).alias("step"),
            F.col("close").alias("actual"),
            "pred",
            F.lit(False).alias("fit_failed"),
        )
    )


def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """Mean absolute error, root mean square error and directional accuracy per series and model.

    Direction compares the sign of the actual move with that of the predicted move from the same
    previous actual. The naive model predicts no move, so it only scores where the price is
    flat. Groups hold one holdout each.
    """
    by_step = Window.partitionBy(*KEY, "model").orderBy("step")
    before = F.lag("actual").over(by_step)
    error = F.col("actual") - F.col("pred")
    hit = F.signum(F.col("actual") - F.col("_before")) == F.signum(F.col("pred") - F.col("_before"))
    return (
        predictions.withColumn("_before", before)
        .groupBy(*KEY, "model")
        .agg(
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            or_zero(F.avg(hit.cast("double"))).alias("directional_accuracy"),
            F.count("*").alias("n_holdout"),
            F.count_if("fit_failed").alias("n_fit_failed"),
        )
    )


def forecast_eval(
    bars: DataFrame,
    predictions: DataFrame,
    holdout: int = 10,
    digits: int = 6,
    order: tuple[int, int, int] = (1, 1, 1),
) -> DataFrame:
    """One row per eligible series with both models' rounded metrics side by side."""
    wide = (
        forecast_metrics(predictions)
        .groupBy(*KEY)
        .pivot("model", ["naive", "arima"])
        .agg(
            F.first(F.round("mae", digits)).alias("mae"),
            F.first(F.round("rmse", digits)).alias("rmse"),
            F.first(F.round("directional_accuracy", 4)).alias("directional_accuracy"),
        )
    )
    lengths = series_lengths(bars, holdout).filter("eligible")
    return wide.join(lengths, KEY).select(
        *KEY,
        (F.col("n") - holdout).alias("n_train"),
        F.lit(holdout).alias("n_holdout"),
        F.array(*map(F.lit, order)).alias("arima_order"),
        *[name for name in wide.columns if name not in KEY],
        (F.col("arima_mae") < F.col("naive_mae")).alias("arima_beats_naive_mae"),
    )


def short_series(bars: DataFrame, holdout: int = 10) -> DataFrame:
    """Series too short to evaluate, with their length."""
    return series_lengths(bars, holdout).filter(~F.col("eligible")).select(*KEY, "n")
