"""Event studies: an event bar's log return against the returns before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from candlewick.functions.columns import growth, sorted_percentile
from candlewick.operators.features import KEY, TIME, log_return
from candlewick.operators.series import over_series

# Fixed values of the draw generator: modulus 2^31 - 1 and two multipliers of full period.
MODULUS = 2_147_483_647
STRIDE = 40_692
MIXER = 48_271


def event_windows(
    bars: DataFrame,
    events: DataFrame | None = None,
    pre: int = 10,
    post: int = 10,
    *,
    daily: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """One row per event bar with the returns around it and its place in the series, from 0.

    `events` holds (symbol, open_time_ms); without it every bar is an event. `complete` is
    false for events with fewer than `pre` returns before or `post` after them; only rows
    with `complete` can be studied, the others are the rejected set.
    """

    def build(df: DataFrame, window: WindowSpec) -> DataFrame:
        returned = df.withColumn("event_return", log_return(window))
        following = window.rowsBetween(1, post)
        return returned.withColumns(
            {
                "pre_close": F.lag("close").over(window),
                "pre_returns": F.collect_list("event_return").over(window.rowsBetween(-pre, -1)),
                "post_mean": F.avg("event_return").over(following),
                "n_post": F.count("event_return").over(following),
            }
        )

    narrow = bars.select(*KEY, *TIME, "close")
    if events is not None:
        # Series without an event need not be shuffled.
        narrow = narrow.join(events.select(*KEY).distinct(), KEY, "left_semi")
    around = over_series(
        narrow,
        KEY,
        TIME,
        build,
        before=pre + 1,
        after=post,
        daily=daily,
        block_rows=block_rows,
        number="event_index",
    )
    if events is not None:
        around = around.join(events.select(*KEY, *TIME).distinct(), [*KEY, *TIME], "left_semi")
    n_pre = F.size("pre_returns")
    total = F.aggregate("pre_returns", F.lit(0.0), lambda sum_, value: sum_ + value)
    return around.select(
        *KEY,
        *TIME,
        "event_index",
        F.col("close").alias("event_close"),
        "pre_close",
        "event_return",
        "pre_returns",
        n_pre.alias("n_pre"),
        F.try_divide(total, n_pre.cast("double")).alias("pre_mean"),
        F.col("n_post").cast("int").alias("n_post"),
        "post_mean",
        ((n_pre == pre) & (F.col("n_post") == post)).alias("complete"),
    )


def event_study(
    bars: DataFrame,
    events: DataFrame | None = None,
    pre: int = 10,
    post: int = 10,
    null: str = "exact",
    n_boot: int = 500,
    seed: int = 42,
    *,
    daily: bool = False,
) -> DataFrame:
    """Difference to the pre-event mean with a p-value under a redraw from the pre window.

    One draw of the null is one pre-window return minus the mean. "bootstrap" makes `n_boot`
    seeded draws; "exact" uses each pre return once, the limit of many draws. The null
    lives in a short array in the event's own row, so neither variant shuffles anything.
    The reference interval holds percentiles of the null, not of the effect.
    """
    if null not in ("exact", "bootstrap"):
        raise ValueError("null must be 'exact' or 'bootstrap'")
    windows = event_windows(bars, events, pre, post, daily=daily).filter("complete")
    mean, size = F.col("pre_mean"), F.col("n_pre")
    centred = F.transform("pre_returns", lambda value: value - mean)
    if null == "bootstrap":
        centred = _draws(centred, size, n_boot, seed)
    drawn = windows.withColumns(
        {
            "diff": F.col("event_return") - mean,
            "null_values": F.array_sort(centred),
        }
    )
    n_null = F.size("null_values")
    extreme = F.filter("null_values", lambda value: F.abs(value) >= F.abs(F.col("diff")))
    return drawn.select(
        *KEY,
        *TIME,
        "event_index",
        F.lit(pre).alias("pre_window"),
        F.lit(post).alias("post_window"),
        "n_pre",
        "n_post",
        mean.alias("pre_mean_log_return"),
        F.col("event_return").alias("event_log_return"),
        F.col("post_mean").alias("post_mean_log_return"),
        F.col("diff").alias("diff_event_minus_pre"),
        sorted_percentile(F.col("null_values"), n_null, 0.025).alias("null_p2_5"),
        sorted_percentile(F.col("null_values"), n_null, 0.975).alias("null_p97_5"),
        (F.size(extreme) / n_null).alias("p_event_vs_pre"),
        "event_close",
        "pre_close",
        (growth(F.col("event_close"), F.col("pre_close")) * 100).alias("abs_price_jump_pct"),
    )


def rejected_events(
    bars: DataFrame,
    events: DataFrame | None = None,
    pre: int = 10,
    post: int = 10,
    *,
    daily: bool = False,
) -> DataFrame:
    """Events too close to either end of their series, with the returns they do have."""
    windows = event_windows(bars, events, pre, post, daily=daily)
    return windows.filter(~F.col("complete")).select(*KEY, *TIME, "n_pre", "n_post")


def _draws(values: Column, size: Column, n_boot: int, seed: int) -> Column:
    """`n_boot` elements of `values`, chosen by a counter-based generator.

    Start and shift come from 30 hexadecimal digits of a digest of seed and event; each draw
    squares a strided counter modulo a prime and shifts it. Everything fits 63 bits, so any
    engine reproduces the same draws, and a retried task repeats them.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *KEY, *[F.col(name).cast("string") for name in TIME])
    start, shift = (
        F.conv(F.substring(F.md5(text), place, 15), 16, 10).cast("bigint") % MODULUS
        for place in (1, 16)
    )

    def pick(draw: Column) -> Column:
        counter = (start + draw * STRIDE) % MODULUS
        mixed = (counter * counter + MIXER) % MODULUS
        spread = (mixed * MIXER + shift) % MODULUS
        return F.element_at(values, (spread % size + 1).cast("int"))

    return F.transform(F.sequence(F.lit(1).cast("bigint"), F.lit(n_boot).cast("bigint")), pick)
