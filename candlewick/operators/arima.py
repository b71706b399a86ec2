"""Rolling one-step ARIMA forecasts of series of any length and number.

All series are sorted together and cut into blocks, so a long one is read by many tasks and many short
ones by one. A search round reads the blocks once for the candidates of each series and composes their
sums, see `functions.arma`; every step of the holdout gets its own best candidate from the same reading.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.arma import (
    LIMIT,
    SPACINGS,
    carried,
    first_points,
    folded,
    neighbours,
    read_blocks,
    roll,
)
from candlewick.operators.features import KEY, TIME
from candlewick.operators.forecast import MIN_EXTRA_ROWS
from candlewick.operators.series import overlapping_blocks, sorted_rows, spread
from candlewick.sources.storage import stored

ORDER = (1, 1, 1)
BLOCK_ROWS = 2048
TOGETHER = 128  # blocks that a task reads in lockstep
FOLD = 64  # blocks that one row holds the sums of
# A task of Python holds one group of rows at a time. Groups are cut from the sorted rows of all series, which bounds
# them whatever the number of series is.
READ_BLOCKS, DECKS = 8192, 64  # neighbouring blocks whose pieces are dealt to some groups to read
COMPOSED_ROWS = 1024  # the series that begin in so many rows are composed together


def arima_forecast(
    bars: DataFrame,
    holdout: int = 10,
    order: tuple[int, int, int] = ORDER,
    *,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(symbol, model, step, actual, pred, fit_failed, converged), fitted anew before every step.

    Series of at most `holdout` and five rows are left out. Step k is predicted from all closes before it. A
    fit without a positive finite cost fails and predicts the last close. `converged` is false where it
    failed or its best candidate lies on the border of the lattice. The block size changes no result
    beyond rounding.
    """
    p, d, q = order
    # Written once by sorted_rows, so every use below sees the same numbers.
    rows = sorted_rows(bars.select(*KEY, *TIME, "close"), KEY, TIME)
    spans = rows.groupBy(*KEY).agg(F.min("_row").alias("first"), F.max("_row").alias("last"))
    spans = spans.filter(F.col("last") - F.col("first") + 1 > holdout + MIN_EXTRA_ROWS)
    spans = stored(spans.withColumn("trained", F.col("last") - holdout).drop("last"), "spans")
    ordered = F.array_sort(F.collect_list(F.struct("_row", "close")))
    blocks = (
        overlapping_blocks(rows, p + d, 0, block_rows)
        .groupBy(*KEY, "_block")
        .agg(ordered.alias("values"))
        .select(*KEY, "_block", F.col("values._row")[0].alias("start"), F.col("values.close").alias("closes"))
    )
    blocks = stored(blocks.join(spans, KEY).filter("start <= trained"), "blocks")
    tails = rows.join(spans, KEY).filter(F.col("_row") > F.col("trained") - (p + d))
    state = stored(
        tails.groupBy(*KEY, "first").agg(ordered["close"].alias("tail")).withColumn(
            "points", F.lit(None).cast("binary")
        ),
        "search",
    )
    # Blocks of the longest series decide how often neighbours are folded into one.
    longest = blocks.groupBy(*KEY).agg((F.max("_block") - F.min("_block") + 1).alias("n")).agg(F.max("n")).first()[0]
    for spacing in (*SPACINGS[1:], 0):
        read = _gathered(_read(blocks, state, p, d, q, block_rows), longest or 0, p, d, q)
        state = stored(_composed(read, state, holdout, order, spacing), "search")
    step = F.posexplode(F.arrays_zip("actual", "pred", "failed", "converged")).alias("step", "found")
    return state.select(*KEY, step).select(
        *KEY,
        F.lit("arima").alias("model"),
        (F.col("step") + 1).alias("step"),
        "found.actual",
        "found.pred",
        F.col("found.failed").alias("fit_failed"),
        "found.converged",
    )


PART = "block long, sums binary, errors binary, n long, total double"


def _candidates(points, size: int) -> np.ndarray:
    if points is None:
        return first_points(size)
    found = np.frombuffer(points, dtype=np.int64)
    return found.reshape(-1, size) if size else np.zeros((1, 0), dtype=np.int64)


def _read(blocks: DataFrame, state: DataFrame, p: int, d: int, q: int, block_rows: int) -> DataFrame:
    """A row a block: what it says of the candidates of its series."""
    symbol = blocks.schema[KEY[0]].dataType.simpleString()

    def read(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.iloc[np.argsort(frame["closes"].map(len).to_numpy())]
        return pd.concat([together(frame.iloc[low : low + TOGETHER]) for low in range(0, len(frame), TOGETHER)])

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [_candidates(x, p + q) for x in frame["points"]]
        most = max(map(len, sets))
        points = np.stack([np.concatenate((s, np.repeat(s[:1], most - len(s), axis=0))) for s in sets])
        columns = []
        for row in frame.itertuples():
            closes = np.asarray(row.closes, dtype=float)
            changes = np.diff(closes, n=d)
            numbers = row.start + d + np.arange(len(changes))
            own = (numbers // block_rows == row.place) & (numbers <= row.trained)
            begin = int(np.argmax(own)) if own.any() else len(changes)
            lags = changes[max(0, begin - p) : begin]
            missing = p - len(lags)
            values = np.concatenate((np.zeros(missing), lags, changes[begin:][own[begin:]]))
            there = np.concatenate((np.zeros(missing), np.ones(len(values) - missing)))
            columns.append((values, there))
        long = max(len(v) for v, _ in columns)
        values = np.stack([np.pad(v, (0, long - len(v))) for v, _ in columns])
        there = np.stack([np.pad(x, (0, long - len(x))) for _, x in columns])
        size = np.array([len(v) - p for v, _ in columns])
        active = np.arange(long - p)[None, :] < size[:, None]
        sums, errors = read_blocks(values, there, active, points, p, q, d == 0)
        total = (values[:, p:] * active).sum(axis=1)
        return pd.DataFrame(
            {
                KEY[0]: frame[KEY[0]].to_numpy(),
                "block": frame["place"].to_numpy(),
                "sums": [a[: len(s)].tobytes() for a, s in zip(sums, sets, strict=True)],
                "errors": [a[: len(s)].tobytes() for a, s in zip(errors, sets, strict=True)],
                "n": size,
                "total": total,
            }
        )

    given = blocks.withColumnRenamed("_block", "place").join(state.select(*KEY, "points"), KEY)
    deck = F.pmod(F.xxhash64(*KEY, "place"), F.lit(DECKS))
    given = given.withColumns({"_span": F.floor(F.col("place") / READ_BLOCKS), "_deck": deck})
    groups = spread(given, "_span", "_deck").groupBy("_span", "_deck")
    return groups.applyInPandas(read, f"{KEY[0]} {symbol}, {PART}")


def _gathered(read: DataFrame, longest: int, p: int, d: int, q: int) -> DataFrame:
    """(symbol, parts): at most FOLD parts of every series in order.

    What FOLD neighbouring blocks say composes to what one block of their length would, so a series of any number
    of blocks comes down to one row in a few rounds, and no row holds more than FOLD parts of a few kilobytes.
    """
    symbol = read.schema[KEY[0]].dataType.simpleString()
    readings = 1 + q + (d == 0)

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for row in frame.itertuples():
            sums, errors = folded(_arrays(row.parts, readings, q), d == 0)
            n, total = sum(x["n"] for x in row.parts), sum(x["total"] for x in row.parts)
            rows.append((getattr(row, KEY[0]), row.block, sums.tobytes(), errors.tobytes(), n, total))
        return pd.DataFrame(rows, columns=[KEY[0], "block", "sums", "errors", "n", "total"])

    part = F.array_sort(F.collect_list(F.struct("block", "sums", "errors", "n", "total"))).alias("parts")
    decks = FOLD
    while longest > FOLD:
        groups = read.groupBy(*KEY, F.floor(F.col("block") / FOLD).alias("group")).agg(part)
        # A group number spans ever more short series, which are dealt to as many more decks.
        deck = F.pmod(F.xxhash64(*KEY), F.lit(decks))
        dealt = groups.withColumnRenamed("group", "block").groupBy("block", deck.alias("_deck"))
        read = dealt.applyInPandas(fold, f"{KEY[0]} {symbol}, {PART}")
        longest = longest // FOLD + 2  # a series may begin and end within a group
        decks *= FOLD
    return read.groupBy(*KEY).agg(part)


def _arrays(parts, readings: int, q: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sums and errors of each part, by candidate."""
    found = []
    for x in parts:
        sums = np.frombuffer(x["sums"]).reshape(-1, readings, readings)
        found.append((sums, np.frombuffer(x["errors"]).reshape(len(sums), readings, q)))
    return found


def _composed(
    read: DataFrame, state: DataFrame, holdout: int, order: tuple[int, int, int], spacing: int
) -> DataFrame:
    """One row a series: the best of its candidates for each step, and the next candidates."""
    p, d, q = order
    symbol = state.schema[KEY[0]].dataType.simpleString()
    readings = 1 + q + (d == 0)

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            [one(row) for row in frame.itertuples()],
            columns=[KEY[0], "first", "tail", "points", "actual", "pred", "failed", "converged"],
        )

    def one(row) -> tuple:
        points = _candidates(row.points, p + q)
        parts = _arrays(row.parts, readings, q)
        before = sum(x["n"] for x in row.parts), sum(x["total"] for x in row.parts)
        tail = np.asarray(row.tail, dtype=float)
        with np.errstate(all="ignore"):
            best, cost, ahead = roll(parts, before, tail, points, holdout, order)
            at = len(tail) - holdout + np.arange(holdout)
            pred = ahead + carried(tail, at, d)
        failed = ~((cost > 0) & np.isfinite(cost) & np.isfinite(pred))
        inside = (np.abs(best) < LIMIT).all(axis=1)
        following = neighbours(best, spacing) if spacing else best
        return (
            getattr(row, KEY[0]),
            row.first,
            row.tail,
            following.tobytes(),
            tail[at],
            np.where(failed, tail[at - 1], pred),
            failed,
            ~failed & inside,
        )

    schema = (
        f"{KEY[0]} {symbol}, first long, tail array<double>, points binary, actual array<double>, "
        "pred array<double>, failed array<boolean>, converged array<boolean>"
    )
    given = state.select(*KEY, "first", "tail", "points").join(read, KEY)
    given = given.withColumn("_span", F.floor(F.col("first") / COMPOSED_ROWS))
    return spread(given, "_span").groupBy("_span").applyInPandas(compose, schema)
