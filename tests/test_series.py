import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators.series import over_series


def build(df, window):
    return df.withColumns(
        {
            "previous": F.lag("value").over(window),
            "back": F.sum("value").over(window.rowsBetween(-4, 0)),
            "ahead": F.sum("value").over(window.rowsBetween(1, 3)),
            "n_back": F.count("value").over(window.rowsBetween(-4, -1)),
        }
    )


@pytest.mark.parametrize("block_rows", [9, 64, 100_000])
def test_blocks_equal_the_plain_window(spark, block_rows):
    rng = random.Random(7)
    # One key holds more than a third of the rows, others have one to ten.
    sizes = {"hot": 400, "empty-ish": 1, **{f"k{i}": rng.randint(1, 10) for i in range(80)}}
    rows = [
        (key, time * 3, float(rng.randint(0, 99))) for key, n in sizes.items() for time in range(n)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, time long, value double").repartition(7)
    options = {"before": 4, "after": 3}
    plain = over_series(df, ["symbol"], ["time"], build, daily=True, **options)
    blocked = over_series(df, ["symbol"], ["time"], build, block_rows=block_rows, **options)
    assert blocked.columns == plain.columns
    assert sorted(map(tuple, blocked.collect()), key=str) == sorted(
        map(tuple, plain.collect()), key=str
    )


def test_frames_must_fit_a_block(spark):
    df = spark.createDataFrame([("a", 1, 1.0)], "symbol string, time long, value double")
    with pytest.raises(ValueError):
        over_series(df, ["symbol"], ["time"], build, before=4, after=3, block_rows=7)
    assert over_series(df.limit(0), ["symbol"], ["time"], build, before=4, after=3).count() == 0
