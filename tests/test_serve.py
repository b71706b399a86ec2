import datetime as dt

import pytest

from candlewick.operators import serve

SCHEMA = (
    "symbol string, trade_date date, close double, daily_return double, volatility_7d double,"
    "volatility_30d double, avg_quote_volume_30d double"
)


@pytest.fixture
def mart(spark):
    day = dt.date
    rows = [
        ("A", day(2025, 7, 1), 10.0, None, None, None, 5.0),
        ("A", day(2025, 7, 2), 11.0, 0.1, None, 0.3, 6.0),
        ("A", day(2025, 7, 3), 12.0, 0.09, 0.2, None, 7.0),
        ("B", day(2025, 7, 1), 20.0, None, None, None, 50.0),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_series_and_views(mart):
    assert [tuple(r)[1:] for r in serve.series(mart, "close").collect()][:2] == [
        ("A", 10.0),
        ("B", 20.0),
    ]
    assert serve.series(mart, "volatility_30d", drop_null=True).count() == 1
    columns = ["volatility_7d", "volatility_30d"]
    assert serve.symbol_view(mart, "A", columns, columns).count() == 2
    assert serve.symbol_view(mart, "A' OR '1'='1", ["close"]).count() == 0
    assert [r.close for r in serve.symbol_view(mart, "A", ["close"]).collect()] == [10, 11, 12]


def test_latest_rows(mart):
    assert serve.latest_row(mart, "trade_date", ["close"], "A").first().close == 12.0
    rows = {row.symbol: row for row in serve.latest_by_symbol(mart).collect()}
    # The newest volatility is missing; the last known one counts.
    assert rows["A"].volatility_30d == 0.3
    assert rows["A"].last_daily_return == 0.09
    assert rows["B"].volatility_30d is None
    assert rows["A"].symbol_link == "/symbols/A"
    assert [row.symbol for row in serve.latest_by_symbol(mart).collect()] == ["B", "A"]


def test_describe_and_pivot(mart):
    row = serve.describe_by(mart, "symbol", ["close"]).filter("symbol = 'A'").first()
    assert (row.close_count, row.close_mean, row.close_std) == (3, 11.0, 1.0)
    assert (row.close_min, row.close_p25, row.close_p50, row.close_p75, row.close_max) == (
        10.0,
        10.5,
        11.0,
        11.5,
        12.0,
    )
    wide = serve.pivot_mean(mart, "trade_date", "symbol", "close", ["A", "B"])
    assert [tuple(r)[1:] for r in wide.orderBy("trade_date").collect()] == [
        (10.0, 20.0),
        (11.0, None),
        (12.0, None),
    ]


def test_a_page_filter_reaches_the_scan(spark, mart, tmp_path):
    path = str(tmp_path / "mart")
    mart.write.parquet(path)
    view = serve.symbol_view(spark.read.parquet(path), "A", ["close"])
    plan = view._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "EqualTo(symbol,A)" in plan
    assert "ReadSchema: struct<symbol:string,trade_date:date,close:double>" in plan


def test_quartiles_of_uneven_groups(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    groups = {"a": rng.normal(size=101).tolist(), "b": [1.0, 1.0, 5.0], "c": [2.0], "d": []}
    rows = [(k, v) for k, values in groups.items() for v in [*values, None]]
    df = spark.createDataFrame(rows, "k string, v double")
    for r in serve.describe_by(df, "k", ["v"]).collect():
        values = groups[r.k]
        assert r.v_count == len(values)
        for q in (25, 50, 75):
            want = np.percentile(values, q) if values else None
            assert r[f"v_p{q}"] == (want if want is None else pytest.approx(want))


def test_quartiles_of_a_key_with_a_third_of_the_rows(spark):
    """Every key's values are spread over tasks; nothing is windowed by key."""
    from pyspark.sql import functions as F

    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("k"),
        (F.col("id") * 7919 % n).cast("double").alias("v"),
    )
    described = serve.describe_by(df, "k", ["v"])
    plan = described._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(_part" in plan and "windowspecdefinition(key" not in plan
    hot = described.filter("k = 'hot'").first()
    want = df.filter("k = 'hot'").agg(F.percentile("v", F.array(*map(F.lit, (0.25, 0.5, 0.75))))).first()[0]
    assert [hot.v_p25, hot.v_p50, hot.v_p75] == want
