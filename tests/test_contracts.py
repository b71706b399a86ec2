import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators import checks
from candlewick.operators.contracts import (
    KLINES,
    MARKETS,
    Contract,
    ContractError,
    Field,
    rejects,
    require,
    stage_checked,
    violations,
)
from candlewick.sources.payloads import parse_klines, parse_markets


@pytest.fixture
def markets(spark, market_payload):
    raw = spark.createDataFrame([(json.dumps(market_payload),)], "payload string")
    return parse_markets(raw, F.lit("2025-07-21"))


@pytest.fixture
def klines(spark, candle_payload):
    rows = [("A", json.dumps(candle_payload))]
    raw = spark.createDataFrame(rows, "symbol string, payload string")
    return parse_klines(raw)


def broken(df, contract, batch=()):
    rows = violations(df, contract, batch).filter("n > 0").collect()
    return {(row.rule, row.column): row.n for row in rows}


def test_good_batches_pass(markets, klines):
    assert broken(markets, MARKETS) == {}
    assert broken(klines, KLINES) == {}
    assert require(klines, KLINES).columns == [field.name for field in KLINES.fields]


def test_negative_price(markets):
    bad = markets.withColumn("current_price", F.lit(-1.0))
    assert broken(bad, MARKETS) == {("greater_than", "current_price"): 2}
    with pytest.raises(ContractError, match=r"greater_than\(current_price\): 2"):
        require(bad, MARKETS)


def test_duplicate_coin(markets):
    bad = markets.withColumn("coin_id", F.lit("bitcoin"))
    assert broken(bad, MARKETS) == {("unique", "coin_id"): 2}


def test_same_coin_in_two_batches_is_legal(markets):
    first = markets.withColumn("ingested_date", F.lit(dt.date(2026, 7, 20)))
    both = first.unionByName(markets.withColumn("ingested_date", F.lit(dt.date(2026, 7, 21))))
    assert broken(both, MARKETS, ["ingested_date"]) == {}
    assert broken(both.drop("ingested_date"), MARKETS) == {("unique", "coin_id"): 4}


def test_unexpected_and_missing_columns(spark, klines):
    strange = spark.createDataFrame([(1,)], "surprise int")
    found = broken(strange, MARKETS)
    assert ("unexpected_column", "surprise") in found
    assert ("missing_column", "coin_id") in found
    assert broken(klines.drop("volume"), KLINES) == {("missing_column", "volume"): 1}


def test_klines_types_are_not_coerced(klines):
    bad = klines.withColumn("trade_count", F.col("trade_count").cast("double"))
    assert broken(bad, KLINES) == {("type", "trade_count"): 1}


def test_market_numbers_are_coerced(markets):
    text = markets.withColumn("current_price", F.col("current_price").cast("string"))
    assert broken(text, MARKETS) == {}
    assert dict(require(text, MARKETS).dtypes)["current_price"] == "double"
    junk = markets.withColumn("market_cap", F.lit("n/a"))
    assert broken(junk, MARKETS) == {("convertible", "market_cap"): 2}


def test_nan_counts_as_null(klines, markets):
    nan = klines.withColumn("close", F.lit(float("nan")))
    assert broken(nan, KLINES) == {("not_null", "close"): 3}
    optional = markets.withColumn("market_cap", F.lit(float("nan")))
    assert broken(optional, MARKETS) == {}


def test_high_below_low(klines):
    bad = klines.withColumn("high", F.col("low") - 1)
    assert broken(bad, KLINES) == {("ordered", "high>=low"): 3}


def test_empty_frame_passes(klines):
    assert broken(klines.limit(0), KLINES) == {}


def test_rejects_name_all_broken_rules(klines):
    rows = klines.orderBy("open_time_ms")
    first = rows.first().open_time_ms
    hit = F.col("open_time_ms") == first
    bad = klines.withColumns(
        {
            "high": F.when(hit, 0.0).otherwise(F.col("high")),
            "volume": F.when(hit, None).otherwise(F.col("volume")),
        }
    )
    found = rejects(bad, KLINES).collect()
    assert len(found) == 1
    assert set(found[0].failed) == {"greater_than:high", "not_null:volume", "ordered:high>=low"}
    assert found[0].first_failed == found[0].failed[0]


def test_a_key_holding_most_rows_is_fully_rejected(spark, klines):
    copies = klines.limit(1).crossJoin(spark.range(5000)).drop("id")
    found = rejects(klines.unionByName(copies), KLINES)
    assert found.count() == 5001
    assert found.select("first_failed").distinct().collect()[0][0] == "unique:symbol,open_time_ms"


def test_hot_and_null_keys_are_rejected_alike(spark, markets):
    coin = markets.limit(1)
    counts = {"once": 1, "twice": 2, "often": 30, None: 40}
    batch = None
    for name, n in counts.items():
        rows = coin.withColumn("coin_id", F.lit(name).cast("string")).withColumn(
            "_copy", F.explode(F.sequence(F.lit(1), F.lit(n)))
        )
        batch = rows if batch is None else batch.unionByName(rows)
    found = rejects(batch.drop("_copy"), MARKETS)
    shared = found.filter(F.array_contains("failed", "unique:coin_id"))
    got = {row.coin_id: row["count"] for row in shared.groupBy("coin_id").count().collect()}
    assert got == {"twice": 2, "often": 30, None: 40}
    assert broken(batch.drop("_copy"), MARKETS)[("unique", "coin_id")] == 72


def test_data_tests(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 0.0), ("b", -2.0), ("c", None)], "key string, value double"
    )
    assert checks.not_null(df, "value").count() == 1
    assert checks.positive_value(df, "value").count() == 2
    assert [tuple(row) for row in checks.unique(df, ["key"]).collect()] == [("a", 2)]
    results = checks.column_tests(df, "m", ["key", "value"], ["value"]).collect()
    assert [row.failures for row in results] == [0, 1, 2]
    assert checks.result_of("m", "unique", "key", checks.unique(df, ["key"])).first().failures == 1


def test_staged_batch_is_judged_like_the_frame(spark):
    rows = [("a", "x", None, -1.0), ("a", "y", "n", 2.0), ("b", "z", "n", float("nan"))]
    frame = spark.createDataFrame(rows, "coin_id string, symbol string, name string, price double")
    contract = Contract(
        "coins",
        (
            Field("coin_id", T.StringType()),
            Field("symbol", T.StringType()),
            Field("name", T.StringType()),
            Field("price", T.DoubleType(), above=0),
        ),
        unique=("coin_id",),
    )
    found = "; ".join(f"{r.rule}({r.column}): {r.n}" for r in violations(frame, contract).collect() if r.n)
    with pytest.raises(ContractError) as error:
        stage_checked(frame, contract, "coins")
    assert str(error.value) == f"coins: {found}"
    good = frame.filter("symbol = 'y'")
    assert stage_checked(good, contract, "coins").collect() == good.collect()
    assert stage_checked(good.limit(0), contract, "coins").count() == 0
    with pytest.raises(ContractError, match="missing_column"):
        stage_checked(frame.drop("price"), contract, "coins")


def test_staging_runs_its_input_once(spark):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        ran.add(1)
        return x

    contract = Contract("numbers", (Field("id", T.LongType(), above=-1),), unique=("id",))
    assert stage_checked(spark.range(50).select(counted("id").alias("id")), contract, "numbers").count() == 50
    assert ran.value == 50


@pytest.mark.parametrize("bits", [1 << 23, 1 << 16])
def test_incremental_uniqueness_equals_the_whole(spark, monkeypatch, bits):
    """A filter that is nearly full only lets more keys through to the comparison."""
    monkeypatch.setattr(checks, "FILTER_BITS", bits)
    draw = random.Random(bits)
    names = ["a", "b", None]
    keys = {(draw.choice(names), i) for i in range(300)}
    old = [(k, i, draw.choice([1, 2, 3, None])) for k, i in sorted(keys, key=str)[:200]]
    new = [(draw.choice(names), draw.randrange(400), 4) for _ in range(80)] + [(None, None, 4)] * 2
    history, fresh = (spark.createDataFrame(rows, "k string, i int, day int") for rows in (old, new))
    filters = checks.key_filters(history, ["k", "i"], "day")
    got = checks.unique_since(fresh, history, filters, ["k", "i"], "day")
    want = checks.unique(history.unionByName(fresh), ["k", "i"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 5
    assert checks.unique_since(fresh.limit(0), history, filters, ["k", "i"], "day").count() == 0
