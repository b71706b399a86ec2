import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators.contracts import KLINES, MARKETS, require
from candlewick.sources.payloads import (
    closed_candles,
    parse_klines,
    parse_markets,
    read_payloads,
    without_rows,
)


def landed(spark, payload, symbol="BTCUSDT"):
    return spark.createDataFrame([(symbol, json.dumps(payload))], "symbol string, payload string")


def test_klines_are_typed_by_position(spark, candle_payload):
    frame = parse_klines(landed(spark, candle_payload))
    require(frame, KLINES)
    assert len(frame.columns) == 14
    rows = frame.orderBy("open_time_ms").collect()
    assert [row.close for row in rows] == [117234.0, 118456.0, 117890.0]
    assert {row.symbol for row in rows} == {"BTCUSDT"}
    assert rows[0].trade_count == 987654
    assert dict(frame.dtypes)["close"] == "double"
    assert frame.select(F.unix_millis("open_time")).first()[0] == rows[0].open_time_ms


def test_open_candle_is_dropped(spark, candle_payload):
    as_of = candle_payload[-1][6] + 1000
    still_open = list(candle_payload[-1])
    still_open[0], still_open[6] = as_of - 10, as_of + 86_400_000
    frame = parse_klines(landed(spark, [*candle_payload, still_open]))
    assert closed_candles(frame, as_of).count() == 3


def test_a_candle_closing_right_now_is_closed(spark, candle_payload):
    frame = parse_klines(landed(spark, candle_payload))
    assert closed_candles(frame, candle_payload[-1][6]).count() == 3
    assert closed_candles(frame, candle_payload[-1][6] - 1).count() == 2


@pytest.mark.parametrize("broken", ['{"code": -1121}', "[[1, 2", '[["x"', "", "  ", None])
def test_malformed_payload_fails(spark, broken):
    frame = spark.createDataFrame([("A", broken)], "symbol string, payload string")
    with pytest.raises(Exception, match="(?i)malformed|failfast|no JSON array"):
        parse_klines(frame).collect()


@pytest.mark.parametrize("broken", ['{"status": {"error_code": 429}}', "", None])
def test_what_is_no_market_list_fails(spark, broken):
    frame = spark.createDataFrame([(broken,)], "payload string")
    with pytest.raises(Exception, match="no JSON array"):
        parse_markets(frame, F.lit("2025-07-21")).collect()


def test_payloads_without_rows_are_found(spark):
    frame = spark.createDataFrame([("A", " []"), ("B", "[[1]]")], "symbol string, payload string")
    assert [r.symbol for r in without_rows(frame).collect()] == ["A"]
    assert parse_klines(frame.filter("symbol = 'A'")).count() == 0


def test_markets_keep_ten_fields(spark, market_payload):
    raw = landed(spark, market_payload)
    frame = parse_markets(raw, F.lit("2025-07-21"))
    require(frame, MARKETS)
    assert len(frame.columns) == 12
    rows = {row.coin_id: row for row in frame.collect()}
    assert set(rows) == {"bitcoin", "ethereum"}
    assert rows["bitcoin"].market_cap == 2_331_456_789_012.0
    assert rows["bitcoin"].snapshot_date == dt.datetime(2025, 7, 21)


def test_missing_market_values_become_null(spark, market_payload):
    del market_payload[0]["market_cap"]
    frame = parse_markets(landed(spark, market_payload), F.lit("2025-07-21"))
    assert frame.filter("market_cap IS NULL").count() == 1


def test_payload_files_carry_their_path_symbol(spark, tmp_path, candle_payload):
    for symbol in ("1INCHUSDT", "007"):
        folder = tmp_path / f"symbol={symbol}"
        folder.mkdir()
        (folder / "klines.json").write_text(json.dumps(candle_payload, indent=2))
    frame = parse_klines(read_payloads(spark, str(tmp_path), "symbol string"))
    counts = {row.symbol: row["count"] for row in frame.groupBy("symbol").count().collect()}
    assert counts == {"1INCHUSDT": 3, "007": 3}
