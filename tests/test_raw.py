import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators.contracts import ContractError
from candlewick.plans.ingest import RAW_SCHEMAS, ingest_klines, ingest_markets
from candlewick.sources.raw import high_water, load_new, load_raw, read_marks, row_counts, write_marks, write_raw

SCHEMA = "coin_id string, price double, ingested_date date"
DAY = dt.date(2026, 7, 21)


def coins(spark, price=1.0):
    rows = [("bitcoin", 117234.0 * price), ("ethereum", 4456.78 * price)]
    return spark.createDataFrame(rows, "coin_id string, price double")


def files(path):
    return sorted(p for p in path.rglob("*.parquet"))


def test_hive_layout(spark, tmp_path):
    write_raw(coins(spark), str(tmp_path), "markets", DAY)
    assert (tmp_path / "markets" / "ingested_date=2026-07-21").is_dir()


def test_same_day_twice_replaces(spark, tmp_path):
    write_raw(coins(spark, 0.5), str(tmp_path), "markets", DAY)
    write_raw(coins(spark), str(tmp_path), "markets", DAY)
    assert len(files(tmp_path)) == 1
    loaded = load_raw(spark, str(tmp_path), {"markets": SCHEMA})["markets"]
    assert {(row.coin_id, row.price) for row in loaded.collect()} == {
        ("bitcoin", 117234.0),
        ("ethereum", 4456.78),
    }


def test_all_days_are_loaded(spark, tmp_path):
    write_raw(coins(spark), str(tmp_path), "markets", dt.date(2026, 7, 20))
    write_raw(coins(spark), str(tmp_path), "markets", DAY)
    tables = load_raw(spark, str(tmp_path), {"markets": SCHEMA})
    assert tables["markets"].select("ingested_date").distinct().count() == 2
    assert [tuple(row) for row in row_counts(tables).collect()] == [("markets", 4)]


def test_missing_dataset_has_no_entry(spark, tmp_path):
    assert load_raw(spark, str(tmp_path), {"klines": SCHEMA}) == {}


def test_rewriting_one_symbol_keeps_the_others(spark, tmp_path):
    schema = "close double, ingested_date date, symbol string"
    rows = [("007", 1.0), ("42", 2.0)]
    both = spark.createDataFrame(rows, "symbol string, close double")
    write_raw(both, str(tmp_path), "klines", DAY, unit="symbol")
    one = both.filter("symbol = '42'").withColumn("close", F.lit(3.0))
    write_raw(one, str(tmp_path), "klines", DAY, unit="symbol")
    loaded = load_raw(spark, str(tmp_path), {"klines": schema})["klines"]
    assert {(row.symbol, row.close) for row in loaded.collect()} == {("007", 1.0), ("42", 3.0)}


def payloads(spark, *payloads_):
    rows = [(symbol, json.dumps(payload)) for symbol, payload in payloads_]
    return spark.createDataFrame(rows, "symbol string, payload string")


def test_ingest_lands_every_symbol_at_once(spark, tmp_path, candle_payload):
    raw = payloads(spark, ("A", candle_payload), ("B", candle_payload[:2]))
    landed = ingest_klines(raw, str(tmp_path), 2_000_000_000_000, DAY)
    assert {(row.symbol, row["rows"]) for row in landed.collect()} == {("A", 3), ("B", 2)}
    klines = load_raw(spark, str(tmp_path), RAW_SCHEMAS)["klines"]
    assert klines.count() == 5
    assert {row.ingested_date for row in klines.collect()} == {DAY}


def test_many_symbols_share_folders(spark, tmp_path, candle_payload):
    names = [f"S{i:03}" for i in range(300)]
    raw = payloads(spark, *[(name, candle_payload[:1]) for name in names])
    landed = ingest_klines(raw, str(tmp_path), 2_000_000_000_000, DAY, folders=4)
    assert landed.count() == 300
    assert len(list((tmp_path / "klines" / f"ingested_date={DAY}").iterdir())) == 4
    klines = load_raw(spark, str(tmp_path), RAW_SCHEMAS)["klines"]
    assert set(klines.columns) == set(RAW_SCHEMAS["klines"].names)
    assert sorted(row.symbol for row in klines.collect()) == names


def test_a_rerun_in_shared_folders_keeps_other_symbols_and_dates(spark, tmp_path):
    schema = "close double, ingested_date date, symbol string"
    later = DAY + dt.timedelta(days=1)

    def land(day, rows):
        write_raw(spark.createDataFrame(rows, "symbol string, close double"), str(tmp_path), "klines", day, "symbol", 2)

    land(DAY, [("007", 1.0), ("007", 1.5), ("42", 2.0), ("a", 3.0), (None, 4.0)])
    land(later, [("42", 5.0)])
    land(DAY, [("42", 6.0), ("b", 7.0), (None, 8.0)])
    loaded = load_raw(spark, str(tmp_path), {"klines": schema})["klines"]
    assert sorted(map(str, loaded.select("ingested_date", "symbol", "close").collect())) == sorted(
        f"Row(ingested_date={day!r}, symbol={symbol!r}, close={close})"
        for day, symbol, close in [
            (DAY, "007", 1.0),
            (DAY, "007", 1.5),
            (DAY, "42", 6.0),
            (DAY, "a", 3.0),
            (DAY, "b", 7.0),
            (DAY, None, 8.0),
            (later, "42", 5.0),
        ]
    )


def test_a_broken_batch_lands_nothing(spark, tmp_path, candle_payload):
    bad = [list(candle) for candle in candle_payload]
    bad[1][2] = "1.0"  # high below low
    raw = payloads(spark, ("A", candle_payload), ("B", bad))
    with pytest.raises(ContractError, match="ordered"):
        ingest_klines(raw, str(tmp_path), 2_000_000_000_000, DAY)
    assert files(tmp_path) == []


def test_ingest_markets(spark, tmp_path, market_payload):
    raw = payloads(spark, ("-", market_payload))
    landed = ingest_markets(raw, str(tmp_path), F.lit("2025-07-21"), DAY)
    assert landed.first()["rows"] == 2
    markets = load_raw(spark, str(tmp_path), RAW_SCHEMAS)["markets"]
    assert {row.snapshot_date for row in markets.collect()} == {dt.datetime(2025, 7, 21)}


def test_a_price_of_zero_lands_nothing(spark, tmp_path, candle_payload):
    bad = [list(candle) for candle in candle_payload]
    bad[0][3] = "0.0"
    with pytest.raises(ContractError, match=r"greater_than\(low\): 1$"):
        ingest_klines(payloads(spark, ("A", candle_payload), ("B", bad)), str(tmp_path), 2_000_000_000_000, DAY)
    assert files(tmp_path) == []


def test_no_candles_land_no_partition(spark, tmp_path):
    landed = ingest_klines(payloads(spark, ("A", [])), str(tmp_path), 2_000_000_000_000, DAY)
    assert landed.collect() == [] and files(tmp_path) == []


def test_a_second_load_opens_new_folders_only(spark, tmp_path):
    root, days = str(tmp_path), [dt.date(2026, 7, d) for d in (19, 20, 21)]
    write_raw(coins(spark, 0.1), root, "markets", days[0])
    write_raw(coins(spark, 0.2), root, "markets", days[1])
    assert read_marks(spark, root) == {}
    first = load_new(spark, root, {"markets": SCHEMA}, {})
    write_marks(spark, root, high_water(first))
    assert read_marks(spark, root) == {"markets": days[1]}
    seen = first["markets"].collect()
    write_raw(coins(spark, 0.3), root, "markets", days[2])
    second = load_new(spark, root, {"markets": SCHEMA}, read_marks(spark, root))["markets"]
    scan = second._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_date" in scan
    assert {row.ingested_date for row in second.collect()} == {days[2]}
    whole = load_raw(spark, root, {"markets": SCHEMA})["markets"]
    assert sorted(seen + second.collect()) == sorted(whole.collect())
    write_raw(coins(spark, 0.4), root, "markets", days[0])  # a day is run again
    again = load_new(spark, root, {"markets": SCHEMA}, read_marks(spark, root), [days[0]])["markets"]
    assert {row.ingested_date for row in again.collect()} == {days[0], days[2]}


def test_marks_of_datasets_without_rows_stay(spark, tmp_path):
    nothing = {"markets": spark.createDataFrame([], SCHEMA)}
    assert high_water(nothing, {"markets": DAY, "klines": DAY}) == {"markets": DAY, "klines": DAY}
    assert high_water(nothing) == {}
