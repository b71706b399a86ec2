import json

import pytest
from pyspark.sql import functions as F

from candlewick.plans import models, scorecard, warehouse
from candlewick.sources.payloads import parse_klines, parse_markets
from candlewick.sources.reports import list_tables, present_tables, write_report


@pytest.fixture(autouse=True)
def empty_catalog(spark):
    for name in warehouse.MODEL_TESTS:
        spark.catalog.dropTempView(name)


@pytest.fixture
def markets(spark, market_payload):
    raw = spark.createDataFrame([(json.dumps(market_payload),)], "payload string")
    return parse_markets(raw, F.lit("2025-07-21"))


@pytest.fixture
def klines(spark, candle_payload):
    rows = [("A", json.dumps(candle_payload))]
    raw = spark.createDataFrame(rows, "symbol string, payload string")
    return parse_klines(raw)


def test_probes_meet_their_expectation(markets, klines):
    probes = scorecard.contract_probes(markets, klines).collect()
    assert len(probes) == 5
    assert all(probe.passed for probe in probes)
    details = {probe.name: probe.detail for probe in probes}
    assert details["markets_reject_negative_price"] == "greater_than:current_price:1"
    assert details["markets_valid"] == "validated"
    assert all(len(probe.detail) <= 200 for probe in probes)


def test_a_bad_valid_frame_fails_its_probe(markets, klines):
    bad = klines.withColumn("volume", F.lit(-1.0))
    probes = scorecard.contract_probes(markets, bad)
    failed = [probe.name for probe in probes.filter("NOT passed").collect()]
    assert failed == ["klines_valid"]
    assert tuple(scorecard.probe_summary(probes).first()) == (5, 4, 1, 0.8)
    caveats = scorecard.scorecard(probes, {}).first().caveats
    assert len(caveats) == 2 and caveats[0].startswith("1 probe")


def test_summary_without_probes(spark):
    empty = spark.createDataFrame([], "passed boolean")
    assert tuple(scorecard.probe_summary(empty).first()) == (0, 0, 0, 0.0)


def test_scorecard_without_warehouse(spark, tmp_path, markets, klines):
    card = scorecard.scorecard(scorecard.contract_probes(markets, klines), {}, "2026-01-01")
    row = card.first()
    assert row.warehouse.available is False
    assert row.probe_summary.failed == 0
    assert len(row.caveats) == 1
    write_report(card, str(tmp_path / "report"))
    part = next((tmp_path / "report").glob("part-*.json"))
    written = json.loads(part.read_text())
    assert written["probe_summary"]["total"] == 5
    assert written["warehouse"] == {
        "available": False,
        "reason": "No warehouse",
        "tables": [],
        "row_counts": None,
        "ohlcv": None,
    }


def test_scorecard_of_a_warehouse(spark, markets, klines):
    probes = scorecard.contract_probes(markets, klines)
    staged = models.stg_klines(klines.withColumn("ingested_date", F.current_date()))
    staged.createOrReplaceTempView("stg_klines")
    models.mart_daily_ohlcv(staged, daily=True).createOrReplaceTempView("mart_daily_ohlcv")
    relations = present_tables(spark, scorecard.SANITY_TABLES)
    assert set(relations) == {"stg_klines", "mart_daily_ohlcv"}
    names = {row.table_name for row in list_tables(spark).collect()}
    assert set(relations) <= names
    row = scorecard.scorecard(probes, relations).first()
    assert [tuple(entry) for entry in row.warehouse.row_counts] == [
        ("mart_daily_ohlcv", 3),
        ("stg_klines", 3),
    ]
    assert (row.warehouse.ohlcv.symbols, str(row.warehouse.ohlcv.max_day)) == (1, "2025-07-22")
    assert row.warehouse.tables == sorted(relations) and row.warehouse.reason is None
    assert row.caveats == []
    emptied = {"mart_daily_ohlcv": relations["mart_daily_ohlcv"].limit(0)}
    assert len(scorecard.scorecard(probes, emptied).first().caveats) == 1


def test_warehouse_models_and_their_tests(spark, tmp_path, markets, klines):
    day = F.lit("2025-07-22").cast("date")
    raw = {
        "klines": klines.withColumn("ingested_date", day),
        "markets": markets.withColumn("ingested_date", day),
    }
    relations = warehouse.build_warehouse(raw, str(tmp_path), daily=True)
    assert set(relations) == set(warehouse.MODEL_TESTS)
    assert spark.table("mart_daily_ohlcv").count() == 3
    assert relations["mart_market_overview"].first().coins_tracked == 2
    results = warehouse.data_tests(relations).collect()
    assert len(results) == 14
    assert all(row.failures == 0 for row in results)
    broken = {"mart_daily_ohlcv": relations["mart_daily_ohlcv"].withColumns(
        {"close": F.lit(-1.0), "trade_date": day}
    )}
    found = {row.test: row.failures for row in warehouse.data_tests(broken).collect()}
    assert found == {"not_null": 0, "positive_value": 3, "unique_combination": 1}
    # Rebuilding from less raw data replaces the mart and builds nothing stale.
    again = warehouse.build_warehouse({"klines": raw["klines"].limit(1)}, str(tmp_path))
    assert set(again) == {"stg_klines", "mart_daily_ohlcv"}
    assert again["mart_daily_ohlcv"].count() == 1
