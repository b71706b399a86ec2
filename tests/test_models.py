import datetime as dt
import random
import statistics
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from candlewick.operators.keyed import (
    append_series,
    last_n_per_key,
    late_wins,
    latest_wins,
    merge_fresh_wins,
    top_n_per_key,
)
from candlewick.plans import models
from candlewick.sources import snapshot
from candlewick.sources.bucketed import write_bucketed
from candlewick.sources.snapshot import export_snapshot, files_of, publish, read_mart, read_snapshot

DAY = 86_400_000
START = 1_752_969_600_000  # 2025-07-20


def raw_klines(spark, rows):
    """rows: (symbol, day number, close, ingested day of July 2026)."""
    data = [
        (s, "1d", START + d * DAY, c, c + 1, c - 1, c, 10.0, 10.0 * (d + 1), 5, dt.date(2026, 7, i))
        for s, d, c, i in rows
    ]
    schema = (
        "symbol string, interval string, open_time_ms long, open double, high double, low double,"
        "close double, volume double, quote_volume double, trade_count long, ingested_date date"
    )
    return spark.createDataFrame(data, schema).withColumn(
        "open_time", F.timestamp_millis("open_time_ms")
    )


def mart_rows(df):
    return df.orderBy("symbol", "trade_date").collect()


def test_latest_ingestion_wins_and_days_are_utc(spark):
    raw = raw_klines(spark, [("A", 0, 100.0, 20), ("A", 0, 101.0, 21), ("A", 1, 102.0, 20)])
    rows = models.stg_klines(raw).orderBy("trade_date").collect()
    # The session runs in New York, where these candles open on the day before.
    assert [row.trade_date for row in rows] == [dt.date(2025, 7, 20), dt.date(2025, 7, 21)]
    assert [row.close for row in rows] == [101.0, 102.0]


def test_ties_are_broken_by_the_given_columns(spark):
    raw = raw_klines(spark, [("A", 0, 100.0, 20), ("A", 0, 101.0, 20)])
    kept = latest_wins(raw, ["symbol"], [F.col("ingested_date").desc()], [F.col("close")])
    assert [row.close for row in kept.collect()] == [100.0]


@pytest.mark.parametrize("daily", [True, False])
def test_mart_by_hand(spark, daily):
    closes = [117234.0, 118456.0, 117890.0]
    raw = raw_klines(spark, [("A", d, c, 20) for d, c in enumerate(closes)])
    rows = mart_rows(models.mart_daily_ohlcv(models.stg_klines(raw), daily=daily))
    returns = [closes[1] / closes[0] - 1, closes[2] / closes[1] - 1]
    assert rows[0].daily_return is None
    assert [row.daily_return for row in rows[1:]] == pytest.approx(returns)
    assert rows[0].volatility_7d is None and rows[1].volatility_7d is None
    assert rows[2].volatility_7d == pytest.approx(statistics.stdev(returns))
    assert [row.avg_quote_volume_30d for row in rows] == pytest.approx([10.0, 15.0, 20.0])


def test_frames_count_rows_not_days(spark):
    days = [0, 1, 2, 10, 11, 40, 41, 42, 90, 91]
    raw = raw_klines(spark, [("A", d, 100.0 + (d * 7) % 13, 20) for d in days])
    rows = mart_rows(models.mart_daily_ohlcv(models.stg_klines(raw), daily=True))
    returns = [row.daily_return for row in rows]
    assert rows[-1].volatility_7d == pytest.approx(statistics.stdev(returns[-7:]))
    assert rows[-1].volatility_30d == pytest.approx(statistics.stdev(returns[1:]))


def test_zero_close_gives_null_not_error(spark):
    raw = raw_klines(spark, [("A", 0, 0.0, 20), ("A", 1, 5.0, 20)])
    rows = mart_rows(models.mart_daily_ohlcv(models.stg_klines(raw), daily=True))
    assert [row.daily_return for row in rows] == [None, None]


def staged_markets(spark, rows):
    schema = (
        "coin_id string, symbol string, name string, current_price double, market_cap double,"
        "market_cap_rank double, total_volume double, price_change_percentage_24h double,"
        "circulating_supply double, snapshot_date timestamp_ntz, ingested_date date"
    )
    data = [
        (coin, coin.upper(), coin, 1.0, cap, rank, volume, None, 1.0, dt.datetime(2025, 7, 21),
         dt.date(2025, 7, 21))
        for coin, cap, rank, volume in rows
    ]
    return models.stg_markets(spark.createDataFrame(data, schema))


def test_overview_of_the_golden_snapshot(spark):
    caps = (2_331_456_789_012.0, 536_789_012_345.0)
    stg = staged_markets(
        spark, [("bitcoin", caps[0], 1.0, 5.0), ("ethereum", caps[1], 2.0, 6.0)]
    )
    row = models.market_overview(stg).first()
    assert row.total_market_cap == sum(caps)
    assert row.coins_tracked == 2
    assert row.btc_dominance == pytest.approx(caps[0] / sum(caps))
    assert row.top10_share == 1.0


def test_overview_null_rules(spark):
    stg = staged_markets(
        spark,
        [("bitcoin", 60.0, 1.0, 5.0), ("x", None, 2.0, 100.0), ("y", 40.0, None, 7.0)],
    )
    row = models.market_overview(stg).first()
    # No cap: not counted, volume included. No rank: not among the top.
    assert (row.total_volume_24h, row.coins_tracked, row.top10_share) == (12.0, 2, 0.6)


def test_overview_of_worthless_market(spark):
    row = models.market_overview(staged_markets(spark, [("bitcoin", 0.0, 1.0, 5.0)])).first()
    assert row.btc_dominance is None and row.top10_share is None


def test_ranks_round_half_to_even(spark):
    given = {"a": 2.5, "b": 3.5, "c": 2.7, "d": None}
    ranks = [(coin, 1.0, rank, 1.0) for coin, rank in given.items()]
    rows = staged_markets(spark, ranks).orderBy("coin_id").collect()
    assert [row.market_cap_rank for row in rows] == [2, 4, 3, None]
    assert rows[0].symbol == "a"


def keyed(spark, rows):
    return spark.createDataFrame(rows, "symbol string, trade_date date, close double")


def test_fresh_rows_win_and_history_stays(spark):
    one, two, three = (dt.date(2025, 7, day) for day in (1, 2, 3))
    previous = keyed(spark, [("A", one, 1.0), ("A", two, 2.0), (None, one, 9.0)])
    fresh = keyed(spark, [("A", two, 20.0), ("A", three, 30.0), (None, one, 8.0)])
    merged = merge_fresh_wins(fresh, previous.select("close", "symbol", "trade_date"),
                              ["symbol", "trade_date"])
    assert sorted(row.close for row in merged.collect()) == [1.0, 8.0, 9.0, 20.0, 30.0]
    assert append_series(fresh, previous).count() == 6


def test_limits_per_key(spark):
    df = spark.range(100).selectExpr("cast(id % 3 as string) AS symbol", "id AS t", "-id AS v")
    last = last_n_per_key(df, "symbol", [F.col("t")], 2)
    assert sorted(row.t for row in last.collect()) == [94, 95, 96, 97, 98, 99]
    top = top_n_per_key(df, "symbol", [F.col("v").desc()], 1)
    assert sorted(row.t for row in top.collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        last_n_per_key(df, "symbol", [F.col("t")], 0)
    with pytest.raises(ValueError):
        top_n_per_key(df, "symbol", [F.col("t")], 0)


def test_snapshot_accumulates_and_old_files_stay(spark, tmp_path):
    root = str(tmp_path / "snap")
    one, two, three = (dt.date(2025, 7, day) for day in (1, 2, 3))
    first = {"mart_daily_ohlcv": keyed(spark, [("A", one, 1.0), ("A", two, 2.0)])}
    assert read_snapshot(spark, root) == {}
    assert [tuple(r) for r in export_snapshot(first, root).collect()] == [("mart_daily_ohlcv", 2)]
    open_reader = read_snapshot(spark, root)["mart_daily_ohlcv"]
    second = {"mart_daily_ohlcv": keyed(spark, [("A", two, 20.0), ("A", three, 30.0)])}
    assert export_snapshot(second, root).first()["rows"] == 3
    now = read_snapshot(spark, root)["mart_daily_ohlcv"]
    assert sorted(row.close for row in now.collect()) == [1.0, 20.0, 30.0]
    assert sorted(row.close for row in open_reader.collect()) == [1.0, 2.0]


MART = "mart_daily_ohlcv"


def history(spark, months=6, symbols=40):
    """A row a symbol and day, on the first ten days of each month."""
    days = [dt.date(2025, m, d) for m in range(1, months + 1) for d in range(1, 11)]
    return keyed(spark, [(f"s{i:02}", day, float(i)) for i in range(symbols) for day in days])


def paths(spark, root):
    return {r.path: r["rows"] for r in files_of(spark, root, MART).collect()}


def test_a_fresh_day_rewrites_few_files(spark, tmp_path):
    root, old = str(tmp_path / "a+b c%20"), history(spark)
    export_snapshot({MART: old}, root, file_rows=50)
    before = paths(spark, root)
    assert len(before) >= 6 * 400 // 50
    fresh = keyed(spark, [(f"s{i:02}", dt.date(2025, 6, d), -1.0) for i in range(3) for d in (10, 11)])
    export_snapshot({MART: fresh}, root, file_rows=50)
    after = paths(spark, root)
    replaced = before.keys() - after.keys()
    assert 1 <= len(replaced) <= 4 and all("2025-06-01" in p for p in replaced)
    assert sum(after.values()) == 6 * 400 + 3
    want = merge_fresh_wins(fresh, old, ["symbol", "trade_date"])
    assert sorted(read_mart(spark, root, MART).collect()) == sorted(want.collect())


def test_many_exports_equal_plain_merges(spark, tmp_path):
    root, draw = str(tmp_path), random.Random(1)
    want = {}
    for turn in range(5):
        rows = {
            (draw.choice(["A", "B", "C", None]), draw.choice([None, dt.date(2024, 12, 30), dt.date(2025, 2, 3)]))
            for _ in range(draw.randrange(9))
        }
        fresh = [(s, d, float(turn)) for s, d in rows]
        export_snapshot({MART: keyed(spark, fresh)}, root, file_rows=2)
        keys = {(s, d) for s, d in rows if s and d}
        want = {k: v for k, v in want.items() if (k[0], k[1]) not in keys} | {(s, d, v): v for s, d, v in fresh}
        got = read_snapshot(spark, root)[MART].collect()
        assert sorted(map(str, got)) == sorted(str(Row(symbol=s, trade_date=d, close=v)) for s, d, v in want)


def test_an_export_lists_folders_and_lays_fresh_rows_out_once(spark, tmp_path):
    root, shared = str(tmp_path / "a+b c%20"), Path(spark.conf.get("spark.checkpoint.dir"))
    export_snapshot({MART: history(spark)}, root, file_rows=20)
    seen = set(shared.rglob("*.parquet"))
    export_snapshot({MART: history(spark).withColumn("close", F.lit(-1.0))}, root, file_rows=20)
    # The fresh rows are compared and merged from a few files, not from 120 small ones.
    staged = [path for path in shared.rglob("*.parquet") if path not in seen and "fresh-" in str(path)]
    assert 1 <= len(staged) < 30
    whole = read_snapshot(spark, root)[MART]
    assert len(whole.inputFiles()) >= 6 * 400 // 20
    assert "InMemoryFileIndex(1 paths)" in whole._jdf.queryExecution().executedPlan().toString()
    assert whole.count() == 6 * 400 and whole.filter("close = -1").count() == 6 * 400


@pytest.mark.parametrize("day", [2, 10])
def test_files_of_partly_replaced_exports_are_read_alone(spark, tmp_path, monkeypatch, day):
    monkeypatch.setattr(snapshot, "NAMED_FILES", 1)
    root, want = str(tmp_path / "a+b c%20"), history(spark, 3, 20)
    export_snapshot({MART: want}, root, file_rows=25)
    for turn, symbols in enumerate((2, 13, 20)):
        fresh = keyed(spark, [(f"s{i:02}", dt.date(2025, 3, day), -float(turn)) for i in range(symbols)])
        export_snapshot({MART: fresh}, root, file_rows=25)
        want = merge_fresh_wins(fresh, want, ["symbol", "trade_date"])
        assert sorted(read_snapshot(spark, root)[MART].collect()) == sorted(want.collect())


def test_pages_open_only_files_of_their_symbol(spark, tmp_path):
    root, old = str(tmp_path), history(spark)
    publish({MART: old}, root, file_rows=50)
    page = read_mart(spark, root, MART, symbol="s07")
    assert len(page.inputFiles()) <= 12 < len(read_mart(spark, root, MART).inputFiles())
    assert sorted(page.collect()) == sorted(old.filter("symbol = 's07'").collect())
    assert read_mart(spark, root, MART, symbol="unknown").collect() == []
    with pytest.raises(KeyError):
        read_mart(spark, root, "unknown")


def test_late_rows_meet_bucketed_history(spark):
    columns = "symbol string, t long, day int, v double"
    draw = random.Random(2)

    def some(n):
        rows = [(f"s{draw.randrange(6)}", draw.randrange(5), draw.choice([None, 1, 2]), draw.choice([None, 1.0, 2.0]))
                for _ in range(n)]
        return spark.createDataFrame(rows, columns)

    first, late = some(40), some(25)
    rank = [F.desc_nulls_last("day"), F.desc_nulls_last("v")]
    history = write_bucketed(latest_wins(first, ["symbol", "t"], rank), ["symbol", "t"], 4)
    merged = late_wins(history, late, ["symbol", "t"], ["day", "v"])
    want = latest_wins(first.unionByName(late), ["symbol", "t"], rank)
    assert sorted(map(str, merged.collect())) == sorted(map(str, want.collect()))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    old = plan.split("FullOuter")[1]
    # The branch of the history has no exchange; that of the late rows has them all.
    scan = next(line for line in old.splitlines() if "Bucketed: true" in line)
    depth = scan.index("FileScan")
    above = [line for line in old[: old.index(scan)].splitlines() if "Exchange" in line]
    assert depth and not above


def test_daily_is_held_against_the_interval(spark):
    raw = spark.createDataFrame([("A", "1h", dt.date(2025, 1, 1))], "symbol string, interval string, trade_date date")
    columns = ("open", "high", "low", "close", "volume", "quote_volume", "trade_count")
    hourly = raw.select("*", *[F.lit(1.0).alias(c) for c in columns])
    assert models.mart_daily_ohlcv(hourly).count() == 1
    with pytest.raises(Exception, match="interval is 1h"):
        models.mart_daily_ohlcv(hourly, daily=True).collect()
