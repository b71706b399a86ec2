"""Raw tables to staging views and mart tables, with their declared data tests."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from candlewick.operators.checks import all_results, column_tests, result_of, unique
from candlewick.plans.ingest import KLINES_DATASET, MARKETS_DATASET
from candlewick.plans.models import market_overview, mart_daily_ohlcv, stg_klines, stg_markets
from candlewick.sources.snapshot import publish, read_mart


@dataclass(frozen=True)
class ModelTests:
    not_null: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()


# The data tests of each model.
MODEL_TESTS = {
    "stg_klines": ModelTests(("symbol", "close"), ("close",), (("symbol", "open_time"),)),
    "stg_markets": ModelTests(
        ("coin_id", "price_usd"), ("price_usd",), (("coin_id", "snapshot_date"),)
    ),
    "mart_daily_ohlcv": ModelTests(("close",), ("close",), (("symbol", "trade_date"),)),
    "mart_market_overview": ModelTests(
        ("snapshot_date", "btc_dominance"), (), (("snapshot_date",),)
    ),
}


def build_warehouse(
    raw: Mapping[str, DataFrame], path: str, *, daily: bool = False
) -> dict[str, DataFrame]:
    """Staging as views, marts as a new version of the tables under `path`; all are registered by name.

    A missing raw dataset gives no models, so nothing stale is served in its place. Whoever reads the
    version before goes on reading it; `read_snapshot` gives the newest one.
    """
    staged, marts = {}, {}
    if KLINES_DATASET in raw:
        staged["stg_klines"] = stg_klines(raw[KLINES_DATASET])
        marts["mart_daily_ohlcv"] = mart_daily_ohlcv(staged["stg_klines"], daily=daily)
    if MARKETS_DATASET in raw:
        staged["stg_markets"] = stg_markets(raw[MARKETS_DATASET])
        marts["mart_market_overview"] = market_overview(staged["stg_markets"])
    relations = dict(staged)
    if marts:
        publish(marts, path)
        spark = next(iter(marts.values())).sparkSession
        relations |= {mart: read_mart(spark, path, mart) for mart in marts}
    for name, relation in relations.items():
        relation.createOrReplaceTempView(name)
    return relations


def data_tests(relations: Mapping[str, DataFrame]) -> DataFrame:
    """(model, test, column, failures) of every declared test of the models given."""
    results = []
    for model, tests in MODEL_TESTS.items():
        if model not in relations:
            continue
        df = relations[model]
        results.append(column_tests(df, model, tests.not_null, tests.positive))
        for keys in tests.unique:
            name = "unique" if len(keys) == 1 else "unique_combination"
            results.append(result_of(model, name, ",".join(keys), unique(df, keys)))
    return all_results(results)
