import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # A zone with gaps and folds: no result may depend on it.
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def candle_payload():
    """Three daily candles in positional form, prices as strings."""
    day = 86_400_000
    start = 1_752_969_600_000  # 2025-07-20
    closes = ("117234.00", "118456.00", "117890.00")
    opens = ("117100.00", "117234.00", "118456.00")
    return [
        [
            start + i * day,
            opens[i],
            "119000.00",
            "115800.00",
            closes[i],
            "12345.678",
            start + (i + 1) * day - 1,
            "1447890123.456",
            987654 - i,
            "6172.839",
            "723945061.728",
            "0",
        ]
        for i in range(3)
    ]


@pytest.fixture
def market_payload():
    def coin(id_, symbol, price, cap, rank, **extra):
        return {
            "id": id_,
            "symbol": symbol,
            "name": id_.title(),
            "image": "https://example.org/x.png",
            "current_price": price,
            "market_cap": cap,
            "market_cap_rank": rank,
            "total_volume": 45_000_000_000,
            "price_change_percentage_24h": -1.25,
            "circulating_supply": 19_800_000.0,
            "last_updated": "2025-07-21T00:00:00.000Z",
            **extra,
        }

    return [
        coin("bitcoin", "BTC", 117_234.0, 2_331_456_789_012, 1, roi=None),
        coin(
            "ethereum",
            "eth",
            4456.78,
            536_789_012_345,
            2,
            roi={"times": 30.1, "currency": "btc", "percentage": 3010.2},
        ),
    ]
