"""Ingestion: landed payloads to checked raw partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.contracts import KLINES, MARKETS, Contract, stage_checked
from candlewick.sources.payloads import closed_candles, parse_klines, parse_markets
from candlewick.sources.raw import write_raw

KLINES_DATASET = "klines"
MARKETS_DATASET = "markets"
# Folders that the symbols of one date are dealt to.
FOLDERS = 256


def raw_schema(contract: Contract) -> T.StructType:
    """Columns of a raw dataset as read back, path columns included."""
    fields = [
        T.StructField(field.name, field.type or T.TimestampType()) for field in contract.fields
    ]
    return T.StructType([*fields, T.StructField("ingested_date", T.DateType())])


RAW_SCHEMAS = {KLINES_DATASET: raw_schema(KLINES), MARKETS_DATASET: raw_schema(MARKETS)}


def ingest_klines(
    payloads: DataFrame,
    root: str,
    as_of_ms: int,
    ingested_date: dt.date,
    interval: str = "1d",
    folders: int | None = FOLDERS,
) -> DataFrame:
    """Parse, drop open candles, check and land all symbols at once; (symbol, rows) landed.

    The contract gates the whole batch: nothing lands if any rule breaks. The payloads are parsed once, into
    a stage that counts broken rules as it is written; what lands is read from there. A run replaces what the date
    holds of its symbols. These share `folders`, see `write_raw`; None gives each a folder of its own.
    """
    candles = closed_candles(parse_klines(payloads, interval), as_of_ms)
    checked = stage_checked(candles, KLINES, "klines")
    write_raw(checked, root, KLINES_DATASET, ingested_date, unit="symbol", folders=folders)
    return checked.groupBy("symbol").agg(F.count("*").alias("rows"))


def ingest_markets(
    payloads: DataFrame,
    root: str,
    snapshot_date: Column,
    ingested_date: dt.date,
    vs_currency: str = "usd",
) -> DataFrame:
    """The same for one market snapshot; one (rows) row."""
    checked = stage_checked(parse_markets(payloads, snapshot_date, vs_currency), MARKETS, "markets")
    write_raw(checked, root, MARKETS_DATASET, ingested_date)
    return checked.agg(F.count("*").alias("rows"))
