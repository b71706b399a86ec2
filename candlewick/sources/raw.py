"""The raw layer: Parquet under dataset/ingested_date=.../[unit=... or folder=.../]."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.sources.storage import stored

MARKS = "version bigint, dataset string, day date"
#: Path column of datasets whose units share folders.
FOLDER = "folder"


def write_raw(
    df: DataFrame,
    root: str,
    dataset: str,
    ingested_date: dt.date | None = None,
    unit: str | None = None,
    folders: int | None = None,
) -> str:
    """Write one ingestion; a re-run replaces the same (date, unit) partitions only.

    Without `ingested_date` the frame must carry that column itself. The rebalance hint
    gathers each partition into few files and lets AQE split a partition that is too large.

    Each unit has a folder of its own. With `folders` the units of a date are dealt to that many instead, so the
    number of files follows the rows and not the units; a re-run then writes the other units of its folders
    again, so runs for one date must follow one another. All runs of a dataset must name the same number.
    """
    if folders and not unit:
        raise ValueError("folders are dealt by unit")
    layout = ["ingested_date", FOLDER if folders else unit] if unit else ["ingested_date"]
    if ingested_date is not None:
        df = df.withColumn("ingested_date", F.lit(ingested_date))
    path = f"{root}/{dataset}"
    if folders:
        df = df.withColumn(FOLDER, F.pmod(F.xxhash64(unit), F.lit(folders)).cast("int"))
        df = _with_other_units(df, path, unit, ingested_date)
    rows = df.hint("rebalance", *[F.col(name) for name in layout])
    if folders:  # a reader of one unit skips the row groups of others
        rows = rows.sortWithinPartitions(*layout, unit)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(path)
    )
    return path


def _with_other_units(df: DataFrame, path: str, unit: str, ingested_date: dt.date | None) -> DataFrame:
    """The batch and what its folders hold of units that it does not bring."""
    try:
        old = df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return df
    if ingested_date is not None:
        old = old.filter(F.col("ingested_date") == F.lit(ingested_date))
    if old.isEmpty():
        return df

    def among(names: Sequence[str], how: str) -> DataFrame:
        keys = df.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct()
        return old.join(keys, reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]), how)

    old = among(["ingested_date", FOLDER], "left_semi")
    old = among(["ingested_date", unit], "left_anti")
    # Written first: the job that replaces a folder must not be the only one to hold these rows.
    return df.unionByName(stored(old, "units"))


def load_raw(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType | str]
) -> dict[str, DataFrame]:
    """Every partition of each dataset; a dataset without files has no entry.

    The schemas must name the path columns too, so that no value is re-typed from its path
    and no file footer is read for inference.
    """
    tables = {}
    for dataset, schema in schemas.items():
        try:
            tables[dataset] = spark.read.schema(schema).parquet(f"{root}/{dataset}").drop(FOLDER)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return tables


def load_new(
    spark: SparkSession,
    root: str,
    schemas: Mapping[str, T.StructType | str],
    marks: Mapping[str, dt.date],
    again: Sequence[dt.date] = (),
) -> dict[str, DataFrame]:
    """What has landed since the marks: partitions of later dates, and those of `again`, days that were re-run.

    The predicate is on the partition column alone, so no other folder is opened. A dataset without a mark is
    loaded whole.
    """
    day = F.col("ingested_date")
    tables = load_raw(spark, root, schemas)
    return {
        name: table.filter((day > F.lit(marks[name])) | day.isin(list(again))) if name in marks else table
        for name, table in tables.items()
    }


def high_water(tables: Mapping[str, DataFrame], marks: Mapping[str, dt.date] | None = None) -> dict[str, dt.date]:
    """The last date of each dataset, from its partition column alone; a dataset without rows keeps its mark."""
    last = {name: table.agg(F.max("ingested_date")).first()[0] for name, table in tables.items()}
    return {**(marks or {}), **{name: day for name, day in last.items() if day is not None}}


def write_marks(spark: SparkSession, root: str, marks: Mapping[str, dt.date]) -> None:
    """Keep the marks beside the datasets; the newest version counts."""
    version = max((row.version for row in _marks(spark, root)), default=0) + 1
    rows = [(version, name, day) for name, day in marks.items()]
    folder = f"{root}/marks/{version:09d}"
    spark.createDataFrame(rows, MARKS).coalesce(1).write.mode("error").json(folder)


def read_marks(spark: SparkSession, root: str) -> dict[str, dt.date]:
    rows = _marks(spark, root)
    newest = max((row.version for row in rows), default=0)
    return {row.dataset: row.day for row in rows if row.version == newest}


def _marks(spark: SparkSession, root: str) -> list:
    try:
        return spark.read.schema(MARKS).json(f"{root}/marks/*").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def row_counts(tables: Mapping[str, DataFrame], label: str = "dataset") -> DataFrame:
    """One (name, n) row per table."""
    counts = [
        table.agg(F.count("*").alias("n")).select(F.lit(name).alias(label), "n")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
