"""Versioned snapshots of the marts with accumulated history.

A version lists, for each mart, its data files with the least and greatest value of every key column. Files never
change. They hold ranges of one slice (a month of days, say), so a fresh batch meets few of them: an export
rewrites these and carries the names of all others over, and a reader of one symbol opens only files that may hold it.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.keyed import merge_fresh_wins
from candlewick.operators.series import ROW_NUMBER_MASK
from candlewick.sources.storage import stored

# Natural key of each mart (fixed values).
MART_KEYS = {
    "mart_daily_ohlcv": ("symbol", "trade_date"),
    "mart_market_overview": ("snapshot_date",),
}
#: What a file may hold of a mart: rows of one value of the expression. Marts without one have one slice.
MART_SLICES = {
    "mart_daily_ohlcv": "trunc(trade_date, 'MM')",
    "mart_market_overview": "trunc(snapshot_date, 'YEAR')",
}
MANIFEST = "version bigint, mart string, files string, rows bigint"
#: Rows of a file; bounds what an export rewrites for one fresh row.
FILE_ROWS = 1 << 20
SLICE = "_slice"
#: Files of one export that are opened by their names.
NAMED_FILES = 32


def export_snapshot(
    marts: Mapping[str, DataFrame],
    root: str,
    keys: Mapping[str, Sequence[str]] = MART_KEYS,
    slices: Mapping[str, str] = MART_SLICES,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """Merge each mart with the current snapshot and publish the result as a new version.

    Only files of the current version whose key ranges meet those of the fresh rows are read and replaced; all
    others belong to the new version as they are. Marts that are not exported stay too. Returns (mart, rows).
    """
    spark = next(iter(marts.values())).sparkSession
    current = {row.mart: row for row in _current(spark, root)}
    lists = {}
    for mart, fresh in marts.items():
        natural, part = keys[mart], slices.get(mart)
        if mart not in current:
            lists[mart] = _written(fresh, f"{root}/marts/{mart}", natural, part, file_rows)
            continue
        rows, boxes = _boxed(fresh, natural, part, file_rows)
        old = spark.read.parquet(current[mart].files)
        met = stored(_meeting(old, boxes, natural), "touched")
        touched = [row.path for row in met.collect()]
        if touched:
            rows = merge_fresh_wins(rows, _read(spark, touched, fresh.schema), natural)
        new = _written(rows, f"{root}/marts/{mart}", natural, part, file_rows)
        lists[mart] = old.join(met, "path", "left_anti").unionByName(new)
    return _commit(spark, root, lists, current).select("mart", "rows")


def publish(
    marts: Mapping[str, DataFrame],
    root: str,
    keys: Mapping[str, Sequence[str]] = MART_KEYS,
    slices: Mapping[str, str] = MART_SLICES,
    *,
    carry: bool = False,
    file_rows: int = FILE_ROWS,
) -> DataFrame:
    """Write the marts as a new version; returns its manifest rows for them.

    Files of older versions are only read. Readers follow the manifest, whose commit is the last step,
    so they see the old version or the whole new one. With `carry`, other marts of the last version stay.
    """
    spark = next(iter(marts.values())).sparkSession
    current = {row.mart: row for row in _current(spark, root)}
    lists = {
        mart: _written(df, f"{root}/marts/{mart}", keys[mart], slices.get(mart), file_rows) for mart, df in marts.items()
    }
    return _commit(spark, root, lists, current, carry)


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts of the newest published version."""
    return {row.mart: _opened(spark, row, None) for row in _current(spark, root)}


def read_mart(spark: SparkSession, root: str, mart: str, **equal: object) -> DataFrame:
    """One mart of the newest version; with `column=value` of its key, only those rows, from files that may hold them."""
    for row in _current(spark, root):
        if row.mart == mart:
            where = [F.lit(value).between(F.col(f"low_{name}"), F.col(f"high_{name}")) for name, value in equal.items()]
            found = _opened(spark, row, where)
            return reduce(lambda df, item: df.filter(F.col(item[0]) == F.lit(item[1])), equal.items(), found)
    raise KeyError(mart)


def files_of(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """(path, rows, low and high of each key column) of every file of a mart in the newest version."""
    return spark.read.parquet(next(row.files for row in _current(spark, root) if row.mart == mart))


def extent(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """Rows and least and greatest value of each key column of a mart, from its list of files alone."""
    files = files_of(spark, root, mart)
    ends = [(F.min if c.startswith("low_") else F.max)(c).alias(c) for c in files.columns if c[:4] in ("low_", "high")]
    return files.agg(F.sum("rows").alias("rows"), *ends)


def _opened(spark: SparkSession, row, where: Sequence[Column] | None) -> DataFrame:
    files = spark.read.parquet(row.files)
    chosen = reduce(DataFrame.filter, where or [], files)
    paths = [r.path for r in chosen.select("path").collect()]
    if not paths:  # no file may hold such rows: any one tells the columns
        return spark.read.parquet(files.first().path).limit(0)
    return _read(spark, paths)


def _read(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of files of a mart.

    Spark looks up named files one by one, in a task each. Where many of an export's files are wanted it lists their
    folder instead, and if that holds others too, as when later exports replaced some, takes the rows of the wanted.
    """
    schema = schema or spark.read.parquet(paths[0]).schema
    groups = defaultdict(list)
    for path in paths:
        groups[path.rpartition(f"/{SLICE}=")[0]].append(path)
    single, parts = [], []
    for folder, wanted in groups.items():
        found = None
        if folder and len(wanted) > NAMED_FILES:
            whole = spark.read.schema(T.StructType([*schema, T.StructField(SLICE, T.StringType())])).parquet(folder)
            present = len(whole.inputFiles())
            if present == len(wanted):
                found = whole
            elif present < 2 * len(wanted):
                names = spark.createDataFrame([(path,) for path in wanted], "_path string")
                found = whole.join(names, _file_path() == F.col("_path"), "left_semi")
        if found is None:
            single += wanted
        else:
            parts.append(found.select(*schema.names))
    if single:
        parts.append(spark.read.schema(schema).parquet(*single))
    return reduce(DataFrame.unionByName, parts)


def _boxed(df: DataFrame, keys: Sequence[str], part: str | None, file_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows, written once, and the ranges of the files that they would make, without making these."""
    order = [SLICE, *keys]
    number = F.monotonically_increasing_id()
    # Sorting by range reads its input twice.
    table = stored(
        stored(df.withColumn(SLICE, F.expr(part or "'all'").cast("string")), "fresh")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({"_part": F.spark_partition_id(), "_box": F.floor(number.bitwiseAND(ROW_NUMBER_MASK) / file_rows)}),
        "fresh",
    )
    boxes = table.groupBy("_part", "_box", SLICE).agg(*_ranges(keys))
    return table.select(*df.columns), boxes


def _file_path() -> Column:
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _ranges(keys: Sequence[str]) -> list[Column]:
    return [pick(name).alias(f"{side}_{name}") for name in keys for side, pick in (("low", F.min), ("high", F.max))]


def _written(df: DataFrame, folder: str, keys: Sequence[str], part: str | None, file_rows: int) -> DataFrame:
    """Write rows in files of one slice each, sorted by key; returns the list of files with their ranges.

    Without rows there is one empty file, which tells the columns.
    """
    spark, path = df.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    order = [SLICE, *keys]
    (
        # Sorting by range reads its input twice.
        stored(df.withColumn(SLICE, F.expr(part or "'all'").cast("string")), "mart")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("maxRecordsPerFile", file_rows)
        .partitionBy(SLICE)
        .parquet(f"{path}/data")
    )
    schema = df.select("*", F.lit("").alias(SLICE)).schema
    lists = (
        spark.read.schema(schema)
        .parquet(f"{path}/data")
        .groupBy(_file_path().alias("path"), SLICE)
        .agg(F.count("*").alias("rows"), *_ranges(keys))
    )
    lists.coalesce(1).write.parquet(f"{path}/files")
    listed = spark.read.schema(lists.schema).parquet(f"{path}/files")
    if listed.isEmpty():
        df.limit(0).coalesce(1).write.parquet(f"{path}/empty")
        names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/empty")
        nothing = names.select(F.col("path"), F.lit("").alias(SLICE), F.lit(0).cast("long").alias("rows"))
        bounds = [F.lit(None).cast(lists.schema[f.name].dataType).alias(f.name) for f in lists.schema[3:]]
        nothing.select("*", *bounds).write.mode("append").parquet(f"{path}/files")
        listed = spark.read.schema(lists.schema).parquet(f"{path}/files")
    return listed


def _meeting(old: DataFrame, fresh: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(path) of old files whose range of every key column meets that of a fresh file of the same slice.

    Rows with a NULL in their key are never replaced, so ranges without them suffice.
    """
    other = fresh.select(
        F.col(SLICE).alias("_of"), *[F.col(f"{s}_{k}").alias(f"_{s}_{k}") for k in keys for s in ("low", "high")]
    )
    on = F.col(SLICE).eqNullSafe(F.col("_of"))
    for key in keys:
        on = on & (F.col(f"low_{key}") <= F.col(f"_high_{key}")) & (F.col(f"high_{key}") >= F.col(f"_low_{key}"))
    return old.join(other, on, "left_semi").select("path")


def _commit(
    spark: SparkSession, root: str, lists: Mapping[str, DataFrame], current: Mapping, carry: bool = True
) -> DataFrame:
    """Write the lists of files, then the manifest of the new version; its rows for the given marts."""
    version = max((row.version for row in current.values()), default=0) + 1
    entries = []
    for mart, listed in lists.items():
        path = f"{root}/files/{mart}/{uuid.uuid4().hex}"
        listed.coalesce(1).write.parquet(path)
        rows = spark.read.schema(listed.schema).parquet(path).agg(F.sum("rows").alias("n")).first().n
        entries.append((version, mart, path, rows))
    if carry:
        entries += [(version, row.mart, row.files, row.rows) for row in current.values() if row.mart not in lists]
    # One folder a version: of two exports at once, one finds its folder taken and fails.
    folder = f"{root}/manifest/{version:09d}"
    spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("error").json(folder)
    return spark.read.schema(MANIFEST).json(folder).filter(F.col("mart").isin(list(lists)))


def _current(spark: SparkSession, root: str) -> list:
    """Manifest rows of the newest version: one per mart, empty before the first export."""
    try:
        manifest = spark.read.schema(MANIFEST).json(f"{root}/manifest/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    last = manifest.agg(F.max("version").alias("version"))
    return manifest.join(last, "version").select("mart", "version", "files", "rows").collect()
