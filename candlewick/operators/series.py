"""Row frames over per-key time series of any length.

A plain `Window.partitionBy(symbol)` puts a whole series into one task. That is right for
daily bars: a (symbol, day) grain holds at most one row per calendar day. For finer
data a single symbol can hold a third of the table, so `over_series` cuts the globally
sorted rows into equal blocks instead. Each block also receives copies of the few rows
around it that its frames reach, so every value equals that of the unsplit window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewick.sources.storage import stored

BLOCK_ROWS = 262_144
# monotonically_increasing_id() numbers the rows of a partition in its low 33 bits.
ROW_NUMBER_MASK = (1 << 33) - 1


def over_series(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    *,
    before: int,
    after: int = 0,
    daily: bool = False,
    block_rows: int | None = None,
    number: str | None = None,
) -> DataFrame:
    """Apply `build(df, window)` to each key's rows in `order`.

    `build` adds columns whose frames reach at most `before` rows back and `after` rows
    ahead in total. (key, order) must identify a row. `daily=True` states that `order` is a
    calendar day, which bounds a series; otherwise the blocked plan is used. That plan
    writes its input once, so hand it the needed columns only. `number` names a column for the
    place of a row in its series, from 0. `block_rows` is for tests of the borders.
    """
    block_rows = block_rows or BLOCK_ROWS
    if daily:
        whole = Window.partitionBy(*key).orderBy(*order)
        if number:
            df = df.withColumn(number, F.row_number().over(whole) - 1)
        return build(df, whole)
    rows = sorted_rows(df, key, order)
    if number:
        starts = rows.groupBy(*key).agg(F.min("_row").alias("_first"))
        rows = rows.join(starts, list(key)).withColumn(number, (F.col("_row") - F.col("_first")).cast("int"))
        rows = rows.drop("_first")
    blocks = overlapping_blocks(rows, before, after, block_rows)
    window = Window.partitionBy("_block", *key).orderBy("_row")
    return (
        build(blocks, window)
        .filter(F.col("_block") == F.col("_home"))
        .drop("_block", "_home", "_row")
    )


def overlapping_blocks(
    rows: DataFrame, before: int, after: int = 0, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Numbered rows assigned to blocks of `block_rows`, with copies in the blocks they reach.

    `_home` is the block a row belongs to, `_block` the one it is copied into.
    """
    if before + after >= block_rows:
        raise ValueError("frames must be shorter than a block")
    home = F.floor(F.col("_row") / block_rows)
    offset = F.col("_row") % block_rows
    blocks = F.array_compact(
        F.array(
            home,
            F.when(offset >= block_rows - before, home + 1),
            F.when(offset < after, home - 1),
        )
    )
    return rows.withColumn("_home", home).withColumn("_block", F.explode(blocks))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Partition by key over all shuffle partitions, for groups that cost much more time than bytes.

    AQE would otherwise merge partitions by their size and line such groups up in few tasks.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *key)


def sorted_rows(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Number all rows 0.. in (key, order) as `_row`, whatever the skew.

    Range partitioning splits long series between tasks. The sorted rows are written once
    because each run of the sort may draw other partition borders. The border table has
    one row per written partition, never per input row, so it is safe to broadcast.
    """
    partition, position = F.spark_partition_id(), F.monotonically_increasing_id()
    table = stored(
        df.repartitionByRange(*key, *order)
        .sortWithinPartitions(*key, *order)
        .withColumns({"_part": partition, "_row": position.bitwiseAND(ROW_NUMBER_MASK)}),
        "sorted",
    )
    preceding = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        table.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(preceding), F.lit(0)).alias("_start"))
    )
    return (
        table.join(F.broadcast(borders), "_part")
        .withColumn("_row", F.col("_row") + F.col("_start"))
        .drop("_part", "_start")
    )
