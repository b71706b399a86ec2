"""Tables laid out by key, which later joins on that key read without a shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from candlewick.sources.storage import fresh_path


def write_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write the rows as a table of `buckets` files, one for each part of the keys, sorted by key.

    The table is registered under a name of its own; its files lie in `path` or in the shared folder.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, *keys)
        .write.bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path or fresh_path(spark, name))
        .format("parquet")
        .saveAsTable(name)
    )
    return spark.table(name)
