"""Declarative data tests: each returns the failing rows; a pass is an empty frame."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.storage import stored


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is set but not above zero."""
    return df.filter(F.col(column).isNotNull() & (F.col(column) <= 0))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row, with their row count."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


#: Bits of a partition's key filter.
FILTER_BITS = 1 << 23


def key_filters(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, bucket, bits): for every partition a filter of fixed size of the keys that it holds."""
    slot = _slot(columns)
    return df.groupBy(F.col(by).alias(by), F.bitmap_bucket_number(slot).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")
    )


def unique_since(
    new: DataFrame, history: DataFrame, filters: DataFrame, columns: Sequence[str], by: str
) -> DataFrame:
    """`unique` of new and old rows together, for a history that is unique and has its `key_filters`.

    A new key is held against the filter of every old partition, which is a megabyte whatever the partition's size;
    rows of history are read only in partitions that may have it, and compared by the key itself. A key that occurs in
    history is reported with the rows of both.
    """
    keys = [f"_k{i}" for i in range(len(columns))]
    counted = new.groupBy(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)]).agg(F.count("*").alias("_n"))
    counted = stored(counted, "new-keys")
    slot = _slot(keys)
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", F.expr("cast(_place div 8 AS int)") + 1, F.lit(1))), 16, 10).cast("int")
    asked = counted.withColumns({"bucket": F.bitmap_bucket_number(slot), "_place": place})
    maybe = asked.join(filters, "bucket").filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 AS int))")) != 0)
    maybe = stored(maybe.select(F.col(by).alias("_by"), *keys), "maybe-old")
    # Each partition with a candidate once; the filter on it prunes the folders of all others.
    parts = [row[0] for row in maybe.select("_by").distinct().collect()]
    same = F.col(by).eqNullSafe(F.col("_by"))
    for c, k in zip(columns, keys, strict=True):
        same = same & F.col(c).eqNullSafe(F.col(k))
    within = F.col(by).isin([v for v in parts if v is not None])
    old = history.filter(within | F.col(by).isNull() if None in parts else within)
    met = old.select(by, *columns).join(maybe, same).groupBy(*keys).agg(F.count("*").alias("_m"))
    met = met.select(*[F.col(k).alias(f"_o{k}") for k in keys], "_m")
    on = reduce(lambda a, k: a & F.col(k).eqNullSafe(F.col(f"_o{k}")), keys, F.lit(True))
    n = F.col("_n") + F.coalesce("_m", F.lit(0))
    failing = counted.join(met, on, "left").filter(n > 1)
    return failing.select(*[F.col(k).alias(c) for c, k in zip(columns, keys, strict=True)], n.alias("n"))


def _slot(columns: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(FILTER_BITS))


def result_of(model: str, test: str, column: str, failing: DataFrame) -> DataFrame:
    """One (model, test, column, failures) row for a test."""
    return failing.agg(F.count("*").alias("failures")).select(
        F.lit(model).alias("model"),
        F.lit(test).alias("test"),
        F.lit(column).alias("column"),
        "failures",
    )


def column_tests(
    df: DataFrame, model: str, no_nulls: Sequence[str] = (), positive: Sequence[str] = ()
) -> DataFrame:
    """Results of several column tests of one model from a single scan."""
    tests = [("not_null", name, F.col(name).isNull()) for name in no_nulls]
    tests += [
        ("positive_value", name, F.col(name).isNotNull() & (F.col(name) <= 0))
        for name in positive
    ]
    counts = df.agg(
        *[F.count_if(failed).alias(f"t{i}") for i, (_, _, failed) in enumerate(tests)]
    )
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(test).alias("test"),
            F.lit(column).alias("column"),
            F.col(f"t{i}").alias("failures"),
        )
        for i, (test, column, _) in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*rows)))


def all_results(results: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
