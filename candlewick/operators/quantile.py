"""Exact quantiles of a whole column by radix selection, without sorting it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.storage import stored

#: Bits that one pass looks at; 64 in all.
DIGIT = 16
LARGEST = (1 << 63) - 1


def _ordered_bits(value: Column) -> Column:
    """A long that orders like the double: NaN last, both zeros equal."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + 0.0).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(LARGEST))).otherwise(bits)


def _double(bits: Column) -> Column:
    plain = F.when(bits < 0, bits.bitwiseXOR(F.lit(LARGEST))).otherwise(bits)
    return F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), plain).cast("double")


def exact_quantiles(df: DataFrame, column: str, qs: Sequence[float]) -> list[float | None]:
    """Linearly interpolated quantiles of the non-null values of `column`; None if there are none."""
    value = F.col(column).cast("double")
    rows = stored(df.filter(value.isNotNull()).select(_ordered_bits(value).alias("bits")), "ordered-bits")
    size = rows.count()
    if size == 0:
        return [None] * len(qs)
    places = [(size - 1) * q for q in qs]
    ranks = {r for p in places for r in (math.floor(p), min(math.floor(p) + 1, size - 1))}
    found = order_statistics(rows, ranks)
    out = []
    for place in places:
        low = math.floor(place)
        first, second = found[low], found[min(low + 1, size - 1)]
        out.append(first if place == low or first == second else first + (place - low) * (second - first))
    return out


def exact_quantile(df: DataFrame, column: str, q: float) -> float | None:
    return exact_quantiles(df, column, [q])[0]


def order_statistics(rows: DataFrame, ranks: set[int]) -> dict[int, float]:
    """Values at 0-based ranks among the ordered `bits`, however many and however many ties they have.

    Every pass counts the rows by their next DIGIT bits among those that share all bits so far with a rank, which
    are at most 2^DIGIT counts for each different prefix, and keeps the digit whose rows hold the rank. The passes
    are the same four for any number of ranks and rows; the driver holds the ranks and their prefixes.
    """
    # prefix so far -> ranks within the rows of that prefix, by the rank asked for
    inside: dict[int | None, dict[int, int]] = {None: {r: r for r in ranks}}
    for shift in range(64 - DIGIT, -1, -DIGIT):
        bits = F.col("bits")
        prefix = F.shiftright(bits, shift + DIGIT) if shift + DIGIT < 64 else F.lit(None).cast("long")
        some = rows if None in inside else rows.filter(prefix.isin(list(inside)))
        before = F.coalesce(
            F.sum("n").over(Window.partitionBy("prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        )
        counts = (
            some.groupBy(prefix.alias("prefix"), F.shiftright(bits, shift).alias("digit"))
            .agg(F.count("*").alias("n"))
            .withColumn("before", before)
        )
        holds = [
            F.col("prefix").eqNullSafe(F.lit(p)) & (F.col("before") <= r) & (F.col("before") + F.col("n") > r)
            for p, asked in inside.items()
            for r in set(asked.values())
        ]
        hits = counts.filter(reduce(or_, holds)).collect()
        inside = {
            row.digit: {
                asked: r - row.before
                for asked, r in inside[row.prefix].items()
                if row.before <= r < row.before + row.n
            }
            for row in hits
        }
    spark = rows.sparkSession
    values = spark.createDataFrame([(b,) for b in inside], "bits long").select("bits", _double(F.col("bits")).alias("v"))
    by_bits = dict(map(tuple, values.collect()))
    return {asked: by_bits[b] for b, of in inside.items() for asked in of}
