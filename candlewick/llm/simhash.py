"""SimHash near-duplicates through deletion variants.

A fingerprint is cut into so few segments that, of two fingerprints within the distance, one segment
differs in at most one bit. Every segment is indexed once for each of its bits, with that bit masked.
Fingerprints meet by an equality join on these variants and are verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import among, bytes_of, sliced, without
from candlewick.llm.graph import components
from candlewick.sources.storage import stored

BITS = 64
SEED = 42
SLICE = 1 << 15  # shingles whose bits are counted at once


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits over the XXH64 values of a text's word shingles; no words give 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: n - 1] + 1)).tolist()
    ends = ends[shingle - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, dtype=np.int64)
    for low in range(0, n, SLICE):
        pairs = zip(starts[low : low + SLICE], ends[low : low + SLICE], strict=True)
        values = np.array([digest(joined[s:e], SEED) for s, e in pairs], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp) a row of `docs`; a null text counts as empty and has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            values = [fingerprint(t, shingle) for t in bytes_of(batch.column("text"))]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), fp], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the fewest segments of which one differs in at most one bit."""
    parts = distance // 2 + 1
    cuts = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def variants(fp: Column, distance: int) -> Column:
    """Array of index keys: one for every segment and every masked bit in it.

    The masked bit's number, which no other variant has, comes above the segment's bits.
    """
    keys = []
    for low, width in _segments(distance):
        segment = F.shiftrightunsigned(fp, low)
        for bit in range(width):
            mask = ((1 << width) - 1) & ~(1 << bit)
            kept = segment.bitwiseAND(F.lit(mask if mask < 1 << 63 else mask - (1 << 64)))
            # A segment with a masked bit has at most 63 bits; the number goes into a second column.
            keys.append(F.struct(F.lit(low + bit).cast("byte").alias("v"), kept.alias("s")))
    return F.array(*keys)


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _indexed(rows: DataFrame, distance: int) -> DataFrame:
    return rows.withColumn("key", F.explode(variants(F.col("fp"), distance))).select(
        "key.v", "key.s", *rows.columns
    )


def links(fps: DataFrame, distance: int) -> DataFrame:
    """Labels (fp, root) of all distinct fingerprints that are linked to another one.

    Two passes find every link without listing all pairs of a group. The first checks each member of a
    bucket against the least member and its neighbour in order, which is every pair of a bucket of up
    to three, and joins what it finds into components. The second takes the larger buckets: two members
    of one component need no further look, so the members outside the bucket's largest component are
    joined with all others.
    """
    order = Window.partitionBy("v", "s").orderBy("fp")
    first = (
        _indexed(fps.select("fp"), distance)
        .withColumn("n", F.row_number().over(order))
        .withColumn("least", F.first("fp").over(order))
        .withColumn("last", F.lag("fp").over(order))
        .filter("n > 1")
        .withColumn("to_least", _near("fp", "least", distance))
        .withColumn("to_last", _near("fp", "last", distance))
        .filter("to_least OR to_last OR n = 4")
    )
    first = stored(first, "simhash-first")
    edges = first.filter("to_least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    edges = edges.unionByName(
        first.filter("to_last AND NOT to_least").select(F.col("fp").alias("a"), F.col("last").alias("b"))
    )
    roots = stored(components(edges).select(F.col("node").alias("fp"), "root"), "simhash-roots")

    sizes = roots.groupBy("root").agg(F.count("*").alias("size"))
    known = roots.join(sizes, "root").select("fp", "root", "size")
    labelled = fps.select("fp").join(known, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("size", F.lit(1)).alias("size")
    )
    large = first.filter("n = 4").select("v", "s")
    # Most buckets are small: a filter of fixed size keeps their rows out of this pass's shuffle.
    members = stored(among(_indexed(labelled, distance), large, "v", "s"), "simhash-large")
    main = members.groupBy("v", "s").agg(
        F.max(F.struct("size", "root"))["root"].alias("main"),
        (F.min("root") < F.max("root")).alias("mixed"),
    )
    outside = members.join(main.filter("mixed"), ["v", "s"]).filter("root <> main")
    outside = outside.select("v", "s", F.col("fp").alias("a"), F.col("root").alias("root_a"))
    every = members.select("v", "s", F.col("fp").alias("b"), F.col("root").alias("root_b"))
    more = outside.join(
        every,
        (outside.v == every.v)
        & (outside.s == every.s)
        & (F.col("root_a") != F.col("root_b"))
        & _near("a", "b", distance),
    ).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    joined = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    joined = stored(joined, "simhash-joined")
    old = roots.join(joined, "root", "left").select("fp", F.coalesce("top", "root").alias("root"))
    # A fingerprint that the first pass left alone is its own root.
    new = joined.join(roots, joined.root == roots.fp, "left_anti").select(
        F.col("root").alias("fp"), F.col("top").alias("root")
    )
    return old.unionByName(new)


def simhash_components(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) a row of `docs` (doc_id, text, any other columns).

    component_id is the smallest doc_id in the component. Repeated rows and rows that share a doc_id are
    rows of their own. Null and empty texts have fingerprint 0 and are linked like any other. A null
    doc_id is never smallest; a component without any other has component_id null. No rows give no rows.
    """
    marked = stored(fingerprints(docs, shingle), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = stored(links(distinct, distance), "simhash-links")
    top = distinct.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    smallest = top.groupBy("root").agg(F.min("least_id").alias("component_id"))
    smallest = top.join(smallest, "root").select("fp", "component_id")
    return marked.join(smallest, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """`docs` with one document of each component: that with the smallest doc_id.

    Of rows that repeat this doc_id one stays. Rows without doc_id can't be told apart and all stay.
    """
    found = stored(simhash_components(docs, shingle, distance), "simhash-components")
    known = found.filter("doc_id IS NOT NULL")
    gone = known.filter("doc_id <> component_id").select("doc_id").distinct()
    again = known.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    # A doc_id on several rows may be smallest in one component and not in another.
    again = stored(again, "simhash-repeated")
    gone = stored(gone.join(again, "doc_id", "left_anti"), "simhash-gone")
    single = without(without(docs, gone, "doc_id"), again, "doc_id")
    repeated = among(docs, again, "doc_id")
    best = known.filter("doc_id = component_id").select("doc_id").distinct()
    # Which of the rows of such a doc_id stays is settled by its text.
    kept = repeated.join(best, "doc_id", "left_semi").withColumn(
        "_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    )
    return single.unionByName(kept.filter("_n = 1").select(*docs.columns))
