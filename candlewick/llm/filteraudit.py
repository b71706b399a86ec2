"""How filters of documents overlap, audited by an incremental stream.

The files of the table pass as micro-batches of a stream that ends when all are read. Four filters look
at a document alone; the fifth fails every document whose text has a smaller id elsewhere, in this batch
or in any other. The state of the stream therefore keeps, for every text, the smallest id so far and what
that document counts for, a few texts to a key. When a smaller id arrives, the earlier document is retracted from the counter of
its old mask and counted under its new one. A mask has one bit for each filter that a document fails;
everything the audit reports follows from how many documents of a part have which mask.

Copies meet no more than once a task: before the shuffle to the state each task keeps of a text only the rows
with its smallest id, and settles the rest as sums, since those have lost whatever comes. The state, the
progress and the counters are files below the shared folder, so lost executors and restarts count nothing
twice.

Rows: a null text is empty, a null lang the part ''. A null id is smaller than none and none is smaller than
it, so such a row never fails the fifth filter nor makes others fail. Rows that repeat id and text are
documents of their own; none of them is smaller than the other. A document is labelled if any row of the labels says
so. No documents give no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from candlewick.sources.storage import fresh_path, stored

FILTERS = "ABCDE"
ORDERS = factorial(len(FILTERS))
#: Bit of the filter that compares documents with each other.
COPY = 16
#: Texts a task holds before it hands them on; only bounds memory.
TEXTS = 200_000
#: Bytes of files in a micro-batch, for each core of the cluster.
BYTES_PER_CORE = 64 << 20

#: Texts that share a key of the state, on average. A call costs more than a row; far fewer texts than this arrive
#: at a key in one batch of a large table, so what is written per batch stays in proportion to the batch.
TEXTS_PER_KEY = 128

CELL = "part string, mask int, good boolean, toxic boolean, n long"
#: `fate`: 0 holds the smallest id so far, 1 has lost to a smaller id, 2 has no id.
CLAIM = f"digest binary, fate int, id long, {CELL}"
#: For each text of a key its smallest id and the documents that have it, a place for each kind of them.
HELD = (
    "digests array<binary>, ids array<long>, parts array<string>, goods array<boolean>, toxics array<boolean>, "
    "counts array<long>"
)


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    fails = (
        n < 100,
        100 * distinct < 80 * n,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0)).cast("int")


def flags(labels: DataFrame) -> DataFrame:
    """One row for each document that is labelled good or toxic."""
    good, toxic = F.col("quality") == 1, F.col("toxic") == 1
    return (
        labels.filter("doc_id IS NOT NULL")
        .filter(good | toxic)
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max(F.coalesce(good, F.lit(False))).alias("good"), F.max(F.coalesce(toxic, F.lit(False))).alias("toxic"))
    )


def _facts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    id = F.col("doc_id").cast("long")
    return docs.select(
        digest.alias("digest"),
        id.alias("id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        own_mask(text).alias("mask"),
        # Rows without an id have no labels; they are spread by their text instead of meeting in one task.
        F.coalesce(id, F.xxhash64(digest)).alias("spread"),
        F.when(id.isNull(), 1).otherwise(0).alias("no_id"),
    )


def _arrow(schema: str) -> pa.Schema:
    kinds = {"binary": pa.binary(), "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def claims(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the rows with the smallest id of this task; all others as sums."""
    schema = _arrow(CLAIM)
    best: dict[bytes, tuple] = {}
    held: dict[tuple, int] = defaultdict(int)  # of the smallest ids
    settled: dict[tuple, int] = defaultdict(int)

    def flush() -> pa.RecordBatch:
        rows = [(d, 0, best[d], *cell, n) for (d, *cell), n in held.items()]
        rows += [(d, fate, None, *cell, n) for (d, fate, *cell), n in settled.items()]
        for table in (best, held, settled):
            table.clear()
        return _batch(rows, schema)

    cells: dict[bytes, set] = defaultdict(set)
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("digest", "id", "part", "mask", "good", "toxic")]
        for digest, id, *cell in zip(*columns, strict=True):
            cell = tuple(cell)
            if id is None:
                settled[(digest, 2, *cell)] += 1
                continue
            smallest = best.get(digest)
            if smallest is not None and id > smallest:
                settled[(digest, 1, *cell)] += 1
                continue
            if smallest is not None and id < smallest:
                for old in cells.pop(digest):
                    settled[(digest, 1, *old)] += held.pop((digest, *old))
            best[digest] = id
            held[(digest, *cell)] += 1
            cells[digest].add(cell)
        if len(best) + len(settled) > TEXTS:
            yield flush()
            cells.clear()
    yield flush()


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What the rows of a few texts change in the counters; the state has each text's smallest id and its holders."""
    holder: dict[bytes, int] = {}
    held: dict[bytes, dict[tuple, int]] = defaultdict(dict)
    if state.exists:
        for digest, id, *cell, n in zip(*state.get, strict=True):
            digest = bytes(digest)
            holder[digest] = id
            held[digest][tuple(cell)] = n
    change: dict[tuple, int] = defaultdict(int)
    moved = False
    for frame in frames:
        columns = [frame[c].tolist() for c in ("digest", "fate", "id", "part", "mask", "good", "toxic", "n")]
        for digest, fate, id, part, mask, good, toxic, n in zip(*columns, strict=True):
            cell = (part, good, toxic)
            if fate == 2:
                change[mask, cell] += n
                continue
            smallest = holder.get(digest)
            if fate == 1 or (smallest is not None and id > smallest):
                change[mask | COPY, cell] += n
                continue
            if smallest is not None and id < smallest:
                for old, count in held.pop(digest).items():
                    change[mask, old] -= count
                    change[mask | COPY, old] += count
            moved = True
            holder[digest] = int(id)
            held[digest][cell] = held[digest].get(cell, 0) + n
            change[mask, cell] += n
    if moved:
        rows = [(d, holder[d], *cell, n) for d, cells in held.items() for cell, n in cells.items()]
        state.update(tuple(map(list, zip(*rows, strict=True))))
    rows = [(part, mask, good, toxic, n) for (mask, (part, good, toxic)), n in change.items() if n]
    yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of the changes of one task, a row for each counter they touch."""
    schema = _arrow(CELL)
    total: dict[tuple, int] = defaultdict(int)
    for batch in batches:
        for *cell, n in zip(*(batch.column(f.name).to_pylist() for f in schema), strict=True):
            total[tuple(cell)] += n
    yield _batch([(*cell, n) for cell, n in total.items() if n], schema)


def counters(spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Documents of each part, mask and pair of labels, from the file or all files of the folder `path`."""
    table = spark.read.parquet(path)
    schema, keys = table.schema, table.count() // TEXTS_PER_KEY + 1
    known = stored(flags(labels), "audit-labels")
    sink, progress = fresh_path(spark, "audit-changes"), fresh_path(spark, "audit-progress")
    root = path.rstrip("/")
    docs = (
        spark.readStream.schema(schema)
        .option("maxBytesPerTrigger", batch_bytes or BYTES_PER_CORE * spark.sparkContext.defaultParallelism)
        # A pattern that only the path itself meets: a stream takes a plain path for a folder, a pattern for either.
        .parquet(f"{root[:-1]}[{root[-1]}]")
    )
    facts = _facts(docs)
    met = (
        facts.join(known, (facts.spread == known.labelled) & (facts.no_id == 0), "left")
        .withColumn("good", F.coalesce("good", F.lit(False)))
        .withColumn("toxic", F.coalesce("toxic", F.lit(False)))
        .select("digest", "id", "part", "mask", "good", "toxic")
    )
    changes = (
        met.mapInArrow(claims, CLAIM)
        .withColumn("key", F.pmod(F.xxhash64("digest"), F.lit(keys)))
        .groupBy("key")
        .applyInPandasWithState(retract, CELL, HELD, "append", GroupStateTimeout.NoTimeout)
        .mapInArrow(tally, CELL)
    )
    query = (
        changes.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return (
        spark.read.schema(CELL)
        .parquet(sink)
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
        .filter("n <> 0")
    )


def _sum(cells: Column, keep, value: str) -> Column:
    return F.aggregate(F.filter(cells, keep), F.lit(0).cast("long"), lambda total, c: total + c[value])


def audit(counted: DataFrame) -> DataFrame:
    """For each part, order and step, what the filter of that step does there."""
    n = F.col("n")
    cells = (
        counted.groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("good"), n).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), n).otherwise(0)).alias("toxic"),
        )
        .groupBy("part")
        .agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 masks at most
    )
    orders = ",".join(map("".join, permutations(FILTERS)))
    bits = F.expr("transform(split(filter_order, ''), x -> shiftleft(1, ascii(x) - 65))")
    steps = (
        cells.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("bit", bits[F.col("step") - 1])
        .withColumn("earlier", F.aggregate(F.slice(bits, F.lit(1), F.col("step") - 1), F.lit(0), lambda m, x: m + x))
    )
    all_cells, bit, earlier = F.col("cells"), F.col("bit"), F.col("earlier")

    def fails(c, mask):
        return c["mask"].bitwiseAND(mask) != 0

    def here(c):
        return fails(c, bit) & ~fails(c, earlier)

    first = F.aggregate(  # among k failing filters, each is the first in one of k orders
        F.filter(all_cells, lambda c: fails(c, bit)),
        F.lit(0).cast("long"),
        lambda total, c: total + c["n"] * (F.lit(ORDERS) / F.bit_count(c["mask"])).cast("long"),
    )
    return steps.select(
        "part",
        "filter_order",
        F.col("step").cast("int").alias("step"),
        _sum(all_cells, lambda c: ~fails(c, bit.bitwiseOR(earlier)), "n").alias("kept"),
        _sum(all_cells, here, "n").alias("removed"),
        _sum(all_cells, lambda c: fails(c, bit) & fails(c, earlier), "n").alias("redundant"),
        _sum(all_cells, lambda c: c["mask"] == bit, "n").alias("unique_fails"),
        _sum(all_cells, here, "good").alias("good_lost"),
        _sum(all_cells, here, "toxic").alias("toxic_lost"),
        first.alias("shapley"),
    )


def filter_audit(spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Audit of the five filters over all files below `path`, in every order."""
    return audit(counters(spark, path, labels, batch_bytes))
