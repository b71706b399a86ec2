"""Exact top-k search, a block of documents at a time.

Vectors are cut into ranges of blocks. Every block keeps the largest and smallest value of each term, a
component taken with its sign; for a query the sum of the better ones bounds each score in the block.
Blocks are scored through their forward index in the order of their bounds until the next bound falls below
the query's kth score.

The kth score of a query begins with the range that its own vector lies in. Against it, first groups of ranges and
then their ranges are bounded, and only what may still hold a better vector is written down. Of these ranges
each query visits those with the highest bounds first; the others are read only if their bounds reach the kth
score that it has by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.sources.storage import stored

SCALE = 1024
RANGE = 4096  # vectors in a range
BLOCK = 64  # vectors in a block
QUERIES = 256  # queries handled together
BOXES = 64  # ranges bounded together
FIRST = 8  # ranges of a query that are read before the kth score is looked at again
SALTS = 64  # parts of the query groups, each of which meets every group of ranges
SIGNS = 16  # leading components whose signs order the vectors
NONE = -(1 << 63)


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): whole numbers, for vectors that take part."""
    broken = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(~broken)
    return rows.select(F.col("vec_id").cast("long"), whole.alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as the rows of a matrix; shorter ones end in zeros."""
    lists = column.to_pylist()
    out = np.zeros((len(lists), max(map(len, lists), default=0)), dtype=np.int64)
    for row, values in zip(out, lists, strict=True):
        row[: len(values)] = values
    return out


def _packed(name: str, number: int, ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
    columns = {
        name: pa.array([number], pa.int64()),
        "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
        "data": pa.array([matrix.astype("<i8").tobytes()], pa.binary()),
        "least": pa.array([matrix.min(axis=0).tolist()], pa.list_(pa.int64())),
        "most": pa.array([matrix.max(axis=0).tolist()], pa.list_(pa.int64())),
    }
    return pa.RecordBatch.from_pydict(columns)


def _bundles(rows: DataFrame, name: str, size: int) -> DataFrame:
    """`rows` (vec_id, v) in bundles of up to `size` neighbours: number, ids, data, least and most values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                part = batch.slice(low, size)
                ids = part.column("vec_id").to_numpy()
                yield _packed(name, number, ids, _matrix(part.column("v")))
                number += 1

    return rows.mapInArrow(
        run, f"{name} long, ids binary, data binary, least array<long>, most array<long>"
    )


def _unpacked(ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype="<i8")
    return ids, np.frombuffer(data, dtype="<i8").reshape(len(ids), -1)


def _alike(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same number of columns for both; zeros do not change an inner product."""
    wide = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (a, b))


def bounds(queries: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """(queries, blocks): the largest inner product that the blocks' extreme values allow."""
    return np.maximum(queries, 0) @ most.T + np.minimum(queries, 0) @ least.T


def best(
    query: np.ndarray, own: int, floor: int, bound: np.ndarray, ids: np.ndarray, data: np.ndarray, k: int, block: int
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best vectors of a range that reach `floor`, without the query's own.

    Blocks come in the order of their bounds; a bound equal to the kth score may still hide a smaller id.
    """
    top_ids = top = np.zeros(0, dtype=np.int64)
    for b in np.argsort(-bound, kind="stable"):
        if bound[b] < (max(floor, top[-1]) if len(top) == k else floor):
            break
        part = slice(b * block, (b + 1) * block)
        score = data[part] @ query
        some = (ids[part] != own) & (score >= floor)
        top_ids = np.concatenate((top_ids, ids[part][some]))
        top = np.concatenate((top, score[some]))
        order = np.lexsort((top_ids, -top))[:k]
        top_ids, top = top_ids[order], top[order]
    return top_ids, top


def _scored(pairs: DataFrame, queries: DataFrame, ranges: DataFrame, k: int) -> DataFrame:
    """(group, q, query_id, vec_id, score) for `pairs` (group, range, wanted: [(q, floor)])."""
    block = BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = {c: [] for c in ("group", "q", "query_id", "vec_id", "score")}
                query_ids, asked = _unpacked(row["q_ids"], row["q_data"])
                ids, data = _unpacked(row["ids"], row["data"])
                asked, data = _alike(asked, data)
                cut = np.arange(0, len(ids), block)
                least, most = np.minimum.reduceat(data, cut), np.maximum.reduceat(data, cut)
                wanted = [w["q"] for w in row["wanted"]]
                bound = bounds(asked[wanted], least, most)
                for w, limit in zip(row["wanted"], bound, strict=True):
                    q = w["q"]
                    found, score = best(asked[q], query_ids[q], w["floor"], limit, ids, data, k, block)
                    out["group"] += [row["group"]] * len(found)
                    out["q"] += [q] * len(found)
                    out["query_id"] += [int(query_ids[q])] * len(found)
                    out["vec_id"] += found.tolist()
                    out["score"] += score.tolist()
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=list(out))

    given = (
        pairs.join(queries.select("group", F.col("ids").alias("q_ids"), F.col("data").alias("q_data")), "group")
        .join(ranges.select("range", "ids", "data"), "range")
        .select("group", "wanted", "q_ids", "q_data", "ids", "data")
    )
    return given.mapInArrow(run, "group long, q int, query_id long, vec_id long, score long")


def _asked(ranges: DataFrame, every: int) -> DataFrame:
    """(range, vec_id, v) of the queries, with the range that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, data = _unpacked(row["ids"], row["data"])
                at = np.flatnonzero(ids % every == 0)
                yield pa.RecordBatch.from_pydict(
                    {
                        "range": pa.array(np.full(len(at), row["range"])),
                        "vec_id": pa.array(ids[at]),
                        "v": pa.array(data[at].tolist(), pa.list_(pa.int64())),
                    }
                )

    found = ranges.select("range", "ids", "data").mapInArrow(run, "range long, vec_id long, v array<long>")
    return found.dropDuplicates(["vec_id"])


def _grouped(asked: DataFrame) -> DataFrame:
    """Queries in bundles of neighbours: group, ids, data, homes (the range of each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for low in range(0, batch.num_rows, QUERIES):
                part = batch.slice(low, QUERIES)
                yield pa.RecordBatch.from_pydict(
                    {
                        "group": pa.array([number]),
                        "ids": pa.array([part.column("vec_id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                        "data": pa.array([_matrix(part.column("v")).astype("<i8").tobytes()], pa.binary()),
                        "homes": pa.array([part.column("range").to_pylist()], pa.list_(pa.int64())),
                    }
                )
                number += 1

    rows = asked.repartitionByRange("range", "vec_id").sortWithinPartitions("range", "vec_id")
    return rows.mapInArrow(run, "group long, ids binary, data binary, homes array<long>")


def _boxed(ranges: DataFrame) -> DataFrame:
    """Extreme values of neighbouring ranges together: boxes, ranges, least, most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BOXES):
                part = batch.slice(low, BOXES)
                least, most = _alike(_matrix(part.column("least")), _matrix(part.column("most")))
                yield pa.RecordBatch.from_pydict(
                    {
                        "ranges": pa.array([part.column("range").to_pylist()], pa.list_(pa.int64())),
                        "least": pa.array([least.astype("<i8").tobytes()], pa.binary()),
                        "most": pa.array([most.astype("<i8").tobytes()], pa.binary()),
                    }
                )

    rows = ranges.select("range", "least", "most").repartitionByRange("range").sortWithinPartitions("range")
    return rows.mapInArrow(run, "ranges array<long>, least binary, most binary")


def _hopeful(groups: DataFrame, boxes: DataFrame) -> DataFrame:
    """(group, range, q, bound) of queries and ranges, not their own, whose bound reaches the query's floor.

    Every group of queries meets the summary of every group of ranges; nothing is written of what falls short.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, data = _unpacked(row["ids"], row["data"])
                numbers = np.array(row["ranges"], dtype=np.int64)
                least, most = (np.frombuffer(row[c], dtype="<i8").reshape(len(numbers), -1) for c in ("least", "most"))
                wide, least = _alike(data, least)
                most = _alike(data, most)[1]
                floors, homes = np.array(row["floors"], dtype=np.int64), np.array(row["homes"], dtype=np.int64)
                outer = bounds(wide, least.min(axis=0, keepdims=True), most.max(axis=0, keepdims=True))[:, 0]
                alive = np.flatnonzero(outer >= floors)
                limit = bounds(wide[alive], least, most)
                q, r = np.nonzero((limit >= floors[alive][:, None]) & (numbers[None, :] != homes[alive][:, None]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "group": pa.array(np.full(len(q), row["group"])),
                        "range": pa.array(numbers[r]),
                        "q": pa.array(alive[q].astype(np.int32)),
                        "bound": pa.array(limit[q, r]),
                    }
                )

    salted = groups.withColumn("salt", F.pmod(F.xxhash64("group"), F.lit(SALTS)))
    meet = salted.join(boxes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "salt").drop("salt")
    return meet.mapInArrow(run, "group long, range long, q int, bound long")


def _floors(found: DataFrame, k: int) -> DataFrame:
    """(group, q, floor): the kth score so far, where there are k."""
    by_score = Window.partitionBy("group", "q").orderBy(F.desc("score"))
    top = found.select("group", "q", "score").withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k)
    return top.groupBy("group", "q").agg(F.when(F.max("n") == k, F.min("score")).otherwise(F.lit(NONE)).alias("floor"))


def _wanted(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("group", "range").agg(F.collect_list(F.struct("q", "floor")).alias("wanted"))


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of all vectors for each whose vec_id `every` divides.

    The score is the inner product of the vectors (vec_id, embedding, any other columns) with components
    floor(1024 x); scores must fit 64 bits. Equal scores rank by smaller vec_id. All rows with the query's
    vec_id count as its own and are no candidates; other repeated rows are candidates of their own, and a
    repeated query row counts once. Rows without vec_id, null vectors and those with a null or non-finite
    component take no part; empty vectors score 0; the shorter of two vectors is filled up with zeros. Fewer
    candidates give fewer rows, an empty table none.
    """
    rows = _valid(vectors)
    # Vectors of like signs become neighbours, which tightens the blocks' bounds; ids split large groups.
    signs = sum((F.when(F.get("v", F.lit(i)) >= 0, 1 << i).otherwise(0) for i in range(SIGNS)), F.lit(0))
    placed = rows.withColumn("code", signs).repartitionByRange("code", "vec_id")
    ranges = stored(_bundles(placed.sortWithinPartitions("code", "vec_id").drop("code"), "range", RANGE), "ranges")
    queries = stored(_grouped(_asked(ranges, every)), "queries")
    home = queries.select("group", F.posexplode("homes").alias("q", "range"))
    own = _wanted(home.withColumn("floor", F.lit(NONE)))
    found = stored(_scored(own, queries, ranges, k), "own-scores")

    known = home.join(_floors(found, k), ["group", "q"], "left")
    in_order = F.array_sort(F.collect_list(F.struct("q", F.coalesce("floor", F.lit(NONE)).alias("floor"))))
    floors = known.groupBy("group").agg(in_order["floor"].alias("floors"))  # QUERIES at most
    hopeful = stored(_hopeful(queries.join(floors, "group"), stored(_boxed(ranges), "boxes")), "hopeful")
    turns = Window.partitionBy("group", "q").orderBy(F.desc("bound"), "range")
    turned = hopeful.withColumn("turn", F.row_number().over(turns))

    def visit(pairs: DataFrame, so_far: DataFrame) -> DataFrame:
        now = pairs.join(_floors(so_far, k), ["group", "q"], "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
        return _scored(_wanted(now.filter("bound >= floor")), queries, ranges, k)

    found = found.unionByName(stored(visit(turned.filter(F.col("turn") <= FIRST), found), "first-scores"))
    found = found.unionByName(visit(turned.filter(F.col("turn") > FIRST), found))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
