"""Mixing sources to target weights.

The words of each source are packed into fixed-length blocks. Every output shard draws how many of its
slots go to each source from a multinomial. The slots of a source are numbered through all shards and
mapped to its blocks by a pseudorandom permutation, a new one for every pass over the source. Slots and
blocks then meet by an equality join on (source, block).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import mix as spread
from candlewick.sources.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
SHARDS = 16  # placed by a task
ROWS = 2000  # documents packed in a row; a source is cut into so many groups that none has many more
MOST_SOURCES = 100_000  # the table of sources and targets is held by the driver


@dataclass(frozen=True)
class Mix:
    """sources: (s, source, source_size, blocks, target, quota); rows: one a document with its place in
    its source; slots: (shard, position, s, block); spans: the words that each slot takes."""

    sources: pd.DataFrame
    rows: DataFrame
    slots: DataFrame
    spans: DataFrame


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Share `total` by weight; none gets over `most` times its size, the rest share what that leaves."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        rate = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if rate * weights[i] > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = rate * weights[i]
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        left, open_ = max(left, 0.0), [i for i in open_ if i not in set(full)]
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Images of `index` (0 <= index < size) under the permutation of range(size) that `key` names.

    A Feistel network permutes the next power of four; values beyond `size` go round again.
    """
    half = max(1, ((int(size) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = spread(np.arange(1, 7, dtype=np.uint64) + np.uint64(key & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & low
        for k in keys:
            a, b = b, a ^ (spread(b ^ k) & low)
        return a << np.uint64(half) | b

    out = once(index.astype(np.uint64))
    while len(far := np.flatnonzero(out >= size)):
        out[far] = once(out[far])
    return out.astype(np.int64)


def _key(*parts: int) -> int:
    value = np.zeros(1, dtype=np.uint64)
    for p in parts:
        value = spread(value + np.uint64(p & (2**64 - 1)) + np.uint64(0x9E3779B97F4A7C15))
    return int(value[0])


def _packed(docs: DataFrame, block: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(documents with their words' place in a group of their source, groups with their first block)."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    sized = stored(
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size")),
        "mix-sizes",
    )
    parts = max(1, -(-sized.count() // ROWS))
    order = F.xxhash64("doc_id", F.lit(seed))
    inside = Window.partitionBy("source", "part").orderBy("shuffled", "doc_id", "size")
    rows = (
        sized.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(parts)))
        .withColumn("shuffled", order)
        .withColumn("n", F.row_number().over(inside))
        .withColumn("end", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("begin", F.col("end") - F.col("size"))
        .drop("shuffled")
    )
    groups = sized.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(parts)))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        groups.groupBy("source", "part")
        .agg(F.sum("size").alias("words"), F.ceil(F.sum("size") / block).cast("long").alias("blocks"))
        .withColumn("first_block", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("long"))
    )
    return rows, stored(groups, "mix-groups")


def _sources(
    groups: DataFrame, weights: tuple[float, ...], share: float, most: float
) -> pd.DataFrame:
    found = groups.groupBy("source").agg(F.sum("words").alias("size"), F.sum("blocks").alias("blocks"))
    found = [tuple(r) for r in found.limit(MOST_SOURCES + 1).collect()]
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in found]
    weight = [weights[i % len(weights)] for i in range(len(found))]
    target = targets(sizes, weight, share * sum(sizes), most)
    blocks = [int(r[2]) for r in found]
    quota = [
        min(int(t * b / w + 0.5), int(most * b)) if w else 0
        for t, b, w in zip(target, blocks, sizes, strict=True)
    ]
    columns = {
        "s": range(len(found)), "source": [r[0] for r in found], "source_size": sizes,
        "blocks": blocks, "target": target, "quota": quota,
    }
    return pd.DataFrame(columns).astype({"source": object})


def _slots(spark, sources: pd.DataFrame, shard_slots: int, seed: int) -> DataFrame:
    quota, blocks = sources["quota"].to_numpy(np.int64), sources["blocks"].to_numpy(np.int64)
    total = int(quota.sum())
    shards = -(-total // shard_slots)
    schema = "shard long, s int, n long, before long"

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                size = min(shard_slots, total - int(shard) * shard_slots)
                counts = np.random.default_rng([seed, int(shard)]).multinomial(size, quota / total)
                before = np.cumsum(counts) - counts
                some = np.flatnonzero(counts)
                yield pd.DataFrame(
                    {"shard": shard, "s": some, "n": counts[some], "before": before[some]}
                )

    drawn = stored(spark.range(shards).mapInPandas(draw, schema), "mix-draws")
    had = np.zeros(len(quota), dtype=np.int64)
    for s, n in drawn.groupBy("s").agg(F.sum("n")).collect():
        had[s] = n
    # Together the shards draw somewhat more or less than a source's quota. The slots beyond a quota go
    # to the sources that fell short: the surplus and the shortfall are numbered alike.
    over, short = np.maximum(had - quota, 0), np.maximum(quota - had, 0)
    over_base, short_end = np.cumsum(over) - over, np.cumsum(short)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, s, n, before, start in frame.itertuples(index=False):
                size = min(shard_slots, total - int(shard) * shard_slots)
                position = permuted(np.arange(before, before + n), size, _key(seed, 3, shard))
                index, to = np.arange(start, start + n), np.full(n, s)
                beyond = index >= quota[s]
                rank = over_base[s] + index[beyond] - quota[s]
                to[beyond] = np.searchsorted(short_end, rank, side="right")
                t = to[beyond]
                index[beyond] = had[t] + rank - (short_end[t] - short[t])
                block = np.empty(n, dtype=np.int64)
                turn = index // blocks[to]
                for t, e in set(zip(to.tolist(), turn.tolist(), strict=True)):
                    own = (to == t) & (turn == e)
                    block[own] = permuted(index[own] % blocks[t], blocks[t], _key(seed, 5, t, e))
                yield pd.DataFrame({"shard": shard, "position": position, "s": to, "block": block})

    through = Window.partitionBy("s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    started = drawn.withColumn("start", F.coalesce(F.sum("n").over(through), F.lit(0)))
    # A row stands for thousands of slots, so a few rows are work enough for a task.
    dealt = started.select("shard", "s", "n", "before", "start").repartition(
        max(1, -(-shards // SHARDS)), "shard"
    )
    return dealt.mapInPandas(place, "shard long, position long, s int, block long")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    block: int = 128,
    shard_slots: int = 4096,
    seed: int = 20,
) -> Mix:
    """Mix `docs` (doc_id, text, source, any other columns).

    Sources in order of code point, null last, take `weights` in turn and share `share` times all words;
    none gets over `most` times its words. A block is taken at most that often, so a document is too.
    Null and empty texts have no words and are never taken. Repeated rows are documents of their own.
    The same rows give the same mix. No rows give empty frames. More than MOST_SOURCES sources raise.
    """
    spark = docs.sparkSession
    rows, groups = _packed(docs, block, seed)
    sources = _sources(groups, weights, share, most)
    named = spark.createDataFrame(
        [
            (int(s), source, int(size), float(target))
            for s, source, size, target in sources[
                ["s", "source", "source_size", "target"]
            ].itertuples(index=False)
        ],
        "s int, named string, source_size long, target double",
    )
    groups = groups.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("named")))
    groups = groups.select(
        F.col("source").alias("g_source"), F.col("part").alias("g_part"),
        "first_block", "s", "source_size", "target",
    )
    rows = stored(
        rows.join(
            groups, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("part") == F.col("g_part"))
        ).select(
            "doc_id", "source", "size", "s", "source_size", "target", "part", "n", "begin", "end", "first_block"
        ),
        "mix-rows",
    )
    pieces = (
        rows.filter("size > 0")
        .withColumn("b", F.explode(F.expr(f"sequence(begin div {block}, (end - 1) div {block})")))
        .withColumn("from", F.greatest("begin", F.col("b") * block))
        .withColumn("to", F.least("end", (F.col("b") + 1) * block))
        .select(
            "s", (F.col("first_block") + F.col("b")).alias("block"), "doc_id", "part", "n",
            (F.col("from") - F.col("begin")).alias("first_word"),
            (F.col("from") - F.col("b") * block).alias("block_word"),
            (F.col("to") - F.col("from")).alias("n_words"),
        )
    )
    slots = _slots(spark, sources, shard_slots, seed)
    # The planner knows the size of the draws, not of the slots, and must not broadcast these.
    return Mix(sources, rows, slots, slots.join(pieces.hint("merge"), ["s", "block"]))


def taken(result: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source), one row for every document."""
    row = ["s", "part", "n"]
    used = result.spans.groupBy(*row).agg(F.sum("n_words").alias("w"))
    both = result.rows.select(*row, "doc_id", "size", "source_size", "target", "source", F.lit(0).alias("w"))
    blank = [F.lit(None).cast(t).alias(c) for c, t in both.dtypes[3:-1]]
    both = both.unionByName(used.select(*row, *blank, "w"))
    picked = [F.max(c).alias(c) for c in ("doc_id", "size", "source_size", "target", "source")]
    return (
        both.groupBy(*row)
        .agg(*picked, F.sum("w").cast("long").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken", "source")
    )
