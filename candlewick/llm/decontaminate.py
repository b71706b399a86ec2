"""Benchmark decontamination by greedy string tiling.

Word shingles of documents that also occur in a benchmark item are seeds. A rolling hash finds those that
may match, an equality join on the shingle settles it. On a pair's seeds, greedy string tiling marks the
longest common run of words that no other run has taken, again and again; a pair counts when the marked
words cover enough of the item, in whatever order they stand.

The longest run is found by running Karp-Rabin matching: windows of unmarked seeds of one length are hashed on both
sides, equal ones are compared and extended, and the length is raised when a match is far longer and halved when there
is none. The places of a seed in the document and in the item stay apart, so a pair needs memory for their sum, not
their product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import ALNUM, batch_word_hashes, shingle_hashes, sliced, without
from candlewick.sources.storage import stored

FILTER_BITS = 1 << 24  # of the filter of the benchmark's shingles: 2 MB, however many there are
FILTER_ROW = 1 << 15
SEARCH = 20  # seeds in the windows that the search for a pair's longest run begins with
BASE, PRIME = 1_000_003, (1 << 61) - 1  # of the rolling hash


def _folded(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t.lower().encode() for t in column.to_pylist()]


def _items(benchmark: DataFrame, shingle: int) -> DataFrame:
    """(item_id, ih, ipos, k, n_item, gram, h): every shingle of every item; short items are one shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, names = batch.column("item_id").to_pylist(), batch.column("ih").to_pylist()
            texts = _folded(batch.column("text"))
            for at, hashes, (starts, ends) in batch_word_hashes(texts, ALNUM):
                words = [texts[at][s:e] for s, e in zip(starts, ends, strict=True)]
                k = min(shingle, len(words))
                if not k:
                    continue
                grams = [b" ".join(words[p : p + k]).decode() for p in range(len(words) - k + 1)]
                size = len(grams)
                yield pa.RecordBatch.from_pydict(
                    {
                        "item_id": pa.array([ids[at]] * size, pa.int64()),
                        "ih": pa.array([names[at]] * size, pa.int64()),
                        "ipos": pa.array(range(size), pa.int32()),
                        "k": pa.array([k] * size, pa.int32()),
                        "n_item": pa.array([len(words)] * size, pa.int32()),
                        "gram": pa.array(grams, pa.string()),
                        "h": pa.array(shingle_hashes(hashes, k).view(np.int64)),
                    }
                )

    schema = "item_id long, ih long, ipos int, k int, n_item int, gram string, h long"
    rows = benchmark.select(F.col("item_id").cast("long"), F.xxhash64("text").alias("ih"), "text")
    return rows.distinct().mapInArrow(run, schema)


def _filter(items: DataFrame) -> np.ndarray:
    """Bit set of the items' shingle hashes, of fixed size."""
    slot = F.pmod("h", F.lit(FILTER_BITS))
    rows = items.groupBy(F.floor(slot / FILTER_ROW).alias("row")).agg(
        F.bitmap_construct_agg(F.pmod(slot, F.lit(FILTER_ROW))).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row, bits in rows.collect():
        out[row * FILTER_ROW // 8 :][: FILTER_ROW // 8] = np.frombuffer(bits, dtype=np.uint8)
    return out


def _seeds(docs: DataFrame, bits: np.ndarray, lengths: list[int]) -> DataFrame:
    """(doc_id, th, k, gram, dpos[]) of the shingles of every document that pass the filter, with their places."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            ids, names = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            texts = _folded(batch.column("text"))
            places: dict[tuple, list[int]] = {}
            for at, hashes, (starts, ends) in batch_word_hashes(texts, ALNUM):
                for k in lengths:
                    slot = (shingle_hashes(hashes, k) % np.uint64(FILTER_BITS)).astype(np.int64)
                    for p in np.flatnonzero(shared.value[slot >> 3] >> (slot & 7).astype(np.uint8) & 1):
                        words = [texts[at][s:e] for s, e in zip(starts[p : p + k], ends[p : p + k], strict=True)]
                        places.setdefault((at, k, b" ".join(words)), []).append(int(p))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([ids[at] for at, _, _ in places], pa.int64()),
                    "th": pa.array([names[at] for at, _, _ in places], pa.int64()),
                    "k": pa.array([k for _, k, _ in places], pa.int32()),
                    "gram": pa.array([gram.decode() for _, _, gram in places], pa.string()),
                    "dpos": pa.array(list(places.values()), pa.list_(pa.int32())),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(run, "doc_id long, th long, k int, gram string, dpos array<int>")


class _Side:
    """Seeds of one text in order: their places, numbers and which of them no tile has touched."""

    def __init__(self, places: list[int], seeds: list[int]):
        order = np.argsort(places, kind="stable")
        self.at = np.array(places, dtype=np.int64)[order]
        self.seed = np.array(seeds, dtype=np.int64)[order]
        self.free = np.ones(len(order), dtype=bool)

    def windows(self, size: int) -> list[tuple[int, int]]:
        """(hash, index) of every run of `size` neighbouring free seeds, by a rolling hash."""
        top, out, value, n = pow(BASE, size, PRIME), [], 0, 0
        at, seed, free = self.at.tolist(), self.seed.tolist(), self.free.tolist()
        for i, x in enumerate(seed):
            if not free[i]:
                value = n = 0
                continue
            if n and at[i] != at[i - 1] + 1:
                value = n = 0
            value, n = (value * BASE + x + 1) % PRIME, n + 1
            if n > size:
                value = (value - top * (seed[i - size] + 1)) % PRIME
            if n >= size:
                out.append((value, i - size + 1))
        return out

    def follows(self, i: int) -> bool:
        """Whether the seed of index i is free and stands next to the one before."""
        return i < len(self.at) and bool(self.free[i]) and self.at[i] == self.at[i - 1] + 1

    def is_free(self, i: int, size: int) -> bool:
        return bool(self.free[i : i + size].all())

    def mark(self, i: int, size: int, k: int) -> None:
        """Take the words of `size` seeds from index i on; every seed that has one of them goes."""
        first = self.at[i]
        low, high = np.searchsorted(self.at, (first - k + 1, first + size + k - 1))
        self.free[low:high] = False


def _longest(doc: _Side, item: _Side, size: int) -> tuple[int, list[tuple[int, int]]]:
    """(length, pairs of indices) of the longest common runs of free seeds; `size` is where the search begins."""
    while size:
        table: dict[int, list[int]] = {}
        for value, i in item.windows(size):
            table.setdefault(value, []).append(i)
        best, found = 0, []
        for value, d in doc.windows(size):
            for i in table.get(value, ()):
                if not np.array_equal(doc.seed[d : d + size], item.seed[i : i + size]):
                    continue
                n = size
                while doc.follows(d + n) and item.follows(i + n) and doc.seed[d + n] == item.seed[i + n]:
                    n += 1
                if n > best:
                    best, found = n, []
                if n == best:
                    found.append((d, i))
            if best > 2 * size:
                break
        if best > 2 * size:
            size = best  # far longer: with longer windows fewer places are compared
        elif best:
            return best, found
        else:
            size //= 2
    return 0, []


def tile(places: list[tuple[list[int], list[int]]], k: int) -> list[tuple[int, int, int]]:
    """(words, place in document, place in item) of the tiles, the longest first, ties by place.

    `places` has for each seed of k words where it stands in the document and in the item.
    """
    sides = []
    for side in (0, 1):
        pairs = [(p, seed) for seed, both in enumerate(places) for p in both[side]]
        sides.append(_Side([p for p, _ in pairs], [s for _, s in pairs]))
    doc, item = sides
    tiles, size = [], SEARCH
    while True:
        size, found = _longest(doc, item, size)
        if not size:
            return tiles
        for d, i in sorted(found):
            if doc.is_free(d, size) and item.is_free(i, size):
                tiles.append((size + k - 1, int(doc.at[d]), int(item.at[i])))
                doc.mark(d, size, k)
                item.mark(i, size, k)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle: int = 5, coverage: float = 0.5
) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, longest, th) of every document that repeats a benchmark item.

    coverage is the share of the item's words in tiles of at least `shingle` words; it reaches `coverage`.
    Words are runs of ASCII letters and digits and of characters beyond ASCII, in lower case. Items of
    fewer words must occur whole; items and documents without words never match. Rows that share doc_id
    and text, or item_id and text, give one row; th tells texts of one doc_id apart. Null ids are kept.
    """
    items = stored(_items(benchmark, shingle), "items")
    lengths = sorted(k for (k,) in items.select("k").distinct().collect())
    seeds = _seeds(docs, _filter(items), lengths)
    of_item = items.groupBy("item_id", "ih", "k", "n_item", "gram").agg(F.collect_list("ipos").alias("ipos"))
    points = (
        seeds.join(of_item, ["gram", "k"])
        .groupBy("doc_id", "th", "item_id", "ih", "k", "n_item")
        # As a set, since repeated rows bring the same places again.
        .agg(F.collect_set(F.struct("dpos", "ipos")).alias("places"))
        .filter(
            F.aggregate("places", F.lit(0), lambda n, x: n + F.size(x["ipos"])) * F.col("k")
            >= coverage * F.col("n_item")
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {c: [] for c in ("doc_id", "item_id", "coverage", "tiles", "longest", "th")}
            for row in batch.to_pylist():
                tiles = tile([(x["dpos"], x["ipos"]) for x in row["places"]], row["k"])
                share = sum(n for n, _, _ in tiles) / row["n_item"]
                if share < coverage:
                    continue
                values = (row["doc_id"], row["item_id"], share, len(tiles), tiles[0][0], row["th"])
                for column, value in zip(rows.values(), values, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int64())
            arrays = [pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(rows))

    return points.mapInArrow(
        run, "doc_id long, item_id long, coverage double, tiles int, longest int, th long"
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that repeat a benchmark item; rows are told apart by id and text."""
    found = stored(contaminated(docs, benchmark).select("doc_id", "th").distinct(), "contaminated")
    found = found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    marked = docs.withColumn("_id", F.col("doc_id").cast("long")).withColumn("_th", F.xxhash64("text"))
    return without(marked, found, "_id", "_th").drop("_id", "_th")
