"""What several operators share: word hashes in numpy, sorted numbering, membership filters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.sources.storage import stored

CHUNK = 1 << 20  # bytes hashed at once; only bounds memory
BITS = 1 << 23  # of a membership filter: 1 MB in all, whatever the number of keys
BITMAP = 1 << 15  # bits of one bitmap row

_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def byte_class(is_word) -> np.ndarray:
    """Table of 256 flags from a predicate on byte values."""
    return np.array([bool(is_word(b)) for b in range(256)])


#: ASCII letters and digits, and every byte of a character beyond ASCII.
ALNUM = byte_class(lambda b: b >= 0x80 or chr(b).isalnum())
#: Everything but ASCII white space.
SOLID = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(buffer: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in a byte array."""
    inside = np.zeros(len(buffer) + 2, dtype=np.int8)
    inside[1:-1] = table[buffer]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _hash_chunk(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = 1 << max(20, int(len(buffer)).bit_length())
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(buffer) + 1, dtype=np.uint64)
        weighted = (buffer.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, size)[: len(buffer)]
        np.cumsum(weighted, out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * _powers(_INVERSE, size)[starts]
        return mix(value + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit polynomial hash, start and end of each word of a text, a chunk at a time."""
    buffer = np.frombuffer(text, dtype=np.uint8)
    parts, low = [], 0
    while low < len(buffer):
        high = min(low + CHUNK, len(buffer))
        while high < len(buffer) and table[buffer[high]]:
            rest = np.flatnonzero(~table[buffer[high : high + CHUNK]])
            high = high + int(rest[0]) if len(rest) else min(high + CHUNK, len(buffer))
        piece = buffer[low:high]
        starts, ends = spans(piece, table)
        parts.append((_hash_chunk(piece, starts, ends), starts + low, ends + low))
        low = high
    if not parts:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Rolling hash of each run of k words; none when there are fewer words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = out * np.uint64(_MULTIPLIER) + words[j : j + n]
    return mix(out)


def groups_of_texts(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts that hold about `most` bytes together."""
    low = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield low, i
            low, size = i, 0
        size += len(text) + 1
    if low < len(texts):
        yield low, len(texts)


def batch_word_hashes(
    texts: list[bytes], table: np.ndarray
) -> Iterator[tuple[int, np.ndarray, tuple[np.ndarray, np.ndarray]]]:
    """(index, word hashes, spans) of every text; short ones are hashed together.

    A space, which is no word byte in any table here, separates neighbours.
    """
    for low, high in groups_of_texts(texts):
        whole = b" ".join(texts[low:high])
        hashes, starts, ends = word_hashes(whole, table)
        begin = np.cumsum([0] + [len(t) + 1 for t in texts[low:high]])
        cut = np.searchsorted(starts, begin)
        for i in range(high - low):
            part = slice(cut[i], cut[i + 1])
            yield low + i, hashes[part], (starts[part] - begin[i], ends[part] - begin[i])


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at once."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)


def bytes_of(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def numbered(df: DataFrame, order: list[str], name: str = "index", label: str = "order") -> DataFrame:
    """`df` with each row's number in the total order of `order`, from 0.

    Rows are dealt by range and sorted in place; only one count a partition reaches the driver.
    """
    cut = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("_id", 33)
    counts = sorted(map(tuple, cut.groupBy(part.alias("p")).count().collect()))
    base, offsets = 0, {}
    for p, n in counts:
        offsets[p] = base
        base += n
    if not offsets:
        return cut.withColumn(name, F.lit(0).cast("long")).drop("_id")
    table = cut.sparkSession.createDataFrame(list(offsets.items()), "_p long, _base long")
    return (
        cut.withColumn("_p", part.cast("long"))
        .join(F.broadcast(table), "_p")
        .withColumn(name, F.col("_base") + F.col("_id").bitwiseAND((1 << 33) - 1))
        .drop("_id", "_p", "_base")
    )


def _slot(*key: Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BITS))


def bitmap(keys: DataFrame, *names: str) -> DataFrame:
    """Membership filter of the keys: at most BITS / BITMAP rows of 4 KB."""
    slot = _slot(*[F.col(n) for n in names])
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bitmap")
    )


def split_by(df: DataFrame, keys: DataFrame, *names: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among `keys`, rows whose key is surely not).

    Only the first part needs a join with `keys`, so the texts of the second are never shuffled. The
    filter has a fixed size and is the only thing broadcast; with too many keys it lets more through.
    """
    slot = _slot(*[F.col(n) for n in names])
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_place div 8 AS int) + 1, 1)")), 16, 10)
    bit = F.expr("shiftleft(1, cast(_place % 8 AS int))")
    marked = (
        df.withColumn("_bucket", F.bitmap_bucket_number(slot))
        .withColumn("_place", place)
        .join(F.broadcast(bitmap(keys, *names)), "_bucket", "left")
        .withColumn("_maybe", F.coalesce(byte.cast("int").bitwiseAND(bit) != 0, F.lit(False)))
        .drop("_bucket", "_bitmap", "_place")
    )
    return marked.filter("_maybe").drop("_maybe"), marked.filter("NOT _maybe").drop("_maybe")


def meets(keys: DataFrame, *names: str) -> tuple[DataFrame, Column]:
    """`keys` under other names, and their equality with the named columns; null equals null."""
    other = keys.select(*[F.col(n).alias(f"_k_{n}") for n in names])
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"_k_{n}"))
    return other, on


def without(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """Rows of `df` whose key is not among `keys`; null equals null."""
    maybe, rest = split_by(df, keys, *names)
    other, on = meets(keys, *names)
    return maybe.join(other, on, "left_anti").unionByName(rest)


def among(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """Rows of `df` whose key is among `keys`; null equals null."""
    other, on = meets(keys, *names)
    return split_by(df, keys, *names)[0].join(other, on, "left_semi")
