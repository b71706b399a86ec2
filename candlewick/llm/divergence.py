"""How the sources of a language differ in their terms, and which terms set a source apart.

A group is one source within one language. Its smoothed share of every kept term is compared with that of
each other source of the language (part `pair`) and with the whole language (part `term`).

Pairs come from a product of the group-by-term matrix with its transpose, by rows: the postings that two blocks
of sources have of a bucket of terms meet in one task, which lays them out term by term. Each group then walks
its own terms and scatters what every posting of a term adds into one dense accumulator cell per peer, so no pair
of postings is ever a row. A peer without the term has its share from smoothing alone. Sums over terms that
only one side has follow from the distinct shares of a group, and the scattered part holds what the terms of both
sides add beyond that. Blocks have about `PEERS` sources and buckets about `POSTINGS` postings whatever the size
of the table; a pair's sums over the buckets are added up at the end.

All figures are whole numbers: shares are billionths rounded down, computed by long division, so that no
product leaves 64 bits while a language has under 9 * 10^15 occurrences.

Rows: null text, lang and source count as ''. Every row is a document, also one that repeats another. A group
without kept terms has shares from smoothing alone. A language without kept terms has pairs of value 0 and no terms.
A language with one source has no pairs. No documents give no rows. Equal values rank by the UTF-8 bytes of the item.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import CHUNK, bytes_of, sliced
from candlewick.sources.storage import stored

TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Sources of a block and postings of a bucket: the most that one task holds at once, on average.
PEERS = 256
POSTINGS = 1 << 19
#: Entries a task counts before it hands them on; only bounds memory.
ENTRIES = 200_000

COUNTS = "lang string, source string, term binary, n long, docs long"
PAIR = "lang string, source string, item string, value long"
KEY = ["lang", "source"]


def terms_of(text: bytes) -> Counter:
    """Occurrences of every term of a text, a piece at a time."""
    text = text.lower()  # of bytes: A to Z only
    if len(text) <= CHUNK:
        return Counter(TERM.findall(text))
    found: Counter = Counter()
    low = 0
    while low < len(text):
        high = low + CHUNK
        if high < len(text):  # up to the end of the term that crosses the border
            rest = TERM.match(text, high)
            high = rest.end() if rest else high
        found.update(TERM.findall(text, low, high))
        low = high
    return found


def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of a task's rows, summed as far as memory allows."""
    counts: dict[tuple, dict[bytes, list[int]]] = {}
    entries = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in counts.items():
            n = len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(terms.keys(), pa.binary()),
                    pa.array([c[0] for c in terms.values()], pa.int64()),
                    pa.array([c[1] for c in terms.values()], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )

    for batch in sliced(batches):
        keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for key, text in zip(keys, bytes_of(batch.column("text")), strict=True):
            terms = counts.setdefault(key, {})
            entries -= len(terms)
            for term, n in terms_of(text).items():
                cell = terms.get(term)
                if cell is None:
                    terms[term] = [n, 1]
                else:
                    cell[0] += n
                    cell[1] += 1
            entries += len(terms)
            if entries > ENTRIES:
                yield from flush()
                counts, entries = {}, 0
    yield from flush()


def share(count: Column, whole: Column) -> Column:
    """1 + floor(10^9 * count / whole) without leaving 64 bits: three digits at a time."""
    out, rest = _div(count, whole), count % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + _div(rest, whole), rest % whole
    return out + 1


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """`share` in numpy; 0 where a language keeps no term."""
    whole = np.maximum(whole, 1)
    out, rest = count // whole, count % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def gap(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def postings(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, total, first): occurrences of kept terms in groups and languages.

    `first` marks one row of every kept term of a language.
    """
    cells = (
        docs.mapInArrow(occurrences, COUNTS)
        .groupBy(*KEY, "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )
    of_term = Window.partitionBy("lang", "term")
    kept = (
        cells.withColumn("total", F.sum("n").over(of_term))
        .withColumn("in_docs", F.sum("docs").over(of_term))
        .withColumn("first", F.row_number().over(of_term.orderBy("source")) == 1)
        .filter(F.col("in_docs") >= min_docs)
    )
    return stored(kept.select(*KEY, F.col("term").cast("string").alias("term"), "n", "total", "first"), "postings")


def measured(docs: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups with their occurrences, languages with occurrences, kept terms, postings and sources)."""
    own = kept.groupBy(*KEY).agg(
        F.sum("n").alias("size"),
        F.count("*").alias("postings"),
        F.sum(F.col("first").cast("long")).alias("terms"),
    )
    groups = stored(docs.select(*KEY).distinct().join(own, KEY, "left").na.fill(0), "groups")
    langs = groups.groupBy("lang").agg(
        F.sum("size").alias("lang_size"),
        F.sum("terms").alias("terms"),
        F.sum("postings").alias("postings"),
        F.count("*").alias("sources"),
    )
    blocks = F.ceil(F.col("sources") / PEERS)
    buckets = F.greatest(F.ceil(2 * F.col("postings") / blocks / POSTINGS), F.lit(1))
    return groups.select(*KEY, "size"), langs.select(
        "lang", "lang_size", "terms", blocks.cast("int").alias("blocks"), buckets.cast("int").alias("buckets")
    )


def _tiles(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """Postings and groups at every pair of blocks that their source is part of; groups have a null term."""
    bucket = F.pmod(F.xxhash64("term"), F.col("buckets"))
    rows = (
        kept.join(langs, "lang")
        .select(*KEY, "term", "n", "terms", "blocks", bucket.cast("int").alias("bucket"))
        .unionByName(
            groups.join(langs, "lang").select(
                *KEY,
                F.lit(None).cast("string").alias("term"),
                F.col("size").alias("n"),
                "terms",
                "blocks",
                F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket"),
            )
        )
    )
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            *KEY, "term", "n", "terms", "bucket", "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
    )


class _Block:
    """The groups of a block and their postings, in the order of groups and in that of terms."""

    def __init__(self, names: np.ndarray, sizes: np.ndarray, terms: int):
        order = np.argsort(names)
        self.names, self.whole = names[order], sizes[order] + 2 * terms
        self.zero = _share(np.full(len(order), 2), self.whole)

    def fill(self, sources: np.ndarray, terms: np.ndarray, counts: np.ndarray, n_terms: int) -> None:
        group = np.searchsorted(self.names, sources)
        p = _share(counts + 2, self.whole[group])
        by_group = np.lexsort((terms, group))
        self.row = np.searchsorted(group[by_group], np.arange(len(self.names) + 1))
        self.terms, self.p = terms[by_group], p[by_group]
        by_term = np.argsort(terms, kind="stable")
        self.column = np.searchsorted(terms[by_term], np.arange(n_terms + 1))
        self.peers, self.q = group[by_term], p[by_term]

    def of(self, g: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.row[g], self.row[g + 1])
        return self.terms[part], self.p[part]


def _one_sided(block: _Block, g: int, zeros: np.ndarray, both_zero: np.ndarray) -> np.ndarray:
    """What the terms of a group add against peers that lack them, beyond terms that both lack."""
    shares, times = np.unique(block.of(g)[1], return_counts=True)
    return (_gap(shares[:, None], zeros[None, :]) * times[:, None]).sum(axis=0) - times.sum() * both_zero


def _accumulated(rows: _Block, index: _Block) -> np.ndarray:
    """For every group of `rows` and peer of `index`, the sum over this bucket beyond terms that both lack."""
    both_zero = _gap(rows.zero[:, None], index.zero[None, :])
    sums = np.zeros(both_zero.shape, dtype=np.int64)
    for g in range(len(rows.names)):
        terms, p = rows.of(g)
        low = index.column[terms]
        many = index.column[terms + 1] - low
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        p, peers, q = np.repeat(p, many), index.peers[at], index.q[at]
        shared = _gap(p, q) - _gap(p, index.zero[peers]) - _gap(rows.zero[g], q) + both_zero[g, peers]
        np.add.at(sums[g], peers, shared)
        sums[g] += _one_sided(rows, g, index.zero, both_zero[g])
    for h in range(len(index.names)):
        sums[:, h] += _one_sided(index, h, rows.zero, both_zero[:, h])
    return sums


def tile(table: pa.Table) -> pa.Table:
    """Sums of one pair of blocks over one bucket of terms, for every ordered pair of groups."""
    lang = table.column("lang")[0].as_py()
    n_terms = table.column("terms")[0].as_py()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    first = table.column("bucket")[0].as_py() == 0
    source = table.column("source").to_numpy(zero_copy_only=False)
    block, counts = table.column("block").to_numpy(), table.column("n").to_numpy()
    coded = table.column("term").combine_chunks().dictionary_encode()
    is_group = coded.indices.is_null().to_numpy(zero_copy_only=False)
    terms = coded.indices.fill_null(0).to_numpy(zero_copy_only=False)

    def made(number: int) -> _Block:
        here = block == number
        out = _Block(source[here & is_group], counts[here & is_group], n_terms)
        own = here & ~is_group
        out.fill(source[own], terms[own], counts[own], len(coded.dictionary))
        return out

    rows = made(low)
    index = rows if low == high else made(high)
    sums = _accumulated(rows, index)
    if first and n_terms:
        sums += n_terms * _gap(rows.zero[:, None], index.zero[None, :])
    if low == high:
        g, h = np.nonzero(~np.eye(len(rows.names), dtype=bool))
    else:
        g, h = (a.ravel() for a in np.indices(sums.shape))
    a, b, value = rows.names[g], index.names[h], sums[g, h]
    if low != high:
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "source": pa.array(a, pa.string()),
            "item": pa.array(b, pa.string()),
            "value": pa.array(value, pa.int64()),
        }
    )


def pairs(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of sources of a language."""
    sums = _tiles(kept, groups, langs).groupBy("lang", "low", "high", "bucket").applyInArrow(tile, PAIR)
    return sums.groupBy(*KEY, "item").agg(F.sum("value").alias("value"))


def apart(kept: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group has more of than its language."""
    both = 2 * F.col("terms")
    p, q = share(F.col("n") + 2, F.col("size") + both), share(F.col("total") + 2, F.col("lang_size") + both)
    return (
        kept.join(groups, KEY)
        .join(langs, "lang")
        .select(*KEY, F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter("p > q")
        .select(*KEY, "item", gap(F.col("p"), F.col("q")).alias("value"))
    )


def divergence(docs: DataFrame, min_docs: int = 10, top_terms: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank): all peers of every group, and its most telling terms."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", *KEY)])
    kept = postings(docs, min_docs)
    groups, langs = measured(docs, kept)
    ranks = F.row_number().over(Window.partitionBy(*KEY).orderBy(F.desc("value"), "item"))
    peers = pairs(kept, groups, langs).withColumn("rank", ranks)
    terms = apart(kept, groups, langs).withColumn("rank", ranks).filter(F.col("rank") <= top_terms)
    return (
        peers.withColumn("part", F.lit("pair"))
        .unionByName(terms.withColumn("part", F.lit("term")))
        .select(*KEY, "part", "item", "value", "rank")
    )
