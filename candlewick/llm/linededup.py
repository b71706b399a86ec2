"""Deletion of repeated runs of lines with a suffix array.

Every line that is not blank gets an id. The suffixes of all documents' id sequences are ranked by
prefix doubling: each round ranks twice as many lines by joining two ranks of the round before.
Neighbours in the suffix array share their longest common prefix; the earliest suffix of each common
prefix keeps its lines and the others, the later copies, lose them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import meets, numbered, sliced, split_by
from candlewick.sources.storage import stored

WORD = r"[^\x20\x09-\x0D]+"
DOC = ["doc_id", "th"]
#: Suffixes with the same first lines that one task compares.
GROUP = 1024


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, th, seq, h, g, words) of every line that is not blank; h and g name its content."""
    solid = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    lines = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), F.posexplode(solid).alias("seq", "line")
    )
    line = F.regexp_replace("line", r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")
    words = F.regexp_count("line", F.lit(WORD)).alias("words")
    return lines.withColumn("line", line).select(
        *DOC, "seq", F.xxhash64("line").alias("h"), F.hash("line").alias("g"), words
    )


def _stretches(docs: DataFrame, min_words: int) -> DataFrame:
    """(sid, doc_id, th, seq, h[], g[], words[]): runs of lines that each occur twice or more anywhere.

    Only these can hold a repeated run; those of under `min_words` words are left out. sid numbers them
    in the order of documents and lines, null ids last. Rows that repeat doc_id and text are one document.
    """
    lines = stored(_lines(docs), "lines")
    # Written first, so that the join below can split a line that very many documents share.
    twice = lines.groupBy("h", "g").agg(F.count("*").alias("n")).filter("n > 1").select("h", "g")
    twice = stored(twice, "repeated-lines")
    inside = Window.partitionBy(*DOC).orderBy("seq")
    found = (
        lines.join(twice, ["h", "g"])
        .withColumn("last", F.lag("seq").over(inside))
        .filter("last IS NULL OR last <> seq")
        .withColumn("island", F.col("seq") - F.row_number().over(inside))
        .groupBy(*DOC, "island")
        .agg(F.sum("words").alias("total"), F.array_sort(F.collect_list(F.struct("seq", "h", "g", "words"))).alias("l"))
        .filter(F.col("total") >= min_words)
        .select(
            F.col("doc_id").isNull().alias("nameless"), *DOC, F.col("l")[0]["seq"].alias("seq"),
            F.col("l.h").alias("h"), F.col("l.g").alias("g"), F.col("l.words").alias("words"),
        )
    )
    return stored(numbered(found, ["nameless", *DOC, "seq"], "sid", "stretches").drop("nameless"), "stretches")


def suffix_ranks(ids: DataFrame, longest: int) -> DataFrame:
    """(sid, i, rank) of every suffix of the sequences `ids` (sid, i, h, g), by prefix doubling.

    Ranks are dense and follow the order of the sequences, the shorter first where one begins the other;
    equal suffixes share a rank. A round is a join of two ranks and a distributed sort of the distinct
    pairs; it ends when no round tells more suffixes apart or `longest` lines are compared.
    """
    names = numbered(ids.select("h", "g").distinct(), ["h", "g"], "rank", "rank-names")
    ranks = stored(ids.join(names, ["h", "g"]).select("sid", "i", "rank"), "ranks")
    apart, width = ranks.agg(F.max("rank")).first()[0], 1
    while apart is not None and width < longest:
        ahead = F.lead("rank", width, -1).over(Window.partitionBy("sid").orderBy("i"))
        paired = ranks.withColumn("then", ahead)
        pairs = paired.groupBy("rank", "then").agg(F.count("*").alias("n")).drop("n")
        pairs = stored(numbered(pairs, ["rank", "then"], "new", "rank-pairs"), "rank-pairs")
        ranks = stored(
            paired.join(pairs, ["rank", "then"]).select("sid", "i", F.col("new").alias("rank")), "ranks"
        )
        last, apart = apart, ranks.agg(F.max("rank")).first()[0]
        if apart == last:
            break
        width *= 2
    return ranks


def _starts(stretches: DataFrame, min_words: int) -> DataFrame:
    """(sid, i, left, lines, head, ahead) of every suffix with `min_words` words in its stretch.

    left: lines to the end of the stretch; lines, head: number and digest of the fewest lines with so many words;
    ahead: the ids of those lines and of the next ones, up to `min_words` words more. As each line that begins
    `min_words` repeated words is looked at, comparing so far finds every line of every repeated run.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for sid, h, g, words in zip(
                *(batch.column(c).to_pylist() for c in ("sid", "h", "g", "words")), strict=True
            ):
                n = len(h)
                raw = np.empty(n, dtype=[("h", "<i8"), ("g", "<i4")])
                raw["h"], raw["g"] = h, g
                raw, step = raw.tobytes(), 12
                sums = np.concatenate(([0], np.cumsum(words)))
                head = np.searchsorted(sums, sums[:-1] + min_words, side="left")
                some = np.flatnonzero(head <= n)
                tail = np.minimum(np.searchsorted(sums, sums[head[some]] + min_words, side="left"), n)
                first = [xxhash.xxh3_128_digest(raw[step * i : step * j]) for i, j in zip(some, head[some], strict=True)]
                ahead = [raw[step * i : step * j] for i, j in zip(some, tail, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "sid": pa.array(np.full(len(some), sid)),
                        "i": pa.array(some.astype(np.int32)),
                        "left": pa.array((n - some).astype(np.int32)),
                        "lines": pa.array((head[some] - some).astype(np.int32)),
                        "head": pa.array(first, pa.binary()),
                        "ahead": pa.array(ahead, pa.binary()),
                    }
                )

    return stretches.select("sid", "h", "g", "words").mapInArrow(
        run, "sid long, i int, left int, lines int, head binary, ahead binary"
    )


def _shared(a: bytes, b: bytes) -> int:
    """Lines that two sequences of 12-byte ids share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // 12
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(x != y)) // 12


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Longest earlier match of every suffix from suffixes in order, by a stack of common prefixes.

    The stack holds suffixes that each lie earlier in the text than the one above. A suffix leaves it when
    an earlier one comes: what it shares with that and with the one below are its longest earlier matches.
    """
    stack: list[tuple[tuple[int, int], int]] = []  # (place, lines shared with the one below)
    head = last = None
    out: list[tuple[int, int, int]] = []

    def leave(shared_above: int) -> int:
        place, below = stack.pop()
        best = max(below, shared_above)
        if best:
            out.append((*place, best))
        return below

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        out.clear()
        types = (pa.int64(), pa.int32(), pa.int32())
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["sid", "i", "n"])

    for batch in batches:
        for sid, i, key, ahead in zip(
            *(batch.column(c).to_pylist() for c in ("sid", "i", "head", "ahead")), strict=True
        ):
            if key != head:
                while stack:
                    leave(0)
                shared = 0
            else:
                shared = _shared(last, ahead)
            while stack and stack[-1][0] > (sid, i):
                # What the newcomer shares with the next below is the least over those that leave.
                shared = min(shared, leave(shared))
            stack.append(((sid, i), shared if stack else 0))
            head, last = key, ahead
        yield flush()
    while stack:
        leave(0)
    yield flush()


def _split(order: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches across the parts of large groups, suffixes in groups of at most GROUP that share a `head`).

    A group of suffixes with the same first lines is an interval of the suffix array. In a large one all but the
    earliest match it by those lines; the group is then cut into the intervals of one line more, and so on until each
    is small or has no further line to compare. What a suffix shares with its own part is found there.
    """
    matches = order.limit(0).select("sid", "i", F.col("lines").alias("n"))
    calm, rows, depth = [], order, 0
    while True:
        groups = rows.groupBy("head").agg(F.count("*").alias("n"), F.min(F.struct("sid", "i")).alias("first"))
        large = stored(groups.filter(F.col("n") > GROUP).select("head", "first"), "large-groups")
        if large.isEmpty():
            return matches, reduce(DataFrame.unionByName, [*calm, rows])
        calm.append(rows.join(large.select("head"), "head", "left_anti"))
        rows = stored(rows.join(large, "head"), "large-group-rows")
        alike = F.col("lines") + depth
        later = rows.filter((F.col("sid") != F.col("first.sid")) | (F.col("i") != F.col("first.i")))
        matches = matches.unionByName(later.select("sid", "i", alike.alias("n")))
        depth += 1
        size = 12 * (F.col("lines") + depth)
        more = rows.drop("first").filter(F.length("ahead") >= size)
        rows = more.withColumn("head", F.unhex(F.md5(F.substring("ahead", F.lit(1), size))))


def repeated_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(doc_id, th, seq, n): n lines from line seq on that are a later copy; th is the text's hash.

    Lines are counted without blank ones and compared without white space at their ends. A run counts if
    it has `min_words` words. The copy with the smallest doc_id stays, null ids counting as largest, and
    within a document the first. Runs may overlap.
    """
    stretches = _stretches(docs, min_words)
    longest = stretches.agg(F.max(F.size("h"))).first()[0] or 0
    ids = stretches.select("sid", F.posexplode(F.arrays_zip("h", "g")).alias("i", "id"))
    ranks = suffix_ranks(ids.select("sid", "i", "id.h", "id.g"), longest)
    starts = stored(_starts(stretches, min_words), "starts")
    often = starts.groupBy("head").agg(F.count("*").alias("n")).filter("n > 1").select("head")
    starts = starts.join(often, "head").join(ranks, ["sid", "i"])
    starts = stored(starts, "starts")
    first = starts.groupBy("rank").agg(F.min(F.struct("sid", "i")).alias("first"))
    first = first.select(F.col("rank").alias("r"), "first.sid", "first.i")
    # Equal suffixes: all but the earliest are copies to the end of their stretch.
    others = first.select("r", F.col("sid").alias("sid_1"), F.col("i").alias("i_1"))
    whole = starts.join(others, F.col("rank") == F.col("r"))
    whole = whole.filter("sid <> sid_1 OR i <> i_1").select("sid", "i", F.col("left").alias("n"))
    order = starts.join(first.drop("r"), ["sid", "i"])
    deep, order = _split(order.select("sid", "i", "rank", "lines", "head", "ahead"))
    order = order.repartition("head").sortWithinPartitions("head", "rank")
    part = order.select("sid", "i", "head", "ahead").mapInArrow(_intervals, "sid long, i int, n int")
    found = whole.unionByName(part).unionByName(deep)
    place = stretches.select("sid", *DOC, "seq")
    return found.join(place, "sid").select(*DOC, (F.col("seq") + F.col("i")).alias("seq"), "n")


def _edited(rows: DataFrame) -> DataFrame:
    """`rows` (…, text, _runs) with text less the lines of _runs, and _deleted."""
    names = [c for c in rows.columns if c not in ("text", "_runs")]
    short = [f"_c{i}" for i in range(len(names))]
    types = dict(rows.dtypes)
    given = rows.select(*[F.col(c).alias(s) for c, s in zip(names, short, strict=True)], "text", "_runs")
    fields = ", ".join(f"{s} {types[c]}" for c, s in zip(names, short, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts, counts = [], []
            runs = batch.column("_runs").to_pylist()
            for text, spans in zip(batch.column("text").to_pylist(), runs, strict=True):
                lines = text.split("\n")
                solid = [k for k, line in enumerate(lines) if line.strip(" \t\n\x0b\x0c\r")]
                gone = np.zeros(len(solid) + 1, dtype=np.int64)
                for span in spans:
                    gone[span["seq"]] += 1
                    gone[span["seq"] + span["n"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                keep, left = [], True
                at = dict(zip(solid, gone.tolist(), strict=True))
                for k, line in enumerate(lines):
                    left = not at[k] if k in at else left  # a blank line goes with the line before
                    if left:
                        keep.append(line)
                texts.append("\n".join(keep))
                counts.append(int(gone.sum()))
            columns = [batch.column(s) for s in short]
            new = [pa.array(texts, pa.string()), pa.array(counts, pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*short, "text", "_deleted"])

    fields = fields + ", " if fields else ""
    done = given.mapInArrow(run, f"{fields}text string, _deleted int")
    back = [F.col(s).alias(c) for c, s in zip(names, short, strict=True)]
    return done.select(*back, "text", "_deleted")


def _deduped(docs: DataFrame, min_words: int) -> DataFrame:
    """`docs` without later copies, and _deleted."""
    found = repeated_lines(docs, min_words)
    runs = stored(
        found.groupBy(*DOC).agg(F.collect_list(F.struct("seq", "n")).alias("_runs")), "line-runs"
    )
    marked = docs.withColumn("_th", F.xxhash64("text")).withColumn("_id", F.col("doc_id").cast("long"))
    names = runs.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "_runs")
    maybe, rest = split_by(marked, names, "_id", "_th")
    _, on = meets(names, "_id", "_th")
    other = names.select(F.col("_id").alias("_k__id"), F.col("_th").alias("_k__th"), "_runs")
    joined = maybe.join(other, on, "left").drop("_k__id", "_k__th", "_id", "_th")
    order = [*docs.columns, "_deleted"]
    changed = _edited(joined.filter("_runs IS NOT NULL")).select(*order)
    same = joined.filter("_runs IS NULL").drop("_runs").withColumn("_deleted", F.lit(0))
    rest = rest.drop("_id", "_th").withColumn("_deleted", F.lit(0))
    return changed.unionByName(same.select(*order)).unionByName(rest.select(*order))


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """`docs` (doc_id, text, any other columns) without later copies of runs, plus deleted_lines.

    Runs are as in repeated_lines. Blank lines go with the line before them. Null and empty texts, and
    texts without a repeated run, stay as they are with deleted_lines 0. Rows that repeat doc_id and text
    are one document: the same lines go from each. A column deleted_lines of `docs` is replaced. No rows
    give no rows.
    """
    done = _deduped(docs, min_words)
    return done.drop("deleted_lines").withColumnRenamed("_deleted", "deleted_lines")


def documents_without_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """dedup_lines with the columns of `docs`; documents that lose all their words are left out."""
    done = _deduped(docs, min_words)
    return done.filter((F.col("_deleted") == 0) | F.col("text").rlike(WORD)).select(*docs.columns)
