"""License scan by diagonal voting.

Rolling hashes of all word k-grams of the documents are joined to the positions of the same k-grams in
license templates. A match votes for its diagonal, the distance between both positions. Neighbouring
diagonals are merged, as lost or added words move a match to the next one, and the spans they mark are
verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.llm.common import (
    ALNUM,
    batch_word_hashes,
    bytes_of,
    shingle_hashes,
    sliced,
    spans,
    split_by,
)
from candlewick.sources.storage import stored

K = 3  # words in a k-gram: as many as the shortest phrase has

# Phrases that name a license wherever their words stand in a row.
PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Further wordings, of which one word in ten may differ.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl-2", "mozilla public license version 2"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced"),
)

TEMPLATES = [(label, text.encode().split(), True) for label, text in PHRASES] + [
    (label, text.encode().split(), False) for label, text in NOTICES
]
EVERY = -1  # template of the mark that each document carries besides its k-grams
MARK = np.uint64(0)


def _table(spark: SparkSession) -> DataFrame:
    """(hash, template, tpos) of the templates' k-grams, and of the mark."""
    rows = [(int(MARK.view(np.int64)), EVERY, 0)]
    for number, (_, words, _) in enumerate(TEMPLATES):
        for _, hashes, _ in batch_word_hashes([b" ".join(words)], ALNUM):
            grams = shingle_hashes(hashes, K).view(np.int64)
            rows += [(int(g), number, at) for at, g in enumerate(grams)]
    return spark.createDataFrame(rows, "hash long, template int, tpos int")


def _grams(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_words, hashes): the mark, then all k-gram hashes of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t.lower() for t in bytes_of(batch.column("text"))]  # bytes: A-Z only
            counts, lists, low = [], [], 0

            def out(high: int, low: int, counts: list, lists: list, batch=batch) -> pa.RecordBatch:
                ends = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
                values = np.concatenate(lists).view(np.int64)
                arrays = [
                    batch.column("doc_id").slice(low, high - low),
                    batch.column("th").slice(low, high - low),
                    pa.array(counts, pa.int64()),
                    pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(values)).cast(
                        pa.list_(pa.int64())
                    ),
                ]
                return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "th", "n_words", "hashes"])

            size = 0
            for at, hashes, _ in batch_word_hashes(texts, ALNUM):
                counts.append(len(hashes))
                lists.append(np.concatenate(([MARK], shingle_hashes(hashes, K))))
                size += len(hashes)
                if size > 1 << 19:
                    yield out(at + 1, low, counts, lists)
                    counts, lists, low, size = [], [], at + 1, 0
            if counts:
                yield out(len(texts), low, counts, lists)

    return docs.mapInArrow(run, "doc_id long, th long, n_words long, hashes array<long>")


def _common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence; b is a template and so short."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "th", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    types = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
    for batch in sliced(batches):
        rows = []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "th", "found"))
        for doc_id, th, found, text in zip(*columns, bytes_of(batch.column("text")), strict=True):
            text = text.lower()
            begin, end = spans(np.frombuffer(text, dtype=np.uint8), ALNUM)
            places, base, labels, score = [], set(), set(), 0.0
            for span in found:
                label, words, phrase = TEMPLATES[span["template"]]
                low, high = max(0, span["low"]), min(len(begin), span["high"])
                here = [text[s:e] for s, e in zip(begin[low:high], end[low:high], strict=True)]
                if phrase:
                    share = float(here == words)
                    if share:
                        places.append(low)
                        base.add(label)
                else:
                    share = _common(here, words) / len(words)
                    share = share if (1 - share) * len(words) <= len(words) // 10 + 1e-9 else 0.0
                if share:
                    labels.add(label)
                    score = max(score, share)
            if labels:
                rows.append((
                    doc_id, th, len(places), min(places, default=None), max(places, default=None),
                    ",".join(sorted(base)), ",".join(sorted(labels)), score,
                ))
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row for every row of `docs` (doc_id, text, any other columns): doc_id, n_words, n_base (places
    of a phrase), first_word and last_word (smallest and largest of them, from 0; null without), base_labels
    and labels (distinct, sorted, comma-joined; with those of notices), score (1 for a phrase, the share of
    its words for the best notice, 0 without).

    Words are ASCII letters and digits and characters beyond ASCII, A-Z in lower case. Null and empty texts
    have no words and no labels. Repeated rows are judged alike; null ids are kept; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    exploded = _grams(rows).select("doc_id", "th", "n_words", F.posexplode("hashes").alias("at", "hash"))
    # The templates are fixed, so the table is small at any input size.
    hits = exploded.join(F.broadcast(_table(spark)), "hash").select(
        "doc_id", "th", "n_words", "template", (F.col("at") - 1 - F.col("tpos")).alias("diagonal"), "tpos"
    )
    hits = stored(hits, "license-hits")
    votes = (
        hits.filter(F.col("template") != EVERY)
        .groupBy("doc_id", "th", "template", "diagonal")
        .agg(F.min("tpos").alias("low"), F.max("tpos").alias("high"), F.count_distinct("tpos").alias("votes"))
    )
    lengths = [len(words) for _, words, _ in TEMPLATES]
    phrase = F.array(*[F.lit(p) for _, _, p in TEMPLATES])[F.col("template")]
    size = F.array(*[F.lit(n) for n in lengths])[F.col("template")]
    along = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    # A phrase stands on one diagonal; a notice with n words may spread over n // 10 each way.
    new = phrase | (F.col("diagonal") - F.lag("diagonal").over(along) > size / 10)
    merged = (
        votes.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
        .withColumn("island", F.sum("new").over(along))
        .groupBy("doc_id", "th", "template", "island")
        .agg(
            F.sum("votes").alias("votes"),
            F.min(F.col("diagonal") + F.col("low")).alias("first"),
            F.max(F.col("diagonal") + F.col("high")).alias("last"),
            F.min("diagonal").alias("least"),
            F.max("diagonal").alias("most"),
        )
    )
    # A word that differs spoils K votes.
    needed = F.when(phrase, size - K + 1).otherwise(
        F.greatest(F.lit(1), size - K + 1 - K * F.floor(size / 10))
    )
    found = merged.filter(F.col("votes") >= needed).select(
        "doc_id", "th",
        F.struct(
            "template",
            F.least("first", "least").cast("long").alias("low"),
            F.greatest(F.col("last") + K, F.col("most") + size).cast("long").alias("high"),
        ).alias("span"),
    )
    found = stored(found.groupBy("doc_id", "th").agg(F.collect_list("span").alias("found")), "license-spans")
    maybe, _ = split_by(rows, found, "doc_id", "th")
    # Rows that share id and text are verified once.
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))
    given = maybe.join(
        found.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "found"), on
    ).select("doc_id", "th", "found", "text")
    schema = (
        "doc_id long, th long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double"
    )
    judged = given.mapInArrow(_verified, schema).dropDuplicates(["doc_id", "th"])
    judged = judged.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    every = hits.filter(F.col("template") == EVERY).select("doc_id", "th", "n_words")
    return every.join(judged, on, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
