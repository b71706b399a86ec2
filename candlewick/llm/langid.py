"""Language identification as inference of a mixture.

A document's character trigrams come from several languages in unknown proportions. Expectation
maximisation estimates the proportions from each language's trigram likelihoods; the set of languages is
the one with the best likelihood less a penalty for every language.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import mix, sliced
from candlewick.sources.storage import stored

BUCKETS = 1 << 16  # trigrams are hashed to this many
SMOOTH = 0.5
SLICE = 1 << 18  # characters counted at once
ROUNDS = 60
CLOSE = 1e-4  # the largest change of a proportion at which the estimate is taken as settled
#: Likelihood that a further language must add, in units of the log of the trigrams' number; trigrams
#: overlap, so they tell less than as many independent draws.
PENALTY = 3.0
UNKNOWN = "und"


@dataclass(frozen=True)
class Model:
    """languages, and log likelihoods of the trigram buckets as (BUCKETS, languages)."""

    languages: list[str]
    logs: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


def _grams(text: str) -> Iterator[np.ndarray]:
    """Buckets of the trigrams around every letter, a slice of the text at a time.

    What is no letter counts as one and the same character, so only spelling and word ends tell.
    """
    table = _letters()
    for low in range(0, len(text), SLICE):
        part = text[max(0, low - 1) : low + SLICE + 1].lower()
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = np.concatenate(([0], codes, [0])).astype(np.uint64)
        letter = table[codes]
        codes[~letter] = 0
        at = np.flatnonzero(letter)
        # A neighbouring slice counts the letters that were read only as context.
        at = at[(at > (low > 0)) & (at < len(codes) - 1 - (low + SLICE < len(text)))]
        gram = codes[at - 1] << np.uint64(42) | codes[at] << np.uint64(21) | codes[at + 1]
        yield (mix(gram) >> np.uint64(48)).astype(np.int64)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of a whole text."""
    parts = list(_grams(text))
    if len(parts) == 1:
        return np.unique(parts[0], return_counts=True)
    dense = np.zeros(BUCKETS, dtype=np.int64)
    for part in parts:
        dense += np.bincount(part, minlength=BUCKETS)
    some = np.flatnonzero(dense)
    return some, dense[some]


def _settle(likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions of the columns by expectation maximisation, and their log likelihood."""
    n, share = counts.sum(), np.full(likely.shape[1], 1 / likely.shape[1])
    for _ in range(ROUNDS):
        last = share
        share = share * (likely.T @ (counts / (likely @ share))) / n
        if np.abs(share - last).max() < CLOSE:
            break
    share = share / share.sum()
    return share, float(counts @ np.log(likely @ share))


def proportions(model: Model, buckets: np.ndarray, counts: np.ndarray) -> dict[str, float]:
    """Language shares of a document: largest first, ties by name; empty without letters."""
    if not len(buckets) or not model.languages:
        return {}
    logs = model.logs[buckets]
    # A bucket's likelihoods only matter relative to each other.
    likely = np.exp(logs - logs.max(axis=1, keepdims=True))
    every, _ = _settle(likely, counts)
    order = np.argsort(-every, kind="stable")
    fee = PENALTY * np.log(counts.sum() + 1)
    alone = counts @ np.log(likely + 1e-300)
    first = int(np.argmax(alone))
    order = [first, *[i for i in order if i != first]]
    best, share = float(alone[first]), np.ones(1)
    for k in range(2, len(order) + 1):
        more, fit = _settle(likely[:, order[:k]], counts)
        if fit - fee <= best:
            break
        best, share = fit - fee, more
    named = [(model.languages[i], float(s)) for i, s in zip(order, share, strict=False)]
    return dict(sorted(named, key=lambda x: (-x[1], x[0])))


def train(
    docs: DataFrame, per_language: int = 2000, most_languages: int = 256, seed: int = 11
) -> Model:
    """Trigram model of the languages in `docs` (text, lang).

    Rows with a null text or lang teach nothing. It is fitted on a sample that is bounded in both
    parameters: the `most_languages` most frequent languages, and about `per_language` documents of each,
    chosen by a hash. No usable rows give a model without languages.
    """
    spark = docs.sparkSession
    usable = docs.filter("text IS NOT NULL AND lang IS NOT NULL")
    key = [F.col(c) for c in ("doc_id", "text") if c in docs.columns]  # copies of a text are drawn apart
    draw = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    usable = usable.select("text", "lang", draw.alias("draw"))
    sizes = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    sizes = sorted(map(tuple, sizes.collect()))
    if not sizes:
        return Model([], np.zeros((BUCKETS, 0)))
    rates = spark.createDataFrame(
        [(i, name, per_language / n) for i, (name, n) in enumerate(sizes)], "l int, lang string, rate double"
    )
    sample = usable.join(F.broadcast(rates), "lang").filter("draw < rate").select("l", "text")
    count = len(sizes)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((count, BUCKETS), dtype=np.int64)
        for batch in sliced(batches):
            pairs = zip(batch.column("l").to_pylist(), batch.column("text").to_pylist(), strict=True)
            for l, text in pairs:  # noqa: E741
                for part in _grams(text):
                    dense[l] += np.bincount(part, minlength=BUCKETS)
        l, bucket = np.nonzero(dense)  # noqa: E741
        yield pa.RecordBatch.from_pydict(
            {"l": l.astype(np.int32), "bucket": bucket.astype(np.int32), "n": dense[l, bucket]}
        )

    tallied = sample.mapInArrow(tally, "l int, bucket int, n long")
    tallied = tallied.groupBy("l", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((BUCKETS, count))
    counts[tallied["bucket"], tallied["l"]] = tallied["n"]
    used = counts.sum(axis=0) > 0
    counts = counts[:, used]
    logs = np.log((counts + SMOOTH) / (counts.sum(axis=0) + SMOOTH * BUCKETS))
    return Model([name for (name, _), u in zip(sizes, used, strict=True) if u], logs)


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The `keep` columns of `docs` with lang_pred, score (its share, 0 to 1) and languages (all shares).

    Only the whole text is looked at. A text that is null or has no letter, and any text under a model
    without languages, gets lang_pred "und", score 0 and no languages. Of equal shares the first name
    wins. Repeated rows are judged alike; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema
    names = [f"_c{i}" for i in range(len(keep))]
    renamed = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names, strict=True)], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            lang, score, every = [], [], []
            for text in batch.column("text").to_pylist():
                found = proportions(shared.value, *gram_counts(text)) if text else {}
                top = next(iter(found), UNKNOWN)
                lang.append(top)
                score.append(min(1.0, found.get(top, 0.0)))
                every.append(",".join(f"{k}:{v:.3f}" for k, v in found.items()))
            columns = [batch.column(n) for n in names]
            new = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*columns, *new], names=[*names, "lang_pred", "score", "languages"]
            )

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema, strict=True))
    fields = fields + ", " if fields else ""
    found = renamed.mapInArrow(run, f"{fields}lang_pred string, score double, languages string")
    return found.select(
        *[F.col(n).alias(c) for c, n in zip(keep, names, strict=True)], "lang_pred", "score", "languages"
    )


def held_out(doc_id) -> F.col:
    """Whether a document is kept from training: CRC-32 of its id leaves 2 by 4. A null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def documents_with_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """`docs` without the documents of which no language has `least` of the letters."""
    known = docs.filter("doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
    model = train(known)
    if not model.languages:  # nothing to judge by
        return docs
    kept = [f"_d{i}" for i in range(len(docs.columns))]  # names that the verdict's can't clash with
    given = docs.select(*[F.col(c).alias(n) for c, n in zip(docs.columns, kept, strict=True)], "text")
    judged = identify(given, model, kept)
    judged = judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return judged.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, kept, strict=True)])
