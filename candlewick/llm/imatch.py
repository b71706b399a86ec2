"""I-Match fingerprints of texts and of edited texts, with DataFrame functions only.

A term is a run of letters and digits in lower case; it is told from others by `CODES` values of its hash, and
terms that share a value count as one. The lexicon holds the terms whose inverse document frequency, the
binary logarithm of documents over documents with the term, lies in a band. Its lower edge drops words
that say nothing, also those of a language with a few hundredths of the documents, its upper edge rare ones. Every share of all documents has a place for a
bounded number of terms only, and there are `CODES` at most, so the lexicon stays small enough to be sent to every task.

The terms that a text has of the lexicon are made distinct, sorted and hashed. This is done for the whole lexicon
and for `CHAINS` chains of random subsets. A chain halves the lexicon again and again; a text is hashed under the
smallest subset of the chain in which it has a term. So long and short texts alike are judged by a few terms a
chain, and the likeness of two fingerprints, the share of chains with equal hashes, falls as their terms differ.
A text without terms of the lexicon is hashed with all its terms, one without any as it is.

Rows: a null text is empty. Documents follow each other by id, those without an id last, equal ids by a digest
of id and text; after the last comes the first, so a single document is its own next. Rows that repeat id and
text are one document in this order, and each of them gets its result. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import split_by
from candlewick.sources.storage import stored

#: Whatever is no letter or digit; every character beyond ASCII counts as a letter.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CODES = 1 << 22
CHAINS = 16
#: Hexadecimal digits of the hash of the whole lexicon and of each chain.
WHOLE, LINK = 16, 4
MASK = (1 << 62) - 1


def codes(text: Column) -> Column:
    """The distinct terms of a text, as numbers below CODES."""
    terms = F.array_remove(F.split(F.lower(text), GAP), "")
    return F.array_distinct(F.transform(terms, lambda t: F.pmod(F.xxhash64(t), F.lit(CODES))))


def lexicon(docs: DataFrame, idf_low: int, idf_high: int) -> DataFrame:
    """(code) of the terms in the band, counted over all rows."""
    n = docs.count()
    seen = docs.select(F.explode(codes(F.col("text"))).alias("code")).groupBy("code").agg(F.count("*").alias("df"))
    inside = (F.col("df") * 2**idf_low <= n) & (F.col("df") * 2**idf_high >= n)
    return stored(seen.filter(inside).select("code"), "lexicon")


def _in_order(docs: DataFrame) -> DataFrame:
    """(key, index, doc_id, copies, n, next, before_key, before_half): every document between its neighbours."""
    order = ["nameless", "doc_id", "key"]
    rows = docs.groupBy("doc_id", "key").agg(F.count("*").alias("copies"), F.max(F.length("text")).alias("n"))
    cut = stored(
        rows.withColumn("nameless", F.col("doc_id").isNull())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id()),
        "document-order",
    )
    part = F.shiftright("id", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    bases = (
        cut.groupBy(part.alias("part"))
        .count()
        .select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("base"))
    )
    total = cut.count()
    index = F.col("base") + F.col("id").bitwiseAND((1 << 33) - 1)
    placed = (
        cut.withColumn("part", part)
        .join(F.broadcast(bases), "part")
        .select("key", "doc_id", "copies", "n", index.alias("index"))
    )
    after = placed.select(
        F.pmod(F.col("index") + 1, F.lit(total)).alias("index"),
        F.col("key").alias("before_key"),
        F.expr("n div 2").cast("int").alias("before_half"),
    )
    linked = placed.join(after, "index").withColumn("next", F.pmod(F.col("index") + 1, F.lit(total)))
    return stored(linked, "document-links")


def edited(docs: DataFrame) -> DataFrame:
    """Each document with its edited text: its last half replaced by the start of the next document."""
    text = F.coalesce("text", F.lit(""))
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.unhex(F.sha2(F.concat(name, F.lit(" "), text), 256)).alias("key"),
    )
    links = _in_order(keyed)
    texts = keyed.select("key", "text")
    repeated = links.filter("copies > 1").select("key")
    if not repeated.isEmpty():
        maybe, rest = split_by(texts, repeated, "key")
        texts = maybe.dropDuplicates(["key"]).unionByName(rest)
    met = texts.join(links, "key")
    starts = met.select(F.col("before_key").alias("key"), F.expr("substring(text, 1, before_half)").alias("start"))
    return met.join(starts, "key").select(
        "key", "index", "next", "doc_id", "copies", "n", "text",
        F.concat(F.expr("substring(text, 1, cast(n - n div 2 AS int))"), "start").alias("edited"),
    )


def _chain(terms: Column, chain: int) -> Column:
    """Hash of the sorted terms in the smallest subset of a chain that holds any of them.

    The k-th subset has the terms whose hash under the chain is below MASK >> k.
    """
    hashes = F.transform(terms, lambda t: F.xxhash64(t, F.lit(chain)).bitwiseAND(F.lit(MASK)))

    def smallest(of: Column) -> Column:
        # The bound is a field here, so it is computed once and not for every term.
        return F.xxhash64(F.filter(of["hashes"], lambda h: h < of["bound"]))

    return F.transform(F.transform(F.array(hashes), _bounded), smallest)[0]


def _bounded(hashes: Column) -> Column:
    """Hashes with the least power of two above the smallest one."""
    bits = F.length(F.bin(F.array_min(hashes)))
    return F.struct(hashes.alias("hashes"), F.call_function("shiftleft", F.lit(1).cast("long"), bits).alias("bound"))


def _digits(x: Column, n: int) -> Column:
    return F.lower(F.substring(F.lpad(F.hex(x), 16, "0"), 17 - n, n))


def fingerprint(terms: Column) -> Column:
    """WHOLE + CHAINS * LINK hexadecimal digits from sorted distinct terms."""
    chains = [_digits(_chain(terms, i), LINK) for i in range(CHAINS)]
    return F.concat(_digits(F.xxhash64(terms), WHOLE), *chains)


def likeness(a: Column, b: Column) -> Column:
    """Share of chains under which two fingerprints agree."""
    places = [WHOLE + 1 + i * LINK for i in range(CHAINS)]
    same = [(F.substring(a, p, LINK) == F.substring(b, p, LINK)).cast("int") for p in places]
    return sum(same[1:], same[0]) / F.lit(float(CHAINS))


def _otherwise(own: Column, text: Column) -> Column:
    """What stands for a text without terms of the lexicon."""
    return F.when(F.size(own) > 0, F.xxhash64(F.sort_array(own))).otherwise(F.xxhash64(text))


def fingerprints(docs: DataFrame, idf_low: int = 6, idf_high: int = 10) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row."""
    band = lexicon(docs, idf_low, idf_high)
    both = edited(docs).select(
        "key",
        F.struct("index", "next", "doc_id", "copies", "n", F.sha2("edited", 256).alias("sha")).alias("about"),
        "text",
        "edited",
        codes(F.col("text")).alias("own"),
        codes(F.col("edited")).alias("new"),
    )
    # One row for each term of either text, and one, numbered -1, for the document itself. All else is computed
    # before the rows multiply.
    marked = both.select(
        "key",
        F.struct(
            "about.*",
            _otherwise(F.col("own"), F.col("text")).alias("spare"),
            _otherwise(F.col("new"), F.col("edited")).alias("new_spare"),
        ).alias("about"),
        F.concat(
            F.array(F.lit(-1).cast("long")),
            F.transform("own", lambda c: c * 2),
            F.transform("new", lambda c: c * 2 + 1),
        ).alias("terms"),
    )
    terms = marked.select("key", "about", F.explode("terms").alias("term"))
    kept = band.unionByName(band.sparkSession.range(1).select(F.lit(-1).cast("long").alias("code")))
    found = (
        terms.withColumn("code", F.shiftright("term", 1))
        .join(F.broadcast(kept), "code")
        .groupBy("key")
        .agg(
            F.max(F.when(F.col("term") == -1, F.col("about"))).alias("about"),
            F.collect_list(F.when(F.col("term") >= 0, F.col("term"))).alias("terms"),
        )
    )

    def sorted_terms(rest: int, spare: str) -> Column:
        own = F.transform(
            F.filter("terms", lambda t: t.bitwiseAND(F.lit(1)) == rest), lambda t: F.shiftright(t, 1)
        )
        return F.when(F.size(own) > 0, F.sort_array(own)).otherwise(F.array(F.col(spare)))

    prints = stored(
        found.select("about.*", "terms")
        .withColumn("own", sorted_terms(0, "spare"))
        .withColumn("new", sorted_terms(1, "new_spare"))
        .select(
            "index", "next", "doc_id", "copies", "n", "sha",
            fingerprint(F.col("own")).alias("fingerprint"),
            fingerprint(F.col("new")).alias("edited_fingerprint"),
        ),
        "fingerprints",
    )
    following = prints.select(F.col("index").alias("next"), F.col("fingerprint").alias("next_fingerprint"))
    return (
        prints.join(following, "next")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_chars"),
            F.col("sha").alias("edited_sha256"),
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        )
    )
