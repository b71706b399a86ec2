import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import imatch

SCHEMA = "doc_id long, text string"


def h64(*values):
    """Hash of longs as the engine chains them."""
    out = 42
    for v in values:
        out = xxhash.xxh64(struct.pack("<Q", v % 2**64), seed=out).intdigest()
    return out


def codes(text):
    terms = set(re.findall(r"[0-9a-z\x80-\U0010ffff]+", text.lower()))
    return {xxhash.xxh64(t.encode(), seed=42).intdigest() % imatch.CODES for t in terms}


def brute_fingerprint(text, band):
    every = sorted(codes(text))
    terms = sorted(c for c in every if c in band)
    if not terms:
        spare = h64(*every) if every else xxhash.xxh64(text.encode(), seed=42).intdigest()
        terms = [spare - 2**64 if spare >= 2**63 else spare]
    out = f"{h64(*terms):016x}"
    for chain in range(imatch.CHAINS):
        # the chain's seed is an int: four bytes
        hashes = [xxhash.xxh64(struct.pack("<i", chain), seed=h64(t)).intdigest() & imatch.MASK for t in terms]
        bound = 1 << max(1, min(hashes).bit_length())
        value = h64(*[h for h in hashes if h < bound])
        out += f"{value & 0xFFFF:04x}"
    return out


def brute_likeness(a, b):
    links = range(imatch.WHOLE, len(a), imatch.LINK)
    return sum(a[i : i + 4] == b[i : i + 4] for i in links) / imatch.CHAINS


def brute(docs, low, high):
    texts = [(id, text or "") for id, text in docs]
    seen = Counter(c for _, text in texts for c in codes(text))
    band = {c for c, df in seen.items() if df * 2**low <= len(texts) <= df * 2**high}
    digest = {d: hashlib.sha256(f"{'-' if d[0] is None else d[0]} {d[1]}".encode()).digest() for d in texts}
    order = sorted(set(texts), key=lambda d: (d[0] is None, d[0] or 0, digest[d]))
    out = []
    for doc, after in zip(order, order[1:] + order[:1], strict=True):
        half = len(doc[1]) // 2
        edited = doc[1][: len(doc[1]) - half] + after[1][:half]
        own, new, following = (brute_fingerprint(t, band) for t in (doc[1], edited, after[1]))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        row = (str(doc[0]), len(doc[1]), sha, own, new, brute_likeness(own, new), brute_likeness(own, following))
        out += [row] * texts.count(doc)
    return sorted(out)


def result(frame):
    names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return sorted((str(r.doc_id), *[r[n] for n in names]) for r in frame.collect())


def corpus(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}é" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(draw.randrange(10**6) - 10, " ".join(draw.choices(words, weights, k=draw.randrange(40)))) for _ in range(n)]


EDGES = [
    (7, None),
    (8, ""),
    (9, "...!"),
    (10, "...!"),
    (11, "Rare words only"),
    (11, "another text of one id"),
    (12, "x 😀 Ü" * 3),
    (13, "w1é W2É w59é"),
    (13, "w1é W2É w59é"),
    (13, "w1é W2É w59é"),
    (None, "w3é w4é"),
    (None, "w3é w4é"),
    (None, None),
    (14, "w7é " * 30_000),
]


@pytest.mark.parametrize(("low", "high"), [(1, 5), (0, 30), (2, 2)])
def test_equals_brute_force(spark, low, high):
    docs = corpus(low, 150) + EDGES
    frame = spark.createDataFrame(docs, SCHEMA).repartition(5).withColumn("key", F.lit("clash"))
    assert result(imatch.fingerprints(frame.withColumn("index", F.lit(1)), low, high)) == brute(docs, low, high)


def test_one_document_follows_itself(spark):
    docs = [(5, "one two three four")]
    assert result(imatch.fingerprints(spark.createDataFrame(docs, SCHEMA))) == brute(docs, 6, 10)


def test_no_documents(spark):
    assert imatch.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0


def test_likeness_follows_the_shared_part(spark):
    """Texts that keep half of their terms are nearer than unrelated ones, and copies have likeness 1."""
    draw = random.Random(9)
    docs = [(i, " ".join(f"t{draw.randrange(3000)}" for _ in range(200))) for i in range(300)]
    docs += [(300 + i, docs[-1][1]) for i in range(3)]
    rows = {r.doc_id: r for r in imatch.fingerprints(spark.createDataFrame(docs, SCHEMA), 3, 10).collect()}
    assert rows[299].near_next == rows[300].near_next == 1.0
    assert rows[299].fingerprint == rows[302].fingerprint
    others = [rows[i] for i in range(299)]
    assert sum(r.near_edited for r in others) / 299 > 0.2
    assert sum(r.near_next for r in others) / 299 < 0.1


def test_main_path_runs_no_python(spark):
    plan = imatch.fingerprints(spark.createDataFrame(corpus(4, 20), SCHEMA).filter("doc_id > 0"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
