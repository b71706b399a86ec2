import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import divergence as dv

SCHEMA = "doc_id long, text string, lang string, source string"


def brute(docs, min_docs=10):
    """Every group and peer, term by term, with Python's unbounded integers."""
    found = [
        (lang or "", source or "", re.findall(r"[a-z\x80-\U0010ffff]+", lower(text or ""))) for _, text, lang, source in docs
    ]
    out = []
    for lang in {d[0] for d in found}:
        own = [d for d in found if d[0] == lang]
        seen = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in seen.items() if n >= min_docs}
        whole = Counter(t for d in own for t in d[2] if t in kept)
        groups = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            groups[s].update(t for t in terms if t in kept)

        def share(counts, t, v=len(kept)):
            return 1 + 10**9 * (counts[t] + 2) // (sum(counts.values()) + 2 * v)

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        shares = {s: {t: share(c, t) for t in kept} for s, c in groups.items()}
        base = {t: share(whole, t) for t in kept}
        for s, counts in groups.items():
            rows = [(sum(gap(shares[s][t], shares[o][t]) for t in kept), o) for o in groups if o != s]
            out += ranked(lang, s, "pair", rows)
            rows = [(gap(shares[s][t], base[t]), t) for t in kept if counts[t] and shares[s][t] > base[t]]
            out += ranked(lang, s, "term", rows)[:10]
    return sorted(out)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def ranked(lang, source, part, rows):
    rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))
    return [(lang, source, part, item, value, i) for i, (value, item) in enumerate(rows, 1)]


def corpus(seed, sources, docs):
    draw = random.Random(seed)
    words = [f"{a}{b}" for a in ("Ab", "é", "co", "Ünd", "zz") for b in "abcdefgh"]
    rows = []
    for i in range(docs):
        source = f"s{min(draw.randrange(sources), draw.randrange(sources))}" if draw.random() < 0.95 else None
        own = words[: 5 + int(source[1:]) % 3 * 10] if source else words
        text = " ".join(draw.choice(own) for _ in range(draw.randrange(30))) + draw.choice(["", "1 x-y", "_É"])
        rows.append((i, text, draw.choice(["en", "en", "de", None]), source))
    return rows


def result(frame):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in frame.collect())


EDGES = [
    (1, None, "en", "quiet"),
    (2, "", "en", ""),
    (2, "", "en", ""),
    (3, "once only", "lone", "one"),
    (4, "never", "few", "a"),
    (5, "kept", "few", "b"),
    (6, "word " * 300_000, "en", "long"),
]


@pytest.mark.parametrize(("peers", "postings"), [(256, 1 << 19), (3, 40), (1, 10**6)])
def test_equals_brute_force(spark, monkeypatch, peers, postings):
    monkeypatch.setattr(dv, "PEERS", peers)
    monkeypatch.setattr(dv, "POSTINGS", postings)
    docs = corpus(1, 9, 400) + EDGES
    frame = spark.createDataFrame(docs, SCHEMA).withColumn("term", F.lit("clash")).withColumn("n", F.lit(1))
    assert result(dv.divergence(frame)) == brute(docs)


def test_no_documents(spark):
    assert dv.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    draw = random.Random(3)
    cases = [(draw.randrange(n + 1), n) for n in (draw.randrange(1, 9 * 10**15) for _ in range(200))]
    want = [1 + 10**9 * c // n for c, n in cases]
    assert dv._share(*np.array(cases).T).tolist() == want
    frame = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, c long, n long")
    got = frame.select("i", dv.share(F.col("c"), F.col("n")).alias("p")).orderBy("i").collect()
    assert [r.p for r in got] == want


def test_long_texts_are_counted_in_pieces(monkeypatch):
    monkeypatch.setattr(dv, "CHUNK", 7)
    text = "Abc défgh  ijklmnopqrstuvw x, y z".encode()
    assert dv.terms_of(text) == Counter(re.findall(rb"[a-z\x80-\xff]+", text.lower()))
