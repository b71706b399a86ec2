import random

import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import simhash
from candlewick.llm.graph import components

ROW = "doc_id long, text string, doc_hint string"


def brute_fp(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    values = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(v >> b & 1 for v in values) > len(values)) << b for b in range(64))


def brute_components(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
                root[find(a)] = find(b)
    out = {}
    for f in fps:
        out.setdefault(find(f), set()).add(f)
    return sorted(map(sorted, out.values()))


def groups(rows):
    out = {}
    for a, b in rows:
        out.setdefault(b, set()).add(a)
    return sorted(map(sorted, out.values()))


def as_long(x):
    return x - 2**64 if x >> 63 else x


def test_fingerprint_equals_definition():
    rng = random.Random(1)
    for n in (0, 1, 3, 4, 5, 60):
        text = "\t\n ".join(rng.choice(["Aé", "b", "C", "ddd"]) for _ in range(n))
        assert simhash.fingerprint(text.encode(), 4) == brute_fp(text)


def test_long_text_in_slices(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(500))
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text.encode(), 4) == brute_fp(text)


def test_same_hash_as_sql(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert got == as_long(xxhash.xxh64_intdigest(b"a b c d", 42))


@pytest.mark.parametrize("distance", [1, 3, 4, 5])
def test_links_equal_brute_force(spark, distance):
    rng = random.Random(distance)
    fps = {0, 2**64 - 1}
    for _ in range(6):  # clusters whose members share most variants, and chains
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = {as_long(x) for x in fps}
    frame = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = groups(map(tuple, simhash.links(frame, distance).select("fp", "root").collect()))
    assert got == [g for g in brute_components(fps, distance) if len(g) > 1]


def test_components_of_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7 + 1)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, components(frame).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(frame.limit(0)).count() == 0


def test_nulls_repeats_and_order(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [
        (7, text, "x"), (3, text.upper(), "y"), (3, text, None), (9, None, "z"), (8, "", "z"),
        (None, " \n ", "n"), (None, "alone in the world today", None), (5, "Only Three words", "q"),
    ]
    docs = spark.createDataFrame(rows, ROW)
    got = sorted(
        (r.doc_id is None, r.doc_id or 0, r.fp == 0, r.component_id)
        for r in simhash.simhash_components(docs).collect()
    )
    assert got == [
        (False, 3, False, 3), (False, 3, False, 3), (False, 5, False, 5), (False, 7, False, 3),
        (False, 8, True, 8), (False, 9, True, 8), (True, 0, False, None), (True, 0, True, 8),
    ]
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.keep_one(docs).collect())
    assert kept == [(False, 3), (False, 5), (False, 8), (True, 0), (True, 0)]
    assert simhash.keep_one(docs).columns == docs.columns
    assert simhash.simhash_components(docs.limit(0)).count() == 0
