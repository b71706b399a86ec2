import random
import re

import pytest

from candlewick.llm import decontaminate as dc


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def brute_tiles(doc, item, k):
    """Greedy string tiling as defined: the longest unmarked match first, every pair of places tried."""
    marked_d, marked_i, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (
                    d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                    and not marked_d[d + n] and not marked_i[i + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < k:
            return tiles
        tiles.append(best)
        marked_d[d : d + n] = [True] * n
        marked_i[i : i + n] = [True] * n


def places(doc, item, k):
    def where(text):
        out = {}
        for p in range(len(text) - k + 1):
            out.setdefault(tuple(text[p : p + k]), []).append(p)
        return out

    in_doc, in_item = where(doc), where(item)
    return [(in_doc[gram], in_item[gram]) for gram in in_doc if gram in in_item]


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("search", [1, 2, 20])
def test_tiles_equal_definition(monkeypatch, seed, search):
    monkeypatch.setattr(dc, "SEARCH", search)
    rng = random.Random(seed)
    letters = "abc" if seed % 2 else "ab"
    item = [rng.choice(letters) for _ in range(25)]
    doc = [rng.choice(letters) for _ in range(60)]
    if seed > 6:
        cut = rng.randrange(25)
        doc[10:10] = item[cut:] + item[:cut]
    k = 3
    assert dc.tile(places(doc, item, k), k) == brute_tiles(doc, item, k)


def test_repeated_words_need_no_product_of_places():
    doc, item = ["r"] * 20_000, ["r"] * 200 + ["s"] * 5
    tiles = dc.tile(places(doc, item, 5), 5)
    assert tiles == [(200, 0, 0)]


def test_pairs_equal_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(rng.randint(8, 40)))) for i in range(12)]
    docs = []
    for d in range(40):
        text = [f"w{rng.randrange(40)}" for _ in range(30)]
        part = items[rng.randrange(12)][1].split()
        cut = rng.randint(0, len(part))
        blocks = [part[cut:], text[:10], part[:cut], text[10:]] if d % 2 else [text, part[:cut]]
        docs.append((d, (" , " if d % 3 else "\n").join(w.upper() for b in blocks for w in b)))
    want = {}
    for d, text in docs:
        for i, item in items:
            tiles = brute_tiles(words(text), words(item), 5)
            share = sum(n for n, _, _ in tiles) / len(words(item))
            if share >= 0.5:
                want[d, i] = (round(share, 9), len(tiles), tiles[0][0])
    got = dc.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id): (round(r.coverage, 9), r.tiles, r.longest) for r in got} == want
    assert len(want) > 10


def test_odd_rows(spark):
    item = " ".join(f"Q{i}" for i in range(20))
    benchmark = spark.createDataFrame(
        [(1, item, "x"), (1, item, "y"), (2, None, None), (3, "two words", None), (None, "", None),
         (None, "é é é é é é", None), (4, " ".join(["r"] * 9), None)], "item_id long, text string, doc_id string",
    )
    half = " ".join(f"q{i}" for i in range(10, 20)) + " !! " + " ".join(f"q{i}" for i in range(10))
    docs = spark.createDataFrame(
        [(1, half, 1), (1, half, 2), (1, "clean", 3), (2, None, 4), (3, "", 5), (None, f"x {item}", 6),
         (4, "has two words in it", 7), (5, "q1 q2 q3 q4 q5", 8), (6, "É" + " é" * 9, 9), (7, "r " * 3000, 1)],
        "doc_id long, text string, item_id int",
    )
    got = {(r.doc_id, r.item_id, r.coverage) for r in dc.contaminated(docs, benchmark).collect()}
    assert got == {(1, 1, 1.0), (None, 1, 1.0), (4, 3, 1.0), (6, None, 1.0), (7, 4, 1.0)}
    kept = dc.uncontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.item_id for r in kept.collect()) == [3, 4, 5, 8]
    assert dc.contaminated(docs.limit(0), benchmark).count() == 0
    assert dc.uncontaminated(docs, benchmark.limit(0)).count() == 10
