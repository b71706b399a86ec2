import random

import pytest

from candlewick.llm import linededup


def brute(docs, least):
    """Line numbers, blank ones not counted, that are later copies: every pair of starts is compared."""
    lines = [[x.strip() for x in (t or "").split("\n") if x.strip()] for _, t in docs]
    order = sorted(range(len(docs)), key=lambda d: (docs[d][0] is None, docs[d][0] or 0))
    gone = {d: set() for d in range(len(docs))}
    before = []
    for d in order:
        for i in range(len(lines[d])):
            for e, j in before:
                n = 0
                while (
                    i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n] == lines[e][j + n]
                ):
                    n += 1
                if n and sum(len(x.split()) for x in lines[d][i : i + n]) >= least:
                    gone[d].update(range(i, i + n))
            before.append((d, i))
    return {d: [x for k, x in enumerate(lines[d]) if k not in gone[d]] for d in gone}


def random_docs(rng, n, letters):
    pool = [[rng.choice(letters) for _ in range(rng.randint(2, 9))] for _ in range(6)]
    docs = []
    for d in range(n):
        lines = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(pool)
            cut = sorted(rng.sample(range(len(part) + 1), 2))
            lines += part[cut[0] : cut[1]] if rng.random() < 0.7 else [f"own {d} {rng.random()}"]
            lines += [" "] * rng.randint(0, 1)
        docs.append((d, "\n".join(lines)))
    return docs


@pytest.mark.parametrize(("seed", "group"), [(1, 1024), (2, 1), (3, 4)])
def test_equals_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(linededup, "GROUP", group)
    rng = random.Random(seed)
    letters = [" ".join([c] * rng.randint(1, 6)) for c in "abcdefgh"[: 3 + 2 * seed]]
    docs = random_docs(rng, 30, letters)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    least = [4, 7, 12][seed - 1]
    got = {
        r.doc_id: [x.strip() for x in r.text.split("\n") if x.strip()]
        for r in linededup.dedup_lines(frame, least).collect()
    }
    assert got == brute(docs, least)


def test_ranks_are_a_suffix_array(spark):
    rng = random.Random(5)
    texts = [[rng.choice("ab") for _ in range(rng.randint(1, 20))] for _ in range(8)]
    rows = [(s, i, ord(c), 0) for s, t in enumerate(texts) for i, c in enumerate(t)]
    frame = spark.createDataFrame(rows, "sid long, i int, h long, g int")
    got = {(r.sid, r.i): r["rank"] for r in linededup.suffix_ranks(frame, 20).collect()}
    suffixes = {(s, i): tuple(t[i:]) for s, t in enumerate(texts) for i in range(len(t))}
    dense = {x: n for n, x in enumerate(sorted(set(suffixes.values())))}
    assert got == {k: dense[v] for k, v in suffixes.items()}


def test_planted_and_odd_rows(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    two = " ".join(f"left{i}" for i in range(30)) + "\n\n" + " ".join(f"right{i}" for i in range(30))
    rows = [
        (1, f"start one\n{passage}\nend one", 9, "a"), (2, f"start two\n  {passage} \nend two", 9, "b"),
        (3, f"x\n{two}\ny", 9, None), (4, f"{two}\nz", None, None), (4, f"{two}\nz", None, None),
        (None, f"n\n{passage}", 1, "c"), (5, None, 1, "c"), (6, "", 1, "c"), (7, "short\nshort", 1, "c"),
        (8, passage, 2, "d"), (8, "other text", 2, "d"), (9, f"{passage}\n{passage}\nself", 3, "e"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, deleted_lines int, seq string")
    got = linededup.dedup_lines(frame).collect()
    assert frame.columns[:2] + ["seq", "deleted_lines"] == linededup.dedup_lines(frame).columns
    seen = sorted((str(r.doc_id), r.text or "", r.deleted_lines) for r in got)
    assert seen == sorted([
        ("1", f"start one\n{passage}\nend one", 0), ("2", "start two\nend two", 1), ("3", f"x\n{two}\ny", 0),
        ("4", "z", 2), ("4", "z", 2), ("None", "n", 1), ("5", "", 0), ("6", "", 0), ("7", "short\nshort", 0),
        ("8", "", 1), ("8", "other text", 0), ("9", "self", 2),
    ])
    kept = linededup.documents_without_repeats(frame)
    assert kept.columns == frame.columns and kept.count() == 11
    assert linededup.dedup_lines(frame.limit(0)).count() == 0
    assert linededup.dedup_lines(frame.filter("text IS NULL")).count() == 1
