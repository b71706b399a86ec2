from itertools import permutations

import pytest
from pyspark.sql import functions as F

from candlewick.llm import filteraudit as fa

LONG = " ".join(f"w{i}" for i in range(120))


def brute(docs, labels):
    """Sets of failing filters by the contract's words, then counts for every order."""
    marks = {}
    for id, quality, toxic in labels:
        good, bad = marks.get(id, (False, False))
        marks[id] = (good or quality == 1, bad or toxic == 1)
    texts = [(id, text or "") for id, text, _ in docs]
    parts = {}
    for id, text, lang in docs:
        text = text or ""
        words = [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]
        caps = sum("A" <= c <= "Z" for c in text)
        fails = "".join(
            letter
            for letter, failed in zip(
                "ABCDE",
                (
                    len(words) < 100,
                    100 * len(set(words)) < 80 * len(words),
                    100 * caps > 10 * len(text),
                    any(c in "#$%&*|" for c in text),
                    id is not None and any(o is not None and o < id and t == text for o, t in texts),
                ),
                strict=True,
            )
            if failed
        )
        good, toxic = marks.get(id, (False, False)) if id is not None else (False, False)
        parts.setdefault(lang or "", []).append((fails, good, toxic))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(rows)
            for step, letter in enumerate(order, 1):
                here = [r for r in left if letter in r[0]]
                left = [r for r in left if letter not in r[0]]
                failing = [r for r in rows if letter in r[0]]
                total[letter] += len(here)
                out[part, order, step] = [
                    len(left),
                    len(here),
                    len(failing) - len(here),
                    sum(r[0] == letter for r in rows),
                    sum(r[1] for r in here),
                    sum(r[2] for r in here),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def result(frame):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in frame.collect()}


DOCS = [
    (9, LONG, "en"),
    (4, LONG, "de"),  # smaller, in another part
    (4, LONG, "de"),  # repeated row
    (12, LONG, "en"),
    (3, LONG + " #", "en"),
    (7, "A B C", None),
    (5, "A B C", "en"),
    (6, "x " * 150, "en"),
    (8, None, "fr"),
    (2, "", "fr"),
    (None, LONG, "en"),
    (None, None, None),
    (20, "Ü " * 120 + "$", ""),
    (1, "word " * 200_000, "en"),
]
LABELS = [(9, 1, 0), (9, 0, 1), (12, 1, 1), (5, 0, 1), (None, 1, 1), (2, None, 1), (99, 1, 1)]
DOC_SCHEMA, LABEL_SCHEMA = "doc_id long, text string, lang string", "doc_id long, quality int, toxic int"


@pytest.mark.parametrize(("files", "texts_per_key"), [(1, 64), (5, 1), (14, 3)])
def test_files_arrive_in_any_order(spark, tmp_path, monkeypatch, files, texts_per_key):
    monkeypatch.setattr(fa, "TEXTS_PER_KEY", texts_per_key)
    for i in range(files):
        part = spark.createDataFrame(DOCS[i::files], DOC_SCHEMA).withColumn("digest", F.lit("clash"))
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    labels = spark.createDataFrame(LABELS, LABEL_SCHEMA)
    got = fa.filter_audit(spark, str(tmp_path / "docs"), labels, batch_bytes=1)
    assert result(got) == brute(DOCS, LABELS)


def test_smaller_ids_retract_what_was_counted(spark, tmp_path):
    """One file a batch, the smallest id last: earlier holders move to the counter of copies."""
    docs = [(id, LONG, "en") for id in (30, 20, 25, 10)]
    for doc in docs:
        spark.createDataFrame([doc], DOC_SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    counted = fa.counters(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABEL_SCHEMA), batch_bytes=1)
    assert sorted((r["mask"], r["n"]) for r in counted.collect()) == [(0, 1), (fa.COPY, 3)]


def test_large_group_of_copies(spark, tmp_path):
    copies = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(LONG).alias("text"), F.lit("en").alias("lang"))
    copies.repartition(7).write.parquet(str(tmp_path / "docs"))
    counted = fa.counters(spark, str(tmp_path / "docs"), spark.createDataFrame([], LABEL_SCHEMA))
    assert sorted((r["mask"], r["n"]) for r in counted.collect()) == [(0, 1), (fa.COPY, 19_999)]


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(str(tmp_path / "docs"))
    assert fa.filter_audit(spark, str(tmp_path / "docs"), spark.createDataFrame(LABELS, LABEL_SCHEMA)).count() == 0
