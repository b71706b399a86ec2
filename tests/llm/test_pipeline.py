import random

import corpus_pipeline
import duckdb
import pytest
from test_decontaminate import brute_tiles, words
from test_linededup import brute as brute_lines
from test_simhash import brute_components, brute_fp



SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def corpus():
    rng = random.Random(8)
    english = "the cat sat on that mat with those other thin things there".split()
    german = "die Katze und der Hund schlafen nicht auf einem großen Stuhl".split()
    item = " ".join(f"question{i}" for i in range(24))
    passage = " ".join(rng.choice(english) + str(i) for i in range(60))

    def text(pool, n):
        return "\n".join(" ".join(rng.choice(pool) + rng.choice("abcd") for _ in range(12)) for _ in range(n))

    rows = [(i, text(english if i % 3 else german, 6), "en" if i % 3 else "de") for i in range(60)]
    rows += [(60, rows[5][1], "en"), (61, rows[5][1].upper(), "en"), (62, f"{text(english, 4)}\n{passage}", "en")]
    rows += [(63, f"{text(english, 4)}\n{passage}\nend of it", "en"), (64, f"{text(english, 3)} {item}", "en")]
    half = item.split()
    rows += [(65, f"{' '.join(half[12:])} and {text(english, 2)} {' '.join(half[:12])}", "en"), (66, None, "en")]
    rows += [(67, "12345 !!", None), (68, "", None), (None, text(german, 5), None), (70, text(english, 2), "en")]
    rows += [rows[-1]]
    rows = [(i, t, lang, f"s{(i or 0) % 4}" if i != 3 else None, 0) for i, t, lang in rows]
    return rows, [(1, item), (2, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, items = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_equal_brute_force(spark, folder, tmp_path):
    rows, items = corpus()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "simhash", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    def run(name, docs):
        out = str(tmp_path / name)
        stages[name](spark, docs, folder).write.parquet(out)
        return spark.read.parquet(out)

    # Language: only texts without letters go.
    first = run("language_id", docs)
    assert first.columns == docs.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in first.collect())
    assert kept == sorted((r[0] is None, r[0] or 0) for r in rows if r[0] not in (66, 67, 68))

    # Lines: brute force over the distinct documents.
    distinct = sorted({(r.doc_id, r.text) for r in first.collect()}, key=str)
    left = brute_lines(distinct, 50)
    want = {distinct[k][0]: v for k, v in left.items() if v}
    second = run("line_dedup", first)
    assert second.columns == docs.columns
    got = {r.doc_id: [x.strip() for x in r.text.split("\n") if x.strip()] for r in second.collect()}
    assert got == want and 60 not in got
    assert len(got[63]) == 5  # the passage stays in 62

    # Near-duplicates: one of each component, rows without id all.
    texts = {r.doc_id: r.text for r in second.collect()}
    fps = {i: brute_fp(t) for i, t in texts.items() if i is not None}
    groups = brute_components(set(fps.values()), 4)
    one = {min(i for i, f in fps.items() if f in set(g)) for g in groups}
    third = run("simhash", second)
    assert third.columns == docs.columns
    assert sorted(r.doc_id for r in third.collect() if r.doc_id is not None) == sorted(one)
    assert 61 not in one and third.filter("doc_id IS NULL").count() == 1

    # Benchmark: half of the item's words in tiles.
    texts = {r.doc_id: r.text for r in third.collect()}
    bad = {
        i
        for i, t in texts.items()
        if sum(n for n, _, _ in brute_tiles(words(t), words(items[0][1]), 5)) >= 12
    }
    fourth = run("decontamination", third)
    assert fourth.columns == docs.columns and bad == {64, 65}
    assert {r.doc_id for r in fourth.collect()} == set(texts) - bad

    # Mixing: every document once, each source near its target.
    last = run("mixing", fourth).collect()
    sizes = {r.doc_id: len((r.text or "").split()) for r in fourth.collect()}
    assert {r.doc_id: r["size"] for r in last} == sizes and len(last) == len(sizes)
    assert all(r.taken <= 2 * r["size"] for r in last)

    whole = sorted(map(str, (tuple(r) for r in corpus_pipeline.run(spark, folder).collect())))
    assert whole == sorted(map(str, (tuple(r) for r in last)))


def test_empty_tables(spark, folder):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0


def test_extra_columns_with_clashing_names(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.selectExpr("*", "'x' AS lang_pred", "1 AS score", "2 AS fp", "3 AS th", "4 AS seq", "5 AS taken")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, folder)
        assert out.columns == wide.columns and out.count() > 50
    assert corpus_pipeline.STAGES[-1][1](spark, wide, folder).count() == docs.count()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    assert kept.count() >= 0.99 * docs.count()
    n = duckdb.sql(f"SELECT count(*) FROM '{SF_DIR}/documents.parquet'").fetchall()[0][0]
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0.7 * n < len(rows) < n
