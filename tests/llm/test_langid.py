import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import langid

SF_DIR = "/root/testdata/sf0.01"


def test_grams_do_not_depend_on_slices(monkeypatch):
    text = "Ein Wort, noch eins! ÉTÉ 12 a" * 9
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "SLICE", 10)
    parts = langid.gram_counts(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    assert whole[1].sum() == sum(c.isalpha() for c in text)


def two_languages():
    rng = np.random.default_rng(3)
    logs = np.log(rng.dirichlet(np.full(langid.BUCKETS, 0.01), size=2).T + 1e-9)
    return langid.Model(["aa", "bb"], logs), rng


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 1.0])
def test_mixture_is_found(share):
    model, rng = two_languages()
    n = 4000
    draws = [
        rng.choice(langid.BUCKETS, size=int(n * s), p=np.exp(model.logs[:, i]) / np.exp(model.logs[:, i]).sum())
        for i, s in enumerate((share, 1 - share))
    ]
    found = langid.proportions(model, *np.unique(np.concatenate(draws), return_counts=True))
    assert found.get("aa", 0.0) == pytest.approx(share, abs=0.04)
    assert len(found) == (1 if share in (0.0, 1.0) else 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))
    got = langid.identify(docs.filter(langid.held_out(F.col("doc_id"))), model, ["doc_id", "lang"]).toPandas()
    assert len(got) > 200 and (got["lang"] == got["lang_pred"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, lang_pred string, score int"
    english, german = "the cat and the dog " * 9, "die Katze und der Hund ß " * 9
    rows = [(i, english, "en", "x", 1) for i in range(12)] + [(20 + i, german, "de", None, 2) for i in range(12)]
    odd = [(50, None, "en", None, None), (51, "", "de", None, None), (52, "12 34 !?", None, None, None),
           (None, english, "de", "q", 5), (53, english * 9000, None, None, None)]
    docs = spark.createDataFrame(rows + odd, schema)
    model = langid.train(docs.filter("doc_id < 50"), per_language=100)
    assert model.languages == ["de", "en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model, ["doc_id"]).collect()}
    assert got[50] == got[51] == got[52] == ("und", 0.0)
    assert got[None][0] == got[53][0] == "en" and got[25][0] == "de"
    kept = langid.documents_with_language(docs)
    assert kept.columns == docs.columns and kept.count() == 26
    assert langid.documents_with_language(docs.limit(0)).count() == 0
    none = langid.train(docs.limit(0))
    assert none.languages == []
    assert {r.lang_pred for r in langid.identify(docs, none, ["doc_id"]).collect()} == {"und"}
