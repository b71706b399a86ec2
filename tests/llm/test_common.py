import numpy as np

from candlewick.llm import common


def test_words_equal_split(monkeypatch):
    text = "Ab,c  d1-é\n€x " * 50 + "y" * 300
    whole = common.word_hashes(text.encode(), common.ALNUM)
    monkeypatch.setattr(common, "CHUNK", 37)
    parts = common.word_hashes(text.encode(), common.ALNUM)
    for a, b in zip(whole, parts, strict=True):
        assert (a == b).all()
    words = [text.encode()[s:e] for s, e in zip(whole[1], whole[2], strict=True)]
    assert words[:4] == [b"Ab", b"c", b"d1", "é".encode()]
    assert len(set(words)) == len(set(whole[0].tolist()))
    assert len({(w, h) for w, h in zip(words, whole[0].tolist(), strict=True)}) == len(set(words))


def test_batches_do_not_change_hashes():
    texts = [b"", b"a b", b"b", b"a b c " * 9]
    for i, hashes, (starts, ends) in common.batch_word_hashes(texts, common.SOLID):
        alone = common.word_hashes(texts[i], common.SOLID)
        assert (hashes == alone[0]).all() and (starts == alone[1]).all() and (ends == alone[2]).all()


def test_shingles():
    words = np.arange(6, dtype=np.uint64)
    twice = np.concatenate([words, words])
    got = common.shingle_hashes(twice, 3)
    assert len(got) == 10 and (got[:4] == got[6:]).all() and len(set(got.tolist())) == 6
    assert len(common.shingle_hashes(words, 7)) == 0


def test_numbered(spark):
    frame = spark.createDataFrame([(x * 7 % 50, str(x)) for x in range(50)], "k int, v string")
    got = common.numbered(frame, ["k"]).collect()
    assert sorted((r["index"], r["k"]) for r in got) == [(i, i) for i in range(50)]
    assert common.numbered(frame.limit(0), ["k"]).count() == 0


def test_filter_parts(spark):
    frame = spark.createDataFrame([(i % 300 or None,) for i in range(900)], "k long")
    keys = spark.createDataFrame([(None,), (5,), (77,), (100_000,)], "k long")
    assert common.without(frame, keys, "k").count() == 900 - 9
    assert common.among(frame, keys, "k").count() == 9
    assert common.without(frame, keys.limit(0), "k").count() == 900
    maybe, rest = common.split_by(frame, keys, "k")
    assert maybe.count() + rest.count() == 900 and rest.count() > 800
