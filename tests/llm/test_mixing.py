import numpy as np
import pytest
from pyspark.sql import functions as F

from candlewick.llm import mixing


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450, 2) == pytest.approx([200, 500 / 3, 250 / 3])
    assert mixing.targets([0, 10], [5, 2], 15, 2) == [0, 15]
    assert mixing.targets([], [], 0, 2) == []
    assert mixing.targets([0, 0], [5, 2], 0, 2) == [0, 0]


@pytest.mark.parametrize("size", [1, 2, 3, 17, 1000])
def test_permutation(size):
    got = mixing.permuted(np.arange(size), size, 9)
    assert sorted(got) == list(range(size))
    if size > 100:
        assert (got != mixing.permuted(np.arange(size), size, 10)).mean() > 0.9


def docs_of(spark, n=600):
    rows = [
        (i, " ".join(["w"] * (i * 37 % 90)), None if i % 7 == 0 else "hot" if i % 3 else f"s{i % 4}", i)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")


def test_mix_meets_targets(spark):
    docs = docs_of(spark)
    result = mixing.mix(docs, block=16, shard_slots=100)
    got = mixing.taken(result).toPandas()
    assert sorted(got["doc_id"]) == list(range(600))
    assert (got["taken"] <= 2 * got["size"]).all()
    assert (got["size"] == got["doc_id"].map(lambda i: i * 37 % 90)).all()
    total = got["size"].sum()
    names = sorted({s for s in got["source"] if s is not None}) + [None]
    sizes = [int(got.loc[got["source"].isna() if s is None else got["source"] == s, "size"].sum()) for s in names]
    want = mixing.targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * total, 2)
    for s, size, t in zip(names, sizes, want, strict=True):
        own = got[got["source"].isna() if s is None else got["source"] == s]
        assert (own["source_size"] == size).all() and own["target"].to_numpy() == pytest.approx(t)
        assert abs(own["taken"].sum() - t) <= 0.02 * t + 16
    again = mixing.taken(mixing.mix(docs.repartition(5), block=16, shard_slots=100)).toPandas()
    assert sorted(map(tuple, got[["doc_id", "taken"]].to_numpy())) == sorted(
        map(tuple, again[["doc_id", "taken"]].to_numpy())
    )


def test_slots_are_whole(spark):
    result = mixing.mix(docs_of(spark), block=16, shard_slots=100)
    slots = result.slots.toPandas()
    assert len(slots) == result.sources["quota"].sum()
    assert not slots.duplicated(["shard", "position"]).any()
    counts = slots.groupby("s").size()
    assert (counts == result.sources.set_index("s")["quota"][counts.index]).all()
    times = slots.groupby(["s", "block"]).size().unstack(fill_value=0)
    for s, row in times.iterrows():
        row = row[: int(result.sources["blocks"][s])]
        assert row.max() <= 2 and row.max() - row.min() <= 1  # passes are complete before the next
    # The draws of a shard are the multinomial's, but for the few slots that mend the totals.
    share = slots[slots["shard"] == 0].groupby("s").size() / 100
    assert abs(share - result.sources["quota"] / result.sources["quota"].sum()).max() < 0.2
    spans = result.spans.groupBy("shard", "position").agg(F.sum("n_words").alias("n"), F.max("s").alias("s"))
    assert spans.filter("n > 16").count() == 0


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, s string, part string"
    rows = [(1, None, "a", "x", None), (1, "one two", "a", None, "y"), (1, "one two", "a", None, "y"),
            (None, "x " * 5000, None, None, None), (2, "", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted(tuple(r)[:3] for r in mixing.taken(mixing.mix(docs)).fillna(-1, ["doc_id"]).collect())
    assert got == [(-1, 5000, 5000), (1, 0, 4), (1, 2, 4), (1, 2, 4), (2, 0, 5000)]
    assert mixing.taken(mixing.mix(docs.limit(0))).count() == 0
    assert mixing.taken(mixing.mix(docs.filter("text IS NULL"))).count() == 1
