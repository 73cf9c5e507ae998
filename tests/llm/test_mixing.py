import pytest
from pyspark.sql import functions as F

from cellframe.llm import mixing


def fill(sizes, weights):
    """Targets by resharing excess until nothing is above its ceiling."""
    left, open_, out = sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        w = sum(weights[i] for i in open_)
        above = [i for i in open_ if left * weights[i] / w > 3 * sizes[i]]
        if not above:
            for i in open_:
                out[i] = left * weights[i] / w
            break
        for i in above:
            out[i] = 3.0 * sizes[i]
            left -= out[i]
        open_ -= set(above)
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 5, 9], [0, 10, 3], [0, 0], [7], [5, 500, 20, 3, 1, 900, 2]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", n) for i, n in enumerate(sizes)]
    got = mixing.targets(spark.createDataFrame(rows, "source string, size long")).orderBy("source").collect()
    assert [r["target"] for r in got] == pytest.approx(fill(sizes, [(1, 2, 3)[i % 3] for i in range(len(sizes))]))


def test_documents(spark, sf):
    rows = mixing.op3_mixing(spark, sf).collect()
    by = {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], [r["target"], 0])[1] += r["taken"]
    assert all(abs(t - n) <= 1 for t, n in by.values())
    assert sorted(rows) == sorted(mixing.op3_mixing(spark, sf).collect())


def test_edge_tables(odd_docs, no_docs):
    got = mixing.mix(odd_docs)
    assert got.columns == odd_docs.columns
    assert {r["doc_id"] for r in got.collect()} <= {r["doc_id"] for r in odd_docs.collect()}
    assert mixing.mix(no_docs).count() == 0
    sizes = mixing._sizes(odd_docs)
    rows = mixing.mixed_words(sizes).collect()
    assert len(rows) == odd_docs.count()
    assert {r["source_size"] for r in rows if r["source"] is None} == {243}


def test_frequent_id(spark):
    """Rows of one id lie in many ranges, and the mix comes near its target although they are half of a source."""
    docs = spark.range(3000).select(F.when(F.col("id") % 2 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.expr("repeat('w ', 10)").alias("text"), (F.col("id") % 500).alias("n_chars"))
    spread = ("n_chars",)
    rows = mixing.mixed_words(mixing._sizes(docs, spread), spread=spread).collect()
    assert len({r["key"] for r in rows if r["doc_id"] is None}) > 200
    goal = {r["source"]: r["target"] for r in rows}
    taken = {r["source"]: r["n"] * 10 for r in mixing.mix(docs, spread=spread).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert all(abs(taken[s] - t) < 0.02 * t + 100 for s, t in goal.items())
