import zlib
from collections import Counter

import numpy as np

from cellframe.llm import language_id
from cellframe.llm.language_id import Chains


def test_held_out_accuracy(spark, sf):
    source = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = language_id.op9_language_id(spark, sf).collect()
    assert len(rows) == len(source)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    right = [r["lang_pred"] == source[r["doc_id"]]["lang"] for r in held if any(c.isalpha() for c in source[r["doc_id"]]["text"] or "")]
    assert len(right) > 100 and sum(right) / len(right) > 0.95


def test_marginals_equal_enumeration():
    from itertools import product

    rng = np.random.default_rng(1)
    scores, start, trans = rng.normal(size=(7, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    chains = Chains(np.array([3, 0, 4]), 10)
    got = np.empty((7, 3))
    got[chains.order] = chains.marginals(scores[chains.order], start, trans)[0]
    for lo, hi in ((0, 3), (3, 7)):
        want = np.zeros((hi - lo, 3))
        for path in product(range(3), repeat=hi - lo):
            p = np.exp(start[path[0]] + sum(scores[lo + i, y] for i, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
            for i, y in enumerate(path):
                want[i, y] += p
        assert np.allclose(got[lo:hi], want / want.sum(axis=1, keepdims=True))


def test_code_switching():
    en, fr = "the cat and the dog of this house is there", "le chat et le chien de cette maison est la"
    model = language_id.train([(en, "en"), (fr, "fr")] * 8)
    scorer = language_id.Scorer(model)
    got = list(scorer.labelled([en.encode(), (fr + " " + fr + " " + en).encode(), b"12 34 ...", None, b""]))
    assert [x[0] for x in got] == ["en", "fr", "und", "und", "und"] and got[1][1] < got[0][1]
    assert got[0][2] > 0.999 and got[2][2] == 0.0


def test_every_language_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(language_id, "train", lambda sample: sample)
    rows = [(100 * k + i, f"word{k} text", f"l{k:02d}") for k in range(70) for i in range(8)]
    rows += [(10_000 + i, "long words " * 3000, "long") for i in range(400)]
    rows += [(20_000 + i, None if i % 4 else "short text", "null") for i in range(2000)]
    rows += [(30_000 + i, "12 34", "und") for i in range(20)] + [(None, "no id", "none"), (1, "two languages", "second")]
    sample = language_id.learned(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    sizes = Counter(lang for _, lang in sample)
    assert set(sizes) == {f"l{k:02d}" for k in range(70)} | {"long", "null", "second"}
    assert sizes["long"] == sizes["null"] == language_id.PER_LANGUAGE
    assert max(len(text) for text, _ in sample) == language_id.SAMPLE_CHARS


def test_edge_tables(spark, odd_docs, no_docs):
    model = language_id.learned(odd_docs)
    rows = language_id.language_id(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and {r["lang_pred"] for r in rows if r["doc_id"] in (3, 4, 5, 6)} == {"und"}
    assert language_id.learned(no_docs) is None and language_id.language_id(no_docs, None).count() == 0
    assert {r["lang_pred"] for r in language_id.language_id(odd_docs, None).collect()} == {"und"}
