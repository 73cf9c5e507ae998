import random
import re

from pyspark.sql import functions as F

import corpus_pipeline
from cellframe.llm import decontamination, mixing, ngram_join


def test_stages_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    tables = []
    for _, stage in corpus_pipeline.STAGES:
        before = docs
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, before.limit(0), sf).schema)
        tables.append((before, docs))
        assert docs.columns[:5] == before.columns[:5]
    ids = [({r["doc_id"] for r in a.collect()}, {r["doc_id"] for r in b.collect()}) for a, b in tables]
    lettered = {r["doc_id"] for r in tables[0][0].collect() if any(c.isalpha() for c in r["text"] or "")}
    assert ids[0][1] <= lettered and len(ids[0][1]) > 0.98 * len(lettered)
    joined = ngram_join.ngram_jaccard_join(tables[1][0]).collect()
    assert ids[1][1] == {r["doc_id"] for r in joined if r["doc_id"] == r["component_id"]}
    hits = decontamination.contaminated_passages(tables[2][0], spark.read.parquet(f"{sf}/benchmark.parquet")).collect()
    assert ids[2][1] == ids[2][0] - {r["doc_id"] for r in hits} and hits
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    taken, largest = {}, {}
    for r in tables[3][1].collect():
        taken[r["source"]] = taken.get(r["source"], 0) + size(r["text"])
    for r in tables[3][0].collect():
        largest[r["source"]] = max(largest.get(r["source"], 0), size(r["text"]))
    goals = mixing.targets(mixing._sizes(tables[3][0])).collect()
    assert all(abs(taken.get(g["source"], 0) - g["target"]) <= largest[g["source"]] + 1 for g in goals)
    rows = tables[4][1].collect()
    assert len(rows) == tables[4][0].count()
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_language_stage_rejects_junk_and_keeps_mixed_texts(spark, sf):
    rng = random.Random(5)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    by = {lang: [r["text"] for r in docs.where(F.col("lang") == lang).orderBy("doc_id").limit(60).collect() if len(r["text"].split()) > 60] for lang in ("en", "fr", "de", "es")}
    half = lambda lang, i: " ".join(by[lang][i % len(by[lang])].split()[:200])
    mixed = [(10_000_000 + i, half(a, i) + " " + half(b, i)) for i, (a, b) in enumerate([("en", "fr"), ("de", "es"), ("fr", "de"), ("es", "en")] * 5)]
    noise = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.choice([3, 6, 9]))) for _ in range(100))
    junk = [(20_000_000 + i, noise("abcdefghijklmnopqrstuvwxyz")) for i in range(10)] + [(20_000_100 + i, noise("абвгдежзиклмнопрстуфхцчш")) for i in range(10)] + [(20_000_200, "12 34 ..."), (20_000_201, None)]
    more = spark.createDataFrame([(d, t, None, "x", len(t or "")) for d, t in mixed + junk], docs.schema)
    for languages in (["en", "fr"], ["en", "fr", "de", "es"]):  # with two languages learned as with four
        some = docs.where(F.col("lang").isin(*languages)).unionByName(more)
        kept = {r["doc_id"] for r in corpus_pipeline.identify_language(spark, some, sf).select("doc_id").collect()}
        assert not kept & {d for d, _ in junk}
        assert {d for i, (d, _) in enumerate(mixed) if languages[2:] or i % 4 == 0} <= kept


def test_edge_tables(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs.select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf)
            assert out.columns == docs.columns
            out.count()
            docs = out
