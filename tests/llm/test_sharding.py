import zlib

from pyspark.sql import functions as F

from cellframe.llm import sharding


def test_documents(spark, sf):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sharding.op8_sharding(spark, sf).collect()
    slots = {}
    for r in rows:
        assert r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) and r["size"] == len(texts[r["doc_id"]]) + 1 and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and len(slots) == 16
    assert 0 < sum(r["grown_shard"] == 16 for r in rows) < len(rows) / 8


def test_weights_and_moves(spark):
    keys = spark.range(20_000).select("id", sharding.rendezvous(F.col("id"), [1.0, 2.0, 1.0]).alias("s"))
    rows = keys.groupBy("s").count().collect()
    n = {r["s"]: r["count"] for r in rows}
    assert 0.47 < n[1] / 20_000 < 0.53


def test_edge_tables(odd_docs, no_docs):
    got = sharding.sharded(odd_docs, [1.0] * 4).collect()
    assert len(got) == odd_docs.count() and isinstance(got[0]["shard"], int)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert len({r["shard"] for r in got if r["doc_id"] == 2}) == 1
    assert sharding.sharded(no_docs, [1.0] * 4).count() == 0


def test_frequent_key(spark):
    docs = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), (F.col("id") % 400).alias("n_chars"))
    plain, spread = (sharding.sharded(docs, [1.0] * 4, parts=64, spread=s).collect() for s in ((), ("n_chars",)))
    for rows in (plain, spread):
        by = {}
        for r in rows:
            by.setdefault(r["shard"], []).append(r["slot"])
        assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert len({r["shard"] for r in spread if r["doc_id"] is None}) == 1
    assert {(r["doc_id"], r["shard"]) for r in plain} == {(r["doc_id"], r["shard"]) for r in spread}
    part = sharding.part_of(F.col("doc_id"), ("n_chars",), 64)
    most = docs.where("doc_id IS NULL").groupBy(part).count().agg({"count": "max"}).first()[0]
    assert most < 2000 / 8
