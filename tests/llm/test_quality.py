import random
import re

from cellframe.llm import quality


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = {}
    for g in grams:
        seen[g] = seen.get(g, 0) + 1
    hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_odd_texts(spark):
    texts = ["a b c a b c", "a a a a a", "a b c d", "", None, "x\nx\n \n \ny\r\ny", "😀 é # $$ |\n😀", "a b " * 400, "\x0b1\x0c2\x85 3 4"]
    rows = quality.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(texts[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])


def test_hash_bits_that_collide_and_long_texts(spark):
    from pyspark.sql import functions as F

    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (3, 4, 5, 12, 30, 90, 300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").select("doc_id", F.split("text", " ").alias("w"))
    for bits in (4, 8, 61, 62):  # places of 4 bits are too few for the longer texts; 1 or 2 bits of hash collide
        rows = docs.select("doc_id", quality.repeat_words(F.col("w"), bits).alias("n")).collect()
        assert [r["n"] for r in rows] == [brute(t)[4] for t in texts]


def test_rules_are_a_table(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog sat of " + " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    assert quality.judged(docs).first()["kept"]
    assert not quality.judged(docs, [quality.Rule("more", "n_words", least=1000)]).first()["kept"]
    assert quality.judged(docs, []).first()["failed_rules"] == ""


def test_edge_tables(odd_docs, no_docs):
    got = quality.judged(odd_docs)
    assert got.count() == odd_docs.count() and dict(got.dtypes)["n_words"] == "bigint"
    assert quality.judged(no_docs).count() == 0
