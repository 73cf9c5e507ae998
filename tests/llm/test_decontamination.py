import math
import random
from collections import Counter

from cellframe.llm import decontamination


def grams(w):
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute(docs, items):
    """(doc, item) with a window of the item's size whose weighted similarity reaches the threshold."""
    split = lambda t: (t or "").encode().lower().split()
    own = {i: split(t) for i, t in items if split(t)}
    holders = Counter(g for w in own.values() for g in set(grams(w)))
    weight = lambda g: math.log1p(len(own) / holders.get(g, 1)) if g in holders else math.log1p(len(own))
    out = set()
    for d, t in docs:
        w = split(t)
        for i, v in own.items():
            n = min(len(v), len(w))
            if n < min(5, len(v)):
                continue
            b = grams(v)
            for s in range(len(w) - n + 1):
                a = grams(w[s : s + n])
                both = sum(weight(g) * min(c, b[g]) for g, c in a.items())
                union = sum(weight(g) * max(a[g], b[g]) for g in a.keys() | b.keys())
                if union and both / union >= 0.75:
                    out.add((d, i))
                    break
    return out


def test_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(80)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, words(rng.choice([5, 12, 16, 30, 45]))) for i in range(30)] + [(30, words(3)), (31, [])]
    items += [(32, items[3][1]), (33, items[4][1][:-1] + ["other"])]
    docs = []
    for d in range(120):
        text = words(rng.choice([0, 4, 30, 200]))
        if d % 2:
            passage = rng.choice(items)[1][:]
            for _ in range(rng.choice([0, 0, 1, 2])):
                if passage:
                    passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage * rng.choice([1, 1, 3]) + text[at:]
        docs.append((d, " ".join(text)))
    items = [(i, " ".join(w).upper()) for i, w in items]
    got = decontamination.contaminated_passages(spark.createDataFrame([*docs, (500, None)], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 40
    assert all(r["similarity"] >= 0.75 and r["hamming"] <= decontamination.RADIUS for r in got)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = decontamination.op7_decontamination(spark, sf).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    items = {r["item_id"]: " ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    whole = {(r["doc_id"], i) for r in docs.collect() for i, t in items.items() if t in " ".join((r["text"] or "").lower().split())}
    assert whole and whole <= found
    kept = decontamination.decontaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet"))
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {d for d, _ in found} and kept.schema == docs.schema


def test_blocks_of_items(spark, sf, monkeypatch):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet").limit(200), spark.read.parquet(f"{sf}/benchmark.parquet")
    one = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated_passages(docs, items).collect()}
    monkeypatch.setattr(decontamination, "BLOCK", 7)
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated_passages(docs, items).collect()} == one


def test_pairs_compared_at_once(spark, sf, monkeypatch):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet").limit(200), spark.read.parquet(f"{sf}/benchmark.parquet")
    one = sorted(decontamination.contaminated_passages(docs, items).collect())
    monkeypatch.setattr(decontamination, "PAIRS", 3)
    assert sorted(decontamination.contaminated_passages(docs, items).collect()) == one


def test_weights_of_the_whole_benchmark(spark, monkeypatch):
    template = [f"t{i}" for i in range(24)]
    items = [(i, " ".join(template + [f"own{i}x{j}" for j in range(20)])) for i in range(8)]
    docs = [(i, text.replace(f"own{i}x9", "changed")) for i, text in items] + [(100, items[0][1])]
    want = brute(docs, items)
    assert want == {(100, 0)}
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for block in (1, 3, 20):
        monkeypatch.setattr(decontamination, "BLOCK", block)
        assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated_passages(*tables).collect()} == want
        assert {r["doc_id"] for r in decontamination.decontaminated(*tables).collect()} == set(range(8))


def test_edge_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "abc def abc def abc def abc def abc def"), (None, "x"), (2, None), (3, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated_passages(odd_docs, items).collect()} == {(9, 1)}
    assert decontamination.contaminated_passages(no_docs, items).count() == 0
    assert decontamination.contaminated_passages(odd_docs, items.limit(0)).count() == 0
    assert decontamination.decontaminated(odd_docs, items).count() == odd_docs.count() - 1
