import random

from cellframe.llm import ngram_join


def brute(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {d: d for d in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = sorted((root(a), root(b)))
                comp[q] = p
    return {d: (len(s), root(d)) for d, s in sets.items()}


def family(rng):
    rows, n = [], 0
    vocabulary = [f"w{i}" for i in range(400)]
    for _ in range(12):
        text = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 8, 40, 90]))]
        for _ in range(rng.choice([1, 2, 6])):
            rows.append((n, " ".join(text)))
            n += 1
            text = text[:]
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text.append(rng.choice(vocabulary))
    passage = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(15):  # a passage that many documents share
        rows.append((n, " ".join(passage + [rng.choice(vocabulary) for _ in range(rng.choice([2, 9, 30]))])))
        n += 1
    rng.shuffle(rows)
    return rows


def test_brute_force(spark):
    for seed in range(3):
        rows = family(random.Random(seed)) + [(900, None), (901, ""), (902, " \n"), (903, "ÉA b"), (904, "Éa B"), (905, "éa b"), (-7, "minus one two three four five"), (-1, "minus one two three four five"), (-3, "other words")]
        got = ngram_join.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)


def test_long_lists_in_parts(spark):
    rng = random.Random(11)
    rows = family(rng)
    template = [rng.choice([f"t{i}" for i in range(300)]) for _ in range(60)]
    for i in range(120):  # a large family of near copies, some of them far from most others
        text = template[:]
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(30)}"
        rows.append((2000 + i, " ".join(text[: rng.choice([60, 60, 60, 50, 45, 20])])))
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for long in (2, 9, 40):
        got = ngram_join.ngram_jaccard_join(docs, long=long, sample=1).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_pairs_of_long_lists(spark):
    """With every set a component, blocks and whole lists propose the same pairs in the last round."""
    rng = random.Random(2)
    rows = [(t, g, rng.randrange(1, n + 1), n, g % 7) for t in (1, 2) for g in range(60) for n in [rng.randrange(8, 14)]]
    lists = spark.createDataFrame([(t, g, max(1, r), n, c) for t, g, r, n, c in rows], "token long, gid long, rest int, n long, comp long")
    from pyspark.sql import functions as F

    want = {tuple(r) for r in ngram_join._proposals(lists, "all").collect()}
    got = {tuple(r) for r in ngram_join._long_proposals(lists.withColumn("salts", F.lit(5)), "all").collect()}
    by = {}
    for t, g, rest, n, c in rows:
        by.setdefault(t, []).append((g, rest, n, c))
    brute_pairs = {(min(x[0], y[0]), max(x[0], y[0])) for some in by.values() for x in some for y in some if x[3] != y[3] and 4 * min(x[2], y[2]) >= 3 * max(x[2], y[2]) and min(x[1], y[1]) * 7 >= 3 * (x[2] + y[2])}
    assert got == want == brute_pairs and want


def test_prefix_bound_is_sound():
    import numpy as np

    rng = np.random.default_rng(0)
    levels = rng.integers(0, 5, 1 << 22).astype(np.uint8)
    for _ in range(300):
        common = rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64) * np.uint64(2)
        x = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64) * np.uint64(2)]))
        y = np.unique(np.concatenate([common, rng.integers(0, 2**63, rng.integers(0, 12)).astype(np.uint64) * np.uint64(2)]))
        c = len(np.intersect1d(x, y))
        if 4 * c >= 3 * (len(x) + len(y) - c):
            assert ngram_join.prefixes_allow(ngram_join.prefix_of(x, levels), len(x), ngram_join.prefix_of(y, levels), len(y), levels)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r["node"]: r["comp"] for r in ngram_join.components(edges).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 100: 100, 101: 100}


def test_edge_tables(odd_docs, no_docs):
    got = ngram_join.ngram_jaccard_join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[2]["component_id"] == 1 and by[None]["component_id"] is None and by[3]["n_shingles"] == 0 and by[8]["component_id"] == 7
    assert ngram_join.ngram_jaccard_join(no_docs).count() == 0


def test_components_of_further_links(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "a long, b long")
    one = ngram_join._joined(None, frame((1, 2), (5, 6), (20, 21)))
    assert ngram_join._joined(one, spark.createDataFrame([], "a long, b long")) is one
    two = ngram_join._joined(one, frame((2, 5), (6, 9), (9, 10), (30, 31)))
    assert {r["node"]: r["comp"] for r in two.collect()} == {**dict.fromkeys((1, 2, 5, 6, 9, 10), 1), 20: 20, 21: 20, 30: 30, 31: 30}
