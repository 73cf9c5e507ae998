import random
import threading
from contextlib import contextmanager

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.functions import geometry as geo
from cellframe.operators import focal, labels, models, spatial, targets

RING = [(0, 0, 5, 0), (5, 0, 5, 5), (5, 5, 0, 5), (0, 5, 0, 0), (1, 1, 1, 4), (1, 4, 4, 4), (4, 4, 4, 1), (4, 1, 1, 1)]


def edges(spark, rows, key=1):
    return spark.createDataFrame([(key, *map(float, r)) for r in rows], "feature_id long, x1 double, y1 double, x2 double, y2 double")


def test_holes_and_borders(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 5.0, 2.0), (4, 0.0, 0.0), (5, 9.0, 1.0), (6, 4.5, 4.5)], "id long, x double, y double")
    got = {r["id"] for r in spatial.containing(pts, edges(spark, RING)).collect()}
    assert got == {1, 4, 6}
    assert {r["id"] for r in spatial.containing(pts, edges(spark, RING), closed=True).collect()} == {1, 3, 4, 6}
    m = geo.polygon_measures(edges(spark, RING), "feature_id").first()
    assert m["area"] == 16 and m["length"] == 32 and m["cx"] == 2.5


def test_segment_and_box(spark):
    rows = [(0, 0, 4, 4, True), (0, 3, 3, 0, True), (0, 1.5, 1.5, 0, False), (5, 5, 6, 6, False), (1.2, 1.2, 1.4, 1.3, True), (0, 1, 5, 1, True)]
    df = spark.createDataFrame([tuple(map(float, r[:4])) + (r[4],) for r in rows], "x1 double, y1 double, x2 double, y2 double, want boolean")
    hit = geo.segment_meets_box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), F.lit(1.0), F.lit(1.0), F.lit(2.0), F.lit(2.0))
    assert df.where(hit != F.col("want")).count() == 0


@pytest.mark.parametrize("radius", [0.5, 2.0, 7.0])
def test_radius_and_nearest_equal_brute_force(spark, radius):
    rng = random.Random(radius)
    p = [(i, rng.uniform(-20, 20), rng.uniform(-20, 20)) for i in range(60)]
    o = [(rng.uniform(-20, 20), rng.uniform(-20, 20)) for _ in range(40)] + [(60.0, 60.0)]
    pts, others = spark.createDataFrame(p, "id long, x double, y double"), spark.createDataFrame(o, "ox double, oy double")
    d = lambda a, b: (a[1] - b[0]) ** 2 + (a[2] - b[1]) ** 2
    n = {r["id"]: r["n"] for r in spatial.density(pts, others, radius).collect()}
    assert n == {a[0]: sum(d(a, b) <= radius**2 for b in o) for a in p}
    near = {r["id"]: r["distance"] for r in spatial.nearest(pts, others, radius).collect()}
    assert near == pytest.approx({a[0]: min(d(a, b) for b in o) ** 0.5 for a in p})


@contextmanager
def at_most(spark, seconds):
    """Cancels what still runs after so many seconds."""
    timer = threading.Timer(seconds, spark.sparkContext.cancelAllJobs)
    timer.start()
    try:
        yield
    finally:
        timer.cancel()


def odd_places(seed):
    """Points and others with copies, equal distances, crowds far from others, and rows without a place."""
    rng = random.Random(seed)
    at = lambda: rng.choice([(float(rng.randint(-8, 8)), float(rng.randint(-8, 8))), (rng.uniform(-9, 9), rng.uniform(-9, 9)), (500 + rng.gauss(0, 1e-3), -0.0)])
    p = [(i, *at()) for i in range(150)] + [(1000, None, 1.0), (1001, 1.0, float("nan")), (1002, float("inf"), 0.0)]
    return p, [at() for _ in range(150)] + [(None, 2.0), (float("nan"), 0.0), (float("-inf"), 0.0)]


def placed(p, o):
    """For each point, the squares of its distances to others."""
    o = [b for b in o if b[0] is not None and np.isfinite(b).all()]
    return {i: [(x - a) * (x - a) + (y - b) * (y - b) for a, b in o] if i < 1000 else [] for i, x, y in p}


def crowd(spark, n, x, y, shift=0.0):
    """n rows in n places of a square of side 2."""
    side = round(n**0.5)
    return spark.range(side * side).selectExpr("id", f"(id % {side}) * {2 / side}D + {shift}D as {x}", f"floor(id / {side}) * {2 / side}D as {y}")


def copies(spark, n, x, y):
    """n rows in 20 places."""
    return spark.range(n).selectExpr("id", f"cast(id % 5 as double) as {x}", f"cast(id % 4 as double) as {y}")


@pytest.mark.parametrize("leaf", [4, 256])
def test_nearest_halved_to_the_end(spark, monkeypatch, leaf):
    monkeypatch.setattr(spatial, "LEAF", leaf)
    monkeypatch.setattr(spatial, "FEW", 0)
    p, o = odd_places(leaf)
    with at_most(spark, 200):
        got = {r["id"]: r["distance"] for r in spatial.nearest(spark.createDataFrame(p, "id long, x double, y double"), spark.createDataFrame(o, "ox double, oy double"), 3.0).collect()}
    assert got == {i: min(d) ** 0.5 if d else None for i, d in placed(p, o).items()}


def test_nearest_does_not_pair_copies_or_crowds(spark):
    with at_most(spark, 120):
        got = spatial.nearest(copies(spark, 300_000, "x", "y"), copies(spark, 300_000, "ox", "oy").selectExpr("ox + 0.25 as ox", "oy"), 2.0)
        assert [tuple(r) for r in got.groupBy("distance").count().collect()] == [(0.25, 300_000)]
    with at_most(spark, 120):
        got = spatial.nearest(crowd(spark, 90_000, "x", "y"), crowd(spark, 90_000, "ox", "oy", 1e-3), 4.0)
        low, high, n = got.agg(F.min("distance"), F.max("distance"), F.count("distance")).first()
        assert n == 90_000 and low == pytest.approx(1e-3) and high == pytest.approx(1e-3)


@pytest.mark.parametrize("leaf", [4, 256])
def test_density_halved_to_the_end(spark, monkeypatch, leaf):
    monkeypatch.setattr(spatial, "LEAF", leaf)
    monkeypatch.setattr(spatial, "FEW", 0)
    p, o = odd_places(leaf)
    got = {r["id"]: r["n"] for r in spatial.density(spark.createDataFrame(p, "id long, x double, y double"), spark.createDataFrame(o, "ox double, oy double"), 5.0).collect()}
    assert got == {i: sum(v <= 25 for v in d) for i, d in placed(p, o).items()}


def test_density_does_not_pair_copies_or_crowds(spark):
    with at_most(spark, 120):
        got = spatial.density(copies(spark, 300_000, "x", "y"), copies(spark, 300_000, "ox", "oy"), 1.0)
        n = {(r["x"], r["y"]): r["n"] for r in got.groupBy("x", "y").agg(F.min("n").alias("n")).collect()}
        assert n == {(a, b): 15_000 * sum((a - c) ** 2 + (b - d) ** 2 <= 1 for c in range(5) for d in range(4)) for a in range(5) for b in range(4)}
    with at_most(spark, 120):
        got = spatial.density(crowd(spark, 90_000, "x", "y"), crowd(spark, 90_000, "ox", "oy", 1e-3), 4.0)
        assert [tuple(r) for r in got.groupBy("n", "density").count().collect()] == [(90_000, 1.0, 90_000)]


def test_densify_walks_bends(spark):
    lines = spark.createDataFrame([(1, 1, 0.0, 0.0, 3.0, 0.0), (1, 2, 3.0, 0.0, 3.0, 3.0), (2, 1, 0.0, 0.0, 0.5, 0.0)], "feature_id long, seg int, x1 double, y1 double, x2 double, y2 double")
    got = [tuple(r) for r in spatial.densify(lines.withColumnRenamed("seg", "o"), 1.0, order="o").orderBy("feature_id", "i").collect()]
    assert [g[1] for g in got] == [0, 1, 2, 3, 4, 5, 0, 1]
    assert np.allclose([g[2:] for g in got], [(0, 0), (1.2, 0), (2.4, 0), (3, 0.6), (3, 1.8), (3, 3), (0, 0), (0.5, 0)])


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(-69.0, -33.0), (-70.5, -31.2)], "x double, y double")
    there = geo.project(df, "x", "y")
    assert there.collect()[0]["x"] == pytest.approx(500_000, abs=1e-3)
    # On the central meridian: false northing less the scaled arc of 33 degrees.
    arc = 111132.954 * 33 - 16038.509 * np.sin(np.radians(66)) + 16.833 * np.sin(np.radians(132)) - 0.022 * np.sin(np.radians(198))
    assert there.collect()[0]["y"] == pytest.approx(10_000_000 - 0.9996 * arc, abs=1)
    assert np.allclose(np.array(geo.project(there, "x", "y", inverse=True).collect()), np.array(df.collect()), atol=1e-7)


def components(cells):
    seen, out = set(), {}
    for c in sorted(cells):
        if c in seen:
            continue
        stack, region = [c], []
        while stack:
            x = stack.pop()
            if x in seen or x not in cells:
                continue
            seen.add(x)
            region.append(x)
            stack += [(x[0] + a, x[1] + b) for a, b in ((0, 1), (1, 0), (0, -1), (-1, 0))]
        first = min(i * 200 + j for i, j in region)
        out |= dict.fromkeys(region, first)
    return out


def test_components_equal_search(spark):
    rng = random.Random(4)
    shapes = [{(i, j) for i in range(30) for j in range(150) if rng.random() < 0.55}, {(i, j) for i in range(4) for j in range(4) if (i + j) % 2 == 0}, {(i, j) for i in range(5) for j in range(5) if i in (0, 4) or j in (0, 4)}]
    snake = {(i, j) for i in range(0, 40, 2) for j in range(12)} | {(i, 11 if i % 4 == 1 else 0) for i in range(1, 39, 2)}
    for cells in [*shapes, snake]:
        got = {(r["row_id"], r["col_id"]): r["component"] for r in targets.components(spark.createDataFrame(sorted(cells), "row_id int, col_id int"), 200).collect()}
        assert got == components(cells)


def test_ranking_breaks_ties(spark):
    cells = spark.createDataFrame([(0, 0, 0.9, 5), (0, 2, 0.9, 7), (0, 4, 0.8, 9)], "row_id int, col_id int, v double, component long")
    got = targets.top(targets.measured(cells, "v", 1000.0), F.lit("porfiro"), 2).orderBy("rank").collect()
    assert [(r["component"], r["target_id"], r["area_km2"]) for r in got] == [(5, "POR-001", 1.0), (7, "POR-002", 1.0)]
    assert targets.measured(cells, "v", 1000.0, most_km2=0.5).count() == 0


def test_priority_and_splits(spark):
    m = spark.createDataFrame([(1, "nucleo"), (1, "negativo"), (2, "interpretado"), (2, "nucleo"), (3, None), (4, "none")], "id long, zone string")
    got = {r["id"]: (r["label_source"], r["label"], r["weight"]) for r in labels.priority_label(m, "id").collect()}
    assert got == {1: ("negativo", 0, 1.0), 2: ("nucleo", 1, 1.0), 3: ("background", 0, 0.7), 4: ("background", 0, 0.7)}
    df = spark.range(2000).select("id", (F.col("id") % 60).cast("string").alias("b"), ((F.col("id") % 60) < 20).cast("int").alias("y"))
    s = labels.block_split(df, "b", "y", 1)
    assert s.groupBy("b").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert {r["split"] for r in s.where("y = 1").select("split").distinct().collect()} == {"train", "val", "test"}
    f = labels.group_folds(df, "b", "y", 4, 1)
    assert f.groupBy("b").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0


def test_explicit_negatives_stay(spark):
    rows = [(i, 1, "nucleo") for i in range(5)] + [(10 + i, 0, "negativo") for i in range(4)] + [(100 + i, 0, "background") for i in range(50)]
    got = labels.downsample_negatives(spark.createDataFrame(rows, "id long, label int, label_source string"), 2.0, "id", 1)
    n = {r["label_source"]: r["count"] for r in got.groupBy("label_source").count().collect()}
    assert n == {"nucleo": 5, "negativo": 4, "background": 6}
    assert labels.quotas({"nucleo": 10, "interpretado": 100, "negativo": 5, "background": 1000}, 50) == {"nucleo": 10, "interpretado": 40, "negativo": 5, "background": 145}


def test_metrics_equal_pairs(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0.1, 0.2, 0.5, 0.5001, 0.9, rng.random()]), int(rng.random() < 0.4)) for _ in range(300)]
    got = models.metrics(spark.createDataFrame(rows, "s double, y int"), "s", "y").first()
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert got["auc_roc"] == pytest.approx(auc, abs=6e-5) and got["tp"] == sum(s > 0.5 for s in pos) and got["n"] == 300
    assert models.metrics(spark.createDataFrame([(0.5, 1)], "s double, y int"), "s", "y").first()["auc_roc"] is None


def test_selection_prefers_the_fast_model():
    assert models.select_model({"forest": [0.9], "logistic": [0.88]}) == "logistic"
    assert models.select_model({"forest": [0.9], "logistic": [0.8]}) == "forest"
    assert models.batch_size(24) == 103 and models.batch_size(4) == 1


def test_encoder_and_neighbours(spark):
    p = spark.createDataFrame([(i, [float(i)] * 8 + [1.0] * 8) for i in range(5)], "id long, pixels array<double>")
    got = models.encode(p, "pixels", (2, 2, 4)).orderBy("id").collect()
    assert len(got[3]["embedding"]) == 8 and got[3]["embedding"][0] == 3.0
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6))
    v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sim = u @ u.T - 2 * np.eye(50)
    for block in (1, 4096):
        near = {(r["query"], r["rank"]): r["neighbour"] for r in models.cosine_neighbours(v.where("vec_id < 3"), v, 4, block=block).collect()}
        assert near == {(i, k + 1): int(j) for i in range(3) for k, j in enumerate(np.argsort(-sim[i])[:4])}


def test_models_train_and_round_trip(spark, tmp_path):
    df = spark.range(400).select("id", (F.rand(1)).alias("a"), F.rand(2).alias("b")).withColumn("y", (F.col("a") > 0.5).cast("double"))
    m = models.fit(df, ("a", "b"), "y", models.candidates(1)["logistic"]())
    assert models.metrics(models.scored(m, df, ["y"]), "prob", "y").first()["auc_roc"] > 0.95
    m.write().overwrite().save(f"{tmp_path}/m")
    from pyspark.ml import PipelineModel

    again = models.scored(PipelineModel.load(f"{tmp_path}/m"), df, ["id"])
    assert again.count() == 400
    drop = models.permutation_importance(m, df, ("a", "b"), "y", 1).collect()
    assert drop[0]["feature"] == "a" and drop[0]["drop"] > 0.2
    assert models.tuned(df, ("a", "b"), "y", 1, (2,), (0.1,)) is not None


def test_models_by_type(spark, tmp_path):
    df = spark.range(300).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"))
    df = df.withColumn("y", (F.col("a") > 0.5).cast("double")).withColumn("kind", F.when(F.col("y") == 1, F.when(F.col("b") > 0.5, "p").when(F.col("id") < 150, "q").otherwise("p")))
    rare = df.withColumn("kind", F.when(F.col("id") == 0, "rare").otherwise(F.col("kind")))
    bundle = models.train_types(rare, ("a", "b"), "y", "kind", models.candidates(1)["logistic"])
    assert sorted(bundle) == ["p", "q"]
    got = models.scored_by_all(bundle, df, ["id"])
    assert got.columns == ["id", "prob_p", "prob_q", "best"] and got.where("best < prob_p OR best < prob_q").count() == 0
    models.save_bundle(f"{tmp_path}/b", bundle["p"], ["a", "b"], windows=[5])
    model, meta = models.load_bundle(spark, f"{tmp_path}/b")
    assert meta == {"features": ["a", "b"], "categorical": [], "windows": [5]} and models.scored(model, df, ["id"]).count() == 300


def test_run_skips_what_is_done(spark, sf, tmp_path):
    from cellframe.plans import runs
    from cellframe.sources.io import Config, load_metadata

    cfg = Config(percentile=0.8, patch_size=8, stride=4, n_positive=200, folds=2, model_scale=0.02, min_prob=0.05)
    out = str(tmp_path)
    first = runs.run(spark, sf, out, cfg)
    assert list(first) == [n for n, _ in runs.STAGES] and {v["status"] for v in first.values()} == {"done"}
    again = runs.run(spark, sf, out, cfg, start="scores")
    assert {k: v["status"] for k, v in again.items()} == {"scores": "skipped", "targets": "skipped", "export": "skipped"}
    assert load_metadata(spark, f"{out}/_run")["stages"]["targets"]["status"] == "skipped"
    assert "POR-001" in spark.read.text(f"{out}/_map").first()[0]
    assert spark.read.csv(f"{out}/_ranking", header=True).count() == spark.read.parquet(f"{out}/targets").count() > 0
    table = spark.read.parquet(f"{out}/model").collect()
    assert {r["model"] for r in table} == {"forest", "boosted", "logistic"} and sum(r["chosen"] for r in table) == 1
    lab = spark.read.parquet(f"{out}/labels")
    assert {r["split"] for r in lab.select("split").distinct().collect()} == {"train", "val", "test"} and lab.where("label = 1").count() > 20
    cells = spark.read.parquet(f"{out}/composite")
    assert spark.read.parquet(f"{out}/scores").count() == cells.count() == spark.read.parquet(f"{out}/layers").count()
    e = spark.read.parquet(f"{out}/embeddings")
    assert e.count() > 50 and len(e.first()["embedding"]) == 4 * len(runs.ENCODED)
    with pytest.raises(ValueError):
        runs.run(spark, sf, out, only="no")


def test_pixels_of_patches(spark):
    z = {(r, c): None if (r, c) == (2, 2) else float(10 * r + c) for r in range(6) for c in range(7)}
    df = spark.createDataFrame([(r, c, v, None if v is None else -v) for (r, c), v in z.items()], "row_id int, col_id int, a double, b double")
    got = {(r["row_id"], r["col_id"]): r for r in focal.patch_pixels(df, ["a", "b"], 4, 3, 6, 7, 0.9).collect()}
    assert set(got) == {(0, 0), (0, 3)} and got[0, 3]["valid"] == 1.0 and got[0, 0]["valid"] == 15 / 16 and (got[0, 3]["center_row"], got[0, 3]["center_col"]) == (2, 5)
    for (r0, c0), r in got.items():
        want = [z[r0 + i, c0 + j] or 0.0 for i in range(4) for j in range(4)]
        assert r["pixels"] == want + [-x for x in want]


def test_align_across_reference_systems(spark):
    """A plane in metres, asked for on a grid of degrees, keeps its values at the cells' places."""
    from cellframe.functions.geometry import project, utm
    from cellframe.sources.grid import GridSpec

    source, target = GridSpec(430_000.0, 6_190_000.0, 500.0, 40, 40), GridSpec(-69.72, -34.45, 0.01, 12, 10)
    plane = spark.createDataFrame([(r, c, 2.0 * (430_000 + (c + 0.5) * 500) + 3.0 * (6_190_000 - (r + 0.5) * 500)) for r in range(40) for c in range(40)], "row_id int, col_id int, z double")
    got = spatial.align(plane, "z", source, target, "bilinear", lambda df: project(df, "x", "y")).where("z IS NOT NULL").collect()
    inside = 0
    for r in got:
        x, y = utm(np.array([target.x0 + (r["col_id"] + 0.5) * 0.01]), np.array([target.y0 - (r["row_id"] + 0.5) * 0.01]), 19, True)
        if 430_500 < x[0] < 449_500 and 6_170_500 < y[0] < 6_189_500:
            inside += 1
            assert r["z"] == pytest.approx(2 * x[0] + 3 * y[0], abs=1e-3)
    assert inside > 20
    with pytest.raises(ValueError):
        spatial.align(plane, "z", source, target, "cubic")


def test_valid_points_stay_inside(spark):
    """A triangle and a box of one group: points lie inside, on valid cells, as dense in both; a group without area has none."""
    tri, box = [(0, 0, 20, 0), (20, 0, 0, 20), (0, 20, 0, 0)], [(30, 0, 40, 0), (40, 0, 40, 20), (40, 20, 30, 20), (30, 20, 30, 0)]
    e = spark.createDataFrame([(1, "a", *map(float, x)) for x in tri] + [(2, "a", *map(float, x)) for x in box] + [(3, "b", 5.0, 5.0, 5.0, 5.0)], "feature_id long, zone string, x1 double, y1 double, x2 double, y2 double")
    raster = spark.createDataFrame([(r, c, None if r < 3 else 1.0) for r in range(20) for c in range(40)], "row_id int, col_id int, v double")
    from cellframe.operators import labels

    got = labels.valid_points(e, raster, "v", 400, 1).collect()
    assert len(got) == 400 and all(r["y"] >= 3 and (r["x"] + r["y"] <= 20 if r["feature_id"] == 1 else 30 <= r["x"] <= 40) for r in got)
    assert 0.6 < sum(r["feature_id"] == 1 for r in got) / sum(r["feature_id"] == 2 for r in got) * 170 / 144.5 < 1.6
