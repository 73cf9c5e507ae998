import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.functions import algebra as alg
from cellframe.operators import composite, focal
from cellframe.sources import io
from cellframe.sources.grid import GridSpec, patch_grid, reference_grid


def frame(spark, array, name="v"):
    rows = [(i, j, None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v)) for i, line in enumerate(array) for j, v in enumerate(line)]
    return spark.createDataFrame(rows, f"row_id int, col_id int, {name} double")


def array(df, column, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        if r[column] is not None:
            out[r["row_id"], r["col_id"]] = r[column]
    return out


def brute(z, size, stat, mode=None):
    lo, hi = size // 2, size - size // 2 - 1
    if mode:
        z = np.pad(z, ((lo, hi), (lo, hi)), mode="edge" if mode == "nearest" else "symmetric")
    out = np.full((z.shape[0] - (lo + hi if mode else 0), z.shape[1] - (lo + hi if mode else 0)), np.nan)
    for i in range(out.shape[0]):
        for j in range(out.shape[1]):
            a, b = (i + lo, j + lo) if mode else (i, j)
            w = z[max(0, a - lo) : a + hi + 1, max(0, b - lo) : b + hi + 1]
            w = w[~np.isnan(w)]
            if len(w):
                out[i, j] = {"mean": w.mean, "std": w.std, "max": w.max}[stat]()
    return out


@pytest.mark.parametrize("size", [3, 4, 5])
def test_box_statistics(spark, size):
    rng = np.random.default_rng(size)
    z = rng.normal(size=(9, 11))
    z[rng.random(z.shape) < 0.3] = np.nan
    z[:5, :5] = np.nan
    got = focal.box(frame(spark, z.tolist()), "v", size)
    for stat in ("mean", "std", "max"):
        assert np.allclose(array(got, f"v_w{size}_{stat}", z.shape), brute(z, size, stat), equal_nan=True, atol=1e-7)


@pytest.mark.parametrize("mode", ["nearest", "reflect"])
@pytest.mark.parametrize("size", [3, 4, 5])
def test_borders(spark, size, mode):
    z = np.random.default_rng(1).normal(size=(7, 8))
    z[2, 3] = np.nan
    got = focal.bordered_box(frame(spark, z.tolist()), "v", size, 7, 8, mode)
    for stat in ("mean", "std"):
        assert np.allclose(array(got, f"v_w{size}_{stat}", z.shape), brute(z, size, stat, mode), equal_nan=True, atol=1e-7)


def test_plane_has_constant_slope_and_no_curvature(spark):
    z = [[2.0 * j + 3.0 * i for j in range(5)] for i in range(5)]
    s = focal.slope_aspect(frame(spark, z), "v", 1.0)
    dy, dx = np.gradient(np.array(z))
    assert np.allclose(array(s, "slope", (5, 5)), np.degrees(np.arctan(np.hypot(dx, dy))))
    assert np.allclose(array(s, "aspect", (5, 5)), np.degrees(np.arctan2(-dx, dy)) % 360)
    assert np.allclose(array(focal.curvature(frame(spark, z), "v"), "curvature", (5, 5))[1:-1, 1:-1], 0)


def test_gradient_beside_holes_and_single_cells(spark):
    g = focal.gradients(frame(spark, [[1.0, None, 4.0, 6.0]]), "v", 1.0).orderBy("col_id").collect()
    assert [r["dz_dx"] for r in g] == [None, None, 2.0, 2.0]


def test_gaussian_equals_convolution(spark):
    z = np.zeros((6, 7))
    pts = [(1, 1, 2.0), (1, 1, 3.0), (4, 5, 1.0)]
    num, den = z.copy(), z.copy()
    k = dict(focal.kernel(0.8))
    for i, j, v in pts:
        for a in range(6):
            for b in range(7):
                w = k.get(a - i, 0) * k.get(b - j, 0)
                num[a, b] += v * w
                den[a, b] += w
    got = array(focal.gaussian_surface(spark.createDataFrame(pts, "row_id int, col_id int, v double"), "v", 0.8, 6, 7), "surface", z.shape)
    assert np.allclose(np.nan_to_num(got), np.where(den > 1e-8, num / np.maximum(den, 1e-300), 0))


def test_percentiles_equal_numpy(spark):
    from cellframe.functions.ranks import percentiles

    rng = np.random.default_rng(0)
    for x in (rng.normal(size=3000), np.concatenate([np.zeros(2000), [1e12, -5.0, 3.0]]), np.ones(10), np.array([2.0])):
        df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double")
        for small in (20, 10_000):
            assert np.allclose(percentiles(df, "v", (0, 0.02, 0.5, 0.997, 1), small), np.quantile(x, (0, 0.02, 0.5, 0.997, 1)))
    assert percentiles(df.where("v > 5"), "v", (0.5,)) == [None]


def test_ratios_and_indices(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 0.0, None, 2.0), (0, 1, 2.0, 2.0, 2.0, 0.0)], "row_id int, col_id int, B08 double, B04 double, B02 double, B11 double")
    a = df.select(alg.safe_ratio(F.col("B08"), F.col("B04")), alg.norm_diff(F.col("B08"), F.col("B02"))).collect()
    assert a[0][0] is None and a[0][1] is None and a[1] == (1.0, 0.0)
    i = alg.indices(df, alg.S2_INDICES)
    assert i.columns == ["row_id", "col_id", "NDVI", "Ferrous_Iron", "Ferric_Iron", "BSI"]
    assert i.collect()[0]["BSI"] is None and i.collect()[1]["Ferrous_Iron"] is None


def test_ingestion_makes_one_missing_value(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (-9999.0,), (0.0,), (None,), (float("inf"),)], "v double")
    assert [r[0] for r in io.clean(df, ["v"]).collect()] == [1.0, None, None, 0.0, None, None]
    assert [r[0] for r in io.clean(df, ["v"], zero=True).collect()] == [1.0] + [None] * 5


def test_layers_round_trip(spark, tmp_path):
    z = frame(spark, np.arange(600 * 4).reshape(600, 4).tolist())
    io.write_layer(z, str(tmp_path), "dem")
    back = io.read_layer(spark, str(tmp_path), "dem", ["v"])
    assert sorted(tuple(r)[:2] + (r["v"],) for r in back.collect()) == sorted(map(tuple, z.collect()))
    part = io.window(back, 510, 1, 4, 2)
    assert part.count() == 8 and "PartitionFilters: [isnotnull(row_block" in part._jdf.queryExecution().toString()
    assert io.band_names(z, ["v", "w"]).first()["w"] == 0.0


def test_csv_versions_metadata(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    io.write_csv(df, f"{tmp_path}/csv")
    assert io.read_csv(spark, f"{tmp_path}/csv", "x int, s string").collect() == df.collect()
    first, second = io.write_version(df, f"{tmp_path}/v"), io.write_version(df, f"{tmp_path}/v")
    assert first.endswith("v1") and second.endswith("v2") and io.exists(spark, second) and not io.exists(spark, f"{tmp_path}/no")
    io.save_metadata(spark, f"{tmp_path}/m", features=["a", "b"], config=io.Config())
    assert io.load_metadata(spark, f"{tmp_path}/m")["features"] == ["a", "b"]
    with pytest.raises(ValueError):
        io.Config.of({"no": 1})
    mosaic = io.virtual_mosaic(spark, {"v": [first, second]})
    assert mosaic["v"].count() == 2
    assert io.rename_assets(spark.createDataFrame([(1,)], "blue int")).columns == ["B02"]


def test_catalog_retries_and_pages():
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "ok"

    assert io.retried(flaky, sleep=waits.append) == "ok" and waits == [10.0, 20.0]
    with pytest.raises(ZeroDivisionError):
        io.retried(lambda: 1 / 0, tries=2, sleep=waits.append)
    pages = [[1, 2], [3, 4], [5]]
    assert io.paged(lambda k: pages[k] if k < 3 else [], 4) == [1, 2, 3, 4] and io.paged(lambda k: pages[k] if k < 3 else []) == [1, 2, 3, 4, 5]


def test_greedy_coverage_equals_a_loop(spark, sf):
    from cellframe.plans.rasters import greedy_coverage

    rows = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_suppkey as s", "(l_partkey % 40) * 40 + l_orderkey % 40 as c", "l_linenumber * 5 as cloud").collect()
    cells, cloud = {}, {}
    for r in rows:
        cells.setdefault(r["s"], set()).add(r["c"])
        cloud[r["s"]] = min(cloud.get(r["s"], 100), r["cloud"])
    total, covered, want = len(set().union(*cells.values())), set(), []
    while len(covered) < 0.9 * total:
        best = min(cells, key=lambda s: (-len(cells[s] - covered), cloud[s], s))
        gain = len(cells[best] - covered)
        if gain < 0.005 * total:
            break
        want.append((best, len(want) + 1, gain))
        covered |= cells[best]
    got = [tuple(r) for r in greedy_coverage(spark, sf).orderBy("step").collect()]
    assert got[: len(want)] == want and all(r[2] == 0 for r in got[len(want) :])


def test_fill_takes_all_bands_together(spark):
    a = spark.createDataFrame([(0, 0, 1.0, None), (0, 1, 1.0, 1.0), (0, 2, None, 1.0)], "row_id int, col_id int, p double, q double")
    b = spark.createDataFrame([(0, 0, 5.0, 6.0), (0, 1, 5.0, 6.0), (0, 2, 5.0, None)], "row_id int, col_id int, p double, q double")
    got = composite.patch_fill(a, b, ["p", "q"])
    assert [tuple(r) for r in got.orderBy("col_id").collect()] == [(0, 0, 5.0, 6.0, True), (0, 1, 1.0, 1.0, False), (0, 2, None, 1.0, False)]
    assert tuple(composite.fill_report(got, ["p", "q"]).first()) == (3, 1, 1)


def test_grids(spark):
    g = GridSpec.snapped(430_000, 6_185_000, 480_000, 6_235_000, 90)
    assert (g.width, g.height, g.x0 % 90, g.y0 % 90) == (557, 556, 0, 0)
    r = reference_grid(spark, GridSpec(0, 20, 10, 3, 2))
    assert [tuple(x) for x in r.orderBy("row_id", "col_id").collect()] == [(0, 0, 5, 15), (0, 1, 15, 15), (0, 2, 25, 15), (1, 0, 5, 5), (1, 1, 15, 5), (1, 2, 25, 5)]
    back = r.select("row_id", "col_id", GridSpec(0, 20, 10, 3, 2).row(F.col("y")).alias("a"), GridSpec(0, 20, 10, 3, 2).col(F.col("x")).alias("b")).where("row_id <> a OR col_id <> b")
    assert back.count() == 0
    p = patch_grid(spark.createDataFrame([("n", 10.0, 10.0, 6730.0, 20.0)], "segment string, minx double, miny double, maxx double, maxy double"), 6720)
    assert [x["patch_id"] for x in p.orderBy("patch_id").collect()] == ["n_r000_c000", "n_r000_c001"]


def test_patches_are_full_and_valid(spark):
    z = [[float(i * 10 + j) for j in range(10)] for i in range(9)]
    z[0][0] = None
    got = {(r["row_id"], r["col_id"]): r for r in focal.patches(frame(spark, z), "v", 4, 3, 9, 10, 0.7).collect()}
    assert set(got) == {(i, j) for i in (0, 3) for j in (0, 3, 6)} and got[0, 0]["valid"] == 15 / 16
    assert got[3, 3]["mean"] == np.array(z, float)[3:7, 3:7].mean() and got[3, 3]["center_row"] == 5


def test_streaming_equals_batch(spark, sf, tmp_path):
    from cellframe.sources.fixtures import view
    from cellframe.streaming.composite import windowed_mean

    obs = view(spark, sf, "obs").limit(2000)
    obs.write.parquet(f"{tmp_path}/in")
    batch = windowed_mean(spark.read.parquet(f"{tmp_path}/in"), ["B02"], late="3650 days")
    stream = windowed_mean(spark.readStream.schema(obs.schema).parquet(f"{tmp_path}/in"), ["B02"], late="3650 days")
    q = stream.writeStream.outputMode("update").format("memory").queryName("windows").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(str, spark.table("windows").collect())) == sorted(map(str, batch.collect()))
