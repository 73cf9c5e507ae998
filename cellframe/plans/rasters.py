"""Registered queries over grids, algebra, composites and windows, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.functions import algebra as alg
from cellframe.operators import composite, focal
from cellframe.sources import io
from cellframe.sources.fixtures import view, with_views
from cellframe.sources.grid import GridSpec, degree_chunks, named_north_to_south, patch_grid, reference_grid, snapped_chunks

S2 = ("B02", "B03", "B04", "B05", "B08", "B8A", "B11", "B12")
QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Sums depend on the order of addition in their last bits; results are rounded on both sides."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Grids and generators


@query("SELECT CAST(i // 120 AS INTEGER) AS row_id, CAST(i % 120 AS INTEGER) AS col_id, 429930.0e0 + (i % 120 + 0.5e0) * 90 AS x, 6190020.0e0 - (i // 120 + 0.5e0) * 90 AS y FROM range(6720) t(i)")
def grid_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid snapped to its cells: 120 columns and 56 rows."""
    grid = GridSpec.snapped(430_000, 6_185_000, 440_700, 6_190_000, 90)
    return reference_grid(spark, grid)


@query(with_views(""", b AS (SELECT feature_id, x0 * 1000 AS minx, y0 * 1000 AS miny, x1 * 1000 AS maxx, y1 * 1000 AS maxy FROM zones
), n AS (SELECT *, floor(minx / 6720) * 6720 AS px, floor(miny / 6720) * 6720 AS py FROM b
), g AS (SELECT *, unnest(range(CAST(ceil((maxy - py) / 6720) AS BIGINT))) AS r FROM n
), h AS (SELECT *, unnest(range(CAST(ceil((maxx - px) / 6720) AS BIGINT))) AS c FROM g)
SELECT feature_id, CAST(r AS INTEGER) AS row_id, CAST(c AS INTEGER) AS col_id, format('{}_r{:03d}_c{:03d}', feature_id, r, c) AS patch_id,
  px + c * 6720 AS minx, py + r * 6720 AS miny, px + c * 6720 + 6720 AS maxx, py + r * 6720 + 6720 AS maxy FROM h
WHERE px + c * 6720 <= maxx AND px + c * 6720 + 6720 >= minx AND py + r * 6720 <= maxy AND py + r * 6720 + 6720 >= miny""", "zones"))  # fmt: skip
def patch_grid_over_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = view(spark, sf_dir, "zones")
    boxes = z.select("feature_id", *[(F.col(a) * 1000).alias(b) for a, b in (("x0", "minx"), ("y0", "miny"), ("x1", "maxx"), ("y1", "maxy"))])
    return patch_grid(boxes, 6720, "feature_id")


@query(with_views(""", a AS (SELECT feature_id, x0, y0, x1, y1, unnest(range(CAST(ceil((x1 - x0) / 2.5e0) AS BIGINT))) AS i FROM zones
), b AS (SELECT *, unnest(range(CAST(ceil((y1 - y0) / 2.5e0) AS BIGINT))) AS j FROM a)
SELECT feature_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(x0 + i * 2.5e0, 4) AS x0, round(y0 + j * 2.5e0, 4) AS y0,
  round(least(x0 + i * 2.5e0 + 2.5e0, x1), 4) AS x1, round(least(y0 + j * 2.5e0 + 2.5e0, y1), 4) AS y1 FROM b""", "zones"))  # fmt: skip
def degree_chunks_over_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = view(spark, sf_dir, "zones").selectExpr("feature_id", "x0 as minx", "y0 as miny", "x1 as maxx", "y1 as maxy")
    return degree_chunks(z, 2.5, "feature_id")


@query(with_views(""", a AS (SELECT x0, y0, x1, y1, unnest(range(CAST(floor(x0 / 3) AS BIGINT), CAST(greatest(floor(x0 / 3), ceil(x1 / 3) - 1) AS BIGINT) + 1)) AS i FROM zones WHERE zone <> 'none'
), b AS (SELECT i, unnest(range(CAST(floor(y0 / 3) AS BIGINT), CAST(greatest(floor(y0 / 3), ceil(y1 / 3) - 1) AS BIGINT) + 1)) AS j FROM a)
SELECT DISTINCT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, i * 3.0e0 AS x0, j * 3.0e0 AS y0, (i + 1) * 3.0e0 AS x1, (j + 1) * 3.0e0 AS y1 FROM b""", "zones"))  # fmt: skip
def training_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapped_chunks(view(spark, sf_dir, "zones").where("zone <> 'none'"), 3.0)


@query(with_views(""", n AS (SELECT feature_id, y1, row_number() OVER (ORDER BY y1 DESC, feature_id) AS n FROM zones)
SELECT feature_id, y1 AS maxy, CAST(n AS INTEGER) AS n, coalesce(['norte', 'centro_n', 'centro_s', 'sur'][n], 'tile_' || n) AS tile, CAST(CASE WHEN n <= 4 THEN n ELSE 9 END AS INTEGER) AS priority FROM n""", "zones"))
def tiles_north_to_south(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = view(spark, sf_dir, "zones").selectExpr("feature_id", "y1 as maxy")
    return named_north_to_south(z, ["norte", "centro_n", "centro_s", "sur"])


@query(with_views("""SELECT category, count(*) AS cells, CAST(sum(CASE WHEN dem IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS holes, round(100 * avg(CASE WHEN dem IS NULL THEN 1.0e0 ELSE 0 END), 6) AS pct FROM grid GROUP BY ROLLUP (category)""", "grid"))
def valid_ratio_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.hole_report(view(spark, sf_dir, "grid"), "category", "dem")


@query(with_views("SELECT row_id, col_id, dem FROM grid WHERE row_id BETWEEN 5 AND 12 AND col_id BETWEEN 10 AND 29", "grid"))
def windowed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.window(view(spark, sf_dir, "grid").select("row_id", "col_id", "dem"), 5, 10, 8, 20)


# Algebra

_ND = "CASE WHEN {a} + {b} <> 0 THEN greatest(-1.0e0, least(1.0e0, ({a} - {b}) / ({a} + {b}))) END"


@query(with_views(f"""SELECT scene_id, row_id, col_id, {_ND.format(a="B08", b="B04")} AS NDVI, {_ND.format(a="B03", b="B08")} AS NDWI, B11 / nullif(B12, 0) AS Clay_Index, B08 / nullif(B11, 0) AS Ferrous_Iron,
  B04 / nullif(B02, 0) AS Ferric_Iron, B04 / nullif(B03, 0) AS Iron_Oxide, B05 / nullif(B11, 0) AS Propylitic_Proxy, B11 / nullif(B8A, 0) AS Hydroxyl_Bearing,
  B04 / (B03 + 1e-10) * (B04 / (B02 + 1e-10)) AS Fe_Oxide_Composite, CASE WHEN B11 + B04 + B08 + B02 <> 0 THEN (B11 + B04 - B08 - B02) / (B11 + B04 + B08 + B02 + 1e-10) END AS BSI FROM obs""", "obs"))  # fmt: skip
def s2_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alg.indices(view(spark, sf_dir, "obs"), alg.S2_INDICES, ("scene_id", "row_id", "col_id"))


_ASTER = "B01 B02 B03 B04 B05 B06 B07 B08 B09 B10 B11 B12 B13 B14".split()
_ASTER_SQL = ", ".join(f"nullif((l_partkey * {i + 3} + l_suppkey * {i + 1}) % 97, 0) * 1.0e0 AS {b}" for i, b in enumerate(_ASTER))


@query(f"""WITH a AS (SELECT l_orderkey, l_linenumber, {_ASTER_SQL} FROM lineitem)
SELECT l_orderkey, l_linenumber, B05 / B07 AS Alunite, B04 / B06 AS Kaolinite, B06 / B09 AS Propylitic_ASTER, B06 / B08 AS Carbonate, B07 / B06 AS Potassic, B02 / B01 AS Fe_Oxide_ASTER,
  B11 / B10 AS Silica_TIR, (B12 + B13) / (B10 + B14 + 1e-10) AS Calc_Silicate, B02 / B03 AS Gossan_ASTER FROM a""")
def aster_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    bands = [(F.nullif((F.col("l_partkey") * (i + 3) + F.col("l_suppkey") * (i + 1)) % 97, F.lit(0)) * F.lit(1.0)).alias(b) for i, b in enumerate(_ASTER)]
    return alg.indices(li.select("l_orderkey", "l_linenumber", *bands), alg.ASTER_INDICES, ("l_orderkey", "l_linenumber"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) AS ratio FROM lineitem")
def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", alg.safe_ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("ratio"))


@query(f"SELECT l_orderkey, l_linenumber, {_ND.format(a='l_discount', b='l_tax')} AS nd FROM lineitem")
def norm_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select("l_orderkey", "l_linenumber", alg.norm_diff(F.col("l_discount"), F.col("l_tax")).alias("nd"))


@query(with_views("SELECT scene_id, row_id, col_id, " + ", ".join(f"CASE WHEN {b} <> 0 THEN greatest(0.0e0, least(1.0e0, {b} / 10000.0e0)) END AS {b}" for b in S2[:3]) + " FROM obs", "obs"))
def reflectance_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select("scene_id", "row_id", "col_id", *[alg.reflectance(F.col(b)).alias(b) for b in S2[:3]])


@query(with_views("SELECT row_id, col_id, nullif(v, 0) AS dem, CASE WHEN dem <> 0 THEN nullif(v / (dem + 1e-10), 0) END AS ratio FROM grid", "grid"))
def sar_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = view(spark, sf_dir, "grid")
    return g.select("row_id", "col_id", alg.elevation(F.col("v")).alias("dem"), alg.radar_ratio(F.col("v"), F.col("dem")).alias("ratio"))


@query(with_views("SELECT scene_id, row_id, col_id, " + ", ".join(f"coalesce((({b} / 10000.0e0) * 10000.0e0 - {m}) / ({s} + 1e-8), 0) AS {b}" for b, (m, s) in alg.BAND_STATS.items()) + " FROM obs", "obs"))
def band_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select("scene_id", "row_id", "col_id", *[alg.standardised(F.col(b) / 10_000.0, m, s).alias(b) for b, (m, s) in alg.BAND_STATS.items()])


@query(with_views("SELECT scene_id, row_id, col_id, B02 IS NOT NULL AND B02 <> 0 AS valid, " + " AND ".join(f"{b} IS NOT NULL" for b in S2) + " AS all_valid FROM obs", "obs"))
def validity_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").select("scene_id", "row_id", "col_id", alg.valid(F.col("B02")).alias("valid"), alg.all_valid(S2).alias("all_valid"))


@query(with_views(""", p AS (SELECT quantile_cont(dem, 0.02) AS a, quantile_cont(dem, 0.98) AS b FROM grid)
SELECT row_id, col_id, CASE WHEN dem IS NOT NULL THEN round(greatest(0, least(1, (dem - a) / greatest(b - a, 1e-6))), 6) END AS dem FROM grid, p""", "grid"))
def percentile_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(alg.stretched(view(spark, sf_dir, "grid").select("row_id", "col_id", "dem"), ["dem"]), "dem")


@query("SELECT CAST(row_number() OVER (ORDER BY c) AS INTEGER) AS codigo, c AS categoria FROM (SELECT DISTINCT trim(coalesce(CASE WHEN p_size > 5 THEN p_type END, 'DESCONHECIDO')) AS c FROM part) UNION ALL SELECT -1, 'sem_dados'")
def category_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return alg.legend_of(part.select(F.when(F.col("p_size") > 5, F.col("p_type")).alias("kind")), "kind")


@query("""WITH l AS (SELECT row_number() OVER (ORDER BY c) AS codigo, c FROM (SELECT DISTINCT p_brand AS c FROM part WHERE p_size > 25))
SELECT p_partkey, CAST(coalesce(codigo, -1) AS INTEGER) AS codigo FROM part LEFT JOIN l ON c = p_brand""")
def legend_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    legend = alg.legend_of(part.where("p_size > 25"), "p_brand").where("codigo > 0")
    return alg.encoded(part.select("p_partkey", "p_brand"), "p_brand", legend).select("p_partkey", "codigo")


@query(with_views("""SELECT patch_id, regexp_extract(patch_id, '^(.*)_r(\\d+)_c(\\d+)$', 1) AS stem, CAST(regexp_extract(patch_id, '^(.*)_r(\\d+)_c(\\d+)$', 2) AS INTEGER) AS row_id,
  CAST(regexp_extract(patch_id, '^(.*)_r(\\d+)_c(\\d+)$', 3) AS INTEGER) AS col_id FROM patches""", "patches"))
def patch_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    stem, row, col = alg.patch_id_parts(F.col("patch_id"))
    return view(spark, sf_dir, "patches").select("patch_id", stem.alias("stem"), row.alias("row_id"), col.alias("col_id"))


@query("SELECT p_partkey, CASE WHEN lower(trim(p_name)) IN ('4b', '4c') THEN 'porfiro' ELSE 'outro' END AS deposit_type, CASE WHEN lower(trim(p_name)) IN ('4b', '4c') THEN 1500.0e0 ELSE 500.0e0 END AS buffer_m FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN ' 4B' WHEN 1 THEN '4c' ELSE p_name END AS p_name FROM part)")
def occurrence_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    code = F.when(F.col("p_partkey") % 5 == 0, " 4B").when(F.col("p_partkey") % 5 == 1, "4c").otherwise(F.col("p_name"))
    return io.occurrences(part.select("p_partkey", code.alias("cod_modelo")), "cod_modelo", {"porfiro": 1500.0}).drop("cod_modelo")


@query(with_views("""SELECT row_id, col_id, format('{}-{:03d}', upper(substr(category, 1, 3)), row_id + 1) AS target_id, format('{}_r{:03d}_c{:03d}', category, row_id, col_id) AS patch_id,
  split_part('s2_' || category || '_-69.5_' || col_id, '_-', 1) AS layer FROM grid""", "grid"))
def id_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = view(spark, sf_dir, "grid")
    name = F.concat(F.lit("s2_"), F.col("category"), F.lit("_-69.5_"), F.col("col_id").cast("string"))
    patch = F.format_string("%s_r%03d_c%03d", F.col("category"), F.col("row_id"), F.col("col_id"))
    return g.select("row_id", "col_id", alg.target_id(F.col("category"), F.col("row_id") + 1).alias("target_id"), patch.alias("patch_id"), alg.chunk_key(name).alias("layer"))


@query(with_views(", a AS (SELECT row_id, col_id, v FROM grid WHERE v > 20), b AS (SELECT row_id, col_id, dem FROM grid WHERE dem > 300) SELECT row_id, col_id, v, dem FROM a FULL JOIN b USING (row_id, col_id)", "grid"))
def band_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = view(spark, sf_dir, "grid")
    return io.band_stack([g.where("v > 20").select("row_id", "col_id", "v"), g.where("dem > 300").select("row_id", "col_id", "dem")])


_MASKS = ", a AS (SELECT row_id, col_id FROM grid WHERE v > 20), b AS (SELECT row_id, col_id FROM grid WHERE dem > 300), x AS (SELECT row_id, col_id FROM grid WHERE category = 'click')"


@query(with_views(f"{_MASKS} (SELECT * FROM a INTERSECT SELECT * FROM b) EXCEPT SELECT * FROM x", "grid"))
def mask_set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells in both masks but not in a third, as set operations on cells."""
    g = view(spark, sf_dir, "grid")
    cells = lambda where: g.where(where).select("row_id", "col_id")
    return cells("v > 20").intersect(cells("dem > 300")).subtract(cells("category = 'click'"))


@query(with_views("SELECT category, count(v) AS n, round(avg(v / 100), 9) AS mean_prob FROM grid GROUP BY 1", "grid"))
def tile_mean_prob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "grid").groupBy("category").agg(F.count("v").alias("n"), F.round(F.avg(F.col("v") / 100), 9).alias("mean_prob"))


# Composites


@query(with_views("SELECT row_id, col_id, " + ", ".join(f"median(CASE WHEN {b} > 0 THEN {b} END) AS {b}" for b in S2) + " FROM obs WHERE cloud < 20 AND month(ts) BETWEEN 3 AND 10 GROUP BY 1, 2", "obs"))
def median_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.median_composite(composite.dry_and_clear(view(spark, sf_dir, "obs"), 20), S2)


@query(with_views("SELECT scene_id, ts, cloud, count(*) AS cells FROM obs WHERE cloud < 15 AND month(ts) BETWEEN 3 AND 10 AND ts >= TIMESTAMP '1995-01-01' AND ts < TIMESTAMP '1997-01-01' GROUP BY 1, 2, 3", "obs"))
def scene_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = composite.dry_and_clear(view(spark, sf_dir, "obs"), 15, start="1995-01-01", end="1997-01-01")
    return some.groupBy("scene_id", "ts", "cloud").agg(F.count("*").alias("cells"))


_TILES = "SELECT row_id, col_id, scene_id AS tile, min(B02) AS B02, min(B03) AS B03 FROM obs GROUP BY 1, 2, 3"


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "obs").groupBy("row_id", "col_id", F.col("scene_id").alias("tile")).agg(F.min("B02").alias("B02"), F.min("B03").alias("B03"))


@query(with_views(f", t AS ({_TILES}) SELECT row_id, col_id, arg_min(B02, tile) FILTER (B02 IS NOT NULL) AS B02, arg_min(B03, tile) FILTER (B03 IS NOT NULL) AS B03 FROM t GROUP BY 1, 2", "obs"))
def mosaic_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite.first_mosaic(_tiles(spark, sf_dir), "tile", ["B02", "B03"])


@query(with_views(f", t AS ({_TILES}) SELECT row_id, col_id, round(avg(B02), 9) AS B02, round(avg(B03), 9) AS B03 FROM t GROUP BY 1, 2", "obs"))
def multi_source_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = composite.mean_mosaic(_tiles(spark, sf_dir), ["B02", "B03"])
    return out.withColumns({b: F.round(b, 9) for b in ("B02", "B03")})


@query(with_views("SELECT row_id, col_id, greatest(v, dem) AS best FROM grid", "grid"))
def composite_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "grid").select("row_id", "col_id", composite.greatest_of(["v", "dem"]).alias("best"))


@query(with_views(""", p AS (SELECT row_id, (col_id + 1) % 50 AS col_id, v AS pv, dem AS pd FROM grid)
SELECT row_id, col_id, CASE WHEN f THEN pv ELSE v END AS v, CASE WHEN f THEN pd ELSE dem END AS dem, f AS filled
FROM (SELECT *, NOT (v IS NOT NULL AND dem IS NOT NULL) AND pv IS NOT NULL AND pd IS NOT NULL AS f FROM grid LEFT JOIN p USING (row_id, col_id))""", "grid"))
def patch_fill_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = view(spark, sf_dir, "grid").select("row_id", "col_id", "v", "dem")
    return composite.patch_fill(g, g.withColumn("col_id", (F.col("col_id") + 1) % 50), ["v", "dem"])


@query()
def greedy_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes by greedy coverage; an iteration, compared with a loop in the tests."""
    obs = view(spark, sf_dir, "obs")
    cells = obs.select("scene_id", (F.col("row_id") * 40 + F.col("col_id")).alias("cell"))
    return composite.greedy_coverage(cells, obs.groupBy("scene_id").agg(F.min("cloud").alias("cloud")), 0.9, 0.005, 12)


# Windows


def _box_sql(value: str, size: int, view_name: str = "grid") -> str:
    lo, hi = size // 2, size - size // 2 - 1
    return f"""a AS (SELECT row_id, col_id, count({value}) OVER h AS n, sum({value}) OVER h AS s, sum({value} * {value}) OVER h AS q, max({value}) OVER h AS m FROM {view_name}
  WINDOW h AS (PARTITION BY row_id ORDER BY col_id RANGE BETWEEN {lo} PRECEDING AND {hi} FOLLOWING)
), b AS (SELECT row_id, col_id, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q, max(m) OVER w AS m FROM a
  WINDOW w AS (PARTITION BY col_id ORDER BY row_id RANGE BETWEEN {lo} PRECEDING AND {hi} FOLLOWING))"""


def _focal(spark: SparkSession, sf_dir: str, size: int, stat: str, places: int = 6) -> DataFrame:
    out = focal.box(view(spark, sf_dir, "grid").select("row_id", "col_id", "v"), "v", size, (stat,))
    return out.select("row_id", "col_id", F.round(f"v_w{size}_{stat}", places).alias(stat))


@query(with_views(f", {_box_sql('v', 7)} SELECT row_id, col_id, round(s / nullif(n, 0), 9) AS mean FROM b", "grid"))
def focal_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _focal(spark, sf_dir, 7, "mean", 9)


@query(with_views(f", {_box_sql('v', 8)} SELECT row_id, col_id, CASE WHEN n > 0 THEN round(sqrt(greatest(q / n - (s / n) * (s / n), 0)), 6) END AS std FROM b", "grid"))
def focal_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _focal(spark, sf_dir, 8, "std")


@query(with_views(f", {_box_sql('v', 5)} SELECT row_id, col_id, round(m, 6) AS max FROM b", "grid"))
def focal_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _focal(spark, sf_dir, 5, "max")


def _height(spark: SparkSession, sf_dir: str) -> int:
    return spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max(F.floor(F.col("event_id") / 50))).first()[0] + 1


@query(with_views(""", o AS (SELECT unnest(range(-2, 3)) AS d), h AS (SELECT max(row_id) AS hr FROM grid
), p AS (SELECT g.row_id, g.col_id, x.v FROM grid g, h, o a, o b, grid x WHERE x.row_id = greatest(0, least(hr, g.row_id + a.d)) AND x.col_id = greatest(0, least(49, g.col_id + b.d)))
SELECT row_id, col_id, round(avg(v), 6) AS mean, CASE WHEN count(v) > 0 THEN round(sqrt(greatest(avg(v * v) - avg(v) * avg(v), 0)), 5) END AS std FROM p GROUP BY 1, 2""", "grid"))
def focal_nearest_border(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = focal.bordered_box(view(spark, sf_dir, "grid"), "v", 5, _height(spark, sf_dir), 50, "nearest")
    return out.select("row_id", "col_id", F.round("v_w5_mean", 6).alias("mean"), F.round("v_w5_std", 5).alias("std"))


_SIDE = "CASE WHEN {f}({at}) OVER {w} = {at} {s} 1 THEN {f}({z}) OVER {w} END"


def _grad(at: str, w: str, res: str, z: str = "z") -> str:
    b, a = _SIDE.format(f="lag", at=at, w=w, s="-", z=z), _SIDE.format(f="lead", at=at, w=w, s="+", z=z)
    return f"CASE WHEN ({b}) IS NOT NULL AND ({a}) IS NOT NULL THEN (({a}) - ({b})) / (2 * {res}) WHEN ({a}) IS NOT NULL THEN (({a}) - {z}) / {res} WHEN ({b}) IS NOT NULL THEN ({z} - ({b})) / {res} END"


@query(with_views(f""", g AS (SELECT row_id, col_id, dem AS z FROM grid), d AS (SELECT row_id, col_id, z, {_grad("col_id", "x", "30.0e0")} AS dx, {_grad("row_id", "y", "30.0e0")} AS dy FROM g
  WINDOW x AS (PARTITION BY row_id ORDER BY col_id), y AS (PARTITION BY col_id ORDER BY row_id)), e AS (SELECT *, degrees(atan2(-dx, dy)) AS a FROM d)
SELECT row_id, col_id, CASE WHEN z IS NOT NULL THEN round(degrees(atan(sqrt(dx * dx + dy * dy))), 6) END AS slope, CASE WHEN z IS NOT NULL THEN round(CASE WHEN a < 0 THEN a + 360 ELSE a END, 6) END AS aspect FROM e""", "grid"))
def slope_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(focal.slope_aspect(view(spark, sf_dir, "grid"), "dem", 30.0), "slope", "aspect")


@query(with_views(""", o AS (SELECT unnest(range(-2, 3)) AS d), h AS (SELECT max(row_id) AS hr FROM grid
), q AS (SELECT g.row_id, g.col_id, g.dem, g.row_id + a.d AS r, g.col_id + b.d AS c, hr FROM grid g, h, o a, o b
), p AS (SELECT row_id, col_id, dem, CASE WHEN r < 0 THEN -1 - r WHEN r > hr THEN 2 * hr + 1 - r ELSE r END AS r, CASE WHEN c < 0 THEN -1 - c WHEN c > 49 THEN 99 - c ELSE c END AS c FROM q)
SELECT p.row_id, p.col_id, round(any_value(p.dem) - avg(x.dem), 6) AS tpi FROM p JOIN grid x ON x.row_id = p.r AND x.col_id = p.c GROUP BY 1, 2""", "grid"))
def tpi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(focal.tpi(view(spark, sf_dir, "grid"), "dem", 5, _height(spark, sf_dir), 50), "tpi")


@query(with_views(""", g AS (SELECT row_id, col_id, dem AS z FROM grid)
SELECT a.row_id, a.col_id, CASE WHEN a.z IS NOT NULL THEN round((coalesce(l.z, a.z) - a.z) + (coalesce(r.z, a.z) - a.z) + (coalesce(u.z, a.z) - a.z) + (coalesce(d.z, a.z) - a.z), 6) END AS curvature FROM g a
LEFT JOIN g l ON l.row_id = a.row_id AND l.col_id = a.col_id - 1 LEFT JOIN g r ON r.row_id = a.row_id AND r.col_id = a.col_id + 1
LEFT JOIN g u ON u.col_id = a.col_id AND u.row_id = a.row_id - 1 LEFT JOIN g d ON d.col_id = a.col_id AND d.row_id = a.row_id + 1""", "grid"))
def curvature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(focal.curvature(view(spark, sf_dir, "grid"), "dem"), "curvature")


_KERNEL = ", ".join(f"({d}, {w!r})" for d, w in focal.kernel(1.5))


@query(with_views(f""", k(d, w) AS (VALUES {_KERNEL}), p AS (SELECT row_id, col_id, sum(v) AS num, CAST(count(v) AS DOUBLE) AS den FROM grid GROUP BY 1, 2
), h AS (SELECT max(row_id) AS hr FROM grid), s AS (SELECT p.row_id + a.d AS row_id, p.col_id + b.d AS col_id, sum(num * a.w * b.w) AS num, sum(den * a.w * b.w) AS den FROM p, k a, k b GROUP BY 1, 2)
SELECT CAST(row_id AS INTEGER) AS row_id, CAST(col_id AS INTEGER) AS col_id, round(CASE WHEN den > 1e-8 THEN num / den ELSE 0 END, 6) AS surface FROM s, h WHERE row_id BETWEEN 0 AND hr AND col_id BETWEEN 0 AND 49""", "grid"))
def gaussian_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(focal.gaussian_surface(view(spark, sf_dir, "grid"), "v", 1.5, _height(spark, sf_dir), 50), "surface")


@query(with_views(""", o AS (SELECT unnest(range(-3, 3)) AS d), h AS (SELECT max(row_id) AS hr FROM grid)
SELECT CAST(row_id + a.d AS INTEGER) AS row_id, CAST(col_id + b.d AS INTEGER) AS col_id, max(v) AS surface FROM grid, h, o a, o b WHERE row_id + a.d BETWEEN 0 AND hr AND col_id + b.d BETWEEN 0 AND 49 GROUP BY row_id + a.d, col_id + b.d""", "grid"))
def block_max_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    return focal.block_max_surface(view(spark, sf_dir, "grid").select("row_id", "col_id", "v"), "v", 6, _height(spark, sf_dir), 50)


@query(with_views(""", f AS (SELECT a.row_id, a.col_id, sum(b.dem / ((a.row_id - b.row_id) ** 2 + (a.col_id - b.col_id) ** 2)) / sum(1 / ((a.row_id - b.row_id) ** 2 + (a.col_id - b.col_id) ** 2)) AS z
  FROM grid a JOIN grid b ON a.dem IS NULL AND b.dem IS NOT NULL AND b.row_id BETWEEN a.row_id - 4 AND a.row_id + 4 AND (a.row_id - b.row_id) ** 2 + (a.col_id - b.col_id) ** 2 <= 16 GROUP BY 1, 2)
SELECT row_id, col_id, round(coalesce(dem, z), 6) AS dem, dem IS NULL AND z IS NOT NULL AS filled FROM grid LEFT JOIN f USING (row_id, col_id)""", "grid"))
def idw_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r6(focal.idw_fill(view(spark, sf_dir, "grid").select("row_id", "col_id", "dem"), "dem", 4), "dem")


@query(with_views(""", o AS (SELECT r * 4 AS r, c * 4 AS c FROM (SELECT unnest(range((max(row_id) + 1 - 8) // 4 + 1)) AS r FROM grid), (SELECT unnest(range(11)) AS c))
SELECT CAST(r AS INTEGER) AS row_id, CAST(c AS INTEGER) AS col_id, CAST(r + 4 AS INTEGER) AS center_row, CAST(c + 4 AS INTEGER) AS center_col, round(avg(dem), 9) AS mean, count(dem) / 64.0e0 AS valid
FROM o JOIN grid ON row_id BETWEEN r AND r + 7 AND col_id BETWEEN c AND c + 7 GROUP BY r, c HAVING count(dem) / 64.0e0 >= 0.7""", "grid"))
def sliding_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = focal.patches(view(spark, sf_dir, "grid"), "dem", 8, 4, _height(spark, sf_dir), 50)
    return out.withColumn("mean", F.round("mean", 9))


@query(with_views(""", o AS (SELECT r * 4 AS r, c * 4 AS c FROM (SELECT unnest(range((max(row_id) + 1 - 8) // 4 + 1)) AS r FROM grid), (SELECT unnest(range(11)) AS c))
SELECT CAST(r AS INTEGER) AS row_id, CAST(c AS INTEGER) AS col_id, CAST(128 AS INTEGER) AS n, count(dem) / 64.0e0 AS valid, round(sum(coalesce(dem, 0) * ((row_id - r) * 8 + col_id - c + 1) + coalesce(v, 0) * ((row_id - r) * 8 + col_id - c + 65)), 4) AS weighted
FROM o JOIN grid ON row_id BETWEEN r AND r + 7 AND col_id BETWEEN c AND c + 7 GROUP BY r, c HAVING count(dem) / 64.0e0 >= 0.7""", "grid"))
def patch_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoder's input of every window, told by its length and by a sum of pixels weighted by their places."""
    out = focal.patch_pixels(view(spark, sf_dir, "grid"), ["dem", "v"], 8, 4, _height(spark, sf_dir), 50)
    weighted = F.aggregate(F.transform("pixels", lambda x, i: x * (i + 1)), F.lit(0.0), lambda acc, x: acc + x)
    return out.select("row_id", "col_id", F.size("pixels").alias("n"), "valid", F.round(weighted, 4).alias("weighted"))
