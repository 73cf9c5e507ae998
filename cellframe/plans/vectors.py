"""Registered queries over vectors: spatial joins, resampling, labels, samples and splits, with DuckDB equivalents."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.functions.geometry import box_overlap, edges_of_boxes, polygon_measures, project
from cellframe.operators import labels, spatial
from cellframe.plans.rasters import _height
from cellframe.sources import io
from cellframe.sources.fixtures import view, with_views
from cellframe.sources.grid import GridSpec

QUERIES, ORACLES = {}, {}
_EDGES = """e AS (SELECT feature_id, x0 AS x1, y0 AS y1, x1 AS x2, y0 AS y2 FROM zones UNION ALL SELECT feature_id, x1, y0, x1, y1 FROM zones
  UNION ALL SELECT feature_id, x1, y1, x0, y1 FROM zones UNION ALL SELECT feature_id, x0, y1, x0, y0 FROM zones)"""
_INSIDE = """i AS (SELECT id, feature_id FROM points, e WHERE ((y1 > y) <> (y2 > y)) AND x < (x2 - x1) * ((y - y1) / nullif(y2 - y1, 0)) + x1 GROUP BY 1, 2 HAVING count(*) % 2 = 1)"""


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges_of_boxes(view(spark, sf_dir, "zones"), "feature_id")


# Joins in the plane


@query(with_views(f", {_EDGES}, {_INSIDE} SELECT points.id, x, y, kind, CAST(coalesce(z, -1) AS BIGINT) AS zone_id FROM points LEFT JOIN (SELECT id, min(feature_id) AS z FROM i GROUP BY 1) f USING (id)", "zones", "points"))
def point_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.first_zone(view(spark, sf_dir, "points"), _zones(spark, sf_dir), strip=4.0)


@query(with_views("SELECT p.id, CAST(z.feature_id AS INTEGER) AS feature_id FROM points p JOIN zones z ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1", "zones", "points"))
def point_in_closed_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.containing(view(spark, sf_dir, "points"), _zones(spark, sf_dir), strip=4.0, closed=True)


@query(with_views("""SELECT row_id, col_id, CAST(coalesce(max(feature_id), -1) AS BIGINT) AS code FROM (SELECT row_id, col_id FROM grid) g
LEFT JOIN zones ON col_id <= x1 AND col_id + 1 >= x0 AND row_id <= y1 AND row_id + 1 >= y0 GROUP BY 1, 2""", "grid", "zones"))
def categorical_burn_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = view(spark, sf_dir, "grid").select("row_id", "col_id")
    return spatial.burn(cells, _zones(spark, sf_dir))


@query(with_views("""SELECT row_id, col_id, coalesce(bool_or(zone = 'nucleo'), false) AS nucleo, coalesce(bool_or(zone = 'negativo'), false) AS negativo FROM (SELECT row_id, col_id FROM grid) g
LEFT JOIN zones ON col_id <= x1 AND col_id + 1 >= x0 AND row_id <= y1 AND row_id + 1 >= y0 GROUP BY 1, 2""", "grid", "zones"))
def binary_mask_burn(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells, zones = view(spark, sf_dir, "grid").select("row_id", "col_id"), view(spark, sf_dir, "zones")
    out = cells
    for name in ("nucleo", "negativo"):
        burnt = spatial.burn(cells, edges_of_boxes(zones.where(F.col("zone") == name), "feature_id"))
        out = out.join(burnt.select("row_id", "col_id", (F.col("code") >= 0).alias(name)), ["row_id", "col_id"])
    return out


@query(with_views("SELECT id, x, y, v, dem FROM points LEFT JOIN grid ON row_id = floor(y) AND col_id = floor(x)", "points", "grid"))
def raster_at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.at_points(view(spark, sf_dir, "points").select("id", "x", "y"), view(spark, sf_dir, "grid"), ["v", "dem"])


@query(with_views(""", s AS (SELECT a.row_id, a.col_id, avg(b.v) AS m FROM grid a JOIN grid b ON b.row_id BETWEEN a.row_id - 3 AND a.row_id + 3 AND b.col_id BETWEEN a.col_id - 3 AND a.col_id + 3 GROUP BY 1, 2)
SELECT id, round(m, 9) AS v_w7_mean FROM points LEFT JOIN s ON row_id = floor(y) AND col_id = floor(x)""", "points", "grid"))
def patch_stats_at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellframe.operators.focal import box

    stats = box(view(spark, sf_dir, "grid").select("row_id", "col_id", "v"), "v", 7, ("mean",))
    out = spatial.at_points(view(spark, sf_dir, "points").select("id", "x", "y"), stats, ["v_w7_mean"])
    return out.select("id", F.round("v_w7_mean", 9).alias("v_w7_mean"))


_BOXES = "b AS (SELECT id, x - 2 AS bx0, y - 2 AS by0, x + 2 AS bx1, y + 2 AS by1 FROM points)"


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("x"), F.col("y")
    return view(spark, sf_dir, "points").select("id", (x - 2).alias("bx0"), (y - 2).alias("by0"), (x + 2).alias("bx1"), (y + 2).alias("by1"))


_SHARE = "greatest(0, least(bx1, x1) - greatest(bx0, x0)) * greatest(0, least(by1, y1) - greatest(by0, y0)) / ((bx1 - bx0) * (by1 - by0))"


@query(with_views(f", {_BOXES} SELECT id, CAST(feature_id AS INTEGER) AS feature_id, zone, round({_SHARE}, 6) AS share FROM b, zones WHERE {_SHARE} >= 0.1", "points", "zones"))
def zone_overlap_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spatial.boxes_meeting(_boxes(spark, sf_dir), view(spark, sf_dir, "zones"), 4.0, "id")
    return pairs.withColumn("share", labels.overlap_share(pairs)).where("share >= 0.1").select("id", "feature_id", "zone", F.round("share", 6).alias("share"))


@query(with_views(f", {_BOXES} SELECT id, CAST(feature_id AS INTEGER) AS feature_id, zone FROM b, zones WHERE bx0 <= x1 AND bx1 >= x0 AND by0 <= y1 AND by1 >= y0", "points", "zones"))
def zone_intersects_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.boxes_meeting(_boxes(spark, sf_dir), view(spark, sf_dir, "zones"), 4.0, "id").select("id", "feature_id", "zone")


@query(with_views(f", {_BOXES} SELECT id FROM b SEMI JOIN (SELECT * FROM zones WHERE zone = 'nucleo') z ON bx0 <= x1 AND bx1 >= x0 AND by0 <= y1 AND by1 >= y0", "points", "zones"))
def semi_patch_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir)
    met = spatial.boxes_meeting(boxes, view(spark, sf_dir, "zones").where("zone = 'nucleo'"), 4.0, "id")
    return boxes.join(met, "id", "left_semi").select("id")


_FAULTS = "o AS (SELECT x1 AS ox, y1 AS oy FROM fault_lines UNION ALL SELECT x2, y2 FROM fault_lines)"


def _ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = view(spark, sf_dir, "fault_lines")
    return f.selectExpr("x1 as ox", "y1 as oy").unionByName(f.selectExpr("x2 as ox", "y2 as oy"))


@query(with_views(f", {_FAULTS}, n AS (SELECT id, count(ox) AS n FROM points LEFT JOIN o ON (x - ox) * (x - ox) + (y - oy) * (y - oy) <= 9 GROUP BY 1) SELECT id, n, n / max(n) OVER () AS density FROM n", "points", "fault_lines"))
def radius_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.density(view(spark, sf_dir, "points"), _ends(spark, sf_dir), 3.0).select("id", "n", "density")


@query(with_views(f", {_FAULTS} SELECT id, round(ln(1 + min(sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy)))), 6) AS log_distance FROM points, o GROUP BY 1", "points", "fault_lines"))
def nearest_log_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = spatial.nearest(view(spark, sf_dir, "points"), _ends(spark, sf_dir), 2.0)
    return near.select("id", F.round(F.log1p("distance"), 6).alias("log_distance"))


@query(with_views(""", d AS (SELECT id, min((x - (x1 + t * (x2 - x1))) ** 2 + (y - (y1 + t * (y2 - y1))) ** 2) AS d2 FROM (
  SELECT *, greatest(0, least(1, coalesce(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / nullif((x2 - x1) ** 2 + (y2 - y1) ** 2, 0), 0))) AS t FROM points, fault_lines) GROUP BY 1)
SELECT points.id FROM points LEFT JOIN d USING (id) WHERE d2 IS NULL OR d2 > 2.25""", "points", "fault_lines"))
def exclusion_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.exclude_near(view(spark, sf_dir, "points").select("id", "x", "y"), view(spark, sf_dir, "fault_lines"), 1.5).select("id")


@query(with_views("""SELECT CAST(feature_id AS INTEGER) AS feature_id, count(v) AS n, round(avg(v), 9) AS mean, max(v) AS max FROM grid JOIN zones ON col_id + 0.5 >= x0 AND col_id + 0.5 < x1 AND row_id + 0.5 >= y0 AND row_id + 0.5 < y1 GROUP BY 1""", "grid", "zones"))
def zonal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = view(spark, sf_dir, "grid")
    centres = g.select(F.struct("row_id", "col_id").alias("id"), (F.col("col_id") + 0.5).cast("double").alias("x"), (F.col("row_id") + 0.5).cast("double").alias("y"))
    inside = spatial.containing(centres, _zones(spark, sf_dir), strip=4.0).select("id.row_id", "id.col_id", "feature_id")
    return spatial.zonal(g, inside, "v", "feature_id").withColumn("mean", F.round("mean", 9))


_COARSE = "(SELECT unnest(range(CAST(ceil((max(row_id) + 1) / 1.5e0) AS BIGINT) * 33)) AS i FROM grid)"


@query(with_views(f"SELECT CAST(i // 33 AS INTEGER) AS row_id, CAST(i % 33 AS INTEGER) AS col_id, dem FROM {_COARSE} t LEFT JOIN grid ON row_id = floor((i // 33 + 0.5e0) * 1.5e0) AND col_id = floor((i % 33 + 0.5e0) * 1.5e0)", "grid"))
def nearest_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_resample(view(spark, sf_dir, "grid"), "dem", 1.5, ceil(_height(spark, sf_dir) / 1.5), 33)


@query(with_views(f""", t AS (SELECT i // 33 AS r, i % 33 AS c, (i // 33 + 0.5e0) * 1.5e0 - 0.5e0 AS fr, (i % 33 + 0.5e0) * 1.5e0 - 0.5e0 AS fc FROM {_COARSE}
), n AS (SELECT r, c, floor(fr) + i AS sr, floor(fc) + j AS sc, (CASE WHEN i = 0 THEN 1 - (fr - floor(fr)) ELSE fr - floor(fr) END) * (CASE WHEN j = 0 THEN 1 - (fc - floor(fc)) ELSE fc - floor(fc) END) AS w
  FROM t, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)), s AS (SELECT r, c, sum(dem * w) AS s, sum(CASE WHEN dem IS NOT NULL THEN w END) AS w FROM n LEFT JOIN grid ON row_id = sr AND col_id = sc GROUP BY 1, 2)
SELECT CAST(r AS INTEGER) AS row_id, CAST(c AS INTEGER) AS col_id, CASE WHEN w > 0 THEN round(s / w, 6) END AS dem FROM s""", "grid"))
def bilinear_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = spatial.bilinear_resample(view(spark, sf_dir, "grid"), "dem", 1.5, ceil(_height(spark, sf_dir) / 1.5), 33)
    return out.withColumn("dem", F.round("dem", 6))


#: Cells of 1.7 on a grid whose corner is 3.3 right of and 2.4 below the source's.
_SHIFTED = """h AS (SELECT max(row_id) + 1 AS h FROM grid), t AS (SELECT CAST(i // 27 AS INTEGER) AS r, CAST(i % 27 AS INTEGER) AS c, (h - ((h - 2.4e0) - (i // 27 + 0.5e0) * 1.7e0)) / 1.0e0 - 0.5e0 AS fr, ((3.3e0 + (i % 27 + 0.5e0) * 1.7e0) - 0.0e0) / 1.0e0 - 0.5e0 AS fc
  FROM (SELECT h, unnest(range(CAST(ceil((h - 2.4e0) / 1.7e0) AS BIGINT) * 27)) AS i FROM h))"""


def _aligned(spark: SparkSession, sf_dir: str, value: str, method: str) -> DataFrame:
    h = _height(spark, sf_dir)
    source, target = GridSpec(0.0, float(h), 1.0, 50, h), GridSpec(3.3, h - 2.4, 1.7, 27, ceil((h - 2.4) / 1.7))
    return spatial.align(view(spark, sf_dir, "grid"), value, source, target, method)


@query(with_views(f", {_SHIFTED} SELECT r AS row_id, c AS col_id, category FROM t LEFT JOIN grid ON row_id = floor(fr + 0.5e0) AND col_id = floor(fc + 0.5e0)", "grid"))
def grid_align_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir, "category", "nearest")


@query(with_views(f""", {_SHIFTED}, n AS (SELECT r, c, floor(fr) + i AS sr, floor(fc) + j AS sc, (CASE WHEN i = 0 THEN 1 - (fr - floor(fr)) ELSE fr - floor(fr) END) * (CASE WHEN j = 0 THEN 1 - (fc - floor(fc)) ELSE fc - floor(fc) END) AS w
  FROM t, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)), s AS (SELECT r, c, sum(dem * w) AS s, sum(CASE WHEN dem IS NOT NULL THEN w END) AS w FROM n LEFT JOIN grid ON row_id = sr AND col_id = sc GROUP BY 1, 2)
SELECT r AS row_id, c AS col_id, CASE WHEN w > 0 THEN round(s / w, 6) END AS dem FROM s""", "grid"))
def grid_align_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir, "dem", "bilinear").withColumn("dem", F.round("dem", 6))


@query(with_views(""", p AS (SELECT format('{}_r{:03d}_c{:03d}', zone, CAST(floor(y0) AS BIGINT), CAST(floor(x0) AS BIGINT)) AS patch_id, CAST(floor(y0) AS INTEGER) AS r0, CAST(floor(x0) AS INTEGER) AS c0 FROM zones
), k AS (SELECT patch_id, row_id - r0 AS row_id, col_id - c0 AS col_id, v, dem FROM p JOIN grid ON row_id BETWEEN r0 AND r0 + 5 AND col_id BETWEEN c0 AND c0 + 5
), q AS (SELECT patch_id, quantile_cont(v, 0.02) AS v0, quantile_cont(v, 0.98) AS v1, quantile_cont(dem, 0.02) AS d0, quantile_cont(dem, 0.98) AS d1 FROM k GROUP BY 1)
SELECT patch_id, CAST(row_id AS INTEGER) AS row_id, CAST(col_id AS INTEGER) AS col_id, CASE WHEN v IS NOT NULL THEN round(greatest(0, least(1, (v - v0) / greatest(v1 - v0, 1e-6))), 6) END AS v, CASE WHEN dem IS NOT NULL THEN round(greatest(0, least(1, (dem - d0) / greatest(d1 - d0, 1e-6))), 6) END AS dem FROM k JOIN q USING (patch_id)""", "zones", "grid"))
def preview_chips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stretched window of cells at each zone's corner, found by the id of its patch."""
    z = view(spark, sf_dir, "zones")
    ids = z.select(F.format_string("%s_r%03d_c%03d", "zone", F.floor("y0"), F.floor("x0")).alias("patch_id"))
    out = spatial.chips(view(spark, sf_dir, "grid"), ids, ["v", "dem"], 6)
    return out.withColumns({b: F.round(b, 6) for b in ("v", "dem")})


@query(with_views(""", l AS (SELECT *, sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS len FROM fault_lines), n AS (SELECT *, greatest(2, CAST(floor(len / 1.5e0) AS BIGINT)) AS n FROM l), p AS (SELECT *, unnest(range(n)) AS i FROM n WHERE len > 0)
SELECT feature_id, CAST(i AS INTEGER) AS i, round(x1 + (i * 1.0e0 / (n - 1)) * (x2 - x1), 6) AS x, round(y1 + (i * 1.0e0 / (n - 1)) * (y2 - y1), 6) AS y FROM p""", "fault_lines"))
def line_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view(spark, sf_dir, "fault_lines").where("x1 <> x2 OR y1 <> y2")
    return spatial.densify(lines, 1.5).select("feature_id", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(with_views("SELECT CAST(feature_id AS INTEGER) AS feature_id, round((x1 - x0) * (y1 - y0), 6) AS area, round(2 * ((x1 - x0) + (y1 - y0)), 6) AS length, round((x0 + x1) / 2, 6) AS cx, round((y0 + y1) / 2, 6) AS cy FROM zones", "zones"))
def polygon_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = polygon_measures(_zones(spark, sf_dir), "feature_id")
    return m.select("feature_id", *[F.round(c, 6).alias(c) for c in ("area", "length", "cx", "cy")])


@query(with_views("SELECT row_id, col_id, v FROM grid SEMI JOIN zones ON zone = 'nucleo' AND col_id + 0.5 >= x0 AND col_id + 0.5 < x1 AND row_id + 0.5 >= y0 AND row_id + 0.5 < y1", "grid", "zones"))
def clip_to_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    core = edges_of_boxes(view(spark, sf_dir, "zones").where("zone = 'nucleo'"), "feature_id")
    return spatial.clip(view(spark, sf_dir, "grid").select("row_id", "col_id", "v"), core, strip=4.0)


@query(with_views(f""", {_BOXES}, s AS (SELECT id, bx0 + (i + 0.5e0) * (bx1 - bx0) / 4 AS x, by0 + (j + 0.5e0) * (by1 - by0) / 4 AS y FROM b, (SELECT unnest(range(4)) AS i), (SELECT unnest(range(4)) AS j))
SELECT id, CAST(feature_id AS INTEGER) AS feature_id, count(*) / 16.0e0 AS share FROM s JOIN zones ON x >= x0 AND x < x1 AND y >= y0 AND y < y1 GROUP BY 1, 2""", "points", "zones"))
def polygon_overlap_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.covered_cells(_boxes(spark, sf_dir), _zones(spark, sf_dir), 4, "id", strip=4.0)


@query(with_views("SELECT zone, count(DISTINCT row_id * 50 + col_id) * 900.0e0 AS area FROM grid JOIN zones ON col_id + 0.5 >= x0 AND col_id + 0.5 < x1 AND row_id + 0.5 >= y0 AND row_id + 0.5 < y1 GROUP BY 1", "grid", "zones"))
def zone_union_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    g, z = view(spark, sf_dir, "grid").select("row_id", "col_id"), view(spark, sf_dir, "zones").select("feature_id", "zone")
    centres = g.select(F.struct("row_id", "col_id").alias("id"), (F.col("col_id") + 0.5).cast("double").alias("x"), (F.col("row_id") + 0.5).cast("double").alias("y"))
    inside = spatial.containing(centres, _zones(spark, sf_dir), strip=4.0).join(z, "feature_id").select("id.row_id", "id.col_id", "zone")
    return spatial.union_area(g, inside, "zone", 900.0)


@query()
def utm_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points placed around the central meridian, projected; the series is tested against the meridian arc."""
    p = view(spark, sf_dir, "points").select("id", (F.col("x") / 50 - 69.5).alias("x"), (F.col("y") / 20 - 33).alias("y"))
    return project(p, "x", "y")


@query(with_views("""SELECT CAST(feature_id AS INTEGER) AS feature_id, '{"type":"Polygon","coordinates":[[[' || x0 || ',' || y0 || '],[' || x1 || ',' || y0 || '],[' || x1 || ',' || y1 || '],[' || x0 || ',' || y1 || '],[' || x0 || ',' || y0 || ']]]}' AS geojson FROM zones""", "zones"))
def geojson_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "zones").select("feature_id", io.as_geojson("x0", "y0", "x1", "y1").alias("geojson"))


@query(with_views("SELECT CAST(z.feature_id AS BIGINT) AS a, CAST(y.feature_id AS BIGINT) AS b, round(greatest(0, least(z.x1, y.x1 + 1) - greatest(z.x0, y.x0 + 1)) * greatest(0, least(z.y1, y.y1 + 1) - greatest(z.y0, y.y0 + 1)), 6) AS area FROM zones z JOIN zones y ON z.x0 <= y.x1 + 1 AND z.x1 >= y.x0 + 1 AND z.y0 <= y.y1 + 1 AND z.y1 >= y.y0 + 1", "zones"))
def zone_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with a copy of themselves moved by (1, 1): pairs that meet, and the area they share."""
    z = view(spark, sf_dir, "zones")
    moved = z.select(F.col("feature_id").cast("long").alias("b"), *[(F.col(c) + 1).alias(f"b{c}") for c in ("x0", "y0", "x1", "y1")])
    pairs = spatial.boxes_meeting(moved, z.select(F.col("feature_id").cast("long").alias("a"), "x0", "y0", "x1", "y1"), 4.0, "b")
    area = box_overlap(*[F.col(c) for c in ("x0", "y0", "x1", "y1", "bx0", "by0", "bx1", "by1")])
    return pairs.select("a", "b", F.round(area, 6).alias("area"))


# Labels, samples and splits

_MATCH = f", {_EDGES}, {_INSIDE}, m AS (SELECT points.id, z.zone FROM points LEFT JOIN i USING (id) LEFT JOIN zones z ON z.feature_id = i.feature_id)"
_PRIORITY = """SELECT id, CASE WHEN bool_or(zone = 'negativo') THEN 'negativo' WHEN bool_or(zone = 'nucleo') THEN 'nucleo' WHEN bool_or(zone = 'interpretado') THEN 'interpretado' ELSE 'background' END AS label_source FROM m GROUP BY 1"""
_LABELS = f"{_MATCH}, p AS ({_PRIORITY}), lab AS (SELECT id, label_source, CASE WHEN label_source IN ('nucleo', 'interpretado') THEN 1 ELSE 0 END AS label, CASE label_source WHEN 'nucleo' THEN 1.0e0 WHEN 'interpretado' THEN 0.6e0 WHEN 'negativo' THEN 1.0e0 ELSE 0.7e0 END AS weight FROM p)"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, zones = view(spark, sf_dir, "points").select("id", "x", "y"), view(spark, sf_dir, "zones").select("feature_id", "zone")
    inside = spatial.containing(points, _zones(spark, sf_dir), strip=4.0).join(zones, "feature_id")
    return labels.priority_label(points.join(inside.select("id", "zone"), "id", "left"), "id")


@query(with_views(f"{_LABELS} SELECT * FROM lab", "zones", "points"))
def priority_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir)


@query(with_views(f"{_MATCH} SELECT id, CASE WHEN bool_or(zone = 'nucleo') THEN 'nucleo' WHEN bool_or(zone = 'negativo') THEN 'negativo' WHEN bool_or(zone = 'interpretado') THEN 'interpretado' ELSE 'negative' END AS deposit_type, CAST(coalesce(bool_or(zone IN ('nucleo', 'interpretado', 'negativo')), false) AS INTEGER) AS label FROM m GROUP BY 1", "zones", "points"))
def type_priority_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    points, zones = view(spark, sf_dir, "points").select("id", "x", "y"), view(spark, sf_dir, "zones").select("feature_id", "zone")
    inside = spatial.containing(points, _zones(spark, sf_dir), strip=4.0).join(zones, "feature_id")
    matches = points.join(inside.select("id", F.col("zone").alias("kind")), "id", "left")
    return labels.type_label(matches, "id", ("nucleo", "interpretado", "negativo"), first="nucleo")


@query(with_views("SELECT CAST(feature_id AS INTEGER) AS feature_id, zone, CASE zone WHEN 'negativo' THEN 0 ELSE 1 END AS label, CASE zone WHEN 'interpretado' THEN 0.6e0 ELSE 1.0e0 END AS weight FROM zones WHERE zone <> 'none'", "zones"))
def label_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.label_sets(view(spark, sf_dir, "zones"), io.Config().label_sets).select("feature_id", "zone", "label", "weight")


@query(with_views(f"""{_LABELS}, c AS (SELECT sum(label) AS pos, sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS neg, sum(CASE WHEN label_source = 'negativo' THEN 1 ELSE 0 END) AS ex FROM lab
), r AS (SELECT lab.*, row_number() OVER (PARTITION BY label_source ORDER BY md5(CAST(id AS VARCHAR) || '|' || 7), id) AS n FROM lab)
SELECT id, label_source, label, weight FROM r, c WHERE neg <= pos OR label_source <> 'background' OR n <= greatest(0, pos - ex)""", "zones", "points"))
def negative_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.downsample_negatives(_labelled(spark, sf_dir), 1.0, "id", 7)


_BLOCKS = "b AS (SELECT patch_id, label % 2 AS label, CAST(floor(center_x / 30000) AS BIGINT) || '_' || CAST(floor(center_y / 30000) AS BIGINT) AS block_id FROM patches), k AS (SELECT block_id, max(label) AS has_pos, md5(block_id || '|42') AS d FROM b GROUP BY 1)"


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "patches")
    return p.select("patch_id", (F.col("label") % 2).alias("label"), labels.block_id(F.col("center_x"), F.col("center_y"), 30_000).alias("block_id"))


@query(with_views(f", {_BLOCKS}, s AS (SELECT block_id, percent_rank() OVER (PARTITION BY has_pos ORDER BY d) AS p FROM k) SELECT patch_id, label, block_id, CASE WHEN p < 0.7e0 THEN 'train' WHEN p < 0.85e0 THEN 'val' ELSE 'test' END AS split FROM b JOIN s USING (block_id)", "patches"))
def block_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.block_split(_blocks(spark, sf_dir), "block_id", "label", 42).select("patch_id", "label", "block_id", "split")


@query(with_views(f", {_BLOCKS}, s AS (SELECT block_id, CAST((row_number() OVER (PARTITION BY has_pos ORDER BY d) - 1) % 5 AS INTEGER) AS fold FROM k) SELECT patch_id, label, block_id, fold FROM b JOIN s USING (block_id)", "patches"))
def group_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.group_folds(_blocks(spark, sf_dir), "block_id", "label", 5, 42).select("patch_id", "label", "block_id", "fold")


@query(with_views(f", {_BLOCKS}, s AS (SELECT block_id, percent_rank() OVER (PARTITION BY has_pos ORDER BY d) AS p FROM k), t AS (SELECT label, CASE WHEN p < 0.7e0 THEN 'train' WHEN p < 0.85e0 THEN 'val' ELSE 'test' END AS split FROM b JOIN s USING (block_id)) SELECT label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'val') AS val, count(*) FILTER (split = 'test') AS test FROM t GROUP BY 1", "patches"))
def split_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.crosstab(labels.block_split(_blocks(spark, sf_dir), "block_id", "label", 42), "label", "split", ("train", "val", "test"))


_SEG = "SELECT c_custkey, c_mktsegment FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5(CAST(c_custkey AS VARCHAR) || '|3'), c_custkey) AS n FROM customer)"


@query(f"{_SEG} WHERE (c_mktsegment = 'BUILDING' AND n <= 20) OR (c_mktsegment = 'MACHINERY' AND n <= 35)")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    return labels.stratified(c, "c_mktsegment", {"BUILDING": 20, "MACHINERY": 35}, "c_custkey", 3)


@query(with_views(f"{_LABELS}, n AS (SELECT count(*) FILTER (label_source = 'nucleo') AS a, count(*) FILTER (label_source = 'interpretado') AS b, count(*) FILTER (label_source = 'negativo') AS c, count(*) FILTER (label_source = 'background') AS d FROM lab), q AS (SELECT *, least(24, a) AS w0 FROM n), q2 AS (SELECT *, least(40 - w0, b) AS m FROM q), q3 AS (SELECT *, least(40 - m, a) AS w FROM q2), q4 AS (SELECT *, least(c, 3 * (w + m)) AS h, least(d, 3 * (w + m) - least(c, 3 * (w + m))) AS g FROM q3), r AS (SELECT id, label_source, label, row_number() OVER (PARTITION BY label_source ORDER BY md5(CAST(id AS VARCHAR) || '|11'), id) AS k FROM lab) SELECT id, label_source, label FROM r, q4 WHERE k <= CASE label_source WHEN 'nucleo' THEN w WHEN 'interpretado' THEN m WHEN 'negativo' THEN h ELSE g END", "zones", "points"))
def training_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas by source, rebalanced where one is short, then a draw in each."""
    lab = _labelled(spark, sf_dir).select("id", "label_source", "label")
    have = {r["label_source"]: r["count"] for r in lab.groupBy("label_source").count().collect()}
    return labels.stratified(lab, "label_source", labels.quotas(have, 40), "id", 11)


@query(with_views("""SELECT CAST(feature_id AS INTEGER) AS feature_id, zone, CAST(i AS INTEGER) AS i, round(x0 + ux * (x1 - x0), 6) AS x, round(y0 + uy * (y1 - y0), 6) AS y FROM (SELECT *,
  CAST(('0x' || substr(md5(feature_id || 'x' || i || '|5'), 1, 8)) AS BIGINT) / 4294967296.0e0 AS ux, CAST(('0x' || substr(md5(feature_id || 'y' || i || '|5'), 1, 8)) AS BIGINT) / 4294967296.0e0 AS uy FROM zones, (SELECT unnest(range(20)) AS i))""", "zones"))
def random_points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = labels.random_points(view(spark, sf_dir, "zones"), 20, 5)
    return out.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(with_views(""", b AS (SELECT zone, feature_id, x0, y0, x1, y1, (x1 - x0) * (y1 - y0) AS area FROM zones), k AS (SELECT *, CAST(ceil(area / sum(area) OVER (PARTITION BY zone) * 320) AS BIGINT) AS k FROM b
), c AS (SELECT *, unnest(range(k)) AS i FROM k), u AS (SELECT zone, feature_id, i, x0 + CAST(('0x' || substr(md5(feature_id || 'x' || i || '|13'), 1, 8)) AS BIGINT) / 4294967296.0e0 * (x1 - x0) AS x,
  y0 + CAST(('0x' || substr(md5(feature_id || 'y' || i || '|13'), 1, 8)) AS BIGINT) / 4294967296.0e0 * (y1 - y0) AS y FROM c
), r AS (SELECT u.*, row_number() OVER (PARTITION BY zone ORDER BY md5(feature_id || '_' || i || '|13'), feature_id || '_' || i) AS n FROM u JOIN grid ON row_id = floor(y) AND col_id = floor(x) WHERE v <> 0)
SELECT zone, CAST(feature_id AS INTEGER) AS feature_id, CAST(i AS INTEGER) AS i, round(x, 6) AS x, round(y, 6) AS y FROM r WHERE n <= 40""", "zones", "grid"))
def valid_points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 random points in the zones of each kind, on cells that have a value."""
    z = view(spark, sf_dir, "zones")
    edges = _zones(spark, sf_dir).join(z.select("feature_id", "zone"), "feature_id")
    out = labels.valid_points(edges, view(spark, sf_dir, "grid"), "v", 40, 13, strip=4.0)
    return out.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query(with_views(f"{_LABELS} SELECT label_source, count(*) AS n, round(avg(weight), 6) AS weight, CAST(max(label) AS INTEGER) AS label FROM lab GROUP BY 1", "zones", "points"))
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(spark, sf_dir).groupBy("label_source").agg(F.count("*").alias("n"), F.round(F.avg("weight"), 6).alias("weight"), F.max("label").alias("label"))


@query(with_views("SELECT row_id, col_id, v IS NOT NULL AND dem IS NOT NULL AND category <> 'click' AS candidate FROM grid", "grid"))
def mask_algebra_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "grid").select("row_id", "col_id", (F.col("v").isNotNull() & F.col("dem").isNotNull() & (F.col("category") != "click")).alias("candidate"))


@query(with_views("SELECT id, kind, 'mktsegment' AS source_name, 'porfiro' AS deposit_type FROM points UNION ALL SELECT CAST(feature_id AS BIGINT), zone, 'zones', 'porfiro' FROM zones", "points", "zones"))
def sample_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "points").select("id", "kind")
    b = view(spark, sf_dir, "zones").select(F.col("feature_id").cast("long").alias("id"), F.col("zone").alias("kind"))
    return io.sample_union([("mktsegment", a), ("zones", b)], "porfiro")
