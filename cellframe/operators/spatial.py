"""Joins in the plane. Every one has an integer bin as an equality key, so none is a nested loop or a broadcast by force.

Features come as edge frames (key, x1, y1, x2, y2). A ray to the right of a point meets only edges that span its y, so a
strip of y is the bin of point-in-polygon. For distances of points, square cells are paired, and pairs halved until few
places are left to compare; for those of segments the bin is a square of the distance.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions import geometry as geo
from cellframe.functions.algebra import patch_id_parts
from cellframe.sources.grid import GridSpec
from cellframe.sources.scratch import written


def bin_of(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size))).cast("long")


def _strips(edges: DataFrame, height: float) -> DataFrame:
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    return edges.withColumn("strip", F.explode(F.sequence(bin_of(lo, height), bin_of(hi, height))))


#: Strips' heights that a bin of x is wide.
WIDE = 64


def containing(points: DataFrame, edges: DataFrame, key: str = "feature_id", pid: str = "id", strip: float = 1.0, closed: bool = False) -> DataFrame:
    """(pid, key) for every feature that holds a point: an odd number of crossings, or if closed, on an edge.

    A point first meets the features whose extent within its strip covers it, by bins of x, and then the edges that
    these features have in the strip: edges of features elsewhere in the strip never meet it.
    """
    wide = WIDE * strip
    p = points.select(pid, "x", "y").withColumns({"strip": bin_of(F.col("y"), strip), "xbin": bin_of(F.col("x"), wide)})
    e = _strips(edges.select(key, "x1", "y1", "x2", "y2"), strip)
    extents = e.groupBy(key, "strip").agg(F.min(F.least("x1", "x2")).alias("xlo"), F.max(F.greatest("x1", "x2")).alias("xhi"))
    extents = extents.withColumn("xbin", F.explode(F.sequence(bin_of(F.col("xlo"), wide), bin_of(F.col("xhi"), wide))))
    near = p.join(extents, ["strip", "xbin"]).where(F.col("x").between(F.col("xlo"), F.col("xhi"))).select(pid, "x", "y", key, "strip")
    args = [F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]
    hit = geo.crosses_ray(*args)
    pairs = near.join(e, [key, "strip"])
    if closed:
        pairs = pairs.withColumns({"hit": hit, "on": geo.on_segment(*args)}).where("hit OR on")
        return pairs.groupBy(pid, key).agg(F.sum(F.col("hit").cast("int")).alias("n"), F.max("on").alias("on")).where("n % 2 = 1 OR on").select(pid, key)
    return pairs.where(hit).groupBy(pid, key).agg(F.count("*").alias("n")).where("n % 2 = 1").select(pid, key)


def first_zone(points: DataFrame, edges: DataFrame, key: str = "feature_id", pid: str = "id", strip: float = 1.0) -> DataFrame:
    """points with the smallest feature that holds each, -1 if none."""
    first = containing(points, edges, key, pid, strip).groupBy(pid).agg(F.min(key).alias("zone_id"))
    return points.join(first, pid, "left").withColumn("zone_id", F.coalesce("zone_id", F.lit(-1).cast("long")))


def burn(cells: DataFrame, edges: DataFrame, key: str = "feature_id", strip: float = 1.0) -> DataFrame:
    """cells with the largest feature that touches each unit cell (row_id, col_id at y, x), -1 if none.

    A feature touches a cell if it holds the centre or an edge of it meets the cell's box.
    """
    c = cells.select("row_id", "col_id").withColumns({"id": F.struct("row_id", "col_id"), "x": F.col("col_id") + F.lit(0.5), "y": F.col("row_id") + F.lit(0.5)})
    inside = containing(c, edges, key, "id", strip)
    spans = _strips(edges.select(key, "x1", "y1", "x2", "y2"), 1.0)
    spans = spans.withColumn("col_id", F.explode(F.sequence(F.floor(F.least("x1", "x2")), F.floor(F.greatest("x1", "x2")))))
    boxes = c.select("id", F.col("row_id").cast("long").alias("strip"), F.col("col_id").cast("long").alias("col_id"))
    met = boxes.join(spans, ["strip", "col_id"])
    b = (F.col("col_id").cast("double"), F.col("strip").cast("double"), F.col("col_id") + 1.0, F.col("strip") + 1.0)
    met = met.where(geo.segment_meets_box(F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2"), *b)).select("id", key)
    last = inside.unionByName(met).groupBy("id").agg(F.max(key).alias("code")).select("id.row_id", "id.col_id", "code")
    return cells.join(last, ["row_id", "col_id"], "left").withColumn("code", F.coalesce("code", F.lit(-1).cast("long")))


def _places(df: DataFrame, x: str, y: str) -> DataFrame:
    """(x, y, w): the places that rows lie in and how many, so that copies are compared once; a place has two finite numbers."""
    finite = (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))
    return written(df.where(finite).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("w")), "places")


def _around(cells: DataFrame) -> DataFrame:
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    out = cells.withColumn("nx", F.explode(F.transform(near, lambda d: F.col("bx") + d)))
    return out.withColumn("ny", F.explode(F.transform(near, lambda d: F.col("by") + d)))


#: Pairs of cells with up to LEAF comparisons of places are halved no more; if all others together have up to FEW, none is.
LEAF, FEW = 256, 1 << 22
#: What bins may be off by, in cells, while no coordinate is beyond REACH cells.
SLACK, REACH = 1e-6, 2.0**30


def _halved(p: DataFrame, o: DataFrame, size: float, reach: float, sift: Callable[[DataFrame, float], DataFrame]) -> tuple[DataFrame, DataFrame, list[float]]:
    """Pairs of cells of p and o (places), halved until few places are left to compare: (pairs to compare, pairs that are inside, sizes).

    Neighbouring cells of the first size are paired, later those within pairs. sift gets each round's pairs (ax, ay and bx, by; w:
    rows of o's cell; low, high: bounds of the square of the distance, in cells) and the size, leaves out what cannot count, and
    adds "inside", true where all of o's cell counts for all of p's. level is the place of a pair's cells in sizes.
    """
    cells = lambda df, c: df.groupBy(bin_of(F.col("x"), size).alias(f"{c}x"), bin_of(F.col("y"), size).alias(f"{c}y"))
    up = lambda df, c: df.withColumns({f"{c}x0": F.shiftright(f"{c}x", 1), f"{c}y0": F.shiftright(f"{c}y", 1)})
    far = lambda i: F.abs(F.col(f"a{i}") - F.col(f"b{i}"))
    compare, inside, sizes, left = [], [], [], None
    while True:
        a = cells(p, "a").agg(F.count("*").cast("double").alias("an"))
        b = cells(o, "b").agg(F.count("*").cast("double").alias("bn"), F.sum("w").alias("w"))
        if left is None:
            pairs = a.withColumns({"nx": F.col("ax"), "ny": F.col("ay")}).join(_around(b), ["nx", "ny"])
        else:
            left = left.select(*[F.col(c).alias(f"{c}0") for c in ("ax", "ay", "bx", "by")])
            pairs = left.join(up(a, "a"), ["ax0", "ay0"]).join(up(b, "b"), ["bx0", "by0"])
        bounds = {"low": sum(F.pow(F.greatest(far(i) - F.lit(1 + SLACK), F.lit(0.0)), 2) for i in "xy"), "high": sum(F.pow(far(i) + F.lit(1 + SLACK), 2) for i in "xy")}
        pairs = sift(pairs.withColumns(bounds), size).select("ax", "ay", "bx", "by", "w", "inside", (F.col("an") * F.col("bn")).alias("cost"))
        pairs = written(pairs.withColumn("level", F.lit(len(sizes))), "cells")
        sizes.append(size)
        inside.append(pairs.where("inside"))
        large = pairs.where(~F.col("inside") & (F.col("cost") > LEAF))
        if (large.agg(F.sum("cost")).first()[0] or 0) <= FEW or size / 2 * REACH < reach:
            compare.append(pairs.where("NOT inside"))
            return reduce(DataFrame.unionByName, compare), reduce(DataFrame.unionByName, inside), sizes
        compare.append(pairs.where(~F.col("inside") & (F.col("cost") <= LEAF)))
        left, size = large, size / 2


def _in_cells(places: DataFrame, sizes: Sequence[float], c: str) -> DataFrame:
    """places once for each size, with level and cell."""
    cells = [F.struct(F.lit(i).alias("level"), bin_of(F.col("x"), s).alias(f"{c}x"), bin_of(F.col("y"), s).alias(f"{c}y")) for i, s in enumerate(sizes)]
    return places.withColumn("cell", F.explode(F.array(*cells))).select("*", "cell.*").drop("cell")


def _compared(p: DataFrame, o: DataFrame, pairs: DataFrame, sizes: Sequence[float]) -> DataFrame:
    """(x, y, w, d2): p's places with each of o's in paired cells, o's number of rows and the square of the distance."""
    others = _in_cells(o.withColumnsRenamed({"x": "ox", "y": "oy"}).withColumns({"x": F.col("ox"), "y": F.col("oy")}), sizes, "b").drop("x", "y")
    pairs = pairs.select("level", "ax", "ay", "bx", "by").join(others, ["level", "bx", "by"])
    dx, dy = F.col("x") - F.col("ox"), F.col("y") - F.col("oy")
    return pairs.join(_in_cells(p.drop("w"), sizes, "a"), ["level", "ax", "ay"]).select("x", "y", "w", (dx * dx + dy * dy).alias("d2"))


def _extent(*places: DataFrame) -> tuple[float, float]:
    """The longer side of the box around places, and their largest coordinate."""
    ends = [f(c) for c in ("x", "y") for f in (F.min, F.max)]
    x0, x1, y0, y1 = (float(v or 0) for v in reduce(DataFrame.unionByName, [p.select("x", "y") for p in places]).agg(*ends).first())
    return max(x1 - x0, y1 - y0), max(map(abs, (x0, x1, y0, y1)))


def density(points: DataFrame, others: DataFrame, radius: float, pid: str = "id") -> DataFrame:
    """points with the number of others (ox, oy) within the closed radius, and that over the largest number.

    Cells that lie within the radius as a whole are counted as a whole; only places in cells at its border are compared.
    """
    p, o = _places(points, "x", "y"), _places(others, "ox", "oy")

    def sift(pairs: DataFrame, size: float) -> DataFrame:
        cells = (radius / size) ** 2
        return pairs.where(F.col("low") <= cells).withColumn("inside", F.col("high") <= cells)

    pairs, inside, sizes = _halved(p, o, radius * (1 + 1e-3), _extent(p, o)[1], sift)
    met = _compared(p, o, pairs, sizes).where(F.col("d2") <= radius * radius).groupBy("x", "y").agg(F.sum("w").alias("n"))
    whole = inside.groupBy("level", "ax", "ay").agg(F.sum("w").alias("n")).join(_in_cells(p, sizes, "a"), ["level", "ax", "ay"]).select("x", "y", "n")
    found = written(met.unionByName(whole).groupBy("x", "y").agg(F.sum("n").alias("n")), "near")
    n = points.join(found, ["x", "y"]).groupBy(pid).agg(F.sum("n").alias("n"))
    counted = points.join(n, pid, "left").withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
    top = n.agg(F.coalesce(F.max("n"), F.lit(0)).alias("top"))
    return counted.join(F.broadcast(top)).withColumn("density", F.when(F.col("top") > 0, F.col("n") / F.col("top")).otherwise(0.0)).drop("top")


def nearest(points: DataFrame, others: DataFrame, start: float, pid: str = "id") -> DataFrame:
    """(pid, distance) to the nearest of others (ox, oy), NULL for a point without a place or if there are no others.

    Cells of start times a power of two that cover everything are halved; of others' cells only those go on that may
    be nearer than the farthest corner of the nearest one.
    """
    if start <= 0:
        raise ValueError(f"start is {start}")
    p, o = _places(points, "x", "y"), _places(others, "ox", "oy")
    extent, reach = _extent(p, o)
    size = float(start)
    while size < extent:
        size *= 2

    def sift(pairs: DataFrame, size: float) -> DataFrame:
        least = F.min("high").over(Window.partitionBy("ax", "ay"))
        return pairs.withColumn("least", least).where("low <= least").withColumn("inside", F.lit(False))

    pairs, _, sizes = _halved(p, o, size, reach, sift)
    found = _compared(p, o, pairs, sizes).groupBy("x", "y").agg(F.sqrt(F.min("d2")).alias("distance"))
    return points.select(pid, "x", "y").join(found, ["x", "y"], "left").groupBy(pid).agg(F.min("distance").alias("distance"))


def near_segments(points: DataFrame, segments: DataFrame, distance: float, pid: str = "id") -> DataFrame:
    """(pid) of points within a distance of some segment; a segment goes to the bins its widened box covers."""
    d = F.lit(float(distance))
    s = segments.select("x1", "y1", "x2", "y2")
    for b, lo, hi in (("bx", "x1", "x2"), ("by", "y1", "y2")):
        s = s.withColumn(b, F.explode(F.sequence(bin_of(F.least(lo, hi) - d, distance), bin_of(F.greatest(lo, hi) + d, distance))))
    p = points.select(pid, "x", "y").withColumns({"bx": bin_of(F.col("x"), distance), "by": bin_of(F.col("y"), distance)})
    args = [F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2")]
    return p.join(s, ["bx", "by"]).where(geo.segment_distance2(*args) <= distance * distance).select(pid).distinct()


def exclude_near(points: DataFrame, segments: DataFrame, distance: float, pid: str = "id") -> DataFrame:
    """points farther than a distance from every segment."""
    return points.join(near_segments(points, segments, distance, pid), pid, "left_anti")


def boxes_meeting(boxes: DataFrame, zones: DataFrame, size: float, pid: str) -> DataFrame:
    """Pairs of boxes (bx0..by1) and zones (x0..y1) that share a point, by bins of size; each pair once."""

    def spread(df: DataFrame, x0: str, y0: str, x1: str, y1: str) -> DataFrame:
        out = df.withColumn("gx", F.explode(F.sequence(bin_of(F.col(x0), size), bin_of(F.col(x1), size))))
        return out.withColumn("gy", F.explode(F.sequence(bin_of(F.col(y0), size), bin_of(F.col(y1), size))))

    pairs = spread(boxes, "bx0", "by0", "bx1", "by1").join(spread(zones, "x0", "y0", "x1", "y1"), ["gx", "gy"])
    first = (F.col("gx") == F.greatest(bin_of(F.col("bx0"), size), bin_of(F.col("x0"), size))) & (F.col("gy") == F.greatest(bin_of(F.col("by0"), size), bin_of(F.col("y0"), size)))
    meet = geo.boxes_meet(*[F.col(c) for c in ("bx0", "by0", "bx1", "by1", "x0", "y0", "x1", "y1")])
    return pairs.where(first & meet).drop("gx", "gy")


def at_points(points: DataFrame, raster: DataFrame, values: Sequence[str], res: float = 1.0, pid: str = "id") -> DataFrame:
    """points with the raster's values of the cell that holds each; NULL outside."""
    cells = raster.select(F.col("row_id").alias("__r"), F.col("col_id").alias("__c"), *values)
    placed = points.withColumns({"__r": F.floor(F.col("y") / res).cast("int"), "__c": F.floor(F.col("x") / res).cast("int")})
    return placed.join(cells, ["__r", "__c"], "left").drop("__r", "__c")


def zonal(cells: DataFrame, zone_of_cell: DataFrame, value: str, key: str) -> DataFrame:
    """Count, mean and max of the valid cells of each zone; zone_of_cell: row_id, col_id, key."""
    joined = cells.join(zone_of_cell, ["row_id", "col_id"])
    return joined.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def _cells(raster: DataFrame, height: int, width: int) -> DataFrame:
    cells = raster.sparkSession.range(height * width)
    return cells.select(F.floor(F.col("id") / width).cast("int").alias("row_id"), (F.col("id") % width).cast("int").alias("col_id"))


def _nearest(cells: DataFrame, raster: DataFrame, value: str) -> DataFrame:
    """cells (row_id, col_id, fr, fc: their place in the source, centres at whole numbers) with the cell there."""
    src = raster.select(F.col("row_id").alias("sr"), F.col("col_id").alias("sc"), value)
    at = lambda c: F.floor(F.col(c) + F.lit(0.5)).cast("int")
    return cells.withColumns({"sr": at("fr"), "sc": at("fc")}).join(src, ["sr", "sc"], "left").select("row_id", "col_id", value)


def _bilinear(cells: DataFrame, raster: DataFrame, value: str) -> DataFrame:
    """As _nearest, with the four cells around, valid ones weighted by distance."""
    two = F.array(F.lit(0), F.lit(1))
    g = cells.withColumn("i", F.explode(two)).withColumn("j", F.explode(two))
    weigh = lambda f, k: F.when(F.col(k) == 0, 1 - (F.col(f) - F.floor(f))).otherwise(F.col(f) - F.floor(f))
    g = g.select("row_id", "col_id", (F.floor("fr") + F.col("i")).cast("int").alias("sr"), (F.floor("fc") + F.col("j")).cast("int").alias("sc"), (weigh("fr", "i") * weigh("fc", "j")).alias("w"))
    src = raster.select(F.col("row_id").alias("sr"), F.col("col_id").alias("sc"), value).where(F.col(value).isNotNull())
    sums = g.join(src, ["sr", "sc"], "left").groupBy("row_id", "col_id").agg(F.sum(F.col(value) * F.col("w")).alias("s"), F.sum(F.when(F.col(value).isNotNull(), F.col("w"))).alias("w"))
    return sums.select("row_id", "col_id", F.when(F.col("w") > 0, F.col("s") / F.col("w")).alias(value))


def _coarse(raster: DataFrame, factor: float, height: int, width: int) -> DataFrame:
    at = lambda c: (F.col(c) + F.lit(0.5)) * F.lit(float(factor)) - F.lit(0.5)
    return _cells(raster, height, width).withColumns({"fr": at("row_id"), "fc": at("col_id")})


def nearest_resample(raster: DataFrame, value: str, factor: float, height: int, width: int) -> DataFrame:
    """The raster on a grid of cells factor times as large: each takes the source cell at its centre."""
    return _nearest(_coarse(raster, factor, height, width), raster, value)


def bilinear_resample(raster: DataFrame, value: str, factor: float, height: int, width: int) -> DataFrame:
    """The raster on a grid of cells factor times as large: valid neighbours weighted by distance of centres."""
    return _bilinear(_coarse(raster, factor, height, width), raster, value)


def align(raster: DataFrame, value: str, source: GridSpec, target: GridSpec, method: str = "bilinear", to_source: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A raster of one grid on another, whatever their origins and cell sizes; NULL where the source has nothing.

    method: "nearest" for categories, "bilinear" for values. to_source takes a frame with x and y of the target's
    reference system to that of the source (see geometry.project); without it both are the same.
    """
    if method not in ("nearest", "bilinear"):
        raise ValueError(f"no method {method}")
    cells = _cells(raster, target.height, target.width)
    cells = cells.select("row_id", "col_id", target.x(F.col("col_id")).alias("x"), target.y(F.col("row_id")).alias("y"))
    cells = to_source(cells) if to_source else cells
    half, res = F.lit(0.5), F.lit(float(source.res))
    places = {"fr": (F.lit(float(source.y0)) - F.col("y")) / res - half, "fc": (F.col("x") - F.lit(float(source.x0))) / res - half}
    return (_nearest if method == "nearest" else _bilinear)(cells.withColumns(places), raster, value)


def chips(raster: DataFrame, patches: DataFrame, bands: Sequence[str], size: int, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(patch_id, row_id, col_id in the chip, bands): a size x size window for each patch_id `<stem>_r<row>_c<col>`.

    Bands are stretched to [0, 1] between two percentiles of the chip's valid cells; a chip is size ** 2 cells at most.
    """
    _, row, col = patch_id_parts(F.col("patch_id"))
    rows = patches.select("patch_id", row.alias("r0"), col.alias("c0")).withColumn("row_id", F.explode(F.sequence(F.col("r0"), F.col("r0") + size - 1)))
    cells = rows.join(raster.select("row_id", "col_id", *bands), "row_id").where(F.col("col_id").between(F.col("c0"), F.col("c0") + size - 1))
    bounds = cells.groupBy("patch_id").agg(*[F.percentile(b, F.array(F.lit(low), F.lit(high))).alias(f"__{b}") for b in bands])

    def stretched(b: str) -> Column:
        lo, hi = F.get(f"__{b}", F.lit(0)), F.get(f"__{b}", F.lit(1))
        share = (F.col(b) - lo) / F.greatest(hi - lo, F.lit(1e-6))
        return F.when(F.col(b).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))).alias(b)

    return cells.join(bounds, "patch_id").select("patch_id", (F.col("row_id") - F.col("r0")).alias("row_id"), (F.col("col_id") - F.col("c0")).alias("col_id"), *map(stretched, bands))


def densify(lines: DataFrame, step: float, key: str = "feature_id", order: str | None = None) -> DataFrame:
    """Points along each line, max(2, int(length / step)) of them at equal arc length, ends included.

    lines: key, x1, y1, x2, y2, one row a segment, in order; each segment makes the points that fall on it.
    """
    own = Window.partitionBy(key)
    so_far = own.orderBy(order or "x1").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seg = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    rows = lines.withColumn("seg", seg).withColumns({"total": F.sum("seg").over(own), "end": F.sum("seg").over(so_far)})
    rows = rows.withColumns({"start": F.col("end") - F.col("seg"), "n": F.greatest(F.lit(2), F.floor(F.col("total") / step)).cast("int")})
    gap = F.col("total") / (F.col("n") - 1)
    first = F.when(F.col("start") <= 0, 0).otherwise(F.floor(F.try_divide(F.col("start"), gap)) + 1).cast("int")
    last = F.when(F.col("end") >= F.col("total"), F.col("n") - 1).otherwise(F.floor(F.try_divide(F.col("end"), gap))).cast("int")
    rows = rows.withColumns({"gap": gap, "i0": first, "i1": last}).where("i0 <= i1").withColumn("i", F.explode(F.sequence("i0", "i1")))
    t = F.coalesce(F.try_divide(F.col("i") * F.col("gap") - F.col("start"), F.col("seg")), F.lit(0.0))
    return rows.select(key, "i", (F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("x"), (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("y"))


def clip(cells: DataFrame, edges: DataFrame, key: str = "feature_id", strip: float = 1.0) -> DataFrame:
    """The cells whose centre some feature holds."""
    c = cells.select(F.struct("row_id", "col_id").alias("id"), (F.col("col_id") + F.lit(0.5)).cast("double").alias("x"), (F.col("row_id") + F.lit(0.5)).cast("double").alias("y"))
    inside = containing(c, edges, key, "id", strip).select("id.row_id", "id.col_id").distinct()
    return cells.join(inside, ["row_id", "col_id"], "left_semi")


def covered_cells(boxes: DataFrame, edges: DataFrame, n: int, pid: str, key: str = "feature_id", strip: float = 1.0) -> DataFrame:
    """(pid, key, share): the share of n x n sub-cell centres of each box (bx0..by1) that a feature holds.

    For polygons of any shape, holes included; the error is that of the sub-cells. The union of features needs no
    geometry: a centre is in it if it is in any.
    """
    i = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    sub = boxes.withColumn("i", i).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    x = F.col("bx0") + (F.col("i") + F.lit(0.5)) * (F.col("bx1") - F.col("bx0")) / n
    y = F.col("by0") + (F.col("j") + F.lit(0.5)) * (F.col("by1") - F.col("by0")) / n
    centres = sub.select(F.struct(pid, "i", "j").alias("id"), x.alias("x"), y.alias("y"))
    inside = containing(centres, edges, key, "id", strip)
    return inside.groupBy(F.col(f"id.{pid}").alias(pid), key).agg((F.count("*") / F.lit(float(n * n))).alias("share"))


def union_area(cells: DataFrame, zones_of_cell: DataFrame, key: str, cell_area: float) -> DataFrame:
    """Area of the union of each key's features: distinct cells that any of them holds."""
    held = cells.join(zones_of_cell, ["row_id", "col_id"]).select(key, "row_id", "col_id").distinct()
    return held.groupBy(key).agg((F.count("*") * F.lit(float(cell_area))).alias("area"))
