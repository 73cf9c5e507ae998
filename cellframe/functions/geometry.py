"""Plane geometry as column arithmetic, and the map projection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crosses_ray(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether an edge crosses the ray from (x, y) to the right; an odd number of crossings is inside."""
    at = (x2 - x1) * F.try_divide(y - y1, y2 - y1) + x1
    return ((y1 > y) != (y2 > y)) & (x < at)


def on_segment(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    cross = (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)
    return (cross == 0) & x.between(F.least(x1, x2), F.greatest(x1, x2)) & y.between(F.least(y1, y2), F.greatest(y1, y2))


def segment_distance2(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared distance of a point to a segment."""
    dx, dy = x2 - x1, y2 - y1
    t = F.coalesce(F.try_divide((x - x1) * dx + (y - y1) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    ex, ey = x - (x1 + t * dx), y - (y1 + t * dy)
    return ex * ex + ey * ey


def box_overlap(ax0: Column, ay0: Column, ax1: Column, ay1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Area that two boxes share."""
    w = F.greatest(F.lit(0.0), F.least(ax1, bx1) - F.greatest(ax0, bx0))
    return w * F.greatest(F.lit(0.0), F.least(ay1, by1) - F.greatest(ay0, by0))


def boxes_meet(ax0: Column, ay0: Column, ax1: Column, ay1: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    return (ax0 <= bx1) & (ax1 >= bx0) & (ay0 <= by1) & (ay1 >= by0)


def segment_meets_box(x1: Column, y1: Column, x2: Column, y2: Column, bx0: Column, by0: Column, bx1: Column, by1: Column) -> Column:
    """Whether a segment and a closed box share a point: their bounds meet and the corners aren't all on one side."""
    side = lambda x, y: (x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)
    s = [side(x, y) for x, y in ((bx0, by0), (bx0, by1), (bx1, by0), (bx1, by1))]
    bounds = boxes_meet(F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2), bx0, by0, bx1, by1)
    return bounds & (F.least(*s) <= 0) & (F.greatest(*s) >= 0)


def edges_of_boxes(df: DataFrame, key: str, x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> DataFrame:
    """The four edges of each box: the edge frame that polygons have too."""
    corner = lambda a, b, c, d: F.struct(F.col(a).alias("x1"), F.col(b).alias("y1"), F.col(c).alias("x2"), F.col(d).alias("y2"))
    sides = F.array(corner(x0, y0, x1, y0), corner(x1, y0, x1, y1), corner(x1, y1, x0, y1), corner(x0, y1, x0, y0))
    return df.select(key, F.explode(sides).alias("e")).select(key, "e.x1", "e.y1", "e.x2", "e.y2")


def polygon_measures(edges: DataFrame, key: str) -> DataFrame:
    """Area, length and centroid of each closed feature, by the shoelace sum over its edges; holes run the other way."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    sums = edges.groupBy(key).agg(
        F.sum(cross).alias("a2"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("cx"), F.sum((F.col("y1") + F.col("y2")) * cross).alias("cy"),
    )
    return sums.select(key, F.abs(F.col("a2") / 2).alias("area"), "length", F.try_divide(F.col("cx"), 3 * F.col("a2")).alias("cx"), F.try_divide(F.col("cy"), 3 * F.col("a2")).alias("cy"))


_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


def utm(lon: np.ndarray, lat: np.ndarray, zone: int, south: bool) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing on the WGS84 ellipsoid, by the third-order transverse Mercator series."""
    lam, phi = np.radians(lon - (6 * zone - 183)), np.radians(lat)
    e = 2 * math.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    y = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(_ALPHA, 1))
    return 500_000 + _K0 * _RECT * x, _K0 * _RECT * y + (10_000_000 if south else 0)


def lonlat(x: np.ndarray, y: np.ndarray, zone: int, south: bool) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of utm."""
    xi, eta = (y - (10_000_000 if south else 0)) / (_K0 * _RECT), (x - 500_000) / (_K0 * _RECT)
    xi1 = xi - sum(b * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    eta1 = eta - sum(b * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, b in enumerate(_BETA, 1))
    chi = np.arcsin(np.sin(xi1) / np.cosh(eta1))
    phi = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return 6 * zone - 183 + np.degrees(np.arctan2(np.sinh(eta1), np.cos(xi1))), np.degrees(phi)


def project(df: DataFrame, x: str, y: str, zone: int = 19, south: bool = True, inverse: bool = False) -> DataFrame:
    """df with columns x and y projected (or, inverse, unprojected), in Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            a, b = (lonlat if inverse else utm)(pdf[x].to_numpy(float), pdf[y].to_numpy(float), zone, south)
            yield pdf.assign(**{x: a, y: b})

    out = df.withColumns({x: F.col(x).cast("double"), y: F.col(y).cast("double")})
    return out.mapInPandas(run, out.schema)
