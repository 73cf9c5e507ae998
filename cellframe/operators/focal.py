"""Moving windows over rasters.

Box statistics are separable: one window pass along rows and one along columns, each a shuffle on one coordinate, so the
work doesn't grow with the window. Frames are RANGE frames on the integer coordinate, right for sparse rasters too.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELL = ("row_id", "col_id")


def _reach(size: int) -> tuple[int, int]:
    """Offsets of a window: an even one reaches one cell further back."""
    return -(size // 2), size - size // 2 - 1


def box(df: DataFrame, value: str, size: int, stats: Sequence[str] = ("mean", "std", "max"), prefix: str | None = None) -> DataFrame:
    """Valid-only mean, population std and max in a size x size window; NULL where it holds no valid cell."""
    lo, hi = _reach(size)
    along = Window.partitionBy("row_id").orderBy("col_id").rangeBetween(lo, hi)
    across = Window.partitionBy("col_id").orderBy("row_id").rangeBetween(lo, hi)
    x = F.col(value)
    want = [("n", F.count, x), ("s", F.sum, x)] + ([("q", F.sum, x * x)] if "std" in stats else []) + ([("m", F.max, x)] if "max" in stats else [])
    one = df.withColumns({f"__{k}": f(e).over(along) for k, f, e in want})
    two = one.withColumns({f"__{k}2": (F.max if k == "m" else F.sum)(f"__{k}").over(across) for k, _, _ in want})
    mean = F.try_divide(F.col("__s2"), F.col("__n2"))
    made = {"mean": lambda: mean, "std": lambda: F.when(F.col("__n2") > 0, F.sqrt(F.greatest(F.col("__q2") / F.col("__n2") - mean * mean, F.lit(0.0)))), "max": lambda: F.col("__m2")}
    p = prefix or f"{value}_w{size}"
    return two.select(*df.columns, *[made[s]().alias(f"{p}_{s}") for s in stats])


def padded(df: DataFrame, value: str, size: int, height: int, width: int, mode: str) -> DataFrame:
    """df with the cells that a border rule adds around a height x width raster.

    mode: "nearest" repeats the edge, "reflect" mirrors with the edge repeated. Only border cells multiply.
    """
    lo, hi = _reach(size)

    def places(c: Column, n: int) -> Column:
        if mode == "nearest":
            low, high = F.sequence(F.lit(lo), F.lit(-1)), F.sequence(F.lit(n), F.lit(n - 1 + hi))
            more = F.concat(F.when((c == 0) & F.lit(lo < 0), low).otherwise(F.array().cast("array<int>")), F.when((c == n - 1) & F.lit(hi > 0), high).otherwise(F.array().cast("array<int>")))
        else:
            near = F.when((c < -lo), F.array(-1 - c)).otherwise(F.array().cast("array<int>"))
            more = F.concat(near, F.when(c >= n - hi, F.array(2 * n - 1 - c)).otherwise(F.array().cast("array<int>")))
        return F.concat(F.array(c), more)

    rows = df.withColumn("row_id", F.explode(places(F.col("row_id"), height)))
    return rows.withColumn("col_id", F.explode(places(F.col("col_id"), width)))


def bordered_box(df: DataFrame, value: str, size: int, height: int, width: int, mode: str = "nearest", stats: Sequence[str] = ("mean", "std")) -> DataFrame:
    """Box statistics where cells beyond the raster take the border's values."""
    wide = box(padded(df.select(*CELL, value), value, size, height, width, mode), value, size, stats)
    return wide.where(F.col("row_id").between(0, height - 1) & F.col("col_id").between(0, width - 1))


def gradients(df: DataFrame, value: str, res: float) -> DataFrame:
    """df with dz_dx and dz_dy: central differences, one-sided at edges and beside missing cells."""
    x, y = Window.partitionBy("row_id").orderBy("col_id"), Window.partitionBy("col_id").orderBy("row_id")

    def slope(w: object, at: str) -> Column:
        back = F.when(F.lag(at).over(w) == F.col(at) - 1, F.lag(value).over(w))
        ahead = F.when(F.lead(at).over(w) == F.col(at) + 1, F.lead(value).over(w))
        here = F.col(value)
        return F.when(here.isNull(), None).when(back.isNotNull() & ahead.isNotNull(), (ahead - back) / (2.0 * res)).when(ahead.isNotNull(), (ahead - here) / res).when(back.isNotNull(), (here - back) / res)

    return df.withColumns({"dz_dx": slope(x, "col_id"), "dz_dy": slope(y, "row_id")})


def slope_aspect(df: DataFrame, value: str, res: float) -> DataFrame:
    """Slope in degrees, and aspect in degrees from north; NULL at missing cells."""
    g = gradients(df, value, res)
    known = F.col(value).isNotNull()
    slope = F.degrees(F.atan(F.hypot("dz_dx", "dz_dy")))
    aspect = F.pmod(F.degrees(F.atan2(-F.col("dz_dx"), F.col("dz_dy"))), F.lit(360.0))
    return g.select(*CELL, F.when(known, slope).alias("slope"), F.when(known, aspect).alias("aspect"))


def tpi_window(res: float) -> int:
    return max(3, int(1000 / res) | 1)


def tpi(df: DataFrame, value: str, size: int, height: int, width: int) -> DataFrame:
    """Height above the mean of a window with mirrored borders."""
    out = bordered_box(df, value, size, height, width, "reflect", ("mean",))
    return out.select(*CELL, (F.col(value) - F.col(f"{value}_w{size}_mean")).alias("tpi"))


def curvature(df: DataFrame, value: str) -> DataFrame:
    """The sum of second differences to four neighbours; a neighbour that is missing or outside counts as the cell."""
    x, y = Window.partitionBy("row_id").orderBy("col_id"), Window.partitionBy("col_id").orderBy("row_id")
    z = F.col(value)

    def side(f: object, w: object, at: str, step: int) -> Column:
        return F.coalesce(F.when(f(at).over(w) == F.col(at) + step, f(value).over(w)), z) - z

    total = side(F.lag, x, "col_id", -1) + side(F.lead, x, "col_id", 1) + side(F.lag, y, "row_id", -1) + side(F.lead, y, "row_id", 1)
    return df.select(*CELL, F.when(z.isNotNull(), total).alias("curvature"))


def kernel(sigma: float, truncate: float = 4.0) -> list[tuple[int, float]]:
    """Normalised Gaussian weights by offset."""
    r = int(truncate * sigma + 0.5)
    w = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-r, r + 1)]
    return [(d - r, x / sum(w)) for d, x in enumerate(w)]


def gaussian_surface(points: DataFrame, value: str, sigma: float, height: int, width: int, truncate: float = 4.0) -> DataFrame:
    """Kernel-weighted mean of point values on every cell within reach of a point: two separable passes of sums.

    points: row_id, col_id, value; several in a cell add up. Each pass spreads a cell along one axis by the kernel's
    fixed offsets and sums by cell, with partial sums before the shuffle. Cells that no kernel reaches are absent.
    """
    spread = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in kernel(sigma, truncate)])
    cells = points.groupBy(*CELL).agg(F.sum(value).alias("num"), F.count(value).cast("double").alias("den"))
    for axis, other, n in (("col_id", "row_id", width), ("row_id", "col_id", height)):
        wide = cells.select(other, axis, "num", "den", F.explode(spread).alias("k"))
        wide = wide.withColumn(axis, F.col(axis) + F.col("k.d")).where(F.col(axis).between(0, n - 1))
        cells = wide.groupBy(other, axis).agg(F.sum(F.col("num") * F.col("k.w")).alias("num"), F.sum(F.col("den") * F.col("k.w")).alias("den"))
    return cells.select(*CELL, F.when(F.col("den") > 1e-8, F.col("num") / F.col("den")).otherwise(0.0).alias("surface"))


def block_max_surface(points: DataFrame, value: str, stride: int, height: int, width: int) -> DataFrame:
    """Each point paints a stride x stride square; where squares overlap the largest value stays."""
    lo, hi = _reach(stride)
    wide = points.withColumn("row_id", F.explode(F.sequence(F.col("row_id") + lo, F.col("row_id") + hi))).withColumn("col_id", F.explode(F.sequence(F.col("col_id") + lo, F.col("col_id") + hi)))
    inside = F.col("row_id").between(0, height - 1) & F.col("col_id").between(0, width - 1)
    return wide.where(inside).groupBy(*CELL).agg(F.max(value).alias("surface"))


def idw_fill(df: DataFrame, value: str, reach: int) -> DataFrame:
    """Missing cells filled by inverse squared distance from valid cells within reach cells; `filled` says where.

    Valid cells spread to the bins of size reach around them, so the join is on bins and local.
    """
    cell = df.select(*CELL, value)
    bins = {"br": F.floor(F.col("row_id") / reach).cast("int"), "bc": F.floor(F.col("col_id") / reach).cast("int")}
    holes = cell.where(F.col(value).isNull()).select(*CELL).withColumns(bins)
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    good = cell.where(F.col(value).isNotNull()).select(F.col("row_id").alias("r2"), F.col("col_id").alias("c2"), F.col(value).alias("z2"))
    good = good.withColumn("br", F.explode(F.transform(near, lambda d: d + F.floor(F.col("r2") / reach).cast("int")))).withColumn("bc", F.explode(F.transform(near, lambda d: d + F.floor(F.col("c2") / reach).cast("int"))))
    dr, dc = (F.col("r2") - F.col("row_id")).cast("double"), (F.col("c2") - F.col("col_id")).cast("double")
    d2 = dr * dr + dc * dc
    found = holes.join(good, ["br", "bc"]).withColumn("d2", d2).where(F.col("d2") <= reach * reach)
    filled = found.groupBy(*CELL).agg((F.sum(F.col("z2") / F.col("d2")) / F.sum(1 / F.col("d2"))).alias("__z"))
    return df.join(filled, list(CELL), "left").select(*[F.coalesce(value, "__z").alias(c) if c == value else F.col(c) for c in df.columns], (F.col(value).isNull() & F.col("__z").isNotNull()).alias("filled"))


def patches(df: DataFrame, value: str, size: int, stride: int, height: int, width: int, least_valid: float = 0.7) -> DataFrame:
    """Full size x size windows every stride cells, with mean and share of valid cells, where that is enough.

    Windows are whole squares of gcd(size, stride) cells a side, so cells are summed by square first and only squares
    go to the windows that hold them: (size / stride) ** 2 copies of a square, not of a cell.
    """
    side = math.gcd(size, stride)
    per, step = size // side, stride // side  # squares along a window, and from one window to the next
    square = lambda c: F.floor(F.col(c) / side).cast("int").alias(c)
    squares = df.groupBy(square("row_id"), square("col_id")).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    steps = lambda c, n: F.filter(F.sequence(F.floor((F.col(c) - per) / step) + 1, F.floor(F.col(c) / step)), lambda k: (k >= 0) & (k * stride + size <= n))
    rows = squares.withColumn("pr", F.explode(steps("row_id", height))).withColumn("pc", F.explode(steps("col_id", width)))
    agg = rows.groupBy("pr", "pc").agg(F.try_divide(F.sum("s"), F.sum("n")).alias("mean"), (F.sum("n") / F.lit(float(size * size))).alias("valid"))
    out = agg.where(F.col("valid") >= least_valid)
    return out.select((F.col("pr") * stride).cast("int").alias("row_id"), (F.col("pc") * stride).cast("int").alias("col_id"), (F.col("pr") * stride + size // 2).cast("int").alias("center_row"), (F.col("pc") * stride + size // 2).cast("int").alias("center_col"), "mean", "valid")


def patch_pixels(df: DataFrame, bands: Sequence[str], size: int, stride: int, height: int, width: int, least_valid: float = 0.7) -> DataFrame:
    """(row_id, col_id, center_row, center_col, valid, pixels): full windows every stride cells, as the encoder reads them.

    pixels is a flat array of bands x size x size, missing values 0; valid is the share of the first band's cells that have
    a value, and windows with less are left out. A window holds size ** 2 cells at most, whatever the raster.
    """
    steps = lambda c, n: F.filter(F.sequence(F.floor((F.col(c) - size) / stride) + 1, F.floor(F.col(c) / stride)), lambda k: (k >= 0) & (k * stride + size <= n))
    rows = df.select(*CELL, *bands).withColumn("pr", F.explode(steps("row_id", height))).withColumn("pc", F.explode(steps("col_id", width)))
    place = (F.col("row_id") - F.col("pr") * stride) * size + F.col("col_id") - F.col("pc") * stride
    cell = F.struct(place.cast("int").alias("at"), F.array(*[F.coalesce(F.col(b).cast("double"), F.lit(0.0)) for b in bands]).alias("v"))
    agg = rows.groupBy("pr", "pc").agg(F.map_from_entries(F.collect_list(cell)).alias("cells"), (F.count(bands[0]) / F.lit(float(size * size))).alias("valid"))
    one = lambda b: F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda i: F.coalesce(F.element_at(F.element_at("cells", i.cast("int")), b + 1), F.lit(0.0)))
    pixels = F.flatten(F.array(*[one(b) for b in range(len(bands))]))
    out = agg.where(F.col("valid") >= least_valid)
    return out.select(*[(F.col(c) * stride + add).cast("int").alias(name) for name, c, add in (("row_id", "pr", 0), ("col_id", "pc", 0), ("center_row", "pr", size // 2), ("center_col", "pc", size // 2))], "valid", pixels.alias("pixels"))


def complete(df: DataFrame, spark: SparkSession, height: int, width: int) -> DataFrame:
    """df with a row for each cell of the raster."""
    cells = spark.range(height * width).select(F.floor(F.col("id") / width).cast("int").alias("row_id"), (F.col("id") % width).cast("int").alias("col_id"))
    return cells.join(df, list(CELL), "left")
