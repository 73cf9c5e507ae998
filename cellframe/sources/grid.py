"""Grids: reference grids, snapping, tiles and patches as table-valued generators.

A raster is a frame with one row for each cell: ``row_id``, ``col_id`` and a column for each band, NULL where there is
no data. ``GridSpec`` ties cells to coordinates; rows count southward from the upper edge.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GridSpec:
    """Upper left corner, cell size and extent in cells."""

    x0: float
    y0: float
    res: float
    width: int
    height: int
    crs: str = "EPSG:32719"

    @classmethod
    def snapped(cls, minx: float, miny: float, maxx: float, maxy: float, res: float, crs: str = "EPSG:32719") -> GridSpec:
        """The smallest grid of whole cells over a box; edges are multiples of res."""
        x0, y1 = math.floor(minx / res) * res, math.ceil(maxy / res) * res
        x1, y0 = math.ceil(maxx / res) * res, math.floor(miny / res) * res
        return cls(x0, y1, res, round((x1 - x0) / res), round((y1 - y0) / res), crs)

    def x(self, col: Column) -> Column:
        return F.lit(float(self.x0)) + (col + F.lit(0.5)) * F.lit(float(self.res))

    def y(self, row: Column) -> Column:
        return F.lit(float(self.y0)) - (row + F.lit(0.5)) * F.lit(float(self.res))

    def col(self, x: Column) -> Column:
        return F.floor((x - F.lit(float(self.x0))) / F.lit(float(self.res))).cast("int")

    def row(self, y: Column) -> Column:
        return F.floor((F.lit(float(self.y0)) - y) / F.lit(float(self.res))).cast("int")

    def inside(self, row: Column, col: Column) -> Column:
        return row.between(0, self.height - 1) & col.between(0, self.width - 1)


def reference_grid(spark: SparkSession, grid: GridSpec) -> DataFrame:
    """Every cell with its centre, generated in parallel."""
    cells = spark.range(grid.width * grid.height)
    row, col = F.floor(F.col("id") / grid.width).cast("int"), (F.col("id") % grid.width).cast("int")
    return cells.select(row.alias("row_id"), col.alias("col_id")).select("row_id", "col_id", grid.x(F.col("col_id")).alias("x"), grid.y(F.col("row_id")).alias("y"))


def patch_grid(boxes: DataFrame, size: float, key: str = "segment") -> DataFrame:
    """Square patches over each box (key, minx, miny, maxx, maxy) that meet it, numbered from the south-west.

    patch_id is ``<key>_r000_c000``; borders that only touch count as meeting.
    """
    s = F.lit(float(size))
    low = boxes.withColumns({"px": F.floor(F.col("minx") / s) * s, "py": F.floor(F.col("miny") / s) * s})
    n = low.withColumns({"nx": F.ceil((F.col("maxx") - F.col("px")) / s).cast("int"), "ny": F.ceil((F.col("maxy") - F.col("py")) / s).cast("int")})
    rows = n.withColumn("row_id", F.explode(F.sequence(F.lit(0), F.col("ny") - 1))).withColumn("col_id", F.explode(F.sequence(F.lit(0), F.col("nx") - 1)))
    x, y = F.col("px") + F.col("col_id") * s, F.col("py") + F.col("row_id") * s
    meets = (x <= F.col("maxx")) & (x + s >= F.col("minx")) & (y <= F.col("maxy")) & (y + s >= F.col("miny"))
    name = F.format_string("%s_r%03d_c%03d", F.col(key).cast("string"), F.col("row_id"), F.col("col_id"))
    return rows.where(meets).select(key, "row_id", "col_id", name.alias("patch_id"), x.alias("minx"), y.alias("miny"), (x + s).alias("maxx"), (y + s).alias("maxy"))


def degree_chunks(boxes: DataFrame, step: float, key: str = "segment") -> DataFrame:
    """Boxes cut into chunks of step degrees, column by column; the last ones are clipped; rounded to 4 places."""
    s = F.lit(float(step))
    n = boxes.withColumns({"nx": F.ceil((F.col("maxx") - F.col("minx")) / s).cast("int"), "ny": F.ceil((F.col("maxy") - F.col("miny")) / s).cast("int")})
    rows = n.where("nx > 0 AND ny > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    x, y = F.col("minx") + F.col("i") * s, F.col("miny") + F.col("j") * s
    return rows.select(key, "i", "j", F.round(x, 4).alias("x0"), F.round(y, 4).alias("y0"), F.round(F.least(x + s, F.col("maxx")), 4).alias("x1"), F.round(F.least(y + s, F.col("maxy")), 4).alias("y1"))


def snapped_chunks(zones: DataFrame, step: float) -> DataFrame:
    """Distinct chunks of a global step grid that meet some zone (x0, y0, x1, y1)."""
    s = F.lit(float(step))
    lo = lambda c: F.floor(F.col(c) / s).cast("int")
    hi = lambda c: (F.ceil(F.col(c) / s) - 1).cast("int")
    cells = zones.withColumn("i", F.explode(F.sequence(lo("x0"), F.greatest(lo("x0"), hi("x1"))))).withColumn("j", F.explode(F.sequence(lo("y0"), F.greatest(lo("y0"), hi("y1")))))
    return cells.select("i", "j").distinct().select("i", "j", (F.col("i") * s).alias("x0"), (F.col("j") * s).alias("y0"), ((F.col("i") + 1) * s).alias("x1"), ((F.col("j") + 1) * s).alias("y1"))


def named_north_to_south(boxes: DataFrame, names: list[str], key: str = "feature_id") -> DataFrame:
    """Boxes with a name and priority by descending upper edge; those beyond the names get `tile_<n>` and priority 9."""
    n = F.row_number().over(Window.orderBy(F.desc("maxy"), key))
    given = F.array(*map(F.lit, names))
    return boxes.withColumn("n", n).withColumn("tile", F.coalesce(F.get(given, F.col("n") - 1), F.concat(F.lit("tile_"), F.col("n").cast("string")))).withColumn("priority", F.when(F.col("n") <= len(names), F.col("n")).otherwise(9).cast("int"))
