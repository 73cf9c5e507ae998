"""From a scored surface to ranked targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.algebra import target_id
from cellframe.functions.ranks import percentiles
from cellframe.operators import graphs
from cellframe.sources.scratch import written


def threshold(surface: DataFrame, value: str, percentile: float, least: float) -> float:
    """The percentile of all valid cells, but not below least."""
    p = percentiles(surface, value, [percentile])[0]
    return least if p is None else max(p, least)


def above(surface: DataFrame, value: str, percentile: float, least: float) -> DataFrame:
    """The cells at or above the threshold; the limit is a constant, so the filter reaches the scan."""
    return surface.where(F.col(value) >= F.lit(threshold(surface, value, percentile, least)))


def components(cells: DataFrame, width: int) -> DataFrame:
    """cells (row_id, col_id) with `component`, the smallest row_id * width + col_id of its 4-connected region.

    Cells of a row join into runs, and touching runs of neighbouring rows are edges. Runs hook onto their smallest
    neighbour and chains are cut short, so rounds grow with the logarithm of a region, not with its length (see graphs).
    """
    across = Window.partitionBy("row_id").orderBy("col_id")
    marked = cells.select("row_id", "col_id").distinct().withColumn("g", F.col("col_id") - F.row_number().over(across))
    runs = marked.groupBy("row_id", "g").agg(F.min("col_id").alias("c0"), F.max("col_id").alias("c1"))
    runs = runs.select("row_id", "g", "c0", "c1", (F.col("row_id").cast("long") * width + F.col("c0")).alias("run"))
    runs = written(runs, "runs")
    # Runs meet by blocks of columns, so a long row doesn't pair all its runs.
    size = 64
    spread = lambda df, a, b: df.withColumn("block", F.explode(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size))))
    upper = spread(runs.select((F.col("row_id") + 1).alias("row_id"), F.col("c0").alias("u0"), F.col("c1").alias("u1"), F.col("run").alias("a")), "u0", "u1")
    lower = spread(runs.select("row_id", "c0", "c1", F.col("run").alias("b")), "c0", "c1")
    edges = upper.join(lower, ["row_id", "block"]).where("u0 <= c1 AND c0 <= u1").select("a", "b")
    label = runs.select("run").join(graphs.components(edges).toDF("run", "component"), "run", "left").withColumn("component", F.coalesce("component", "run"))
    named = marked.join(runs.join(label, "run").select("row_id", "g", "component"), ["row_id", "g"])
    return cells.join(named.select("row_id", "col_id", "component"), ["row_id", "col_id"])


def measured(cells: DataFrame, value: str, res: float, least_km2: float = 0.0, most_km2: float | None = None) -> DataFrame:
    """Each component's cells, area, mean, max, score 0.7 mean + 0.3 max, and centre; areas outside the bounds go."""
    agg = cells.groupBy("component").agg(F.count("*").alias("cells"), F.avg(value).alias("m"), F.max(value).alias("x"), F.avg("row_id").alias("row"), F.avg("col_id").alias("col"))
    area = F.col("cells") * F.lit(res * res / 1e6)
    out = agg.withColumn("area_km2", area).where(F.col("area_km2") >= least_km2)
    if most_km2 is not None:
        out = out.where(F.col("area_km2") <= most_km2)
    score = F.lit(0.7) * F.col("m") + F.lit(0.3) * F.col("x")
    return out.select("component", "cells", F.round("area_km2", 4).alias("area_km2"), F.round("m", 4).alias("mean_prob"), F.round("x", 4).alias("max_prob"), F.round(score, 4).alias("score"), "row", "col")


def top(regions: DataFrame, kind: Column, n: int) -> DataFrame:
    """The n best regions of each type by score, then max, then component; with rank and target_id."""
    rows = regions.withColumn("deposit_type", kind)
    order = Window.partitionBy("deposit_type").orderBy(F.desc("score"), F.desc("max_prob"), "component")
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
    return ranked.withColumn("target_id", target_id(F.col("deposit_type"), F.col("rank")))
