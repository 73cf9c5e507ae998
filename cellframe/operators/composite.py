"""Composites and mosaics over stacks of scenes and overlapping tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.sources.scratch import written


def dry_and_clear(scenes: DataFrame, max_cloud: float, months: tuple[int, int] = (3, 10), start: str | None = None, end: str | None = None) -> DataFrame:
    """Scenes of the dry months below the cloud limit, and within dates if given; missing cloud counts as 100."""
    ts = F.col("ts").cast("timestamp")
    out = scenes.where((F.coalesce("cloud", F.lit(100)) < max_cloud) & F.month(ts).between(*months))
    if start is not None:
        out = out.where(ts >= F.lit(start).cast("timestamp"))
    return out if end is None else out.where(ts < F.lit(end).cast("timestamp"))


def median_composite(obs: DataFrame, bands: Sequence[str], positive: bool = True, keys: Sequence[str] = ("row_id", "col_id")) -> DataFrame:
    """The median over time of each band and cell, of values above 0 if positive.

    One shuffle on the cell; values of a cell are counted, not listed, before it.
    """
    value = lambda b: F.when(F.col(b) > 0, F.col(b)) if positive else F.col(b)
    return obs.groupBy(*keys).agg(*[F.percentile(value(b), F.lit(0.5)).alias(b) for b in bands])


def first_mosaic(tiles: DataFrame, order: str, bands: Sequence[str], keys: Sequence[str] = ("row_id", "col_id")) -> DataFrame:
    """Of overlapping tiles, for each band the first valid value in tile order."""
    return tiles.groupBy(*keys).agg(*[F.min_by(F.col(b), F.when(F.col(b).isNotNull(), F.col(order))).alias(b) for b in bands])


def mean_mosaic(tiles: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("row_id", "col_id")) -> DataFrame:
    return tiles.groupBy(*keys).agg(*[F.avg(b).alias(b) for b in bands])


def greatest_of(layers: Sequence[str]) -> Column:
    """The largest of several layers' columns; missing only where all are."""
    return F.greatest(*layers) if len(layers) > 1 else F.col(layers[0])


def patch_fill(target: DataFrame, patch: DataFrame, bands: Sequence[str], keys: Sequence[str] = ("row_id", "col_id")) -> DataFrame:
    """target with all bands taken from patch where target misses any and patch has all; `filled` says where."""
    have, can = F.lit(True), F.lit(True)
    for b in bands:
        have, can = have & F.col(b).isNotNull(), can & F.col(f"__{b}").isNotNull()
    joined = target.join(patch.select(*keys, *[F.col(b).alias(f"__{b}") for b in bands]), list(keys), "left")
    fill = ~have & can
    return joined.select(*keys, *[F.when(fill, F.col(f"__{b}")).otherwise(F.col(b)).alias(b) for b in bands], fill.alias("filled"))


def fill_report(filled: DataFrame, bands: Sequence[str]) -> DataFrame:
    miss = F.lit(False)
    for b in bands:
        miss = miss | F.col(b).isNull()
    return filled.agg(F.count("*").alias("cells"), F.sum(F.col("filled").cast("long")).alias("filled"), F.sum(miss.cast("long")).alias("residual"))


def greedy_coverage(footprints: DataFrame, clouds: DataFrame, coverage: float = 0.995, least_gain: float = 0.001, max_scenes: int = 20) -> DataFrame:
    """scene_id, step, gain: scenes that cover most cells, each the one of largest gain, ties to less cloud.

    footprints: (scene_id, cell); clouds: (scene_id, cloud), one row each. Ends when enough is covered or a scene adds too
    little; then the clearest of the rest follow with gain 0, up to max_scenes. Only counts reach the driver, one row a
    step; cells stay distributed, and lineage is cut at each step.
    """
    spark = footprints.sparkSession
    left = written(footprints.select("scene_id", "cell").distinct(), "cells")
    clouds = clouds.select("scene_id", F.coalesce("cloud", F.lit(100)).cast("double").alias("cloud"))
    total = left.select("cell").distinct().count()
    covered, steps = 0, []
    while total and covered < coverage * total:
        best = left.groupBy("scene_id").count().join(clouds, "scene_id").orderBy(F.desc("count"), "cloud", "scene_id").first()
        if best is None or best["count"] < least_gain * total:
            break
        steps.append((best["scene_id"], len(steps) + 1, best["count"]))
        covered += best["count"]
        won = left.where(F.col("scene_id") == best["scene_id"]).select("cell")
        left = written(left.join(won, "cell", "left_anti"), "cells")
    chosen = spark.createDataFrame(steps, "scene_id long, step int, gain long")
    room = max(0, max_scenes - len(steps))
    rest = clouds.join(chosen, "scene_id", "left_anti").orderBy("cloud", "scene_id").limit(room)
    rest = rest.select("scene_id", (F.row_number().over(Window.orderBy("cloud", "scene_id")) + len(steps)).alias("step"), F.lit(0).cast("long").alias("gain"))
    return chosen.unionByName(rest)
