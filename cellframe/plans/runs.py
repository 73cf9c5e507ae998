"""A run: stages in order, each written once, skipped if complete, and recorded.

    python -m cellframe.plans.runs --input DIR --output DIR [--stage NAME] [--from-stage NAME] [--force]
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.functions import algebra as alg
from cellframe.functions.geometry import edges_of_boxes
from cellframe.operators import focal, labels, models, spatial, targets
from cellframe.operators.composite import dry_and_clear, median_composite
from cellframe.sources import io
from cellframe.sources.fixtures import view

Stage = Callable[[SparkSession, str, str, io.Config], DataFrame]
BANDS = ("B02", "B03", "B04", "B05", "B08", "B8A", "B11", "B12")
#: Bands that the encoder reads.
ENCODED = ("B02", "B03", "B04", "B8A", "B11", "B12")
#: Columns of the raster of scenes.
WIDTH = 40


def _made(spark: SparkSession, out: str, stage: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{stage}")


def _height(cells: DataFrame) -> int:
    return cells.agg(F.max("row_id")).first()[0] + 1


def composite_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    obs = dry_and_clear(view(spark, source, "obs"), cfg.max_cloud, cfg.dry_months)
    return median_composite(obs, BANDS)


def layer_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    """Vectors as layers on the composite's cells: the zone that touches each, and how near and dense the faults are."""
    cells = _made(spark, out, "composite").select("row_id", "col_id")
    centres = cells.select("row_id", "col_id", (F.col("row_id") * WIDTH + F.col("col_id")).cast("long").alias("id"), (F.col("col_id") + 0.5).cast("double").alias("x"), (F.col("row_id") + 0.5).cast("double").alias("y"))
    faults = spatial.densify(view(spark, source, "fault_lines").where("x1 <> x2 OR y1 <> y2"), 1.0).select(F.col("x").alias("ox"), F.col("y").alias("oy"))
    near = spatial.nearest(centres, faults, 2.0).select("id", F.log1p("distance").alias("fault_distance"))
    dense = spatial.density(centres, faults, 3.0).select("id", F.col("density").alias("fault_density"))
    zones = spatial.burn(cells, edges_of_boxes(view(spark, source, "zones"), "feature_id"), strip=4.0)
    return centres.join(near, "id").join(dense, "id").join(zones, ["row_id", "col_id"]).select("row_id", "col_id", F.col("code").alias("zone_code"), "fault_distance", "fault_density")


def terrain_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    g = view(spark, source, "grid").select("row_id", "col_id", "dem")
    t = focal.tpi(g, "dem", 5, _height(g), 50)
    return focal.slope_aspect(g, "dem", cfg.resolution).join(t, ["row_id", "col_id"]).join(focal.curvature(g, "dem"), ["row_id", "col_id"])


def index_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    return alg.indices(_made(spark, out, "composite"), alg.S2_INDICES)


def feature_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    i = _made(spark, out, "indices")
    for size in cfg.focal_windows:
        i = focal.box(i, "Ferric_Iron", size, ("mean", "std"))
    more = _made(spark, out, "layers").join(_made(spark, out, "terrain"), ["row_id", "col_id"], "left")
    return i.join(more, ["row_id", "col_id"], "left")


def embedding_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    """A vector for each full window of the composite, by the encoder."""
    c = _made(spark, out, "composite")
    c = c.select("row_id", "col_id", *[alg.standardised(alg.reflectance(F.col(b)), *alg.BAND_STATS[b]).alias(b) if b != ENCODED[0] else F.when(alg.valid(F.col(b)), alg.standardised(alg.reflectance(F.col(b)), *alg.BAND_STATS[b])).alias(b) for b in ENCODED])
    patches = focal.patch_pixels(c, ENCODED, cfg.patch_size, cfg.stride, _height(c), WIDTH)
    return models.encode(patches, "pixels", (len(ENCODED), cfg.patch_size, cfg.patch_size))


def label_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    """Cells by the zones that hold their centres, drawn by quotas of their source, with weights, blocks and a split."""
    cells = _made(spark, out, "composite").where(alg.valid(F.col("B02")))
    centres = cells.select((F.col("row_id") * WIDTH + F.col("col_id")).cast("long").alias("id"), "row_id", "col_id", (F.col("col_id") + 0.5).cast("double").alias("x"), (F.col("row_id") + 0.5).cast("double").alias("y"))
    zones = view(spark, source, "zones")
    inside = spatial.containing(centres, edges_of_boxes(zones, "feature_id"), strip=4.0).join(zones.select("feature_id", "zone"), "feature_id")
    weights = {k: w for k, (_, w) in cfg.label_sets.items()} | {"background": labels.WEIGHTS["background"]}
    lab = labels.priority_label(centres.join(inside.select("id", "zone"), "id", "left"), "id", weights=weights)
    have = {r["label_source"]: r["count"] for r in lab.groupBy("label_source").count().collect()}
    some = labels.stratified(lab, "label_source", labels.quotas(have, cfg.n_positive), "id", cfg.seed).join(centres, "id")
    size = cfg.block_size / cfg.resolution
    some = some.withColumn("block_id", labels.block_id(F.col("x"), F.col("y"), size))
    return labels.split(some, "block_id", "label", "id", cfg.seed).select("id", "row_id", "col_id", "label", "label_source", "weight", "block_id", "split")


def _features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("row_id", "col_id")]


def model_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    """Candidates compared over folds of blocks (of cells, where blocks are few), the chosen one fitted and saved; its table."""
    f = _made(spark, out, "features")
    names = _features(f)
    df = models.aligned(f.join(_made(spark, out, "labels"), ["row_id", "col_id"]), names, ["id", "label", "weight", "block_id"]).withColumn("label", F.col("label").cast("double"))
    if df.where("label = 1").count() < 5:
        raise ValueError("fewer than five positives")
    by = "block_id" if df.select("block_id").distinct().count() >= cfg.folds else "id"
    df = labels.group_folds(df, by, "label", cfg.folds, cfg.seed)
    makers = models.candidates(cfg.seed, "weight", cfg.model_scale)
    scores = {k: models.cross_validated(df, names, "label", "fold", make, cfg.folds) for k, make in makers.items()}
    chosen = models.select_model(scores)
    models.save_bundle(f"{out}/_model", models.fit(df, names, "label", makers[chosen]()), names, windows=cfg.focal_windows)
    return models.cv_table(df, scores).withColumn("chosen", F.col("model") == chosen)


def score_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    model, meta = models.load_bundle(spark, f"{out}/_model")
    cells = models.aligned(_made(spark, out, "features"), meta["features"], ["row_id", "col_id"])
    return models.scored(model, cells, ["row_id", "col_id"])


def target_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    cells = targets.above(_made(spark, out, "scores"), "prob", cfg.percentile, cfg.min_prob)
    regions = targets.measured(targets.components(cells, WIDTH), "prob", cfg.resolution)
    return targets.top(regions, F.lit("porfiro"), cfg.n_top)


def export_stage(spark: SparkSession, source: str, out: str, cfg: io.Config) -> DataFrame:
    """The ranking as CSV and as a map; a report of at most n_top rows of each type."""
    t = _made(spark, out, "targets").orderBy("deposit_type", "rank")
    ranking = t.select("target_id", "deposit_type", "rank", "area_km2", "mean_prob", "max_prob", "score")
    io.write_csv(ranking.coalesce(1), f"{out}/_ranking", "overwrite")
    page = io.html_map(t.selectExpr("*", "col as x", "row as y"))
    spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/_map")
    return ranking


STAGES: Sequence[tuple[str, Stage]] = (
    ("composite", composite_stage), ("layers", layer_stage), ("terrain", terrain_stage), ("indices", index_stage), ("features", feature_stage), ("embeddings", embedding_stage),
    ("labels", label_stage), ("model", model_stage), ("scores", score_stage), ("targets", target_stage), ("export", export_stage),
)


def run(spark: SparkSession, source: str, out: str, cfg: io.Config | None = None, only: str | None = None, start: str | None = None, force: bool = False, stages: Sequence[tuple[str, Stage]] = STAGES) -> dict[str, dict[str, object]]:
    """What each stage did: status (done, skipped, failed) and minutes. A failing stage ends the run and is recorded."""
    cfg, log = cfg or io.Config(), {}
    names = [n for n, _ in stages]
    for name in (only, start):
        if name is not None and name not in names:
            raise ValueError(f"no stage {name}")
    chosen = [only] if only else names[names.index(start) :] if start else names
    for name, stage in stages:
        if name not in chosen:
            continue
        begun = time.time()
        if not force and io.exists(spark, f"{out}/{name}"):
            log[name] = {"status": "skipped", "minutes": 0.0}
            continue
        try:
            stage(spark, source, out, cfg).write.mode("overwrite").parquet(f"{out}/{name}")
            log[name] = {"status": "done", "minutes": round((time.time() - begun) / 60, 3)}
        except Exception:
            log[name] = {"status": "failed", "minutes": round((time.time() - begun) / 60, 3)}
            io.save_metadata(spark, f"{out}/_run", stages=log)
            raise
    io.save_metadata(spark, f"{out}/_run", stages=log)
    return log


def main(args: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--stage")
    p.add_argument("--from-stage")
    p.add_argument("--force", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("cellframe").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print(json.dumps(run(spark, a.input, a.output, only=a.stage, start=a.from_stage, force=a.force)))


if __name__ == "__main__":
    main()
