"""Features, training, scoring and evaluation on pyspark.ml and plain aggregation."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.sources.io import load_metadata, save_metadata

#: Parts of the score's order within which windows run, so that no task ranks all rows.
PARTS = 512


def aligned(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the model's features, in its order: missing ones and missing values are 0, others go."""
    one = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) if c in df.columns else F.lit(0.0)
    return df.select(*keep, *[one(c).alias(c) for c in features])


def one_hot(df: DataFrame, column: str, levels: Sequence[str], missing: str = "missing") -> DataFrame:
    """df with a 0/1 column for each saved level; other values have none set."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(missing))
    return df.select(*df.columns, *[(value == x).cast("int").alias(f"{column}_{x}") for x in levels])


def embedding_columns(df: DataFrame, embedding: str, width: int, keep: Sequence[str] = ()) -> DataFrame:
    """An embedding cut or padded to width, as columns emb_0, emb_1, ..."""
    return df.select(*keep, *[F.coalesce(F.get(embedding, F.lit(i)).cast("double"), F.lit(0.0)).alias(f"emb_{i}") for i in range(width)])


def mean_pool(df: DataFrame, embedding: str, key: str) -> DataFrame:
    """The element-wise mean of a key's vectors, as (key, i, value)."""
    return df.select(key, F.posexplode(embedding).alias("i", "v")).groupBy(key, "i").agg(F.avg(F.col("v").cast("double")).alias("value"))


def cosine_neighbours(queries: DataFrame, vectors: DataFrame, k: int, vid: str = "vec_id", embedding: str = "embedding", block: int = 4096) -> DataFrame:
    """The k vectors of largest cosine for each query, exactly: a stated query set against all rows, in blocks.

    Queries go to the tasks `block` at a time; each task keeps its k best for each query, and those meet by query.
    """
    schema = "query long, neighbour long, cosine double"
    rows = queries.select(vid, embedding).orderBy(vid).toLocalIterator()
    out, held = None, []

    def search(ids: np.ndarray, q: np.ndarray) -> DataFrame:
        sent = vectors.sparkSession.sparkContext.broadcast((ids, q))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, q = sent.value
            for pdf in batches:
                x = np.stack(pdf[embedding].to_numpy()).astype(float)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
                own = pdf[vid].to_numpy()
                sim = q @ x.T
                sim[ids[:, None] == own[None, :]] = -np.inf
                best = np.argsort(-sim, axis=1, kind="stable")[:, :k]
                flat = np.take_along_axis(sim, best, 1).ravel()
                keep = np.isfinite(flat)
                yield pd.DataFrame({"query": np.repeat(ids, best.shape[1])[keep], "neighbour": own[best].ravel()[keep], "cosine": flat[keep]})

        return vectors.select(vid, embedding).mapInPandas(run, schema)

    def flush() -> None:
        nonlocal out
        ids, q = np.array([r[0] for r in held]), np.array([r[1] for r in held], float)
        found = search(ids, q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300))
        out = found if out is None else out.unionByName(found)
        held.clear()

    for r in rows:
        held.append((r[0], r[1]))
        if len(held) == block:
            flush()
    if held:
        flush()
    if out is None:
        return vectors.sparkSession.createDataFrame([], schema + ", rank int")
    order = Window.partitionBy("query").orderBy(F.desc(F.round("cosine", 9)), "neighbour")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ranked(df: DataFrame, score: str, label: str) -> DataFrame:
    """For each distinct score, descending: positives and negatives with it, and before it.

    Scores are cut into ranges; sums before a range come from its totals, those within from a window on it.
    """
    s = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("int").alias("y")).where("s IS NOT NULL AND y IS NOT NULL")
    bounds = s.agg(F.min("s").alias("lo"), F.max("s").alias("hi"))
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(PARTS - 1), F.floor((F.col("hi") - F.col("s")) / (F.col("hi") - F.col("lo")) * PARTS))).otherwise(0).cast("int")
    counts = s.groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).join(F.broadcast(bounds)).withColumn("part", at)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = counts.groupBy("part").agg(F.sum("p").alias("pp"), F.sum("n").alias("nn"))
    parts = parts.select("part", F.coalesce(F.sum("pp").over(before), F.lit(0)).alias("p0"), F.coalesce(F.sum("nn").over(before), F.lit(0)).alias("n0"))
    within = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    rows = counts.withColumns({"p1": F.coalesce(F.sum("p").over(within), F.lit(0)), "n1": F.coalesce(F.sum("n").over(within), F.lit(0))})
    return rows.join(F.broadcast(parts), "part").select("s", "p", "n", (F.col("p0") + F.col("p1")).alias("above_p"), (F.col("n0") + F.col("n1")).alias("above_n"))


def metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: n, positives, AUC (NULL with one class), average precision, and the confusion at > 0.5; rounded to 4."""
    r = _ranked(df, score, label)
    tp, tn = F.col("above_p") + F.col("p"), F.col("above_n") + F.col("n")
    agg = r.agg(
        F.sum("p").alias("pos"), F.sum("n").alias("neg"), F.sum((F.col("above_p") + F.col("p") / 2) * F.col("n")).alias("wins"),
        F.sum(F.try_divide(tp, tp + tn) * F.col("p")).alias("ap"), F.sum(F.when(F.col("s") > 0.5, F.col("p")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("s") > 0.5, F.col("n")).otherwise(0)).alias("fp"),
    )
    c = F.col
    return agg.select(
        (c("pos") + c("neg")).alias("n"), c("pos").alias("positives"), F.round(F.try_divide(c("wins"), (c("pos") * c("neg")).cast("double")), 4).alias("auc_roc"),
        F.round(F.try_divide(c("ap"), c("pos").cast("double")), 4).alias("auc_pr"), c("tp").alias("tp"), c("fp").alias("fp"), (c("pos") - c("tp")).alias("fn"), (c("neg") - c("fp")).alias("tn"),
    )


def candidates(seed: int, weight: str | None = None, scale: float = 1.0) -> dict[str, Callable[[], object]]:
    """The classifiers compared; scale shrinks forests and rounds for small runs."""
    w = {"weightCol": weight} if weight else {}
    n = max(4, int(400 * scale))
    return {
        "forest": lambda: RandomForestClassifier(numTrees=n, maxDepth=10, seed=seed, **w),
        "boosted": lambda: GBTClassifier(maxIter=max(4, int(100 * scale)), maxDepth=5, seed=seed, **w),
        "logistic": lambda: LogisticRegression(maxIter=100, regParam=0.01, **w),
    }


def fit(df: DataFrame, features: Sequence[str], label: str, classifier: object) -> PipelineModel:
    classifier.setFeaturesCol("features").setLabelCol(label)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), classifier]).fit(df)


def scored(model: PipelineModel, df: DataFrame, keep: Sequence[str], name: str = "prob") -> DataFrame:
    """keep and the probability of the positive class: a map over the rows, without a shuffle."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(name))


def train_types(df: DataFrame, features: Sequence[str], label: str, kind: str, make: Callable[[], object], least: int = 5) -> dict[str, PipelineModel]:
    """A model for each type with enough positives: its own positives against all negatives. Others are skipped."""
    counts = df.where(F.col(label) == 1).groupBy(kind).count().collect()
    out = {}
    for name in sorted(r[kind] for r in counts if r[kind] is not None and r["count"] >= least):
        rows = df.where((F.col(label) == 0) | (F.col(kind) == name))
        out[name] = fit(rows, features, label, make())
    return out


def scored_by_all(bundle: dict[str, PipelineModel], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """keep and a probability column for each type, one pass over the rows; `best` is the largest."""
    out = df
    for name, model in bundle.items():
        made = [c for c in model.transform(out.limit(0)).columns if c not in out.columns]
        out = model.transform(out).withColumn(f"prob_{name}", vector_to_array("probability")[1]).drop(*made)
    probs = [f"prob_{name}" for name in bundle]
    best = F.greatest(*probs) if len(probs) > 1 else F.col(probs[0])
    return out.select(*keep, *probs, best.alias("best"))


def save_bundle(path: str, model: PipelineModel, features: Sequence[str], categorical: Sequence[str] = (), windows: Sequence[int] = ()) -> None:
    """A model with the order of its features, which of them are categories, and its windows."""
    model.write().overwrite().save(f"{path}/model")
    save_metadata(SparkSession.active(), f"{path}/metadata", features=list(features), categorical=list(categorical), windows=list(windows))


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    return PipelineModel.load(f"{path}/model"), load_metadata(spark, f"{path}/metadata")


def cross_validated(df: DataFrame, features: Sequence[str], label: str, fold: str, make: Callable[[], object], folds: int) -> list[float]:
    """AUC of each fold by a model of the others; folds with one class are left out."""
    out = []
    for k in range(folds):
        train, test = df.where(F.col(fold) != k), df.where(F.col(fold) == k)
        if train.select(label).distinct().count() < 2:
            continue
        auc = metrics(scored(fit(train, features, label, make()), test, [label]), "prob", label).first()["auc_roc"]
        if auc is not None:
            out.append(auc)
    return out


def select_model(scores: dict[str, list[float]], fast: str = "logistic", margin: float = 0.03) -> str:
    """The largest mean AUC; the fast model if it is within the margin of it."""
    mean = {k: sum(v) / len(v) if v else -math.inf for k, v in scores.items()}
    best = max(sorted(mean), key=lambda k: mean[k])
    return fast if fast in mean and mean[best] - mean[fast] <= margin else best


def cv_table(df: DataFrame, scores: dict[str, list[float]]) -> DataFrame:
    """model, auc_mean and auc_std (population) over folds."""
    rows = [(m, float(x)) for m, xs in sorted(scores.items()) for x in xs]
    long = df.sparkSession.createDataFrame(rows, "model string, auc double")
    return long.groupBy("model").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))


def tuned(df: DataFrame, features: Sequence[str], label: str, seed: int, depths: Sequence[int] = (3, 5), steps: Sequence[float] = (0.05, 0.1)) -> PipelineModel:
    """A boosted model by the parameters of largest validation AUC on a seeded split."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, maxIter=20)
    flow = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), gbt])
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).addGrid(gbt.stepSize, list(steps)).build()
    return TrainValidationSplit(estimator=flow, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol=label), trainRatio=0.8, seed=seed).fit(df).bestModel


def early_stopped(df: DataFrame, features: Sequence[str], label: str, validation: str, seed: int, rounds: int = 50) -> PipelineModel:
    """A boosted model that stops when the rows marked validation no longer improve."""
    return fit(df, features, label, GBTClassifier(maxIter=rounds, seed=seed, validationIndicatorCol=validation, validationTol=0.001))


def importances(model: PipelineModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """feature and importance of a tree model, largest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(features, values, strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature")


def permutation_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], label: str, seed: int) -> DataFrame:
    """How much AUC falls if a feature's values go to other rows, by a hash order of rows within equal parts."""
    base = metrics(scored(model, df, [label]), "prob", label).first()["auc_roc"]
    out = []
    for f in features:
        key = F.pmod(F.xxhash64(*[F.col(c) for c in features]), F.lit(64))
        w = Window.partitionBy(key).orderBy(F.xxhash64(F.lit(seed), *[F.col(c) for c in features]))
        mixed = df.withColumn(f, F.coalesce(F.lag(f).over(w), F.col(f)))
        out.append((f, float(base - metrics(scored(model, mixed, [label]), "prob", label).first()["auc_roc"])))
    return df.sparkSession.createDataFrame(out, "feature string, drop double").orderBy(F.desc("drop"), "feature")


def smote(minority: DataFrame, features: Sequence[str], key: str, k: int, per_row: int, seed: int | str, cell: float) -> DataFrame:
    """Synthetic rows between each minority row and per_row of its k nearest, by a hash-drawn weight.

    Neighbours are sought among rows of the same and adjacent cells of the first two features, so the join is local; a
    row without neighbours makes none. (key, neighbour, i and the features.)
    """
    from cellframe.operators.spatial import bin_of

    a, b = features[0], features[1]
    near = F.array(F.lit(-1), F.lit(0), F.lit(1))
    left = minority.select(key, *features).withColumns({"ba": bin_of(F.col(a), cell), "bb": bin_of(F.col(b), cell)})
    right = minority.select(F.col(key).alias("neighbour"), *[F.col(f).alias(f"o_{f}") for f in features])
    right = right.withColumn("ba", F.explode(F.transform(near, lambda d: bin_of(F.col(f"o_{a}"), cell) + d))).withColumn("bb", F.explode(F.transform(near, lambda d: bin_of(F.col(f"o_{b}"), cell) + d)))
    d2 = sum(((F.col(f) - F.col(f"o_{f}")) ** 2 for f in features), F.lit(0.0))
    order = Window.partitionBy(key).orderBy("d2", "neighbour")
    pairs = left.join(right, ["ba", "bb"]).where(F.col(key) != F.col("neighbour")).withColumn("d2", d2).withColumn("i", F.row_number().over(order)).where(F.col("i") <= min(k, per_row))
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col("i").cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return pairs.select(key, "neighbour", "i", *[(F.col(f) + u * (F.col(f"o_{f}") - F.col(f))).alias(f) for f in features])


class Encoder(Protocol):
    """What turns a batch of patches (n, bands, height, width) into vectors (n, width)."""

    def __call__(self, batch: np.ndarray) -> np.ndarray: ...


def band_statistics(batch: np.ndarray) -> np.ndarray:
    """The default encoder: mean, deviation, extremes of each band."""
    flat = batch.reshape(*batch.shape[:2], -1)
    return np.concatenate([flat.mean(2), flat.std(2), flat.min(2), flat.max(2)], axis=1).astype(np.float32)


def encode(patches: DataFrame, pixels: str, shape: tuple[int, int, int], encoder: Encoder = band_statistics, batch: int = 128) -> DataFrame:
    """patches with an embedding of their pixels (a flat array of bands x height x width), in Arrow batches."""
    keep = [c for c in patches.columns if c != pixels]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in patches.select(*keep).schema) + ", embedding array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                x = np.nan_to_num(np.stack([np.asarray(p, np.float32) for p in part[pixels]])).reshape(-1, *shape)
                yield part[keep].assign(embedding=list(encoder(x)))

    return patches.mapInPandas(run, schema)


def batch_size(memory_gb: float) -> int:
    """Encoder items at once for a device's memory."""
    return min(128, max(1, int((0.8 * memory_gb - 4) * 1024 / 150)))


def column_weighted(source: Column, weights: dict[str, float], default: float) -> Column:
    out = F.lit(float(default))
    for name, w in weights.items():
        out = F.when(source == name, float(w)).otherwise(out)
    return out
