"""Registered queries over models and targets, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.functions import algebra as alg
from cellframe.operators import labels, models, targets
from cellframe.operators.composite import dry_and_clear, median_composite
from cellframe.sources.fixtures import view, with_views
from cellframe.sources.scratch import written

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


# Evaluation and features

_S = "s AS (SELECT l_discount * 10 AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return li.select((F.col("l_discount") * 10).alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))


@query(f"WITH {_S}, r AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0e0 AS r FROM s), n AS (SELECT CAST(sum(y) AS DOUBLE) AS p, count(*) - sum(y) AS q FROM s) SELECT count(*) AS n, CAST(any_value(p) AS BIGINT) AS positives, round((sum(r * y) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * any_value(q)), 4) AS auc_roc FROM r, n")
def auc_roc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.metrics(_scored(spark, sf_dir), "s", "y").select("n", "positives", "auc_roc")


@query(f"WITH {_S}, c AS (SELECT s, sum(y) AS p, count(*) AS k FROM s GROUP BY 1), w AS (SELECT p, sum(p) OVER (ORDER BY s DESC) AS tp, sum(k) OVER (ORDER BY s DESC) AS n FROM c), f AS (SELECT sum(CASE WHEN s > 0.5 THEN y ELSE 0 END) AS tp, sum(CASE WHEN s > 0.5 THEN 1 - y ELSE 0 END) AS fp, sum(y) AS p, sum(1 - y) AS q FROM s) SELECT round(sum(w.p * 1.0e0 * w.tp / w.n) / any_value(f.p), 4) AS auc_pr, CAST(any_value(f.tp) AS BIGINT) AS tp, CAST(any_value(f.fp) AS BIGINT) AS fp, CAST(any_value(f.p - f.tp) AS BIGINT) AS fn, CAST(any_value(f.q - f.fp) AS BIGINT) AS tn FROM w, f")
def average_precision_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.metrics(_scored(spark, sf_dir), "s", "y").select("auc_pr", "tp", "fp", "fn", "tn")


_LEVELS = ("AIR", "MAIL", "1-URGENT", "2-HIGH", "missing")


@query("SELECT o_orderkey, o_orderpriority, " + ", ".join(f"CAST(o_orderpriority = '{x}' AS INTEGER) AS \"o_orderpriority_{x}\"" for x in _LEVELS) + " FROM orders")
def one_hot_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.one_hot(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderpriority"), "o_orderpriority", _LEVELS)


@query(with_views("SELECT row_id, col_id, coalesce(dem, 0) AS dem, 0.0e0 AS slope, coalesce(v, 0) AS v FROM grid", "grid"))
def feature_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.aligned(view(spark, sf_dir, "grid"), ("dem", "slope", "v"), ("row_id", "col_id"))


@query("SELECT label, CAST(i - 1 AS INTEGER) AS i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS value FROM embeddings, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2")
def embedding_mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mean_pool(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", "label").withColumn("value", F.round("value", 6))


@query("SELECT vec_id, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS emb_{i}" for i in range(64)) + " FROM embeddings")
def embedding_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.embedding_columns(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "embedding", 64, ["vec_id"])


@query("""WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), c AS (SELECT q.vec_id AS query, v.vec_id AS neighbour, round(list_cosine_similarity(q.e, v.e), 6) AS cosine, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.e, v.e), 9) DESC, v.vec_id) AS rank
  FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0) SELECT query, neighbour, cosine, CAST(rank AS INTEGER) AS rank FROM c WHERE rank <= 5""")
def embedding_cosine_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return models.cosine_neighbours(v.where("vec_id % 100 = 0"), v, 5).withColumn("cosine", F.round("cosine", 6))


#: One for each value of the embedding.
FEATURES = tuple(f"f{i}" for i in range(64))
#: Most boosting rounds; held-out blocks end them earlier.
ROUNDS = 1000


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = view(spark, sf_dir, "patches")
    cols = [F.get("embedding", F.lit(i)).cast("double").alias(f) for i, f in enumerate(FEATURES)]
    block = labels.block_id(F.col("center_x"), F.col("center_y"), 30_000)
    return v.select("vec_id", block.alias("block_id"), (F.col("label") < 5).cast("double").alias("y"), *cols)


@query()
def model_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated candidates over block folds, and the one chosen."""
    df = written(labels.group_folds(_training(spark, sf_dir), "block_id", "y", 3, 42), "folds")
    scores = {k: models.cross_validated(df, FEATURES, "y", "fold", make, 3) for k, make in models.candidates(7).items()}
    chosen = models.select_model(scores)
    return models.cv_table(df, scores).withColumn("chosen", F.col("model") == chosen)


@query()
def cv_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = written(labels.group_folds(_training(spark, sf_dir), "block_id", "y", 3, 1), "folds")
    return models.cv_table(df, {"logistic": models.cross_validated(df, FEATURES, "y", "fold", models.candidates(7)["logistic"], 3)})


@query()
def rf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _training(spark, sf_dir)
    return models.scored(models.fit(df, FEATURES, "y", models.candidates(7)["forest"]()), df, ["vec_id"])


@query()
def gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A boosted model that stops on held-out blocks, scoring every patch."""
    df = labels.block_split(_training(spark, sf_dir), "block_id", "y", 42).withColumn("held", F.col("split") != "train")
    return models.scored(models.early_stopped(df, FEATURES, "y", "held", 7, ROUNDS), df, ["vec_id"])


@query()
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _training(spark, sf_dir)
    return models.importances(models.fit(df, FEATURES, "y", models.candidates(7)["forest"]()), FEATURES, df)


@query(with_views(""", m AS (SELECT id, x AS a, y AS b FROM points WHERE kind = 'BUILDING'), p AS (SELECT m.id, o.id AS neighbour, m.a, m.b, o.a AS oa, o.b AS ob, row_number() OVER (PARTITION BY m.id ORDER BY (m.a - o.a) ** 2 + (m.b - o.b) ** 2, o.id) AS i
  FROM m JOIN m o ON o.id <> m.id AND abs(floor(m.a / 5) - floor(o.a / 5)) <= 1 AND abs(floor(m.b / 5) - floor(o.b / 5)) <= 1), u AS (SELECT *, CAST(('0x' || substr(md5(id || '|' || i || '|9'), 1, 8)) AS BIGINT) / 4294967296.0e0 AS u FROM p WHERE i <= 2)
SELECT id, neighbour, CAST(i AS INTEGER) AS i, round(a + u * (oa - a), 6) AS x, round(b + u * (ob - b), 6) AS y FROM u""", "points"))
def smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = view(spark, sf_dir, "points").where("kind = 'BUILDING'")
    out = models.smote(p, ("x", "y"), "id", 5, 2, 9, 5.0)
    return out.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


# Targets

_TH = "th AS (SELECT greatest(quantile_cont(v, 0.8), 0.5) AS t FROM grid), hot AS (SELECT row_id, col_id, v FROM grid, th WHERE v >= t)"
_COMP = """ids AS (SELECT CAST(row_id AS BIGINT) * 50 + col_id AS id, row_id, col_id, v FROM hot), nb AS (SELECT a.id AS a, b.id AS b FROM ids a JOIN ids b ON (a.row_id = b.row_id AND abs(a.col_id - b.col_id) = 1) OR (a.col_id = b.col_id AND abs(a.row_id - b.row_id) = 1)),
comp(id, c) USING KEY (id) AS (SELECT id, id FROM ids UNION (SELECT nb.b, min(x.c) FROM comp x JOIN nb ON nb.a = x.id JOIN recurring.comp AS y ON y.id = nb.b WHERE x.c < y.c GROUP BY nb.b))"""


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.above(view(spark, sf_dir, "grid").select("row_id", "col_id", "v"), "v", 0.8, 0.5)


@query(with_views("SELECT greatest(quantile_cont(v, 0.997), 0.5) AS threshold FROM grid", "grid"))
def percentile_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(targets.threshold(view(spark, sf_dir, "grid"), "v", 0.997, 0.5),)], "threshold double")


@query(with_views(f", {_TH}, {_COMP} SELECT row_id, col_id, c AS component FROM ids JOIN comp USING (id)", "grid").replace("WITH ", "WITH RECURSIVE ", 1))
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets.components(_hot(spark, sf_dir), 50).select("row_id", "col_id", "component")


_TOP = f"""{_TH}, {_COMP}, ag AS (SELECT c AS component, count(*) AS cells, avg(v) AS m, max(v) AS x FROM ids JOIN comp USING (id) GROUP BY 1 HAVING count(*) >= 2),
sc AS (SELECT component, cells, round(cells * (900 / 1e6), 4) AS area_km2, round(m, 4) AS mean_prob, round(x, 4) AS max_prob, round(0.7e0 * m + 0.3e0 * x, 4) AS score, CASE component % 2 WHEN 0 THEN 'porfiro' ELSE 'skarn' END AS deposit_type FROM ag),
rk AS (SELECT *, row_number() OVER (PARTITION BY deposit_type ORDER BY score DESC, max_prob DESC, component) AS rank FROM sc)"""


def _top(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    cells = targets.components(_hot(spark, sf_dir), 50)
    regions = targets.measured(cells, "v", 30.0, least_km2=2 * 900 / 1e6)
    return targets.top(regions, F.when(F.col("component") % 2 == 0, "porfiro").otherwise("skarn"), n)


@query(with_views(f", {_TOP} SELECT component, cells, area_km2, mean_prob, max_prob, score, deposit_type, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 50", "grid").replace("WITH ", "WITH RECURSIVE ", 1))
def top_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 50).select("component", "cells", "area_km2", "mean_prob", "max_prob", "score", "deposit_type", "rank")


@query(with_views(f", {_TOP} SELECT format('{{}}-{{:03d}}', upper(substr(deposit_type, 1, 3)), rank) AS target_id, deposit_type, CAST(rank AS INTEGER) AS rank, area_km2, mean_prob, max_prob, score FROM rk WHERE rank <= 10 ORDER BY deposit_type, rank", "grid").replace("WITH ", "WITH RECURSIVE ", 1))
def ranking_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _top(spark, sf_dir, 10).orderBy("deposit_type", "rank")
    return out.select("target_id", "deposit_type", "rank", "area_km2", "mean_prob", "max_prob", "score")


@query(with_views("""SELECT p.patch_id, 'm' || k AS model, round(1 / (1 + exp(-(CAST(embedding[k + 1] AS DOUBLE) * 2))), 6) AS prob FROM patches p, (SELECT unnest([0, 1, 2]) AS k)""", "patches"))
def model_tile_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model scores every patch, in one pass over the patches."""
    p = view(spark, sf_dir, "patches")
    one = lambda k: F.struct(F.lit(f"m{k}").alias("model"), F.round(1 / (1 + F.exp(-(F.get("embedding", F.lit(k)).cast("double") * 2))), 6).alias("prob"))
    return p.select("patch_id", F.explode(F.array(*map(one, range(3)))).alias("s")).select("patch_id", "s.model", "s.prob")


_FLAG = """med AS (SELECT row_id, col_id, median(CASE WHEN B08 > 0 THEN B08 END) AS B08, median(CASE WHEN B04 > 0 THEN B04 END) AS B04, median(CASE WHEN B11 > 0 THEN B11 END) AS B11, median(CASE WHEN B12 > 0 THEN B12 END) AS B12, median(CASE WHEN B02 > 0 THEN B02 END) AS B02 FROM obs WHERE cloud < 20 AND month(ts) BETWEEN 3 AND 10 GROUP BY 1, 2)"""


@query(with_views(f", {_FLAG} SELECT row_id, col_id, CASE WHEN B08 + B04 <> 0 THEN round(greatest(-1.0e0, least(1.0e0, (B08 - B04) / (B08 + B04))), 9) END AS NDVI, round(B11 / nullif(B12, 0), 9) AS Clay_Index, round(B04 / nullif(B02, 0), 9) AS Ferric_Iron FROM med", "obs"))
def composite_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene stack to median composite to indices."""
    c = median_composite(dry_and_clear(view(spark, sf_dir, "obs"), 20), ("B08", "B04", "B11", "B12", "B02"))
    i = alg.indices(c, {k: alg.S2_INDICES[k] for k in ("NDVI", "Clay_Index", "Ferric_Iron")})
    return i.select("row_id", "col_id", *[F.round(x, 9).alias(x) for x in ("NDVI", "Clay_Index", "Ferric_Iron")])


@query()
def flagship_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes to composite, indices, a score, its threshold, regions and ranked targets."""
    c = median_composite(dry_and_clear(view(spark, sf_dir, "obs"), 20), ("B08", "B04", "B11", "B12", "B02"))
    i = alg.indices(c, {k: alg.S2_INDICES[k] for k in ("NDVI", "Clay_Index", "Ferric_Iron")})
    z = F.coalesce("Ferric_Iron", F.lit(0.0)) - F.coalesce("NDVI", F.lit(0.0))
    scored = i.select("row_id", "col_id", F.round(1 / (1 + F.exp(-z)), 6).alias("prob"))
    cells = targets.components(targets.above(scored, "prob", 0.8, 0.5), 40)
    return targets.top(targets.measured(cells, "prob", 30.0), F.lit("porfiro"), 50)
