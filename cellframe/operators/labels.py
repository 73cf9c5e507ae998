"""Labels, samples and splits. Every draw is an order by md5 of a key and a seed: repeatable, and the same anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions import geometry as geo
from cellframe.functions.algebra import valid
from cellframe.operators import spatial

#: Sets in order of priority, and the default weights of samples by source (fixed values).
PRIORITY = ("negativo", "nucleo", "interpretado")
WEIGHTS = {"nucleo": 1.0, "interpretado": 0.6, "negativo": 1.0, "background": 0.7}


def draw(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit("|"), F.lit(str(seed))))


def priority_label(matches: DataFrame, pid: str, sets: Sequence[str] = PRIORITY, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """pid with label_source, label and weight by the first set in order that matches; background otherwise.

    matches: pid and zone, one row for each match, zone NULL for none.
    """
    hits = matches.groupBy(pid).agg(*[F.max(F.coalesce(F.col("zone") == s, F.lit(False))).alias(s) for s in sets])
    source = F.coalesce(*[F.when(F.col(s), s) for s in sets], F.lit("background"))
    out = hits.select(pid, source.alias("label_source"))
    weight = F.lit(float(weights["background"]))
    for s in sets:
        weight = F.when(F.col("label_source") == s, float(weights[s])).otherwise(weight)
    return out.withColumns({"label": F.col("label_source").isin("nucleo", "interpretado").cast("int"), "weight": weight})


def type_label(matches: DataFrame, pid: str, types: Sequence[str], first: str | None = None) -> DataFrame:
    """pid with deposit_type and label: the last type in order that matches, but `first` ends the search if it does.

    matches: pid and kind, one row for each match, kind NULL for none; no match is `negative`, label 0.
    """
    hits = matches.groupBy(pid).agg(*[F.max(F.coalesce(F.col("kind") == t, F.lit(False))).alias(f"__{i}") for i, t in enumerate(types)])
    found = F.lit(None).cast("string")
    for i, t in enumerate(types):
        found = F.when(F.col(f"__{i}"), t).otherwise(found)
    if first is not None:
        found = F.when(F.col(f"__{list(types).index(first)}"), first).otherwise(found)
    return hits.select(pid, F.coalesce(found, F.lit("negative")).alias("deposit_type"), found.isNotNull().cast("int").alias("label"))


def overlap_share(pairs: DataFrame) -> Column:
    """Share of a box (bx0..by1) that a zone box (x0..y1) covers."""
    c = F.col
    area = (c("bx1") - c("bx0")) * (c("by1") - c("by0"))
    return F.try_divide(geo.box_overlap(c("bx0"), c("by0"), c("bx1"), c("by1"), c("x0"), c("y0"), c("x1"), c("y1")), area)


def smallest(df: DataFrame, n: int, key: str, seed: int | str) -> DataFrame:
    """n rows drawn without replacement, or all: a top-k, not a sort of all rows."""
    return df.withColumn("__d", draw(F.col(key), seed)).orderBy("__d", key).limit(n).drop("__d")


def stratified(df: DataFrame, stratum: str, quotas: Mapping[str, int], key: str, seed: int | str) -> DataFrame:
    """Of each stratum its quota of rows, by draw; strata without a quota are left out."""
    parts = [smallest(df.where(F.col(stratum) == s), n, key, seed) for s, n in sorted(quotas.items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def downsample_negatives(labels: DataFrame, ratio: float, key: str, seed: int | str) -> DataFrame:
    """Negatives held to ratio times the positives: explicit ones stay, background ones are drawn for the rest.

    labels: key, label, label_source. If negatives are few enough, all stay.
    """
    n = labels.agg(F.sum("label").alias("pos"), F.sum((F.col("label") == 0).cast("long")).alias("neg"), F.sum((F.col("label_source") == "negativo").cast("long")).alias("explicit")).first()
    pos, neg, explicit = (int(x or 0) for x in n)
    if neg <= ratio * pos:
        return labels
    background = (F.col("label") == 0) & (F.col("label_source") != "negativo")
    drawn = smallest(labels.where(background), max(0, int(ratio * pos) - explicit), key, seed)
    return labels.where(~background).unionByName(drawn)


def block_id(x: Column, y: Column, size: float) -> Column:
    return F.concat(F.floor(x / F.lit(float(size))).cast("string"), F.lit("_"), F.floor(y / F.lit(float(size))).cast("string"))


def block_split(df: DataFrame, block: str, label: str, seed: int | str, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """df with a split by whole blocks, drawn apart among blocks with and without positives."""
    blocks = df.groupBy(block).agg(F.max(label).alias("has_pos")).withColumn("d", draw(F.col(block), seed))
    p = F.percent_rank().over(Window.partitionBy("has_pos").orderBy("d"))
    named = blocks.select(block, F.when(p < train, "train").when(p < train + val, "val").otherwise("test").alias("split"))
    return df.join(named, block)


def split(df: DataFrame, block: str, label: str, key: str, seed: int | str, train: float = 0.7, val: float = 0.15) -> DataFrame:
    """block_split, or where there are fewer than three blocks or only one class, a split of rows by the draw of their key."""
    n = df.agg(F.count_distinct(block).alias("blocks"), F.count_distinct(label).alias("classes")).first()
    if n["blocks"] >= 3 and n["classes"] > 1:
        return block_split(df, block, label, seed, train, val)
    u = F.conv(F.substring(draw(F.col(key), seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return df.withColumn("split", F.when(u < train, "train").when(u < train + val, "val").otherwise("test"))


def group_folds(df: DataFrame, block: str, label: str, folds: int, seed: int | str) -> DataFrame:
    """df with a fold by whole blocks, dealt in turn among blocks with and without positives."""
    blocks = df.groupBy(block).agg(F.max(label).alias("has_pos")).withColumn("d", draw(F.col(block), seed))
    n = F.row_number().over(Window.partitionBy("has_pos").orderBy("d"))
    return df.join(blocks.select(block, ((n - 1) % folds).cast("int").alias("fold")), block)


def random_points(zones: DataFrame, n: int, seed: int | str) -> DataFrame:
    """n candidate points in each zone's box, by hash: (feature_id, i, x, y)."""
    u = lambda tag: F.conv(F.substring(draw(F.concat(F.col("feature_id").cast("string"), F.lit(tag), F.col("i").cast("string")), seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    rows = zones.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.select("feature_id", "zone", "i", (F.col("x0") + u("x") * (F.col("x1") - F.col("x0"))).alias("x"), (F.col("y0") + u("y") * (F.col("y1") - F.col("y0"))).alias("y"))


def valid_points(edges: DataFrame, raster: DataFrame, value: str, n: int, seed: int | str, key: str = "feature_id", group: str = "zone", over: int = 8, strip: float = 1.0) -> DataFrame:
    """(group, key, i, x, y): n random points in the features of each group, on cells whose value is valid; or fewer.

    edges: key, group, x1, y1, x2, y2 in cell units. Every feature gets candidates by the area of its box, `over` times n
    in a group, so that those inside are equally dense in all; the n of smallest draw stay. A group whose features or valid
    cells fill less than one in `over` of their boxes gives fewer points; a larger `over` gives more.
    """
    box = edges.groupBy(key, group).agg(F.min(F.least("x1", "x2")).alias("x0"), F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("x1", "x2")).alias("x9"), F.max(F.greatest("y1", "y2")).alias("y9"))
    area = (F.col("x9") - F.col("x0")) * (F.col("y9") - F.col("y0"))
    share = F.try_divide(area, F.sum(area).over(Window.partitionBy(group)))
    rows = box.withColumn("k", F.ceil(share * (over * n)).cast("int")).where("k > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    u = lambda tag: F.conv(F.substring(draw(F.concat(F.col(key).cast("string"), F.lit(tag), F.col("i").cast("string")), seed), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    tries = rows.select(group, key, "i", F.concat(F.col(key).cast("string"), F.lit("_"), F.col("i").cast("string")).alias("id"), (F.col("x0") + u("x") * (F.col("x9") - F.col("x0"))).alias("x"), (F.col("y0") + u("y") * (F.col("y9") - F.col("y0"))).alias("y"))
    inside = spatial.containing(tries, edges, key, "id", strip)
    good = spatial.at_points(tries.join(inside, ["id", key], "left_semi"), raster, [value]).where(valid(F.col(value)))
    order = Window.partitionBy(group).orderBy(draw(F.col("id"), seed), "id")
    return good.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(group, key, "i", "x", "y")


def quotas(available: Mapping[str, int], n_pos: int, core_share: float = 0.6, negative_ratio: int = 3) -> dict[str, int]:
    """Positives by set, 60 to 40, one taking what the other lacks; negatives explicit first, then background."""
    core, other = available.get("nucleo", 0), available.get("interpretado", 0)
    want = min(round(n_pos * core_share), core)
    more = min(n_pos - want, other)
    want = min(n_pos - more, core)
    hard = min(available.get("negativo", 0), negative_ratio * (want + more))
    return {"nucleo": want, "interpretado": more, "negativo": hard, "background": min(available.get("background", 0), negative_ratio * (want + more) - hard)}


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts by row and column value, 0 where there are none."""
    return df.groupBy(row).pivot(column, list(values)).count().na.fill(0, list(values))
