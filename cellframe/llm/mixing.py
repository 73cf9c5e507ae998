"""Mixing sources to target weights.

Each document has a hash-random key; within its source, documents are taken in the order of keys until the words taken
reach the source's budget, over again for each further epoch. The order is cut into ranges of the key, so prefix sums
are those of ranges plus those within a range: a source that holds a third of all documents spreads over all ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.llm.base import hex_bucket, sf_table, word_count
from cellframe.sources.scratch import written

WEIGHTS = (1, 2, 3)
EPOCHS = 3
#: Hexadecimal digits of the key that name its range: 4096 ranges in each source.
DIGITS = 3


def order_key(*columns: str) -> Column:
    """The hash of doc_id and of further columns; nulls count as empty."""
    return F.md5(F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size (long), target (double), from rows of source and size; one row for each source.

    Sources in code-point order, null last, take the weights in turn. All words are shared by weight; no target
    exceeds epochs times its source, and what is above goes to the others by weight. A source is full if its ceiling for a
    unit of weight is below the level that remains when all sources with lower ceilings are full.
    """
    total = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.array(*[F.lit(int(w)) for w in weights])
    rows = total.withColumn("weight", F.element_at(given, (place % len(weights) + 1).cast("int"))).withColumn("ceiling", F.col("source_size") * epochs)
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("ceiling").over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = rows.withColumn("level", left.cast("double") / weight)
    level = level.withColumn("level", F.max("level").over(everything))
    return level.select("source", "source_size", F.least(F.col("ceiling").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def mixed_words(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, spread: Sequence[str] = ()) -> DataFrame:
    """doc_id, source, size with key, source_size, target, full (whole epochs), start, budget and taken.

    sizes needs doc_id, source, size; it is read several times, so pass a written table. start is the words of the
    source before the document in key order; budget is what the last, incomplete epoch takes. The document at the cut
    gives only the words up to it. Nulls: a null source is a source, the last one; a null doc_id has one fixed key; a
    null size is 0. Rows that repeat a doc_id count each. Documents without words are taken with none. spread names
    further columns that go into the key, so that rows of one very frequent doc_id (null, say) lie in many ranges.
    """
    sizes = sizes.select("doc_id", "source", F.coalesce(F.col("size"), F.lit(0)).cast("long").alias("size"), order_key("doc_id", *spread).alias("key"))
    sizes = sizes.withColumn("range", hex_bucket(F.col("key"), DIGITS))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("source", "range").agg(F.sum("size").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    goal = targets(sizes, weights, epochs)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = goal.withColumn("full", full).withColumn("budget", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("long"))
    plan = ranges.alias("r").join(goal.alias("g"), F.col("r.source").eqNullSafe(F.col("g.source"))).select("r.source", "r.range", "offset", "source_size", "target", "full", "budget")
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).alias("s")
    rows = rows.join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source")) & (F.col("s.range") == F.col("p.range")))
    rows = rows.select("s.doc_id", "s.source", "size", "key", "source_size", "target", "full", "budget", (F.col("offset") + F.col("within")).alias("start"))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("start")))
    return rows.withColumn("taken", (F.col("full") * F.col("size") + last).cast("long"))


def _sizes(docs: DataFrame, spread: Sequence[str] = ()) -> DataFrame:
    return written(docs.select("doc_id", "source", *spread, word_count(F.col("text")).alias("size")), "sizes")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, spread: Sequence[str] = ()) -> DataFrame:
    """The rows of docs that the mix takes, a row for each time; columns as before.

    A document at the cut is taken whole if its middle is within the budget. Only keys and sizes are sorted; texts are
    filtered where they lie, by their source's last key. Rows with equal keys, of doc_id and the columns in spread, are
    taken together.
    """
    words = mixed_words(_sizes(docs, spread), weights, epochs, spread)
    inside = (F.col("start") + F.col("size") / 2 <= F.col("budget")) & (F.col("budget") > 0)
    cut = words.groupBy("source").agg(F.first("full").alias("__full"), F.max(F.when(inside, F.col("key"))).alias("__cut")).withColumnRenamed("source", "__source")
    cut = written(cut, "cut")
    rows = docs.join(cut, F.col("source").eqNullSafe(F.col("__source")))
    times = (F.col("__full") + F.coalesce((order_key("doc_id", *spread) <= F.col("__cut")).cast("long"), F.lit(0))).cast("int")
    return rows.withColumn("__times", F.array_repeat(F.lit(1), times)).withColumn("__time", F.explode("__times")).select(*docs.columns)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = ("n_chars",)
    rows = mixed_words(_sizes(sf_table(spark, sf_dir, "documents"), spread), spread=spread)
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source", "start")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(CAST(n_chars AS VARCHAR), '')) AS k,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size FROM documents
), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (SELECT *, [1, 2, 3][place % 3 + 1] AS weight, 3 * source_size AS ceiling FROM s
), o AS (SELECT *, ceiling / weight AS ratio FROM w
), v AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(ceiling) OVER b, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS DOUBLE) AS lv
  FROM o WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (SELECT source, source_size, least(CAST(ceiling AS DOUBLE), (max(lv) OVER ()) * weight) AS target FROM v
), f AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS fl FROM t
), r AS (
  SELECT d.doc_id, d.size, d.source, CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d
)
SELECT r.doc_id, r.size, f.source_size, f.target, CAST(f.fl * r.size + greatest(0, least(r.size, CAST(round(f.target - f.fl * f.source_size) AS BIGINT) - r.start)) AS BIGINT) AS taken, r.source, r.start
FROM r JOIN f ON r.source IS NOT DISTINCT FROM f.source
"""
