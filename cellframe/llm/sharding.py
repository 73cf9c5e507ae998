"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Each record has a score for each shard, from a hash of its key and the shard's number and from the shard's weight; the
highest score wins. A further shard only takes the records for which its own score is the highest, and moves no other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellframe.llm.base import sf_table

#: Slots are numbered within parts of a shard, by hash of the key, so that no task sorts a whole shard.
PARTS = 1024


def _score(key: Column, shard: int, weight: float) -> Column:
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return F.lit(-float(weight)) / F.ln(uniform)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key; shards are the places in weights. Null keys are one key, the empty text."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    return F.array_max(F.array(*[F.struct(_score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]))["shard"]


def part_of(key: Column, spread: Sequence[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit("")), F.lit("part"), *spread), F.lit(parts)).cast("int")


def sharded(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", parts: int = PARTS, spread: Sequence[str] = ()) -> DataFrame:
    """docs with `shard` (int) and `slot` (long, 0, 1, 2, ... within the shard).

    Key and weights alone decide on the shard, so rows that repeat a key share it; null keys share one. Slots follow
    the hash of the key and of the columns in spread, then these; rows that repeat a key get different slots. spread
    names columns, cheap to read, by which rows of one very frequent key (null, say) go to different parts. Counts by
    shard and part need key and spread only; parts times shards, a fixed number, bounds the table of offsets. Columns
    of docs that clash with the new ones are replaced. An empty table gives an empty result.
    """
    part = part_of(F.col(key), spread, parts)
    keys = docs.select(rendezvous(F.col(key), weights).alias("shard"), part.alias("__part"))
    counts = keys.groupBy("shard", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    rows = docs.drop("shard", "slot").withColumns({"shard": rendezvous(F.col(key), weights), "__part": part})
    within = Window.partitionBy("shard", "__part").orderBy(key, *spread)
    rows = rows.withColumn("__row", F.row_number().over(within)).join(F.broadcast(offsets), ["shard", "__part"])
    return rows.withColumn("slot", (F.col("__offset") + F.col("__row") - 1).cast("long")).select(*docs.drop("shard", "slot").columns, "shard", "slot")


def op8_sharding(spark: SparkSession, sf_dir: str, shards: int = 16) -> DataFrame:
    """Every document in shards 0 to 15 of equal weight, by the law of keys."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = sf_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = sharded(docs, [1.0] * shards, spread=("source", "n_chars"))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", rendezvous(F.col("doc_id"), [1.0] * (shards + 1)).alias("grown_shard"))
