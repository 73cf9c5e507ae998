"""From raw documents to sharded training text: five stages, each written as Parquet and read again.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the columns of documents; the last adds the
shard and the slot in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.llm.base import sf_table
from cellframe.llm.decontamination import decontaminated
from cellframe.llm.language_id import UNDETERMINED, language_id, learned
from cellframe.llm.mixing import mix
from cellframe.llm.ngram_join import ngram_jaccard_join
from cellframe.llm.sharding import sharded
from cellframe.sources.scratch import written

SHARDS = 16
#: Least share of a text's word features that the language model knows.
KNOWN_SHARE = 0.6


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those in no learned language, which their unknown features show.

    Documents in several learned languages stay. How many languages were learned doesn't matter.
    """
    known = language_id(docs, learned(docs)).where((F.col("lang_pred") != UNDETERMINED) & (F.col("known_share") >= KNOWN_SHARE))
    return known.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of the n-gram Jaccard join, the document of the smallest doc_id stays; rows without one stay."""
    leaders = ngram_jaccard_join(docs).where("doc_id = component_id").select("doc_id").distinct()
    one = docs.join(leaders, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    return decontaminated(docs, sf_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes sources to their target weights; a document taken again is a row again."""
    return mix(docs, spread=("n_chars",))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds shard (0 to 15) and slot."""
    return sharded(docs, [1.0] * SHARDS, spread=("source", "n_chars"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: SQL cannot express the trained language model or the SimHash search; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = sf_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
