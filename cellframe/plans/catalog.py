"""The engine's registered queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cellframe.plans import rasters, scores, vectors

_PARTS = (rasters, vectors, scores)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores.flagship_targets(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for part in _PARTS for k, f in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for part in _PARTS for k, s in part.ORACLES.items()}
