"""Composites over scenes as they arrive: an extension beside the batch operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.operators.composite import dry_and_clear


def windowed_mean(obs: DataFrame, bands: Sequence[str], size: str = "30 days", late: str = "10 days", max_cloud: float = 20.0) -> DataFrame:
    """Mean and count of valid values by cell and event-time window, of clear dry-season scenes.

    obs may be a stream; its ts is cast, as watermarks need a time zone. Rows later than the watermark are dropped by
    the engine's rule for late data, and a window's state goes when the watermark passes it.
    """
    rows = dry_and_clear(obs, max_cloud).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    value = lambda b: F.when(F.col(b) > 0, F.col(b))
    agg = rows.groupBy(F.window("ts", size), "row_id", "col_id").agg(*[F.avg(value(b)).alias(b) for b in bands], F.count("*").alias("scenes"))
    return agg.select(F.col("window.start").alias("start"), "row_id", "col_id", *bands, "scenes")
