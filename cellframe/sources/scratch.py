"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, in local mode only, a folder that goes when the process ends."""
    if root := spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return root
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if "root" not in _OWN:
        _OWN["root"] = tempfile.mkdtemp(prefix="cellframe-")
        atexit.register(shutil.rmtree, _OWN["root"], ignore_errors=True)
    return _OWN["root"]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
