"""Sources and sinks: layers, vectors, label sets, reports, versions and models' metadata."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODATA = -9999.0
#: Cells of a row block, the unit of pruning.
ROW_BLOCK = 512


@dataclass(frozen=True)
class Config:
    """What a run needs to know; the values are the production ones."""

    crs: str = "EPSG:32719"
    resolution: float = 30.0
    nodata: float = NODATA
    dry_months: tuple[int, int] = (3, 10)
    max_cloud: float = 20.0
    max_scenes: int = 100
    coverage: float = 0.995
    patch_size: int = 224
    stride: int = 32
    fault_radius: float = 15_000.0
    exclusion_radius: float = 10_000.0
    block_size: float = 30_000.0
    min_overlap: float = 0.10
    negative_ratio: float = 5.0
    percentile: float = 0.997
    min_prob: float = 0.5
    n_top: int = 50
    focal_windows: tuple[int, ...] = (5, 15)
    n_positive: int = 8000
    folds: int = 5
    seed: int = 42
    model_scale: float = 1.0
    label_sets: Mapping[str, tuple[int, float]] = field(default_factory=lambda: {"nucleo": (1, 1.0), "interpretado": (1, 0.6), "negativo": (0, 1.0)})

    @classmethod
    def of(cls, values: Mapping[str, Any]) -> Config:
        """From a tree of settings, such as a parsed file; unknown names are an error."""
        if unknown := set(values) - set(cls.__dataclass_fields__):
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**values)


def clean(df: DataFrame, bands: Sequence[str], nodata: float = NODATA, zero: bool = False) -> DataFrame:
    """NaN, infinity, the nodata value and, if asked, zero become NULL; the one place where missing values enter."""

    def one(c: str) -> Column:
        x = F.col(c).cast("double")
        bad = F.isnan(x) | (F.abs(x) == float("inf")) | (x == F.lit(float(nodata)))
        return F.when(~(bad | (x == 0.0) if zero else bad), x)

    return df.withColumns({c: one(c) for c in bands})


def write_layer(df: DataFrame, path: str, layer: str, mode: str = "errorifexists") -> None:
    """A raster layer as Parquet below path, partitioned by blocks of rows so that windowed reads prune files."""
    out = df.withColumn("row_block", F.floor(F.col("row_id") / ROW_BLOCK).cast("int"))
    out.repartition("row_block").sortWithinPartitions("row_id", "col_id").write.mode(mode).partitionBy("row_block").parquet(f"{path}/layer={layer}")


def read_layer(spark: SparkSession, path: str, layer: str, bands: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{path}/layer={layer}")
    return df.select("row_id", "col_id", "row_block", *(bands or [c for c in df.columns if c not in ("row_id", "col_id", "row_block")]))


def window(df: DataFrame, row: int, col: int, height: int, width: int) -> DataFrame:
    """Cells of a window; the block predicate prunes partitions of a written layer."""
    if "row_block" in df.columns:
        df = df.where(F.col("row_block").between(row // ROW_BLOCK, (row + height - 1) // ROW_BLOCK))
    return df.where(F.col("row_id").between(row, row + height - 1) & F.col("col_id").between(col, col + width - 1))


def virtual_mosaic(spark: SparkSession, paths: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """A catalog of layers, each a view over many files."""
    return {layer: spark.read.parquet(*files) for layer, files in paths.items()}


def band_names(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Bands by name, never by place; missing bands are zero columns, as the encoder expects."""
    return df.select("row_id", "col_id", *[F.col(b) if b in df.columns else F.lit(0.0).alias(b) for b in wanted])


def band_stack(layers: Sequence[DataFrame]) -> DataFrame:
    """Layers on one grid side by side, by cell; cells that only some have are NULL in the others."""
    out = layers[0]
    for df in layers[1:]:
        out = out.join(df, ["row_id", "col_id"], "full")
    return out


#: Spectral band names and their names in the scene catalog (fixed values).
ASSETS = {"B02": "blue", "B03": "green", "B04": "red", "B05": "rededge1", "B06": "rededge2", "B07": "rededge3", "B08": "nir", "B8A": "nir08", "B11": "swir16", "B12": "swir22"}


def rename_assets(df: DataFrame, to_catalog: bool = False) -> DataFrame:
    names = ASSETS if to_catalog else {v: k for k, v in ASSETS.items()}
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


#: Deposit codes that count as porphyry, and buffers by type in metres (fixed values).
PORPHYRY_CODES, DEFAULT_BUFFER = ("4b", "4c"), 500.0


def occurrences(df: DataFrame, code: str, buffers: Mapping[str, float] | None = None) -> DataFrame:
    """Occurrence points with a type by code and a buffer by type."""
    kind = F.when(F.lower(F.trim(F.col(code))).isin(*PORPHYRY_CODES), "porfiro").otherwise("outro")
    radius = F.lit(DEFAULT_BUFFER)
    for name, value in (buffers or {}).items():
        radius = F.when(F.col("deposit_type") == name, float(value)).otherwise(radius)
    return df.withColumn("deposit_type", kind).withColumn("buffer_m", radius)


def sample_union(frames: Sequence[tuple[str, DataFrame]], deposit_type: str) -> DataFrame:
    """Samples of several sources stacked, with their source's name and one type."""
    out = None
    for name, df in frames:
        df = df.withColumns({"source_name": F.lit(name), "deposit_type": F.lit(deposit_type)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no sample source")
    return out


def label_sets(zones: DataFrame, sets: Mapping[str, tuple[int, float]]) -> DataFrame:
    """Zones of the given sets with their label and weight."""
    known = zones.where(F.col("zone").isin(*sets))
    label, weight = F.lit(None).cast("int"), F.lit(None).cast("double")
    for name, (y, w) in sets.items():
        label, weight = F.when(F.col("zone") == name, y).otherwise(label), F.when(F.col("zone") == name, float(w)).otherwise(weight)
    return known.withColumns({"label": label.cast("int"), "weight": weight})


def hole_report(df: DataFrame, tile: str, value: str) -> DataFrame:
    """Cells, holes and percentage of holes of each tile, and of all (tile NULL)."""
    hole = F.col(value).isNull().cast("long")
    return df.rollup(tile).agg(F.count("*").alias("cells"), F.sum(hole).alias("holes"), F.round(100 * F.avg(hole.cast("double")), 6).alias("pct"))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def as_geojson(x0: str, y0: str, x1: str, y1: str) -> Column:
    """A box as the text of a GeoJSON polygon."""
    p = lambda x, y: F.concat(F.lit("["), F.col(x).cast("string"), F.lit(","), F.col(y).cast("string"), F.lit("]"))
    ring = F.concat_ws(",", p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))
    return F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))


def html_map(targets: DataFrame, limit: int = 500) -> str:
    """A page with a marker for each of the best targets (at most limit: a report)."""
    colours = ("#d7191c", "#2c7bb6", "#1a9641", "#fdae61")
    rows = targets.orderBy("rank").limit(limit).collect()
    kinds = sorted({r["deposit_type"] for r in rows})
    dots = "".join(f'<circle cx="{r["x"]:.1f}" cy="{-r["y"]:.1f}" r="3" fill="{colours[kinds.index(r["deposit_type"]) % 4]}"><title>{r["target_id"]} {r["score"]}</title></circle>' for r in rows)
    return f"<!DOCTYPE html><html><body><svg>{dots}</svg></body></html>"


_VERSION = re.compile(r"v(\d+)$")


def write_version(df: DataFrame, root: str) -> str:
    """A new version below root; what is being read is never overwritten."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [m for s in (fs.listStatus(path) if fs.exists(path) else []) if (m := _VERSION.search(s.getPath().getName()))]
    out = f"{root}/v{max((int(m[1]) for m in old), default=0) + 1}"
    df.write.mode("errorifexists").parquet(out)
    return out


def retried(call: Callable[[], Any], tries: int = 5, wait: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """call(), again after failures with waits that double; the last failure is raised. For catalogs outside Spark."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(wait * 2**k)


def paged(fetch: Callable[[int], Sequence[Any]], most: int = 100) -> list[Any]:
    """Items of a paged catalog, fetch(page) from 0 on, up to most; an empty page ends it."""
    out: list[Any] = []
    page = 0
    while len(out) < most and (items := retried(lambda: fetch(page))):
        out += items
        page += 1
    return out[:most]


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output is complete."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def save_metadata(spark: SparkSession, path: str, **values: Any) -> None:
    """Model metadata (feature order, categories, settings) as a JSON table beside the model."""
    values = {k: asdict(v) if hasattr(v, "__dataclass_fields__") else v for k, v in values.items()}
    spark.createDataFrame([(json.dumps(values, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_metadata(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(path).first()[0])
