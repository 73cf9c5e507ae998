"""Map algebra: columns over bands. NULL is the only missing value and goes through everything."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.functions.ranks import percentiles

EPS = 1e-10
C = F.col


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b; NULL where b is 0 or either is missing."""
    return F.try_divide(a, b)


def norm_diff(a: Column, b: Column) -> Column:
    """(a - b) / (a + b) held to [-1, 1]; NULL, not -1, where it isn't defined."""
    r = F.try_divide(a - b, a + b)
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def _bsi() -> Column:
    total = C("B11") + C("B04") + C("B08") + C("B02")
    return F.when(total != 0, F.try_divide(C("B11") + C("B04") - C("B08") - C("B02"), total + EPS))


#: index: (bands it needs, how it is built)
S2_INDICES: Mapping[str, tuple[Sequence[str], object]] = {
    "NDVI": (("B08", "B04"), lambda: norm_diff(C("B08"), C("B04"))),
    "NDWI": (("B03", "B08"), lambda: norm_diff(C("B03"), C("B08"))),
    "Clay_Index": (("B11", "B12"), lambda: safe_ratio(C("B11"), C("B12"))),
    "Ferrous_Iron": (("B08", "B11"), lambda: safe_ratio(C("B08"), C("B11"))),
    "Ferric_Iron": (("B04", "B02"), lambda: safe_ratio(C("B04"), C("B02"))),
    "Iron_Oxide": (("B04", "B03"), lambda: safe_ratio(C("B04"), C("B03"))),
    "Propylitic_Proxy": (("B05", "B11"), lambda: safe_ratio(C("B05"), C("B11"))),
    "Hydroxyl_Bearing": (("B11", "B8A"), lambda: safe_ratio(C("B11"), C("B8A"))),
    "Fe_Oxide_Composite": (("B02", "B03", "B04"), lambda: F.try_divide(C("B04"), C("B03") + EPS) * F.try_divide(C("B04"), C("B02") + EPS)),
    "BSI": (("B02", "B04", "B08", "B11"), _bsi),
}
ASTER_INDICES: Mapping[str, tuple[Sequence[str], object]] = {
    "Alunite": (("B05", "B07"), lambda: safe_ratio(C("B05"), C("B07"))),
    "Kaolinite": (("B04", "B06"), lambda: safe_ratio(C("B04"), C("B06"))),
    "Propylitic_ASTER": (("B06", "B09"), lambda: safe_ratio(C("B06"), C("B09"))),
    "Carbonate": (("B06", "B08"), lambda: safe_ratio(C("B06"), C("B08"))),
    "Potassic": (("B07", "B06"), lambda: safe_ratio(C("B07"), C("B06"))),
    "Fe_Oxide_ASTER": (("B02", "B01"), lambda: safe_ratio(C("B02"), C("B01"))),
    "Silica_TIR": (("B11", "B10"), lambda: safe_ratio(C("B11"), C("B10"))),
    "Calc_Silicate": (("B10", "B11", "B12", "B13", "B14"), lambda: F.try_divide(C("B12") + C("B13"), C("B10") + C("B14") + EPS)),
    "Gossan_ASTER": (("B02", "B03"), lambda: safe_ratio(C("B02"), C("B03"))),
}


def indices(df: DataFrame, table: Mapping[str, tuple[Sequence[str], object]], keep: Sequence[str] = ("row_id", "col_id")) -> DataFrame:
    """All indices of a table whose bands df has, in one projection."""
    return df.select(*keep, *[build().alias(name) for name, (bands, build) in table.items() if set(bands) <= set(df.columns)])


def reflectance(band: Column, scale: float = 10_000.0) -> Column:
    """Counts to reflectance in [0, 1]; 0 and missing are NULL."""
    return F.when(band != 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), band / F.lit(scale))))


def elevation(dem: Column) -> Column:
    return F.nullif(dem, F.lit(0.0))


def radar_ratio(vv: Column, vh: Column) -> Column:
    """vv / vh, NULL where it would be 0."""
    return F.nullif(F.when(vh != 0, vv / (vh + EPS)), F.lit(0.0))


#: Means and standard deviations by which the encoder's bands are standardised (fixed values).
BAND_STATS = {"B02": (1087.0, 2248.0), "B03": (1342.0, 2179.0), "B04": (1433.0, 2178.0), "B8A": (2734.0, 1850.0), "B11": (1958.0, 1242.0), "B12": (1363.0, 1049.0)}


def standardised(band: Column, mean: float, std: float) -> Column:
    """Reflectance as the encoder expects it; missing is 0 there."""
    return F.coalesce((band * 10_000.0 - mean) / (std + 1e-8), F.lit(0.0))


def valid(band: Column) -> Column:
    return band.isNotNull() & (band != 0)


def all_valid(bands: Sequence[str]) -> Column:
    out = F.lit(True)
    for b in bands:
        out = out & F.col(b).isNotNull()
    return out


def stretched(df: DataFrame, bands: Sequence[str], low: float = 0.02, high: float = 0.98) -> DataFrame:
    """Bands stretched to [0, 1] between two percentiles of their valid cells; missing cells stay missing."""

    def one(b: str) -> Column:
        lo, hi = percentiles(df, b, (low, high))
        if lo is None:
            return F.lit(None).cast("double")
        share = (F.col(b) - F.lit(lo)) / F.lit(max(hi - lo, 1e-6))
        return F.when(F.col(b).isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))

    return df.withColumns({b: one(b) for b in bands})


def encoded(df: DataFrame, column: str, legend: DataFrame) -> DataFrame:
    """Codes by a legend (codigo, categoria); -1 for categories that it lacks and for missing ones."""
    return df.join(legend.withColumnRenamed("categoria", column), column, "left").withColumn("codigo", F.coalesce("codigo", F.lit(-1)))


def legend_of(df: DataFrame, column: str) -> DataFrame:
    """Codes 1 to n by sorted distinct category, and -1 for no data; missing categories are a category."""
    names = df.select(F.trim(F.coalesce(F.col(column), F.lit("DESCONHECIDO"))).alias("categoria")).distinct()
    coded = names.select(F.row_number().over(Window.orderBy("categoria")).alias("codigo"), "categoria")
    return coded.unionByName(df.sparkSession.createDataFrame([(-1, "sem_dados")], "codigo int, categoria string"))


def patch_id_parts(patch_id: Column) -> tuple[Column, Column, Column]:
    """Stem, row and column of `<stem>_r<row>_c<col>`."""
    pattern = r"^(.*)_r(\d+)_c(\d+)$"
    return F.regexp_extract(patch_id, pattern, 1), F.regexp_extract(patch_id, pattern, 2).cast("int"), F.regexp_extract(patch_id, pattern, 3).cast("int")


def target_id(kind: Column, rank: Column) -> Column:
    """Three letters and the rank in three digits, or more if it needs them."""
    return F.when(kind.isNotNull() & rank.isNotNull(), F.format_string("%s-%03d", F.upper(F.substring(kind, 1, 3)), rank))


def chunk_key(name: Column) -> Column:
    """The layer of a chunk file's name, what stands before the first `_-`."""
    return F.substring_index(name, "_-", 1)
