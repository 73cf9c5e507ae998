"""Raster, vector and patch views derived from the generic tables, as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "obs": ("lineitem", """select l_suppkey as scene_id, l_shipdate as ts, l_linenumber*5 as cloud, cast(l_partkey%40 as int) as row_id, cast(l_orderkey%40 as int) as col_id,
 nullif(l_quantity*60,0) as B02, nullif(l_discount*50000,0) as B03, nullif(l_tax*60000,0) as B04, nullif(l_quantity*l_discount*900,0) as B05,
 nullif(l_extendedprice/20,0) as B08, nullif(l_quantity*l_tax*1100,0) as B8A, nullif(l_quantity*90,0) as B11, nullif(l_discount*l_tax*400000,0) as B12 from lineitem"""),
    "grid": ("events", """select cast(floor(event_id/50) as int) as row_id, cast(event_id%50 as int) as col_id, case when event_type='error' then null else value end as v, event_type as category,
 case when event_id%7=0 then null else value*10 end as dem, ts from events"""),
    "zones": ("nation", """select n_nationkey as feature_id, case n_regionkey when 0 then 'nucleo' when 1 then 'interpretado' when 2 then 'negativo' else 'none' end as zone,
 cast((n_nationkey%5)*10+0.25 as double) as x0, cast(floor(n_nationkey/5)*4+0.25 as double) as y0, cast((n_nationkey%5)*10+8.75 as double) as x1, cast(floor(n_nationkey/5)*4+3.75 as double) as y1 from nation"""),
    "points": ("customer", """select c_custkey as id, cast((c_custkey*37)%500 as double)/10 as x, cast((c_custkey*91)%200 as double)/10 as y, c_mktsegment as kind from customer"""),
    "fault_lines": ("supplier", """select s_suppkey as feature_id, cast((s_suppkey*13)%50 as double) as x1, cast((s_suppkey*7)%20 as double) as y1, cast((s_suppkey*29+5)%50 as double) as x2, cast((s_suppkey*11+3)%20 as double) as y2 from supplier"""),
    "patches": ("embeddings", """select concat('s2_composite_t',cast(label as string),'_r',cast(cast(floor(vec_id/25) as int) as string),'_c',cast(vec_id%25 as string)) as patch_id, 300000+(vec_id%25)*6720+3360.0e0 as center_x, 5800000+floor(vec_id/25)*6720+3360.0e0 as center_y, embedding, label, vec_id from embeddings"""),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, sql = VIEWS[name]
    return spark.sql(sql.replace(f"from {table}", "from {t}"), t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def with_views(sql: str, *names: str) -> str:
    """DuckDB SQL with the named views before it; sql may begin with further `name AS (...)` parts after a comma."""
    parts = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in names)
    return f"WITH {parts}{sql}" if sql.lstrip().startswith(",") else f"WITH {parts}\n{sql}"
