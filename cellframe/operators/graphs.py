"""Connected components of graphs given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.sources.scratch import written


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of edges (a, b); comp is the smallest node that can be reached.

    Contraction: each node hooks onto its smallest neighbour, chains are cut short, and the edges between different
    hooks go on. Each round at least halves what is left; nothing is gathered in one place.
    """
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    maps = []
    while edges.limit(1).count():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("to")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            hooks = written(hooks.join(up, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "hooks")
            if not hooks.where("moved").limit(1).count():
                break
        hooks = hooks.select("node", "to")
        maps.append(hooks)
        ends = edges.join(hooks.toDF("a", "x"), "a").join(hooks.toDF("b", "y"), "b")
        edges = written(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = maps[0].toDF("node", "comp")
    for later in maps[1:]:
        out = out.join(later.toDF("comp", "next"), "comp", "left").select("node", F.coalesce("next", "comp").alias("comp"))
    return out
