"""Exact order statistics of a whole column, without bringing its values together."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a pass, and values of one bin that may be read at the end.
BINS, SMALL = 4096, 50_000


def order_statistics(df: DataFrame, value: str, ranks: Sequence[int], small: int = SMALL) -> dict[int, float]:
    """The values at these ranks (from 0) among the column's sorted valid values.

    Each pass counts values in equal bins and goes on in the bins that hold a rank, until these are small or constant.
    A pass narrows the range 4096 times, so passes are few; the driver sees bin counts and, in the end, `small` values
    of a bin at most.
    """
    x = F.col(value).cast("double")
    rows = df.select(x.alias("x")).where("x IS NOT NULL")
    out: dict[int, float] = {}

    def seek(part: DataFrame, below: int, wanted: list[int]) -> None:
        stats = part.agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        n, lo, hi = stats["n"], stats["lo"], stats["hi"]
        if n == 0:
            return
        if lo == hi:
            out.update(dict.fromkeys(wanted, lo))
            return
        if n <= small:
            values = sorted(r[0] for r in part.collect())
            out.update({k: values[k - below] for k in wanted})
            return
        # The bounds are values, so the first and last bin always hold one, and each pass gets smaller.
        b = F.least(F.lit(BINS - 1), F.floor((F.col("x") - F.lit(lo)) / F.lit((hi - lo) / BINS))).cast("int")
        counts = sorted((r["b"], r["count"]) for r in part.groupBy(b.alias("b")).count().collect())
        at = below
        for i, c in counts:
            if mine := [k for k in wanted if at <= k < at + c]:
                seek(part.where(b == i), at, mine)
            at += c

    seek(rows, 0, sorted(set(ranks)))
    return out


def percentiles(df: DataFrame, value: str, shares: Sequence[float], small: int = SMALL) -> list[float | None]:
    """Percentiles with linear interpolation between neighbours; None for a column without values."""
    n = df.agg(F.count(value)).first()[0]
    if n == 0:
        return [None] * len(shares)
    places = [(n - 1) * p for p in shares]
    ranks = {k for h in places for k in (math.floor(h), math.ceil(h))}
    at = order_statistics(df, value, sorted(ranks), small)
    return [at[math.floor(h)] + (at[math.ceil(h)] - at[math.floor(h)]) * (h - math.floor(h)) for h in places]
