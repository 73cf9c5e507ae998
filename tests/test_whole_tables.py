"""Queries of whole tables: every row, line and cell takes part."""

import pytest
from pyspark.sql import functions as F

from cellframe.plans import catalog
from cellframe.sources.fixtures import view


@pytest.fixture(scope="module")
def grid(spark, sf):
    return {(r["row_id"], r["col_id"]): r for r in view(spark, sf, "grid").collect()}


@pytest.mark.parametrize("name", ["nearest_resample", "bilinear_resample"])
def test_resampling_reaches_the_last_rows(spark, sf, grid, name):
    height = max(r for r, _ in grid) + 1
    rows = catalog.queries()[name](spark, sf).collect()
    assert len(rows) == -(-2 * height // 3) * 33
    assert max(1.5 * r["row_id"] for r in rows if r["dem"] is not None) >= height - 3


def test_every_line_excludes(spark, sf):
    lines = [tuple(map(float, r)) for r in view(spark, sf, "fault_lines").select("x1", "y1", "x2", "y2").collect()]

    def d2(x, y, x1, y1, x2, y2):
        n = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / n)) if n else 0
        return (x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2

    points = view(spark, sf, "points").select("id", F.col("x").cast("double"), F.col("y").cast("double")).collect()
    want = {i for i, x, y in points if all(d2(x, y, *line) > 2.25 for line in lines)}
    assert {r["id"] for r in catalog.queries()["exclusion_anti"](spark, sf).collect()} == want


def test_every_cell_enters_the_surfaces(spark, sf, grid):
    top = {(r["row_id"], r["col_id"]): r["surface"] for r in catalog.queries()["block_max_surface"](spark, sf).collect()}
    assert all(top[k] is not None and top[k] >= r["v"] for k, r in grid.items() if r["v"] is not None)
    smooth = {(r["row_id"], r["col_id"]) for r in catalog.queries()["gaussian_surface"](spark, sf).collect()}
    assert set(grid) <= smooth
