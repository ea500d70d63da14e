"""What leaves the tasks that cast rays, and how frames are dealt to them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from framewright.functions.geometry import Camera, Terrain
from framewright.operators import coverage, footprints, tiled_terrain
from framewright.operators.tiled_terrain import Raster

CAMERA = Camera(1000.0, 1000.0, 960.0, 540.0, 1920, 1080)
ROWS, COLS, CELL = 120, 150, 5.0


def ground() -> Terrain:
    r, c = np.mgrid[:ROWS, :COLS]
    return Terrain((20 + 8 * np.sin(c / 9) + 6 * np.cos(r / 13)).astype("float32"), 1000.0, 5000.0, CELL)


def raster(spark, size: int) -> Raster:
    t = ground()
    heights = spark.createDataFrame([(i, j, float(t.z[i, j])) for i in range(ROWS) for j in range(COLS)], "row long, col long, z double")
    return Raster(tiled_terrain.tiles_of(heights, size), ROWS, COLS, t.origin_e, t.origin_n, t.cell, size, 3)


def frames(spark, n: int):
    """Most hover over one spot; some are far away or have no position."""
    rng = np.random.default_rng(3)
    rows = [(f"f{k % 3}", k, None if k % 50 == 7 else 1e6 if k % 50 == 9 else 1300 + 3 * float(rng.uniform()), 4700 + float(rng.uniform()), 120.0, 0.0, float(rng.uniform(-1.57, -0.9)), float(rng.uniform(-3, 3))) for k in range(n)]
    return spark.createDataFrame(rows, "flight string, frame long, easting double, northing double, altamsl double, roll_rad double, pitch_rad double, yaw_rad double")


def test_groups_over_a_tile_are_bounded_and_hold_every_frame_once(spark, monkeypatch):
    """Before, each tile within reach sent its hits, over 50 KB a frame, through a shuffle."""
    monkeypatch.setattr(tiled_terrain, "GROUP_FRAMES", 10)

    def sizes(found, batch):
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays([batch.column("frame"), pa.array([n] * n, pa.int64()), pa.array([0 if found is None else found.terrain.z.size] * n, pa.int64())], ["frame", "n", "heights"])

    seen = tiled_terrain.by_ground(frames(spark, 300), raster(spark, 32), sizes, "frame long, n long, heights long").collect()
    assert sorted(r.frame for r in seen) == list(range(300)) and max(r.n for r in seen) < 40
    # reach (800 m) covers all of this raster; frames without ground get none
    assert {r.heights for r in seen if r.frame % 50 not in (7, 9)} == {ROWS * COLS} and {r.heights for r in seen if r.frame % 50 in (7, 9)} == {0}
    plan = footprints.footprints(frames(spark, 30), CAMERA, raster(spark, 32), 5.0, grid=(4, 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


@pytest.mark.parametrize("held", [50, 10_000])
def test_views_counted_by_flight_equal_those_of_long_cells(spark, monkeypatch, held):
    monkeypatch.setattr(footprints, "MOST_HELD", held)
    monkeypatch.setattr(footprints, "RAYS_AT_ONCE", 500)
    seen = frames(spark, 200)
    chosen, origins = seen.where("frame % 3 <> 1"), coverage.ground_grid(seen, 5.0, 100.0)
    want = coverage.view_counts(chosen, footprints.long_cells(footprints.footprints(seen, CAMERA, ground(), 5.0, 100.0, grid=(12, 8))))
    want = sorted(map(tuple, want.select("flight", "cx", "cy", "views").collect()))
    assert len(want) > 100 and max(r[3] for r in want) > 10
    for terrain in (ground(), raster(spark, 32)):
        got = footprints.view_counts(chosen, origins, CAMERA, terrain, 5.0, grid=(12, 8))
        assert sorted(map(tuple, got.select("flight", "cx", "cy", "views").collect())) == want
    assert footprints.view_counts(chosen.where(F.lit(False)), origins, CAMERA, ground(), 5.0, grid=(12, 8)).count() == 0


def test_the_query_shuffles_no_cells(spark):
    """Before, all cells of all footprints were written and those of the selection shuffled by flight and cell."""
    import __spark_entry__ as entry

    plan = entry.queries()["footprint_views"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "cells" not in plan
