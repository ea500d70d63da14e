"""Terrain as tiles, against one window of the same heights."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.functions.geometry import BLOCK, Camera, HeightBounds, Terrain, block_hits, first_hits, rotation
from framewright.operators import footprints, tiled_terrain
from framewright.operators.tiled_terrain import Raster
from framewright.sources import readers

CAMERA = Camera(1000.0, 1000.0, 960.0, 540.0, 1920, 1080)
RNG = np.random.default_rng(7)
ROWS, COLS, CELL = 230, 190, 5.0


def ground() -> Terrain:
    """Hills with a strip and a spot that are unknown, and one tower."""
    r, c = np.mgrid[:ROWS, :COLS]
    z = (20 + 8 * np.sin(c / 9) + 6 * np.cos(r / 13) + RNG.normal(0, 0.5, (ROWS, COLS))).astype("float32")
    z[100:103], z[40, 50], z[150:152, 90:92] = np.nan, np.nan, 95
    return Terrain(z, 1000.0, 5000.0, CELL, np.nan, 2.5)


def raster(spark, t: Terrain, size: int = 48, halo: int = 3) -> Raster:
    heights = spark.createDataFrame([(i, j, float(t.z[i, j])) for i in range(ROWS) for j in range(COLS) if np.isfinite(t.z[i, j])], "row long, col long, z double")
    return Raster(tiled_terrain.tiles_of(heights, size, halo), ROWS, COLS, t.origin_e, t.origin_n, t.cell, size, halo, t.datum)


def frames(spark, n: int):
    """Frames over the terrain, around it and, a few, below the ground; the last third hovers over one spot."""
    e, north = RNG.uniform(900, 2050, n), RNG.uniform(3750, 5100, n)
    e[-n // 3 :], north[-n // 3 :] = 1500 + RNG.uniform(0, 1, len(e[-n // 3 :])), 4300
    rows = [(k % 2, k, float(e[k]), float(north[k]), float(RNG.uniform(5, 25) if k % 11 == 0 else RNG.uniform(60, 160)), 0.05, float(RNG.uniform(-1.57, -0.4)), float(RNG.uniform(-3, 3))) for k in range(n)]
    return spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, altamsl double, roll_rad double, pitch_rad double, yaw_rad double")


def test_heights_equal_those_of_one_window(spark):
    t = ground()
    edge = [1000.0, 1000.0 + (COLS - 1) * CELL, 5000.0, 5000.0 - (ROWS - 1) * CELL]
    points = [*zip(RNG.uniform(900, 2050, 400).tolist(), RNG.uniform(3750, 5100, 400).tolist(), strict=True), *((e, n) for e in edge[:2] for n in edge[2:]), (edge[1], 4444.0), (1240.0, edge[3])]
    got = tiled_terrain.sample(spark.createDataFrame([*((k, *p) for k, p in enumerate(points)), (-1, None, 4500.0)], "k long, easting double, northing double"), raster(spark, t))
    assert got.columns == ["k", "easting", "northing", "ground_z"]
    got = {r.k: r.ground_z for r in got.collect()}
    want = t.sample(*np.array(points).T)
    assert got.pop(-1) is None and len(got) == len(points)
    for k, z in enumerate(want):
        assert got[k] is None if np.isnan(z) else abs(got[k] - z) < 1e-9


@pytest.mark.parametrize("size", [32, 300])
def test_footprints_equal_those_of_one_window(spark, monkeypatch, size):
    monkeypatch.setattr(tiled_terrain, "GROUP_FRAMES", 7)
    t, seen = ground(), frames(spark, 60)
    seen = spark.createDataFrame(seen.collect(), seen.schema)
    args = dict(cell_m=5.0, margin_m=100.0, grid=(12, 8))
    got, want = ({(r.flight, r.frame): r for r in footprints.footprints(seen, CAMERA, x, **args).collect()} for x in (raster(spark, t, size), t))
    assert got.keys() == want.keys() and sum(r.valid for r in want.values()) > 20 and sum(r.valid_frac == 0 for r in want.values()) > 3
    for k, w in want.items():
        g = got[k]
        assert (g.valid, g.valid_frac, g.reject_detail) == (w.valid, w.valid_frac, w.reject_detail)
        assert w.centroid_e is None or abs(g.centroid_e - w.centroid_e) < 1e-5
        assert {tuple(c) for c in g.cells} == {tuple(c) for c in w.cells}


def test_a_group_holds_a_bounded_number_of_frames(spark, monkeypatch):
    monkeypatch.setattr(tiled_terrain, "GROUP_FRAMES", 10)
    one = frames(spark, 1).drop("frame").crossJoin(spark.range(300).select(F.col("id").alias("frame")))
    rays = CAMERA.rays(CAMERA.sample_grid(4, 3))
    hits = tiled_terrain.ray_hits(one.withColumn("easting", F.lit(1500.0)).withColumn("northing", F.lit(4300.0)).withColumn("altamsl", F.lit(120.0)), raster(spark, ground()), rays)
    assert hits.select("frame").distinct().count() == 300


def test_height_bounds_hold_and_spare_most_lookups():
    t = ground()
    bounds = HeightBounds.of(t)
    e, n = RNG.uniform(t.origin_e, t.origin_e + (COLS - 1) * CELL, 5000), RNG.uniform(t.origin_n - (ROWS - 1) * CELL, t.origin_n, 5000)
    z, block = t.sample(e, n), bounds.block(e, n)
    known = np.isfinite(z)
    assert (z <= bounds.highest[block])[known].all() and (z >= bounds.lowest[block])[known].all() and bounds.highest.shape == (-(-ROWS // BLOCK), -(-COLS // BLOCK))

    looked = []

    class Counted(Terrain):
        def sample(self, e, n):
            looked.append(np.size(e))
            return super().sample(e, n)

    counted, spared = Counted(t.z, t.origin_e, t.origin_n, t.cell, t.nodata, t.datum), 0
    rays, everywhere = CAMERA.rays(CAMERA.sample_grid(48, 27)), lambda x, y: np.ones(np.shape(x), bool)
    for altitude, pitch in ((150, -1.5), (110, -0.9), (140, -0.5)):
        origin, world = np.array([1500.0, 4600.0, altitude]), rays @ rotation(0.0, pitch, 0.4).T
        want = first_hits(counted, np.repeat(origin[None], len(world), axis=0), world)
        rows, sampled = block_hits(bounds, origin, world, everywhere)
        assert np.allclose(tiled_terrain.nearest_hits([rows.tobytes()], len(world)), want, atol=1e-9, equal_nan=True)
        spared += sampled
    print(f"heights looked up: {sum(looked)} by steps, {spared} with bounds")
    assert spared * 2 < sum(looked)


def test_narrow_halos_and_empty_tables(spark):
    t = ground()
    with pytest.raises(ValueError, match="halo"):
        tiled_terrain.ray_hits(frames(spark, 1), raster(spark, t, halo=1), CAMERA.rays(CAMERA.sample_grid(2, 2)))
    none = spark.createDataFrame([], "row long, col long, z double")
    flat = Raster(tiled_terrain.tiles_of(none), 0, 0, 0.0, 0.0, 5.0, 256, 3)
    got = footprints.footprints(frames(spark, 3), CAMERA, flat, 5.0, grid=(4, 3)).collect()
    assert [r.reject_detail for r in got] == ["too_few_rays"] * 3
    assert footprints.footprints(frames(spark, 3).limit(0), CAMERA, raster(spark, t), 5.0, grid=(4, 3)).count() == 0


def test_tiles_of_a_file(spark, tmp_path, monkeypatch):
    t = ground()
    z = np.where(np.isnan(t.z), -9999, t.z).astype("float32")
    np.save(tmp_path / "dtm.npy", z)
    (tmp_path / "dtm.json").write_text(json.dumps({"origin_e": t.origin_e, "origin_n": t.origin_n, "cell": CELL}))
    box, path = (1300.0, 4300.0, 1500.0, 4500.0), str(tmp_path / "dtm")
    assert isinstance(readers.terrain_around(spark, path, box), Terrain)
    monkeypatch.setattr(readers, "MOST_TERRAIN", 1000)
    found = readers.terrain_around(spark, path, box, 50.0, 2.5)
    assert isinstance(found, Raster) and found.halo == 3 and found.tiles.count() == 1
    points = spark.createDataFrame([(k, float(1300 + 3.3 * k), float(4500 - 3.1 * k)) for k in range(60)], "k long, easting double, northing double")
    tiles = readers.read_tiles(spark, path, (0.0, 0.0, 9e6, 9e6), 0.0, 2.5, 32)
    assert tiles.tiles.count() == 8 * 6
    for one in (found, tiles):
        for r in tiled_terrain.sample(points, one).collect():
            assert abs(r.ground_z - t.sample(np.array([r.easting]), np.array([r.northing]))[0]) < 1e-9 if r.ground_z is not None else np.isnan(t.sample(np.array([r.easting]), np.array([r.northing]))[0])
