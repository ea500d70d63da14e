"""Ground footprints of frames by ray casting, as Arrow batches of frames.

The camera and the terrain window travel with the function; clip the terrain to the
mission first (:func:`terrain_window`), so that its size is bounded by the area flown.  A terrain that is too
large for that comes as a table of tiles (:class:`tiled_terrain.Raster`) and is joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.functions.geometry import REACH_M, STEP_M, Camera, Ground, Terrain, frame_hits, hull_texts, outer_rays, rotations
from framewright.operators import coverage, tiled_terrain
from framewright.operators.tiled_terrain import Raster

#: Bytes of terrain that travel with a function.
MOST_TERRAIN = 256 << 20
#: Rays that are cast together: some arrays of so many numbers fit a core's cache.
RAYS_AT_ONCE = 32_768
#: Cells that are held before those of one flight are added up.
MOST_HELD = 500_000


@dataclass(frozen=True)
class Rays:
    """The rays of a camera's grid, those between which all others lie, and the numbers of those in its corners, around."""

    rays: np.ndarray
    outer: np.ndarray
    corners: list[int]


def terrain_window(terrain: Terrain, box: tuple[float, float, float, float], margin: float) -> Terrain:
    """The part of the terrain around (min_e, min_n, max_e, max_n)."""
    rows, cols = terrain.z.shape
    c0, c1 = (int(np.clip(round((e - terrain.origin_e) / terrain.cell), 0, cols)) for e in (box[0] - margin, box[2] + margin))
    r0, r1 = (int(np.clip(round((terrain.origin_n - n) / terrain.cell), 0, rows)) for n in (box[3] + margin, box[1] - margin))
    return Terrain(terrain.z[r0:r1, c0:c1], terrain.origin_e + c0 * terrain.cell, terrain.origin_n - r0 * terrain.cell, terrain.cell, terrain.nodata, terrain.datum)


def sample_terrain(points: DataFrame, terrain: Terrain | Raster) -> DataFrame:
    """The rows with ``ground_z`` (null outside the terrain)."""
    if isinstance(terrain, Raster):
        return tiled_terrain.sample(points, terrain)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z = terrain.sample(b["easting"].to_numpy(float), b["northing"].to_numpy(float))
            yield b.assign(ground_z=[None if np.isnan(x) else float(x) for x in z])

    return points.mapInPandas(run, points.schema.simpleString()[7:-1] + ",ground_z:double")


def mission_box(frames: DataFrame) -> DataFrame:
    """flight and the least and largest easting and northing."""
    return frames.groupBy("flight").agg(*(f(c).alias(f"{n}_{c}") for c in ("easting", "northing") for n, f in (("min", F.min), ("max", F.max))))


def with_agl(frames: DataFrame, terrain: Terrain | Raster) -> DataFrame:
    """``agl_m``: the altitude above the terrain under the frame, null outside it."""
    return sample_terrain(frames.drop("agl_m", "ground_z"), terrain).withColumn("agl_m", F.col("altamsl") - F.col("ground_z")).drop("ground_z")


def cell_ground(cells: DataFrame, terrain: Terrain | Raster) -> DataFrame:
    """flight, cx, cy and ``ground_z`` under the centres ``center_e``, ``center_n`` of cells, null outside the terrain."""
    at = cells.select("flight", "cx", "cy", F.col("center_e").alias("easting"), F.col("center_n").alias("northing"))
    return sample_terrain(at, terrain).select("flight", "cx", "cy", "ground_z")


def long_cells(footprints_: DataFrame) -> DataFrame:
    """flight, frame, cx, cy and footprint_valid: a row for each cell of a footprint."""
    return footprints_.select("flight", "frame", F.explode("cells").alias("c"), F.col("valid").alias("footprint_valid")).select("flight", "frame", "c.cx", "c.cy", "footprint_valid")


def with_footprints(frames: DataFrame, footprints_: DataFrame) -> DataFrame:
    """Frames with what is known of their footprints: footprint_valid (false if absent), footprint_valid_frac,
    footprint_area_m2, footprint_cell_count and footprint_polygon_wkt."""
    named = footprints_.select("flight", "frame", F.col("valid").alias("footprint_valid"), F.col("valid_frac").alias("footprint_valid_frac"), F.col("area_m2").alias("footprint_area_m2"), F.size("cells").cast("long").alias("footprint_cell_count"), F.col("hull_wkt").alias("footprint_polygon_wkt"))
    joined = frames.drop(*(c for c in named.columns if c.startswith("footprint_"))).join(named, ["flight", "frame"], "left")
    return joined.withColumn("footprint_valid", F.coalesce("footprint_valid", F.lit(False)))


def _outside(hits: np.ndarray, corners: list[int]) -> np.ndarray:
    """Which hits (of rays by frames) may be corners of a hull: all but those that lie clearly within the hits of the corner rays.
    Whatever is on the same side of each line from corner to corner lies between them."""
    x, y = hits[0], hits[1]
    edges = [(x[a], y[a], x[b] - x[a], y[b] - y[a]) for a, b in zip(corners, corners[1:] + corners[:1], strict=True)]
    turn = np.sign(edges[0][2] * edges[1][3] - edges[0][3] * edges[1][2])
    within = np.ones(x.shape, bool)
    for ex, ey, dx, dy in edges:
        within &= (y - ey) * (dx * turn) - (x - ex) * (dy * turn) > 0.05 * np.hypot(dx, dy)
    return ~within


def _measured(ground: Ground | None, pose: dict[str, np.ndarray], camera: Rays, cell_m: float, least_valid: float = 0.0, hulls: bool = True) -> dict[str, np.ndarray | list[str]]:
    """The columns of :func:`footprints` after flight and frame, for a few frames at once; without ground no ray hits.  ``cells`` as
    how many each frame has, and their cx and cy."""
    n, rays = len(pose["easting"]), camera.rays
    if ground is None:
        hits = np.full((3, len(rays), n), np.nan)
    else:
        turned = rotations(*(pose[c] for c in ("roll_rad", "pitch_rad", "yaw_rad")))
        hits = frame_hits(ground, np.array([pose[c] for c in ("easting", "northing", "altamsl")]), turned, rays, camera.outer)
    met = np.isfinite(hits[0])
    count, whole = met.sum(axis=0), met.all()
    share = count / len(rays)
    with np.errstate(invalid="ignore"):
        center = [(hits[i] if whole else np.where(met, hits[i], 0.0)).sum(axis=0) / count for i in (0, 1)]
    # cells around each frame's own by number: rays reach no further
    side = 2 * int(np.ceil((REACH_M + STEP_M) / cell_m)) + 3
    places = (("easting", "origin_e"), ("northing", "origin_n"))
    first = [np.floor(np.nan_to_num(pose[a] - pose[b]) / cell_m) - side // 2 for a, b in places]
    cx, cy = (np.floor((hits[i] - pose[b]) / cell_m) - first[i] for i, (_, b) in enumerate(places))
    number = (cx * side + cy) + np.arange(n) * float(side * side)
    number = (number.ravel() if whole else number[met]).astype(np.int64)
    if side * side <= 64 * len(rays):
        seen = np.zeros(n * side * side, bool)
        seen[number] = True
        number = np.flatnonzero(seen)
    else:
        number = np.unique(number)
    own, rest = np.divmod(number, side * side)
    n_cells = np.bincount(own, minlength=n)
    cells = [v + f.astype(np.int64)[own] for v, f in zip(np.divmod(rest, side), first, strict=True)]
    detail = np.where(share < least_valid, "too_few_rays", np.where(n_cells == 0, "no_cells", "ok"))
    found = {"valid": detail == "ok", "valid_frac": share, "area_m2": n_cells * float(cell_m) ** 2, "centroid_e": center[0], "centroid_n": center[1]}
    if hulls:
        with np.errstate(invalid="ignore"):
            edge = _outside(hits, camera.corners) & met
        found["hull_wkt"] = hull_texts(hits[0][edge], hits[1][edge], np.broadcast_to(np.arange(n), met.shape)[edge], n)
    return found | {"reject_detail": detail, "n_cells": n_cells, "cx": cells[0], "cy": cells[1]}


#: What rays depend on, and where cells are counted from.
NUMBERS = ["easting", "northing", "altamsl", "roll_rad", "pitch_rad", "yaw_rad", "origin_e", "origin_n"]


def _rays(camera: Camera, grid: tuple[int, int]) -> Rays:
    rays = camera.rays(camera.sample_grid(*grid))
    return Rays(rays, outer_rays(rays), [0, grid[1] - 1, len(rays) - 1, len(rays) - grid[1]])


def _few(batch: pa.RecordBatch, rays: Rays) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """The numbers of as many frames as are measured at once, from which row on and how many."""
    pose, most = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in NUMBERS}, max(1, RAYS_AT_ONCE // len(rays.rays))
    for k in range(0, max(1, batch.num_rows), most):
        yield k, most, {c: v[k : k + most] for c, v in pose.items()}


def _clipped(terrain: Terrain | Raster) -> Terrain | None:
    """The terrain if it travels with a function; a table can't."""
    if isinstance(terrain, Raster):
        return None
    if terrain.z.nbytes > MOST_TERRAIN:
        raise ValueError(f"clip the terrain to the mission: {terrain.z.nbytes} bytes go to every task, {MOST_TERRAIN} may")
    return terrain


def _read(frames: DataFrame, origins: DataFrame) -> DataFrame:
    return frames.drop("origin_e", "origin_n").join(origins, "flight").select("flight", "frame", *(F.col(c).cast("double").alias(c) for c in NUMBERS))


def footprints(frames: DataFrame, camera: Camera, terrain: Terrain | Raster, cell_m: float, margin_m: float = 500.0, grid: tuple[int, int] = (48, 27), least_valid: float = 0.25, shapes: bool = True, origins: DataFrame | None = None) -> DataFrame:
    """flight, frame, valid, valid_frac, area_m2, centroid, hull, reject_detail and ``cells``, counted from
    the origin of the flight's ground grid (:func:`coverage.ground_grid`, or ``origins``).  Without ``shapes`` no hull and no cells, by far the most bytes."""
    window, rays = _clipped(terrain), _rays(camera, grid)

    def measured(ground: Ground | None, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k, most, pose in _few(batch, rays):
            found = _measured(ground, pose, rays, cell_m, least_valid, shapes)
            cells = pa.StructArray.from_arrays([pa.array(found.pop(c)) for c in ("cx", "cy")], ["cx", "cy"])
            starts = pa.array(np.concatenate([[0], np.cumsum(found.pop("n_cells"))]), pa.int32())
            columns = {c: batch.column(c).slice(k, most) for c in ("flight", "frame")} | {c: pa.array(v, from_pandas=c.startswith("centroid")) for c, v in found.items()}
            yield pa.RecordBatch.from_pydict(columns | ({"cells": pa.ListArray.from_arrays(starts, cells)} if shapes else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ground = Ground(window)
        for b in batches:
            yield from measured(ground, b)

    kinds = ", ".join(f"{c} {frames.schema[c].dataType.simpleString()}" for c in ("flight", "frame")) + ", valid boolean, valid_frac double, area_m2 double, centroid_e double, centroid_n double"
    kinds += ", hull_wkt string, reject_detail string, cells array<struct<cx:bigint,cy:bigint>>" if shapes else ", reject_detail string"
    read = _read(frames, coverage.ground_grid(frames, cell_m, margin_m) if origins is None else origins)
    if window is None:
        return tiled_terrain.by_ground(read, terrain, measured, kinds)
    # frames are small rows with much work each: spread them whatever the partitions before
    n = 4 * frames.sparkSession.sparkContext.defaultParallelism
    return read.repartition(n, "flight", "frame").mapInArrow(run, kinds)


def _counted(rows: list[np.ndarray]) -> np.ndarray:
    """Rows of flight, cx, cy and views in order, views of equal cells added up."""
    found = np.concatenate(rows, axis=1)
    if not found.size:
        return found
    least = found[:3].min(axis=1)
    _, wide, high = (found[:3].max(axis=1) - least + 1).tolist()
    key = ((found[0] - least[0]) * wide + (found[1] - least[1])) * high + (found[2] - least[2])
    order = np.argsort(key)
    found, key = found[:, order], key[order]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return np.concatenate([found[:3, new], np.add.reduceat(found[3:], new, axis=1)])


def view_counts(selected: DataFrame, origins: DataFrame, camera: Camera, terrain: Terrain | Raster, cell_m: float, grid: tuple[int, int] = (48, 27)) -> DataFrame:
    """:func:`coverage.view_counts` of the cells that the selected frames see, counted from the flights' ``origins`` (flight, origin_e, origin_n).

    Cells are hundreds of times larger than frames, so those of a flight are counted in the task that casts its rays,
    and only the counts leave it.  With tiles, whose tasks hold ground and not flights, the cells are shuffled."""
    window, rays = _clipped(terrain), _rays(camera, grid)
    if window is None:
        cells = long_cells(footprints(selected, camera, terrain, cell_m, grid=grid, origins=origins))
        return cells.groupBy("flight", "cx", "cy").agg(F.count("*").alias("views"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ground, flights, rows, held = Ground(window), [], [np.zeros((4, 0), np.int64)], 0
        for b in batches:
            if not b.num_rows:
                continue
            known = b.column("flight").dictionary_encode()  # in order, so a flight may go on from the batch before
            names = known.dictionary.to_pylist()
            first = len(flights) - (names[0] in flights[-1:])
            flights[first:] = names
            which = first + known.indices.to_numpy().astype(np.int64)
            for k, most, pose in _few(b, rays):
                found = _measured(ground, pose, rays, cell_m, hulls=False)
                own = np.repeat(which[k : k + most], found["n_cells"])
                rows.append(np.stack([own, found["cx"], found["cy"], np.ones_like(own)]))
                held += len(own)
                last = k + most >= b.num_rows
                if held > MOST_HELD or last:
                    # the last flight may go on
                    rows = [_counted(rows)]
                    done = np.searchsorted(rows[0][0], which[min(k + most, b.num_rows) - 1])
                    yield _views(b, flights, rows[0][:, :done])
                    rows = [rows[0][:, done:]]
                    held = rows[0].shape[1]
            kept = b
        if flights:
            yield _views(kept, flights, _counted(rows))

    def _views(b: pa.RecordBatch, flights: list, rows: np.ndarray) -> pa.RecordBatch:
        names = pa.array(flights, b.schema.field("flight").type).take(pa.array(rows[0]))
        return pa.RecordBatch.from_arrays([names, *(pa.array(v) for v in rows[1:])], ["flight", "cx", "cy", "views"])

    n = 4 * selected.sparkSession.sparkContext.defaultParallelism
    kinds = f"flight {selected.schema['flight'].dataType.simpleString()}, cx long, cy long, views long"
    return _read(selected, origins).repartition(n, "flight").sortWithinPartitions("flight").mapInArrow(run, kinds)
