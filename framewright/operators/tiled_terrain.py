"""Terrain as a table of tiles, for rasters of any size: heights under points, and ground footprints.

A tile has ``size`` rows and columns of its own and ``halo`` more on each side, so what begins in a tile is
judged with that tile alone.  Points meet their tile in a join.  For footprints, frames go in groups of at most about
``GROUP_FRAMES`` by the tile under them, and the tiles within reach go to each group (:func:`by_ground`).  :func:`ray_hits` gives
the hits themselves: there frames meet each tile, steps that can't meet the ground by the lowest and highest heights of its
blocks are left out, and the first hit of each ray over all tiles is the frame's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.functions.geometry import REACH_M, STEP_M, Ground, HeightBounds, Terrain, block_hits, rotation

#: Frames that meet a tile in one group.
GROUP_FRAMES = 500
#: The tile of frames that no tile is within reach of.
FAR = -(1 << 40)


@dataclass(frozen=True)
class Raster:
    """``tiles``: tr, tc and ``z``, the heights of a tile row by row, NaN where unknown.  The grid is that of
    :class:`Terrain`, with ``rows`` and ``cols`` heights."""

    tiles: DataFrame
    rows: int
    cols: int
    origin_e: float
    origin_n: float
    cell: float
    size: int
    halo: int
    datum: float = 0.0

    @property
    def width(self) -> int:
        return self.size + 2 * self.halo

    def terrain(self, tr: int, tc: int, z: np.ndarray) -> Terrain:
        """A tile as terrain, without what lies outside the raster."""
        r0, c0 = tr * self.size - self.halo, tc * self.size - self.halo
        up, left = max(0, -r0), max(0, -c0)
        part = z.reshape(self.width, self.width)[up : self.rows - r0, left : self.cols - c0]
        return Terrain(part, self.origin_e + (c0 + left) * self.cell, self.origin_n - (r0 + up) * self.cell, self.cell, np.nan, self.datum)

    def around(self, tiles: pa.Table) -> Terrain:
        """Several tiles (own_tr, own_tc, z) as one terrain; what lies between them is unknown."""
        at = [tiles[c].to_numpy() for c in ("own_tr", "own_tc")]
        first, last = ([f(x) for x in at] for f in (np.min, np.max))
        r0, c0 = (int(k) * self.size for k in first)
        r1, c1 = (min((int(k) + 1) * self.size, n) for k, n in zip(last, (self.rows, self.cols), strict=True))
        z = np.full((max(r1 - r0, 0), max(c1 - c0, 0)), np.nan, np.float32)
        parts = tiles["z"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, self.width, self.width)
        for tr, tc, part in zip(*at, parts, strict=True):
            own = z[tr * self.size - r0 : (tr + 1) * self.size - r0, tc * self.size - c0 : (tc + 1) * self.size - c0]
            own[:] = part[self.halo :, self.halo :][: own.shape[0], : own.shape[1]]
        return Terrain(z, self.origin_e + c0 * self.cell, self.origin_n - r0 * self.cell, self.cell, np.nan, self.datum)


def tiles_of(heights: DataFrame, size: int = 256, halo: int = 3) -> DataFrame:
    """The tiles of a table of heights (row, col, z).  Absent and null heights are unknown; of several at one
    place the lowest counts."""
    width = size + 2 * halo
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / size), F.floor((F.col(c) + halo) / size)))
    spread = heights.select("row", "col", F.col("z").cast("float").alias("z")).where("z IS NOT NULL")
    spread = spread.select("*", near("row").alias("tr")).select("*", near("col").alias("tc")).where("tr >= 0 AND tc >= 0")
    place = ((F.col("row") - F.col("tr") * size + halo) * width + F.col("col") - F.col("tc") * size + halo).cast("int")
    found = spread.select("tr", "tc", place.alias("at"), "z").groupBy("tr", "tc", "at").agg(F.min("z").alias("z"))

    def dense(t: pa.Table) -> pa.Table:
        z = np.full(width * width, np.nan, np.float32)
        z[t["at"].to_numpy()] = t["z"].to_numpy()
        return pa.table({"tr": t["tr"][:1], "tc": t["tc"][:1], "z": pa.array([z], pa.list_(pa.float32()))})

    return found.groupBy("tr", "tc").applyInArrow(dense, "tr long, tc long, z array<float>")


def sample(points: DataFrame, raster: Raster) -> DataFrame:
    """The rows with ``ground_z`` (null outside the raster and next to unknown heights): each meets its tile, and
    the four heights around it are read from there in compiled code."""
    c, r = (F.col("easting").cast("double") - raster.origin_e) / raster.cell, (F.lit(raster.origin_n) - F.col("northing").cast("double")) / raster.cell
    inside = (c >= 0) & (r >= 0) & (c <= raster.cols - 1) & (r <= raster.rows - 1)
    corner = lambda x, n: F.greatest(F.least(F.floor(x), F.lit(n - 2)), F.lit(0))
    at = points.drop("ground_z").withColumns({"_c": F.when(inside, c), "_r": F.when(inside, r)}).withColumns({"_c0": corner(F.col("_c"), raster.cols), "_r0": corner(F.col("_r"), raster.rows)})
    # outside points get no key: corner() alone would give them tile 0
    at = at.withColumns({"_tr": F.when(F.col("_r").isNotNull(), F.floor(F.col("_r0") / raster.size)), "_tc": F.when(F.col("_c").isNotNull(), F.floor(F.col("_c0") / raster.size))})
    tiles = raster.tiles.select(F.col("tr").alias("_tr"), F.col("tc").alias("_tc"), F.col("z").alias("_z"))
    first = ((F.col("_r0") - F.col("_tr") * raster.size + raster.halo) * raster.width + F.col("_c0") - F.col("_tc") * raster.size + raster.halo).cast("int")
    z = [F.get("_z", first + k).cast("double") for k in (0, 1, raster.width, raster.width + 1)]
    fc, fr = F.col("_c") - F.col("_c0"), F.col("_r") - F.col("_r0")
    value = (z[0] * (1 - fc) + z[1] * fc) * (1 - fr) + (z[2] * (1 - fc) + z[3] * fc) * fr + raster.datum
    return at.join(tiles, ["_tr", "_tc"], "left").withColumn("ground_z", F.when(~F.isnan(value), value)).drop("_c", "_r", "_c0", "_r0", "_tr", "_tc", "_z")


def by_ground(frames: DataFrame, raster: Raster, measured: Callable, kinds: str, step: float = STEP_M, reach: float = REACH_M) -> DataFrame:
    """What ``measured(ground, frames)`` yields for groups of frames over one tile, with that tile and those within reach of
    it as one ground; None as ground for frames that no tile is within reach of.

    The tiles go to the frames, so that hits, which are many times larger, stay in their task."""
    key, side = ["tr", "tc", "part"], raster.size * raster.cell
    span, out = int(np.ceil((reach + step + raster.cell) / side)), F.lit(FAR)
    down, right = F.lit(raster.origin_n) - F.col("northing"), F.col("easting") - raster.origin_e
    known = reduce(Column.__and__, (F.col(c).isNotNull() for c in ("easting", "northing", "altamsl", "roll_rad", "pitch_rad", "yaw_rad")))
    near = known & reduce(Column.__and__, ((x >= -reach) & (x <= (n - 1) * raster.cell + reach) for x, n in ((down, raster.rows), (right, raster.cols))))
    over = frames.withColumns({c: F.when(near, F.floor(x / side)).otherwise(out) for c, x in (("tr", down), ("tc", right))})
    parts = over.groupBy("tr", "tc").agg(F.ceil(F.count("*") / GROUP_FRAMES).alias("parts"))
    pieces = over.join(parts, ["tr", "tc"]).withColumn("part", F.pmod(F.xxhash64("flight", "frame"), "parts")).drop("parts")
    around = lambda c: F.explode(F.sequence(F.col(c) - span, F.col(c) + span)).alias(f"own_{c}")
    # columns of new identity, as both sides of the cogroup come from the same frames
    needed = parts.where(F.col("tr") != out).select(F.col("tr").alias("tr"), F.col("tc").alias("tc"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    needed = needed.select("*", around("tr")).select("*", around("tc"))
    tiles = needed.join(raster.tiles.select(F.col("tr").alias("own_tr"), F.col("tc").alias("own_tc"), "z"), ["own_tr", "own_tc"])
    about = (raster.rows, raster.cols, raster.origin_e, raster.origin_n, raster.cell, raster.size, raster.halo, raster.datum)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ground = Ground(Raster(None, *about).around(right)) if right.num_rows else None
        batches = left.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], left.schema)]
        return pa.Table.from_batches(x for b in batches for x in measured(ground, b))

    # small rows with much work each: as many tasks whatever their bytes
    n_tasks = 4 * frames.sparkSession.sparkContext.defaultParallelism
    pieces, tiles = pieces.repartition(n_tasks, *key), tiles.repartition(n_tasks, *key)
    return pieces.groupBy(*key).cogroup(tiles.groupBy(*key)).applyInArrow(run, kinds)


def ray_hits(frames: DataFrame, raster: Raster, rays: np.ndarray, step: float = 10.0, reach: float = 800.0) -> DataFrame:
    """flight, frame, ``hits`` and ``sampled`` for each tile in which a frame has hits: rows of ray, way along it, easting,
    northing and height in 64 bits, and the heights that were looked up.  A frame below the ground has a row of ray -1."""
    if raster.halo * raster.cell < step + raster.cell:
        raise ValueError(f"a halo of {raster.halo} heights is less than a step of {step} m and one height")
    key, side = ["tr", "tc", "part"], raster.size * raster.cell
    low = lambda x: F.greatest(F.floor((x - reach) / side), F.lit(0))
    span = lambda x, n: F.when(x + reach >= 0, F.sequence(low(x), F.least(F.floor((x + reach) / side), F.lit((n - 1) // raster.size)), F.lit(1).cast("long")))
    e, n = F.col("easting") - raster.origin_e, F.lit(raster.origin_n) - F.col("northing")
    known = frames.select("flight", "frame", *(F.col(c).cast("double").alias(c) for c in ("easting", "northing", "altamsl", "roll_rad", "pitch_rad", "yaw_rad"))).dropna()
    known = known.where((low(e) * raster.size < raster.cols) & (low(n) * raster.size < raster.rows))
    near = known.select("*", F.explode(span(n, raster.rows)).alias("tr")).select("*", F.explode(span(e, raster.cols)).alias("tc"))
    parts = near.groupBy("tr", "tc").agg(F.ceil(F.count("*") / GROUP_FRAMES).alias("parts"))
    pieces = near.join(parts, ["tr", "tc"]).withColumn("part", F.pmod(F.xxhash64("flight", "frame"), "parts")).drop("parts")
    tiles = raster.tiles.join(parts, ["tr", "tc"]).select("tr", "tc", "z", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    about = (raster.rows, raster.cols, raster.origin_e, raster.origin_n, raster.cell, raster.size, raster.halo, raster.datum)
    kinds = {c: frames.schema[c].dataType.simpleString() for c in ("flight", "frame")}

    def march(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"flight": [], "frame": [], "hits": [], "sampled": []}
        if left.num_rows and right.num_rows:
            tr, tc = right["tr"][0].as_py(), right["tc"][0].as_py()
            own = Raster(None, *about)
            ground = HeightBounds.of(own.terrain(tr, tc, right["z"].combine_chunks().flatten().to_numpy(zero_copy_only=False)))
            for row in left.to_pylist():
                world = rays @ rotation(row["roll_rad"], row["pitch_rad"], row["yaw_rad"]).T
                at = np.array([row["easting"], row["northing"], row["altamsl"]])
                mine = lambda x, y: (np.floor((x - own.origin_e) / own.cell) // own.size == tc) & (np.floor((own.origin_n - y) / own.cell) // own.size == tr)
                hits, sampled = block_hits(ground, at, world, mine, step, reach)
                if sampled:
                    for c, v in zip(out, (row["flight"], row["frame"], hits.tobytes(), sampled), strict=True):
                        out[c].append(v)
        return pa.table({"flight": pa.array(out["flight"], left.schema.field("flight").type), "frame": pa.array(out["frame"], left.schema.field("frame").type), "hits": pa.array(out["hits"], pa.binary()), "sampled": pa.array(out["sampled"], pa.int64())})

    # small rows with much work each: as many tasks whatever their bytes
    n_tasks = 4 * frames.sparkSession.sparkContext.defaultParallelism
    pieces, tiles = pieces.repartition(n_tasks, *key), tiles.repartition(n_tasks, *key)
    return pieces.groupBy(*key).cogroup(tiles.groupBy(*key)).applyInArrow(march, f"flight {kinds['flight']}, frame {kinds['frame']}, hits binary, sampled long")


def nearest_hits(parts: list[bytes] | None, n_rays: int) -> np.ndarray:
    """Each ray's first hit over all tiles, NaN rows for rays without one; no hits for a frame below the ground."""
    hits = np.full((n_rays, 3), np.nan)
    rows = np.concatenate([np.zeros((0, 5)), *(np.frombuffer(b).reshape(-1, 5) for b in (parts if parts is not None else []))])
    if (rows[:, 0] < 0).any():
        return hits
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    ray, first = np.unique(rows[:, 0].astype(np.int64), return_index=True)
    hits[ray] = rows[first, 2:]
    return hits
