"""Viewing angles: rotations, optical axes and how far apart the views of a cell are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wrap_angle(x: Column) -> Column:
    """Into [-pi, pi)."""
    return F.pmod(x + F.pi(), 2 * F.pi()) - F.pi()


def rotation_deg(r: tuple[Column, Column, Column], s: tuple[Column, Column, Column]) -> Column:
    """Norm of the wrapped differences of roll, pitch and yaw, in degrees; missing angles are 0."""
    d = [wrap_angle(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))) for a, b in zip(r, s, strict=True)]
    return F.degrees(F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2]))


def optical_axis(pitch: Column, yaw: Column) -> tuple[Column, Column, Column]:
    nadir = F.pi() / 2 + pitch
    return F.sin(yaw) * F.sin(nadir), F.cos(yaw) * F.sin(nadir), -F.cos(nadir)


def angle_deg(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Between unit vectors; null if one is unknown."""
    dot = a[0] * b[0] + a[1] * b[1] + a[2] * b[2]
    return F.when(dot.isNotNull(), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))))


def with_axis(frames: DataFrame) -> DataFrame:
    x, y, z = optical_axis(F.col("pitch_rad"), F.col("yaw_rad"))
    return frames.withColumns({"ax": x, "ay": y, "az": z})


def ground_or_viewer(views: DataFrame, ground: DataFrame | None = None) -> DataFrame:
    """Viewed cells with ``ground_z``: that of ``ground`` (flight, cx, cy, ground_z), and where it is unknown the altitude of
    the first frame that sees the cell; without ``ground``, the median altitude of the flight's viewers."""
    cell = Window.partitionBy("flight", "cx", "cy")
    viewer = F.min_by("altamsl", "frame").over(cell)
    if ground is None:
        height = views.select("flight", "frame", "altamsl").distinct().groupBy("flight").agg(F.median("altamsl").alias("ground_z"))
        return views.join(height, "flight")
    known = views.join(ground.select("flight", "cx", "cy", F.nanvl("ground_z", F.lit(None)).alias("_z")), ["flight", "cx", "cy"], "left")
    return known.withColumn("ground_z", F.coalesce("_z", viewer)).drop("_z")


def cell_directions(views: DataFrame, cell_e: float, cell_n: float) -> DataFrame:
    """Unit vectors from the centre of each viewed cell to the camera; views have flight, frame,
    cx, cy, easting, northing, altamsl, ground_z (:func:`ground_or_viewer`)."""
    de = F.col("easting") - (F.col("cx") + 0.5) * cell_e
    dn = F.col("northing") - (F.col("cy") + 0.5) * cell_n
    d = views.select("flight", "frame", "cx", "cy", de.alias("x"), dn.alias("y"), (F.col("altamsl") - F.col("ground_z")).alias("z")).withColumn("norm", F.sqrt(F.expr("x * x + y * y + z * z")))
    unit = lambda c: F.when(F.col("norm") > 0, F.col(c) / F.col("norm")).otherwise(F.lit(0.0)).alias(c)
    return d.select("flight", "frame", "cx", "cy", unit("x"), unit("y"), unit("z"))


def convergence_by_cell(directions: DataFrame, most: int = 256) -> DataFrame:
    """flight, cx, cy, views and the largest angle between two views (0 with one view).

    Cells of up to ``most`` views are an equi-join on the cell, each pair once.  Of fuller ones (hovering)
    the views are cut in tiles, and every pair of tiles is one matrix product in a task."""
    key = ["flight", "cx", "cy"]
    views = directions.groupBy(*key).agg(F.count("*").alias("views"))
    full = views.where(F.col("views") > most).select(*key, F.ceil(F.col("views") / most).cast("int").alias("tiles"))
    few = directions.join(full, key, "left_anti")
    other = few.select(*key, F.col("frame").alias("frame2"), F.col("x").alias("x2"), F.col("y").alias("y2"), F.col("z").alias("z2"))
    least = few.join(other, key).where("frame < frame2").groupBy(*key).agg(F.min(F.expr("x * x2 + y * y2 + z * z2")).alias("dot"))
    own = F.pmod(F.xxhash64("frame"), F.col("tiles")).cast("int").alias("own")
    tiled = directions.join(full, key).select(*key, "frame", "x", "y", "z", own, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    tiled = tiled.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})

    def product(rows):
        import numpy as np
        import pandas as pd

        d = rows[["x", "y", "z"]].to_numpy()
        return pd.DataFrame({k: rows[k].iloc[:1] for k in key} | {"dot": [np.min(d @ d.T + 2 * np.eye(len(d)))]}) if len(d) > 1 else pd.DataFrame(columns=[*key, "dot"])

    kinds = ", ".join(f"{k} {directions.schema[k].dataType.simpleString()}" for k in key)
    hot = tiled.groupBy(*key, "low", "high").applyInPandas(product, f"{kinds}, dot double").groupBy(*key).agg(F.min("dot").alias("dot"))
    angle = F.when(F.col("dot").isNotNull(), F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("dot"))))))
    return views.join(least.union(hot), key, "left").select(*key, "views", F.coalesce(angle, F.lit(0.0)).alias("angle"))


def parallax_metrics(cells: DataFrame, min_views: int = 3, min_deg: float = 10.0) -> DataFrame:
    """Per flight: covered cells, those with enough views and angle, and quantiles over cells with two views."""
    good = (F.col("views") >= min_views) & (F.col("angle") >= min_deg)
    low = (F.col("views") >= min_views) & (F.col("angle") < min_deg)
    seen = F.when(F.col("views") >= 2, F.col("angle"))
    q = lambda p: F.percentile(seen, F.lit(p))
    share = (F.count_if(good) / F.count("*")).alias("satisfied_share")
    return cells.groupBy("flight").agg(F.count("*").alias("n_covered"), F.count_if(good).alias("n_satisfied"), share, F.count_if(low).alias("n_low"), q(0.1).alias("p10"), q(0.5).alias("p50"), q(0.9).alias("p90"))


def axes_of_rotations(shots: DataFrame) -> DataFrame:
    """``ax``, ``ay``, ``az``: the optical axis of shots with an axis-angle rotation rx, ry, rz from the world to the
    camera, that is the third row of its matrix (Rodrigues)."""
    angle = F.sqrt(F.expr("rx * rx + ry * ry + rz * rz"))
    unit = lambda c: F.when(F.col("_angle") > 0, F.col(c) / F.col("_angle")).otherwise(F.lit(0.0))
    k = shots.withColumn("_angle", angle).withColumns({"_x": unit("rx"), "_y": unit("ry"), "_z": unit("rz")})
    c, s = F.cos("_angle"), F.sin("_angle")
    axis = {"ax": F.col("_z") * F.col("_x") * (1 - c) - F.col("_y") * s, "ay": F.col("_z") * F.col("_y") * (1 - c) + F.col("_x") * s, "az": c + F.col("_z") * F.col("_z") * (1 - c)}
    return k.withColumns(axis).drop("_angle", "_x", "_y", "_z")
