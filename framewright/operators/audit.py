"""Reports over a selection: gaps, ranks, nearest keyframes, densities and exact quantiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from framewright.storage import materialize

#: Comparisons of spots that two squares may cost before they are quartered.
MOST_COMPARED = 65_536


def by_frame() -> WindowSpec:
    return Window.partitionBy("flight").orderBy("frame")


def selection_gaps(selected: DataFrame) -> DataFrame:
    """flight, frame, gap_frames and gap_m to the selected frame before; the first has none."""
    lag = lambda c: F.col(c) - F.lag(c).over(by_frame())
    gaps = selected.select("flight", "frame", lag("frame").alias("gap_frames"), F.hypot(lag("easting"), lag("northing")).alias("gap_m"))
    return gaps.where("gap_frames IS NOT NULL")


def worst_gap(gaps: DataFrame, by: str = "gap_m") -> DataFrame:
    """The first longest gap of each flight (in metres, or by ``gap_frames``), if any is over 0."""
    rank = F.row_number().over(Window.partitionBy("flight").orderBy(F.col(by).desc(), "frame"))
    return gaps.where(F.col(by) > 0).withColumn("rn", rank).where("rn = 1").drop("rn")


def bin_rank(binned: DataFrame) -> DataFrame:
    """Rank by quality in the audit cell, best first; null without a quality."""
    w = Window.partitionBy("flight", "cell_x", "cell_y").orderBy(F.col("quality_score").desc_nulls_last(), "frame")
    return binned.withColumn("bin_rank", F.when(F.col("quality_score").isNotNull(), F.row_number().over(w).cast("long")))


def radius_pairs(points: DataFrame, radius: float) -> DataFrame:
    """Ordered pairs (flight, frame, other, d2) of different frames at most ``radius`` apart: an
    equi-join on square buckets and their neighbours instead of a join of all pairs."""
    p = points.select("flight", "frame", "easting", "northing", F.floor(F.col("easting") / radius).alias("bx"), F.floor(F.col("northing") / radius).alias("by"))
    near = F.explode(F.array(*(F.struct((F.col("bx") + i).alias("bx"), (F.col("by") + j).alias("by")) for i in (-1, 0, 1) for j in (-1, 0, 1))))
    q = p.select("flight", F.col("frame").alias("other"), F.col("easting").alias("e2"), F.col("northing").alias("n2"), near.alias("b")).select("flight", "other", "e2", "n2", "b.bx", "b.by")
    d2 = (F.col("easting") - F.col("e2")) * (F.col("easting") - F.col("e2")) + (F.col("northing") - F.col("n2")) * (F.col("northing") - F.col("n2"))
    return p.join(q, ["flight", "bx", "by"]).where("frame <> other").select("flight", "frame", "other", d2.alias("d2")).where(F.col("d2") <= radius * radius)


def _boxes(spots: DataFrame, radius: float, level: int) -> DataFrame:
    """The squares of ``radius`` / 2**level that hold spots: flight, x, y, how many frames and spots, and their extents."""
    at = lambda c: F.floor(F.col(c) / radius * 2**level).cast("long")
    extents = [f(c).alias(f"{c[0]}{k}") for c in ("easting", "northing") for k, f in enumerate((F.min, F.max))]
    return spots.groupBy("flight", at("easting").alias("x"), at("northing").alias("y")).agg(F.sum("w").alias("n"), F.count("*").alias("spots"), *extents)


def _side(boxes: DataFrame, name: str, more: tuple[str, ...] = ()) -> DataFrame:
    return boxes.select("flight", *(F.col(c).alias(f"{c}_{name}") for c in (*more, "x", "y", "n", "spots", "e0", "e1", "n0", "n1")))


def _judged(pairs: DataFrame, radius: float, most: int) -> DataFrame:
    """Pairs of boxes, ordered, that are not wholly apart, with ``way``: inside (all of b lies within the radius of all of a),
    spots (few enough to compare) or split.  The distances of boxes are worked out like those of
    points, and rounding keeps order, so no point is judged otherwise than by itself."""
    far, near = F.lit(0.0), F.lit(0.0)
    for c in ("e", "n"):
        up, down = F.col(f"{c}1_a") - F.col(f"{c}0_b"), F.col(f"{c}1_b") - F.col(f"{c}0_a")
        most_apart, least_apart = F.greatest(up, down), F.greatest(-up, -down, F.lit(0.0))
        far, near = far + most_apart * most_apart, near + least_apart * least_apart
    r2 = radius * radius
    way = F.when(far <= r2, "inside").when(F.col("spots_a") * F.col("spots_b") <= most, "spots").otherwise("split")
    return pairs.where(near <= r2).withColumn("way", way)


def neighbour_counts(points: DataFrame, radius: float, most: int = MOST_COMPARED) -> DataFrame:
    """flight, frame and how many other frames are within the radius, zeros and frames without a position included.

    Frames of one spot count as one with a weight.  Spots lie in squares as wide as the radius; a square wholly
    within the radius of another one gives it its count as a whole, and only spots of squares that may be on the edge are
    compared, where both hold few (``most`` comparisons).  Of fuller ones the quarters are judged in the same way, until none is left."""
    spots = points.where("easting IS NOT NULL AND northing IS NOT NULL").groupBy("flight", "easting", "northing").agg(F.count("*").alias("w"))
    spots = materialize(spots, "spots")
    boxes = _boxes(spots, radius, 0)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("d")
    near = _side(boxes, "a").select("*", around).withColumns({"x_b": F.col("x_a") + F.col("d.i"), "y_b": F.col("y_a") + F.col("d.j")}).drop("d")
    pairs, level, found = near.join(_side(boxes, "b"), ["flight", "x_b", "y_b"]), 0, []
    while True:
        judged = materialize(_judged(pairs, radius, most), "judged")
        whole = judged.where("way = 'inside'").groupBy("flight", F.col("x_a").alias("x"), F.col("y_a").alias("y")).agg(F.sum("n_b").alias("n"))
        at = {c: F.floor(F.col(f"{d}ing") / radius * 2**level).cast("long") for c, d in (("x", "east"), ("y", "north"))}
        placed = spots.withColumns(at)
        a = placed.select("flight", "easting", "northing", F.col("x").alias("x_a"), F.col("y").alias("y_a"))
        b = placed.select("flight", F.col("easting").alias("e2"), F.col("northing").alias("n2"), "w", F.col("x").alias("x_b"), F.col("y").alias("y_b"))
        de, dn = F.col("easting") - F.col("e2"), F.col("northing") - F.col("n2")
        edge = judged.where("way = 'spots'").select("flight", "x_a", "y_a", "x_b", "y_b").join(a, ["flight", "x_a", "y_a"]).join(b, ["flight", "x_b", "y_b"])
        compared = edge.where(de * de + dn * dn <= radius * radius).groupBy("flight", "easting", "northing").agg(F.sum("w").alias("n"))
        found += [placed.join(whole, ["flight", "x", "y"]).select("flight", "easting", "northing", "n"), compared]
        split = judged.where("way = 'split'").select("flight", "x_a", "y_a", "x_b", "y_b")
        if split.isEmpty():
            break
        level += 1
        boxes = _boxes(spots, radius, level).withColumns({"px": F.shiftright("x", 1), "py": F.shiftright("y", 1)})
        inner = split.select("flight", F.explode(F.array(F.struct("x_a", "y_a"), F.struct(F.col("x_b").alias("x_a"), F.col("y_b").alias("y_a")))).alias("p")).select("flight", F.col("p.x_a").alias("px"), F.col("p.y_a").alias("py")).distinct()
        boxes = materialize(boxes.join(inner, ["flight", "px", "py"], "left_semi"), "boxes")
        child = lambda k: _side(boxes, k, ("px", "py"))  # noqa: B023, E731
        over = split.select("flight", *(F.col(f"{c}_{k}").alias(f"p{c}_{k}") for k in "ab" for c in "xy"))
        pairs = over.join(child("a"), ["flight", "px_a", "py_a"]).join(child("b"), ["flight", "px_b", "py_b"]).drop("px_a", "py_a", "px_b", "py_b")
    counts = reduce(DataFrame.unionAll, found).groupBy("flight", "easting", "northing").agg((F.sum("n") - 1).alias("n"))
    return points.select("flight", "frame", "easting", "northing").join(counts, ["flight", "easting", "northing"], "left").select("flight", "frame", F.coalesce("n", F.lit(0)).alias("n"))


def local_density(points: DataFrame, radius: float, members: int = 10) -> DataFrame:
    """The fullest ball of each flight (its centre counts): the first frame that has it, how many it holds and its
    first ``members``, in frame order."""
    rank = F.row_number().over(Window.partitionBy("flight").orderBy(F.col("n").desc(), "frame"))
    best = neighbour_counts(points, radius).withColumn("rn", rank).where("rn = 1").select("flight", "frame", (F.col("n") + 1).alias("population"))
    best = materialize(best, "fullest")
    centre = points.join(best.select("flight", "frame"), ["flight", "frame"], "left_semi").select("flight", F.col("frame").alias("centre"), F.col("easting").alias("e2"), F.col("northing").alias("n2"))
    de, dn = F.col("easting") - F.col("e2"), F.col("northing") - F.col("n2")
    inside = points.join(centre, "flight").where((F.col("frame") == F.col("centre")) | (de * de + dn * dn <= radius * radius))  # one centre a flight
    order = F.row_number().over(Window.partitionBy("flight").orderBy("frame"))
    listed = inside.select("flight", "frame").withColumn("rn", order).where(F.col("rn") <= members).groupBy("flight").agg(F.array_sort(F.collect_list("frame")).alias("members"))
    return best.join(listed, "flight")


def matcher_neighbours(points: DataFrame, radius: float) -> DataFrame:
    """Median of the neighbour counts of a flight, cut to an integer, 1 at least; 0 for a lone frame."""
    m = F.greatest(F.floor(F.percentile("n", F.lit(0.5))), F.lit(1)).cast("long")
    return neighbour_counts(points, radius).groupBy("flight").agg(F.when(F.count("*") < 2, 0).otherwise(m).cast("long").alias("neighbours"))


def nearest_selected(frames: DataFrame) -> DataFrame:
    """Distance of each frame to the nearest selected one, null if there is none; for selected frames distances of 0 don't count.

    One plan without rounds, over grids of doubling squares from a flight's width divided by its selected positions up to
    its width.  A frame's level is the first at which its square and the eight around it hold a position that counts, so one
    lies within 2.9 squares, and the nearest one in or around the frame's square two levels further up.

    Joins of frames and squares are merged: Spark takes a table for as large as its file or as before its rows were
    multiplied, and would gather all of it on the driver to broadcast it."""
    frames = materialize(frames.select("flight", "frame", "easting", "northing", "selected"), "frames")
    at = frames.where("easting IS NOT NULL AND northing IS NOT NULL")
    chosen = at.where("selected").select("flight", F.col("easting").alias("e2"), F.col("northing").alias("n2")).distinct()
    wide = F.greatest(F.max("easting") - F.min("easting"), F.max("northing") - F.min("northing"))
    grids = at.groupBy("flight").agg(wide.alias("width")).join(chosen.groupBy("flight").agg(F.count("*").alias("spots")), "flight")
    grids = grids.select("flight", "spots", F.when(F.col("width") > 0, F.col("width") / F.col("spots")).otherwise(1.0).alias("least"), (F.ceil(F.log2("spots")) + 1).cast("int").alias("top"))

    def square(c: str) -> Column:
        return F.floor(F.col(c) / F.col("least") / F.pow(F.lit(2.0), F.col("level"))).cast("long")

    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)))).alias("d")
    levels = F.explode(F.sequence(F.lit(0), F.col("top"))).alias("level")
    spread = chosen.join(grids.hint("merge"), "flight").select("flight", "e2", "n2", "least", levels).select("*", around)
    spread = spread.select("flight", "level", (square("e2") + F.col("d.i")).alias("x"), (square("n2") + F.col("d.j")).alias("y"), "e2", "n2")
    full = spread.groupBy("flight", "level", "x", "y").agg(F.count("*").alias("n"))
    able = at.join(grids.hint("merge"), "flight").where("spots > 1 OR NOT selected")
    looking = able.select("flight", "frame", "easting", "northing", "selected", "least", "top", levels)
    looking = looking.withColumns({"x": square("easting"), "y": square("northing")}).join(full.hint("merge"), ["flight", "level", "x", "y"]).where(F.col("n") > F.col("selected").cast("int"))
    found = looking.groupBy("flight", "frame", "easting", "northing", "selected").agg(F.min("level").alias("level"), F.first("least").alias("least"), F.first("top").alias("top"))
    found = found.withColumn("level", F.least(F.col("level") + 2, F.col("top"))).withColumns({"x": square("easting"), "y": square("northing")})
    d = F.hypot(F.col("easting") - F.col("e2"), F.col("northing") - F.col("n2"))
    near = found.join(spread.hint("merge"), ["flight", "level", "x", "y"]).withColumn("d", d).where("NOT (selected AND d = 0)").groupBy("flight", "frame").agg(F.min("d").alias("dist_m"))
    return frames.select("flight", "frame").join(near.hint("merge"), ["flight", "frame"], "left").select("flight", "frame", "dist_m")


def audit_table(labelled: DataFrame) -> DataFrame:
    """Labelled frames with cell_x and cell_y, ``bin_rank`` and ``dist_to_nearest_selected_m``."""
    ranked = bin_rank(labelled)
    near = nearest_selected(labelled).withColumnRenamed("dist_m", "dist_to_nearest_selected_m")
    return ranked.join(near.hint("merge"), ["flight", "frame"], "left")


def quantiles(column: str) -> Column:
    """min, p10 .. p90, max by linear interpolation."""
    return F.percentile(column, F.array(*(F.lit(q) for q in (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0))))


def adjacent_baselines(selected: DataFrame, near_repeat_m: float = 0.1, low_m: float = 1.0) -> DataFrame:
    gaps = selection_gaps(selected)
    return gaps.groupBy("flight").agg(F.count("*").alias("n"), F.count_if(F.col("gap_m") <= near_repeat_m).alias("near_repeats"), F.count_if(F.col("gap_m") < low_m).alias("low"), F.percentile("gap_m", F.lit(0.5)).alias("median_m"))
