"""Outline of covered ground: borders of cells stitched to rings, rings to polygons with holes.

1. Every cell has four sides, directed so that the cell lies on the left.  Sides that two cells share
   cancel in a grouped sum, so only the border goes on: its length, not the area, is what later steps handle.
2. A side goes on at its end.  Where two cells touch at a corner only, it stays with its own cell at first; where
   both turn out to lie on one ring, it goes on at the other cell, so that no ring meets itself.
3. Rings are named, and their sides numbered, by pointer jumping: after k rounds a side knows the least side
   among the 2^k ahead of it and how far that lies.  A ring is finished when a round changes nothing.
4. The least side of a ring is one of its lowest.  If the ground lies above it the ring is an outer one, else a hole,
   which belongs to the ring of the next border below it, or to what that one belongs to.

No group is larger than a column of the border; a ring is in one row only in :func:`polygons`.  Cells are counted once however often
they are listed; rows without a flight or a place are left out.  Cells lie within 2^30 of the origin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.storage import materialize

EAST, NORTH, WEST, SOUTH = range(4)
LEFT, RIGHT = 1, 3
#: A side of a cell: axis (0 along east, 1 along north), place against the cell, and the way along the axis.
SIDES = ((0, 0, 0, 1), (1, 1, 0, 1), (0, 0, 1, -1), (1, 0, 0, -1))


def border(cells: DataFrame) -> DataFrame:
    """flight, ``side`` (its number), axis, x, y (its lesser end), ``way``, and ``heading``, of the sides of cells (flight, cx, cy) with no cell behind them."""
    sides = F.array(*(F.struct(F.lit(axis).alias("axis"), (F.col("cx") + dx).alias("x"), (F.col("cy") + dy).alias("y"), F.lit(way).alias("way")) for axis, dx, dy, way in SIDES))
    known = cells.select("flight", F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy")).dropna().distinct()
    each = known.select("flight", F.explode(sides).alias("s")).select("flight", "s.*")
    left = each.groupBy("flight", "axis", "x", "y").agg(F.sum("way").alias("way")).where("way <> 0")
    number = F.expr("shiftleft(y + 1073741824, 32) + 2 * (x + 1073741824) + axis")
    return left.withColumns({"side": number, "heading": F.expr("axis + IF(way < 0, 2, 0)")})


def corners(sides: DataFrame) -> DataFrame:
    """flight, vx, vy, and ``ins`` and ``outs`` (side and heading), at most two each, of every point of the border."""

    def ends(at_start: bool) -> DataFrame:
        far = (F.col("way") < 0) if at_start else (F.col("way") > 0)
        beyond = lambda axis: F.when(far & (F.col("axis") == axis), 1).otherwise(0)
        return sides.select("flight", (F.col("x") + beyond(0)).alias("vx"), (F.col("y") + beyond(1)).alias("vy"), F.lit(at_start).alias("leaves"), F.struct("side", "heading").alias("s"))

    of = lambda leaves: F.collect_list(F.when(F.col("leaves") == leaves, F.col("s")))
    return ends(True).unionAll(ends(False)).groupBy("flight", "vx", "vy").agg(of(False).alias("ins"), of(True).alias("outs"))


def links(points: DataFrame, turn: Column) -> DataFrame:
    """flight, side, ``next``, ``bends`` and the point between them, with this turn where two cells touch."""
    each = points.select("flight", "vx", "vy", "outs", turn.alias("turn"), F.explode("ins").alias("i"))
    after = F.expr("IF(size(outs) = 1, outs[0], filter(outs, o -> (o.heading - i.heading + 4) % 4 = turn)[0])")
    each = each.withColumn("o", after)
    return each.select("flight", F.col("i.side").alias("side"), F.col("o.side").alias("next"), (F.col("i.heading") != F.col("o.heading")).alias("bends"), "vx", "vy")


def numbered(linked: DataFrame) -> tuple[DataFrame, int]:
    """flight, side, ``ring`` (the least side of its ring) and ``ahead`` (sides to go until that one), and the rounds
    taken: the logarithm of the longest ring."""
    at = linked.select("flight", "side", F.col("next").alias("to"), F.col("side").alias("ring"), F.lit(0).cast("long").alias("ahead"))
    rounds = 0
    while True:
        far = at.select("flight", F.col("side").alias("to"), F.col("to").alias("further"), F.col("ring").alias("its_ring"), F.col("ahead").alias("its_ahead"))
        less = F.col("its_ring") < F.col("ring")
        step = at.join(far, ["flight", "to"]).select(
            "flight", "side", F.col("further").alias("to"), F.least("ring", "its_ring").alias("ring"), F.when(less, F.col("its_ahead") + 2**rounds).otherwise(F.col("ahead")).alias("ahead"), less.alias("changed")
        )
        step, rounds = materialize(step, "outline-ranks"), rounds + 1
        if step.where("changed").isEmpty():
            return step.select("flight", "side", "ring", "ahead"), rounds
        at = step.drop("changed")


def outline(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rings: flight, ring, ``polygon`` (its outer ring), ``hole``, n_sides, n_corners and ``area`` in cells, below 0 for holes;
    and their corners: flight, polygon, ring, hole, ``place`` in the ring, vx and vy."""
    sides = materialize(border(cells), "outline-sides")
    points = materialize(corners(sides), "outline-points")
    linked = links(points, F.lit(LEFT))
    ranks, _ = numbered(linked)
    touching = points.where(F.size("ins") == 2).select("flight", "vx", "vy", F.explode("ins.side").alias("side")).join(ranks, ["flight", "side"])
    meets = touching.groupBy("flight", "vx", "vy").agg((F.min("ring") == F.max("ring")).alias("meets")).where("meets")
    meets = materialize(meets, "outline-meets")
    if not meets.isEmpty():
        linked = links(points.join(meets, ["flight", "vx", "vy"], "left"), F.when(F.col("meets"), RIGHT).otherwise(LEFT))
        ranks, _ = numbered(linked)
    whole = materialize(ranks.join(linked, ["flight", "side"]).join(sides, ["flight", "side"]), "outline")
    leads = F.col("side") == F.col("ring")
    rings = whole.groupBy("flight", "ring").agg(
        F.count("*").alias("n_sides"), F.count_if("bends").alias("n_corners"), F.sum(F.expr("IF(axis = 1, way * x, 0)")).cast("long").alias("area"), F.max(leads & (F.col("way") < 0)).alias("hole")
    )
    below = F.lag("ring").over(Window.partitionBy("flight", "x").orderBy("y"))
    under = whole.where("axis = 0").select("flight", "ring", "side", "way", below.alias("below")).where(leads)
    up = materialize(under.select("flight", "ring", F.when(F.col("way") > 0, F.col("ring")).otherwise(F.col("below")).alias("polygon")), "outline-up")
    while True:
        above = up.select("flight", F.col("ring").alias("polygon"), F.col("polygon").alias("further"))
        step = up.join(above, ["flight", "polygon"]).select("flight", "ring", F.col("further").alias("polygon"), (F.col("further") != F.col("polygon")).alias("changed"))
        step = materialize(step, "outline-up")
        if step.where("changed").isEmpty():
            break
        up = step.drop("changed")
    rings = rings.join(up, ["flight", "ring"]).select("flight", "ring", "polygon", "hole", "n_sides", "n_corners", "area")
    bends = whole.where("bends").select("flight", "ring", "ahead", "vx", "vy").join(rings, ["flight", "ring"])
    return rings, bends.select("flight", "polygon", "ring", "hole", (F.col("n_sides") - 1 - F.col("ahead")).alias("place"), "vx", "vy")


def polygons(bends: DataFrame, cell_e: float, cell_n: float, origin: tuple[float, float] = (0.0, 0.0)) -> DataFrame:
    """flight, polygon, n_holes and ``wkt`` with two decimals: the outer ring first and against the clock, holes in order
    of their numbers.  A polygon's text is one value, so its corners meet in a task."""
    at = lambda c, size, o: F.format_string("%.2f", F.col(c) * float(size) + float(o))
    point = F.concat_ws(" ", at("vx", cell_e, origin[0]), at("vy", cell_n, origin[1]))
    rings = bends.groupBy("flight", "polygon", "ring", "hole").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", point.alias("p")))), lambda b: b["p"]).alias("p"))
    text = F.concat(F.lit("("), F.concat_ws(", ", F.concat("p", F.slice("p", 1, 1))), F.lit(")"))
    per = rings.groupBy("flight", "polygon").agg(F.count_if("hole").alias("n_holes"), F.array_sort(F.collect_list(F.struct("hole", "ring", text.alias("text")))).alias("rings"))
    return per.select("flight", "polygon", "n_holes", F.concat(F.lit("POLYGON ("), F.concat_ws(", ", F.transform("rings", lambda r: r["text"])), F.lit(")")).alias("wkt"))
