"""What selected frames see of the ground: cells have flight, frame, cx, cy and footprint_valid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framewright.components import connected_components
from framewright.storage import materialize

#: Cells of one flight that one task may search.
MOST_CELLS = 1_000_000


def assign_bins(frames: DataFrame, bin_m: float) -> DataFrame:
    """``cell_x``, ``cell_y`` from the flight's least easting and northing."""
    w = Window.partitionBy("flight")
    at = lambda c: F.floor((F.col(c) - F.min(c).over(w)) / bin_m).cast("long")
    return frames.withColumns({"cell_x": at("easting"), "cell_y": at("northing")})


def ground_grid(frames: DataFrame, bin_m: float, margin_m: float) -> DataFrame:
    """flight, origin_e, origin_n: the floored corner outside the margin."""
    corner = lambda c: (F.floor((F.min(c) - margin_m) / bin_m) * bin_m).cast("double")
    return frames.groupBy("flight").agg(corner("easting").alias("origin_e"), corner("northing").alias("origin_n"))


def grid_cells(frames: DataFrame, bin_m: float, margin_m: float) -> DataFrame:
    """The distinct cells under the frames, with their centres; frames without a position are left out."""
    on = frames.where("easting IS NOT NULL AND northing IS NOT NULL").join(ground_grid(frames, bin_m, margin_m), "flight")
    cell = lambda c, o: F.floor((F.col(c) - F.col(o)) / bin_m).cast("long")
    cells = on.select("flight", cell("easting", "origin_e").alias("cx"), cell("northing", "origin_n").alias("cy"), "origin_e", "origin_n").distinct()
    return cells.select("flight", "cx", "cy", ((F.col("cx") + 0.5) * bin_m + F.col("origin_e")).alias("center_e"), ((F.col("cy") + 0.5) * bin_m + F.col("origin_n")).alias("center_n"))


def view_counts(selected: DataFrame, cells: DataFrame) -> DataFrame:
    """flight, cx, cy, views over the selected frames."""
    return cells.join(selected.select("flight", "frame"), ["flight", "frame"], "left_semi").groupBy("flight", "cx", "cy").agg(F.count("*").alias("views"))


def mission_cells(cells: DataFrame) -> DataFrame:
    """Cells of valid footprints."""
    return cells.where("footprint_valid").select("flight", "cx", "cy").distinct()


def coverage_metrics(mission: DataFrame, views: DataFrame, target: int, cell_m2: float = 25.0) -> DataFrame:
    """One row a flight with mission cells; shares are 0 without a view."""
    m = mission.groupBy("flight").agg(F.count("*").alias("n_mission"))
    v = views.groupBy("flight").agg(
        F.count("*").alias("n_covered"), F.count_if(F.col("views") >= target).alias("n_at_target"), F.count_if(F.col("views") >= 2 * target).alias("n_at_double"), F.avg("views").alias("mean_views"), F.max("views").alias("max_views")
    )
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    share = lambda a, b, name: F.coalesce(F.col(a) / F.greatest(b, F.lit(1)), F.lit(0.0)).alias(name)
    return m.join(v, "flight", "left").select(
        "flight", "n_mission", n("n_covered"), n("n_at_target"), n("n_at_double"), share("n_covered", "n_mission", "covered_share"), share("n_at_target", "n_covered", "covered_at_target"), share("n_at_target", "n_mission", "mission_at_target"),
        F.coalesce("mean_views", F.lit(0.0)).alias("mean_views"), n("max_views"), F.coalesce(F.col("n_at_double") * cell_m2, F.lit(0.0)).alias("over_coverage_m2"),
    )


def views_histogram(views: DataFrame) -> DataFrame:
    return views.groupBy("flight", "views").agg(F.count("*").alias("n_cells"))


def mission_status(mission: DataFrame, views: DataFrame, target: int) -> DataFrame:
    """``status`` of mission cells: 0 unseen, 1 under target, 2 at target."""
    status = F.when(F.col("views").isNull(), 0).when(F.col("views") < target, 1).otherwise(2)
    return mission.join(views, ["flight", "cx", "cy"], "left").select("flight", "cx", "cy", status.cast("long").alias("status"))


def hole_cells(mission: DataFrame, views: DataFrame, target: int, most: int = MOST_CELLS) -> DataFrame:
    """flight, cx, cy, and hole_x, hole_y, the least cell of the hole: of every mission cell under target.  Holes
    are 4-neighbour components.  Flights of up to ``most`` such cells are searched breadth first, each in a
    task; larger ones by contraction of the table of neighbouring cells."""
    under = materialize(mission_status(mission, views, target).where("status < 2").select("flight", "cx", "cy"), "under-target")
    sizes = under.groupBy("flight").agg(F.count("*").alias("n"))
    large = materialize(sizes.where(F.col("n") > most).select("flight"), "large-flights")

    def search(group):
        import pandas as pd

        left, out = set(zip(group["cx"].tolist(), group["cy"].tolist(), strict=True)), []
        flight = group["flight"].iloc[0]
        while left:
            front = [left.pop()]
            hole = list(front)
            while front:
                x, y = front.pop()
                for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if c in left:
                        left.remove(c)
                        front.append(c)
                        hole.append(c)
            out += [(flight, *c, *min(hole)) for c in hole]
        return pd.DataFrame(out, columns=["flight", "cx", "cy", "hole_x", "hole_y"])

    flight = f"flight {under.schema['flight'].dataType.simpleString()}"
    small = under.join(large, "flight", "left_anti").groupBy("flight").applyInPandas(search, f"{flight}, cx long, cy long, hole_x long, hole_y long")
    if large.isEmpty():
        return small
    cells = under.join(large, "flight", "left_semi").withColumn("node", F.xxhash64("flight", "cx", "cy"))
    near = F.explode(F.array(F.struct((F.col("cx") + 1).alias("cx"), F.col("cy")), F.struct(F.col("cx"), (F.col("cy") + 1).alias("cy")))).alias("c")
    edges = cells.select("flight", F.col("node").alias("a"), near).select("flight", "a", "c.cx", "c.cy").join(cells.withColumnRenamed("node", "b"), ["flight", "cx", "cy"]).select("a", "b")
    named = cells.join(connected_components(edges), "node", "left").withColumn("root", F.coalesce("root", F.xxhash64("node")))
    least = named.groupBy("flight", "root").agg(F.min(F.struct("cx", "cy")).alias("h"))
    return small.union(named.join(least, ["flight", "root"]).select("flight", "cx", "cy", F.col("h.cx").alias("hole_x"), F.col("h.cy").alias("hole_y")))


def coverage_holes(mission: DataFrame, views: DataFrame, target: int, cell_e: float = 5.0, cell_n: float = 5.0, origin: tuple[float, float] = (0.0, 0.0), most: int = MOST_CELLS) -> DataFrame:
    """flight, hole_x, hole_y, size, area_m2 and the mean centre of each hole, and ``rank``, largest first."""
    cells = hole_cells(mission, views, target, most)
    mean = lambda c, size, o, n: F.round((F.avg(c) + 0.5) * size + o, 1).alias(n)
    holes = cells.groupBy("flight", "hole_x", "hole_y").agg(F.count("*").alias("size"), mean("cx", cell_e, origin[0], "centroid_e"), mean("cy", cell_n, origin[1], "centroid_n"))
    rank = F.row_number().over(Window.partitionBy("flight").orderBy(F.col("size").desc(), "hole_x", "hole_y")).cast("long")
    return holes.withColumns({"area_m2": F.round(F.col("size") * (cell_e * cell_n), 1), "rank": rank})


def hole_totals(holes: DataFrame, top: int = 10) -> DataFrame:
    """flight, n_holes, n_under_target, hole_area_m2 and the sizes of the largest holes as an array."""
    largest = F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= top, F.struct("rank", "size")))), lambda h: h["size"])
    return holes.groupBy("flight").agg(F.count("*").alias("n_holes"), F.sum("size").alias("n_under_target"), F.round(F.sum("area_m2"), 1).alias("hole_area_m2"), largest.alias("largest"))
