"""Keyframe selection: quality, airborne span, gates, spacing, budget and labels.

Frames have flight, frame, easting, northing, altamsl and the columns each function names.
Everything is keyed by flight.  Undefined numbers must be null, not NaN.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, fields
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from framewright.storage import materialize


#: What is known of a frame during a cull.
OPEN, GONE, STAYS = 0, 1, 2


def by_flight() -> WindowSpec:
    return Window.partitionBy("flight")


def by_frame() -> WindowSpec:
    return by_flight().orderBy("frame")


@dataclass(frozen=True)
class SelectionParams:
    """What a selection depends on; the numbers are fixed values that results must agree on."""

    bin_m: float = 5.0
    datum_m: float = 0.0
    ray_grid: tuple[int, int] = (48, 27)
    least_valid_rays: float = 0.25
    margin_m: float = 500.0
    min_altitude_m: float = 0.0
    rise_m: float = 2.0
    spacing_m: float = 4.0
    gsd_ratio: float = 3.0
    max_views: int = 0
    cluster_m: float = 10.0
    warn_gap_m: float = 15.0
    max_gap_m: float = 60.0
    max_frames: int = 15000
    target_views: int = 5
    parallax_views: int = 3
    parallax_deg: float = 10.0
    least_covered: float = 0.5
    feature_weight: float = 0.6
    min_island: int = 60

    def constants(self) -> dict:
        return asdict(self)

    @classmethod
    def from_constants(cls, constants: dict) -> SelectionParams:
        """Of a manifest's constants; names that are unknown are left out."""
        known = {f.name: constants[f.name] for f in fields(cls) if f.name in constants}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in known.items()})

    def digest(self, *made_of: str) -> str:
        """Of the values that footprints depend on, and of what else they are made of (camera, terrain), for footprints
        that are stored."""
        own = {k: v for k, v in self.constants().items() if k in ("bin_m", "datum_m", "ray_grid", "least_valid_rays", "margin_m")}
        return hashlib.sha256(json.dumps([own, made_of], sort_keys=True).encode()).hexdigest()


def init_candidates(poses: DataFrame, scores: bool = True) -> DataFrame:
    """Poses with the columns of scores (unless these are there to stay) and of a selection, all null, and ``selected`` false."""
    kinds = {"feature_count": "double", "sharpness": "double", "quality_score": "double"} if scores else {}
    kinds |= {"cell_x": "long", "cell_y": "long", "reject_reason": "string", "selection_reason": "string"}
    return poses.withColumns({**{c: F.lit(None).cast(t) for c, t in kinds.items()}, "selected": F.lit(False)})


def quality_score(frames: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """``quality_score``: weighted min-max shares of feature_count and sharpness in the flight."""

    def share(c: str):
        low = F.min(c).over(by_flight())
        return (F.col(c) - low) / (F.max(c).over(by_flight()) - low + 1e-9)

    return frames.withColumn("quality_score", p.feature_weight * share("feature_count") + (1 - p.feature_weight) * share("sharpness"))


def with_span(frames: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """Frames with ``first_frame`` and ``last_frame`` of their flight (:func:`airborne_span`).  All windows share one
    exchange by flight."""
    part, stretch = by_flight(), Window.partitionBy("flight", "_run")
    known = frames.withColumn("_p5", F.percentile("altamsl", F.lit(0.05)).over(part))
    noise = F.coalesce(F.stddev_pop(F.when(F.col("altamsl") < F.col("_p5"), F.col("altamsl"))).over(part), F.lit(0.0))
    risen = F.coalesce(F.col("altamsl") > F.min("altamsl").over(part) + F.greatest(F.lit(p.rise_m), 5 * noise), F.lit(False))
    up = known.withColumns({"_up": risen, "_n": F.count("*").over(part)})
    # frames of one run have as many frames that are not up before them
    before = F.count_if(~F.col("_up")).over(by_frame().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = up.withColumn("_run", F.when(F.col("_up"), before))
    runs = runs.withColumn("_long", F.col("_up") & (F.count("*").over(stretch) >= F.least(F.lit(p.min_island), F.col("_n"))))
    counts = runs.withColumn("_counts", F.col("_long") | F.col("_up") & ~F.max("_long").over(part))
    edge = lambda f: F.coalesce(f(F.when(F.col("_counts"), F.col("frame"))).over(part), f("frame").over(part))
    return counts.withColumns({"first_frame": edge(F.min), "last_frame": edge(F.max)}).drop("_p5", "_up", "_n", "_run", "_long", "_counts")


def airborne_span(frames: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """flight, first_frame and last_frame between the first and the last airborne run; the
    whole flight if it never rises.  Runs shorter than ``min_island`` count only if all are."""
    spans = with_span(frames.select("flight", "frame", "altamsl"), p)
    return spans.groupBy("flight").agg(F.first("first_frame").alias("first_frame"), F.first("last_frame").alias("last_frame"))


def gate(frames: DataFrame, p: SelectionParams = SelectionParams()) -> DataFrame:
    """``reject_reason`` of scored frames with agl_m and footprint_valid, in order of precedence; null if usable."""
    first = (
        F.when(~F.coalesce(F.col("altamsl") >= p.min_altitude_m, F.lit(False)), "below_altitude")
        .when(~F.col("frame").between(F.col("first_frame"), F.col("last_frame")), "on_ground")
        .when(F.col("quality_score").isNull(), "missing_quality_score")
        .when(~F.coalesce("footprint_valid", F.lit(False)), "invalid_footprint")
    )
    early = with_span(frames, p).withColumn("_early", first)
    floor = F.percentile(F.when(F.col("_early").isNull(), F.col("agl_m")), F.lit(0.5)).over(by_flight()) / p.gsd_ratio
    early = early.withColumn("gsd_floor", floor)
    fine = F.col("_early").isNull() & F.coalesce(F.col("agl_m") < F.col("gsd_floor"), F.lit(False))
    return early.withColumn("reject_reason", F.when(fine, "fine_gsd").otherwise(F.col("_early"))).drop("_early", "first_frame", "last_frame")


def spacing_superset(pool: DataFrame, spacing_m: float) -> DataFrame:
    """flight and frame of the frames kept greedily at ``spacing_m`` from the last kept one.

    Each task streams its flights in frame order and holds only the last kept position,
    so a flight of any length takes constant memory."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flight, e, n, begun = None, 0.0, 0.0, False
        for batch in batches:
            flights, es, ns = (batch.column(c).to_pylist() for c in ("flight", "easting", "northing"))
            keep = []
            for i, (f, x, y) in enumerate(zip(flights, es, ns, strict=True)):
                if not begun or f != flight or (x - e) ** 2 + (y - n) ** 2 >= spacing_m**2:
                    flight, e, n, begun = f, x, y, True
                    keep.append(i)
            yield batch.select(["flight", "frame"]).take(pa.array(keep, pa.int64()))

    ordered = pool.select("flight", "frame", "easting", "northing").repartition("flight").sortWithinPartitions("flight", "frame")
    kinds = {c: pool.schema[c].dataType.simpleString() for c in ("flight", "frame")}
    return ordered.mapInArrow(walk, f"flight {kinds['flight']}, frame {kinds['frame']}")


def thin_to_cap(frames: DataFrame, cap: int) -> DataFrame:
    """flight and frame of at most ``cap`` frames: the best of each of cap even stretches."""
    binned = frames.select("flight", "frame", "quality_score", F.count("*").over(by_flight()).alias("n"), F.ntile(cap).over(by_frame()).alias("bin"))
    best = Window.partitionBy("flight", "bin").orderBy(F.col("quality_score").desc(), "frame")
    return binned.withColumn("rn", F.row_number().over(best)).where(f"n <= {cap} OR rn = 1").select("flight", "frame")


def select_keyframes(frames: DataFrame, p: SelectionParams = SelectionParams(), cells: DataFrame | None = None) -> DataFrame:
    """Scored frames with reject_reason, selection_reason and ``selected``.  With ``max_views`` over 0 frames
    all of whose ``cells`` (flight, frame, cx, cy) have more views than that are culled before the budget.
    Frames are scored and gated once, and written."""
    gated = materialize(gate(quality_score(frames, p), p), "gated")
    pool = gated.where("reject_reason IS NULL")
    key = ["flight", "frame"]
    stages = [spacing_superset(pool, p.spacing_m)]
    if p.max_views > 0 and cells is not None:
        stages.append(coverage_cull(pool.join(stages[0], key, "left_semi"), cells, p.max_views))
    stages.append(thin_to_cap(pool.join(stages[-1], key, "left_semi"), p.max_frames))
    reached = reduce(DataFrame.unionAll, [k.select(*key, F.lit(i + 1).alias("stage")) for i, k in enumerate(stages)])
    marked = gated.join(reached.groupBy(*key).agg(F.max("stage").alias("_stage")), key, "left")
    labels = ["redundant_spacing", *["over_covered"] * (len(stages) - 2), "thinned_by_budget"]
    selected = F.coalesce(F.col("_stage") == len(stages), F.lit(False))
    reason = F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason")).when(selected, None)
    for i, label in enumerate(labels):
        reason = reason.when(F.coalesce("_stage", F.lit(0)) == i, label)
    return marked.withColumns({"selected": selected, "reject_reason": reason, "selection_reason": F.when(selected, "keyframe")}).drop("_stage")


def coverage_cull(frames: DataFrame, cells: DataFrame, floor: int) -> DataFrame:
    """flight and frame left after dropping, from the worst quality up, frames all of whose
    cells have more than ``floor`` views left; frames without cells stay."""
    gone, _ = culled(frames, cells, floor)
    return frames.select("flight", "frame").join(gone, ["flight", "frame"], "left_anti")


def culled(frames: DataFrame, cells: DataFrame, floor: int) -> tuple[DataFrame, int]:
    """The frames that :func:`coverage_cull` drops, and the rounds it took.

    When a frame's turn comes, a cell has all its views but for the frames dropped before.  So a frame that
    has a cell with at most ``floor`` views beside those known to be dropped stays, and one whose cells all
    keep more even if every frame before it that is still open were dropped goes.  Each round decides all such frames of
    all flights at once; the first open frame of a flight is always one of them.  Cells whose frames are all
    decided are left out of later rounds."""
    key, cell = ["flight", "frame"], ["flight", "cx", "cy"]
    rows = cells.select(*key, "cx", "cy").distinct().join(frames.select(*key, "quality_score"), key)
    rows = rows.withColumns({"views": F.count("*").over(Window.partitionBy(*cell)), "state": F.lit(OPEN)})
    rows, gone, rounds = materialize(rows, "cull"), [], 0
    before = Window.partitionBy(*cell).orderBy("quality_score", "frame").rowsBetween(Window.unboundedPreceding, -1)
    count = lambda state: F.coalesce(F.count_if(F.col("state") == state).over(before), F.lit(0))
    while True:
        left = F.col("views") - F.col("gone")
        seen = rows.withColumns({"gone": count(GONE), "open": count(OPEN)}).where(F.col("state") == OPEN)
        turn = seen.groupBy(*key).agg(F.max(left <= floor).alias("stays"), F.min(left - F.col("open") > floor).alias("goes"))
        turn = materialize(turn.select(*key, F.when(F.col("stays"), STAYS).when(F.col("goes"), GONE).otherwise(OPEN).alias("now")), "turn")
        gone.append(turn.where(F.col("now") == GONE).select(*key))
        if turn.where(F.col("now") == OPEN).isEmpty():
            return reduce(DataFrame.unionAll, gone), rounds + 1
        rows = rows.join(turn, key, "left").withColumn("state", F.coalesce("now", "state")).drop("now")
        still = rows.where(F.col("state") == OPEN).select(*cell).distinct()
        rows, rounds = materialize(rows.join(still, cell, "left_semi"), "cull"), rounds + 1
