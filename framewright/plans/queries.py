"""Every operator applied to the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.geometry import Camera, Terrain
from framewright.operators import audit, coverage, footprints, matching, outline, parallax, reports, run_audit, selection, tiled_terrain
from framewright.plans import adapter
from framewright.sources.readers import first_of_key
from framewright.sources.readers import missing_frames as missing_pose_frames
from framewright.sources.sinks import manifest
from framewright.storage import materialize, table

P = adapter.P
BIN_M, MARGIN_M = P.bin_m, P.margin_m
CELL_M2 = float(adapter.CELL_E * adapter.CELL_N)
AUDIT_BIN_M, WARN_GAP_M = 200.0, P.warn_gap_m
DENSITY_M, REACH_M = P.cluster_m, 120.0
PAIR_BUDGET = 3
LEAST_INLIERS = 20
TOP_HOLES = 10

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _scored(s: SparkSession, d: str) -> DataFrame:
    return selection.quality_score(adapter.frames(s, d), P)


def _labelled(s: SparkSession, d: str) -> DataFrame:
    return selection.select_keyframes(adapter.frames(s, d), P)


def _selected(s: SparkSession, d: str) -> DataFrame:
    return _labelled(s, d).where("selected")


def _stored(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Labelled frames, written once, and their cells: for reports that use both many times."""
    labelled = materialize(_labelled(s, d), "labelled")
    return labelled, s.sql(adapter.FOOTPRINTS, frames=labelled)


def _views(s: SparkSession, d: str) -> DataFrame:
    return coverage.view_counts(_selected(s, d), adapter.footprints(s, d))


def _mission(s: SparkSession, d: str) -> DataFrame:
    return coverage.mission_cells(adapter.footprints(s, d))


def _views_and_mission(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    labelled, cells = _stored(s, d)
    return coverage.view_counts(labelled.where("selected"), cells), coverage.mission_cells(cells)


def _text(map_column: str) -> Column:
    """A map as key:value pairs in order of the keys."""
    return F.concat_ws(",", F.transform(F.map_entries(map_column), lambda e: F.concat_ws(":", e["key"], e["value"])))


@query
def frames_adapter(s, d):
    return adapter.frames(s, d)


@query
def pose_dedup_first(s, d):
    rows = table(s, d, "events").select(F.col("user_id").alias("flight"), (F.col("event_id") % 50).alias("frame"), "event_id", "value")
    return first_of_key(rows, ["flight", "frame"], ["event_id"])


@query
def quality_score(s, d):
    return _scored(s, d).select("flight", "frame", F.round("quality_score", 6).alias("quality_score"))


@query
def assign_bins(s, d):
    return coverage.assign_bins(adapter.frames(s, d), AUDIT_BIN_M).select("flight", "frame", "cell_x", "cell_y")


@query
def ground_grid_origin(s, d):
    return coverage.ground_grid(adapter.frames(s, d), BIN_M, MARGIN_M)


@query
def cell_centers(s, d):
    return coverage.grid_cells(adapter.frames(s, d), BIN_M, MARGIN_M)


@query
def airborne_span(s, d):
    return selection.airborne_span(adapter.frames(s, d), P)


@query
def gsd_floor(s, d):
    return selection.gate(_scored(s, d), P).groupBy("flight").agg(F.round(F.max("gsd_floor"), 6).alias("gsd_floor"))


@query
def gate_reject_reason(s, d):
    return selection.gate(_scored(s, d), P).select("flight", "frame", "reject_reason")


@query
def spacing_superset(s, d):
    return selection.spacing_superset(selection.gate(_scored(s, d), P).where("reject_reason IS NULL"), P.spacing_m)


@query
def thin_to_cap(s, d):
    return selection.thin_to_cap(_scored(s, d).where("quality_score IS NOT NULL"), P.max_frames)


@query
def select_keyframes(s, d):
    return _labelled(s, d).select("flight", "frame", "selected", "reject_reason")


@query
def reject_reason_counts(s, d):
    return _labelled(s, d).groupBy("reject_reason").agg(F.count("*").alias("n"))


@query
def build_manifest(s, d):
    return manifest(_labelled(s, d))


@query
def view_counts(s, d):
    return _views(s, d)


@query
def mission_cells(s, d):
    return _mission(s, d)


@query
def coverage_metrics(s, d):
    views, mission = _views_and_mission(s, d)
    m = coverage.coverage_metrics(mission, views, P.target_views, CELL_M2)
    return m.withColumns({c: F.round(c, 6) for c in ("covered_share", "covered_at_target", "mission_at_target", "mean_views")})


@query
def views_histogram(s, d):
    return coverage.views_histogram(_views(s, d))


@query
def mission_status(s, d):
    return coverage.mission_status(_mission(s, d), _views(s, d), P.target_views)


@query
def coverage_holes(s, d):
    views, mission = _views_and_mission(s, d)
    return coverage.coverage_holes(mission, views, P.target_views, adapter.CELL_E, adapter.CELL_N)


@query
def covered_outline(s, d):
    rings, _ = outline.outline(_views(s, d))
    total = lambda c: F.sum(c).alias(c)
    return rings.groupBy("flight").agg(total("area"), total("n_sides"), total("n_corners"))


@query
def outline_polygons(s, d):
    _, bends = outline.outline(_views(s, d))
    return outline.polygons(bends, adapter.CELL_E, adapter.CELL_N)


@query
def hole_totals(s, d):
    found = coverage.hole_totals(coverage_holes(s, d), TOP_HOLES)
    return found.withColumn("largest", F.concat_ws(",", F.col("largest").cast("array<string>")))


@query
def selection_gaps(s, d):
    return audit.selection_gaps(_selected(s, d)).withColumn("gap_m", F.round("gap_m", 6))


@query
def worst_gap(s, d):
    return audit.worst_gap(audit.selection_gaps(_selected(s, d)).withColumn("gap_m", F.round("gap_m", 6)))


@query
def coverage_warnings(s, d):
    return audit.selection_gaps(_selected(s, d)).withColumn("gap_m", F.round("gap_m", 6)).where(F.col("gap_m") > WARN_GAP_M)


@query
def bin_rank(s, d):
    return audit.bin_rank(coverage.assign_bins(_scored(s, d), AUDIT_BIN_M)).select("flight", "frame", "bin_rank")


@query
def nearest_selected(s, d):
    return audit.nearest_selected(_labelled(s, d)).withColumn("dist_m", F.round("dist_m", 6))


@query
def local_density(s, d):
    found = audit.local_density(materialize(_selected(s, d), "selected"), DENSITY_M)
    return found.withColumn("members", F.concat_ws(",", F.col("members").cast("array<string>")))


@query
def matcher_neighbors_radius(s, d):
    return audit.matcher_neighbours(_selected(s, d), REACH_M)


@query
def audit_quantiles(s, d):
    q = audit.quantiles("quality_score")
    names = ("q_min", "p10", "p25", "p50", "p75", "p90", "q_max")
    return _scored(s, d).groupBy("flight").agg(q.alias("q")).select("flight", *(F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(names)))


@query
def adjacent_baselines(s, d):
    return audit.adjacent_baselines(_selected(s, d), 50.0, 70.0).withColumn("median_m", F.round("median_m", 6))


@query
def footprint_jaccard(s, d):
    return matching.footprint_jaccard(adapter.footprints(s, d)).withColumn("jaccard", F.round("jaccard", 6))


def _graph(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges of the selected frames' co-visibility."""
    labelled, cells = _stored(s, d)
    chosen = labelled.where("selected")
    return matching.covis_vertices(chosen, cells), matching.covis_edges(cells.where("footprint_valid"), chosen)


_EDGE_DIGITS = {"iom": 6, "dist_m": 6, "view_angle_deg": 4}


@query
def covis_edges(s, d):
    return _graph(s, d)[1].withColumns({c: F.round(c, n) for c, n in _EDGE_DIGITS.items()})


@query
def covis_edges_of_all_frames(s, d):
    """Without the angle gate."""
    edges = matching.covis_edges(adapter.footprints(s, d).where("footprint_valid"), adapter.frames(s, d), max_angle_deg=None)
    return edges.withColumns({c: F.round(c, n) for c, n in _EDGE_DIGITS.items()})


@query
def covis_degrees(s, d):
    return matching.degrees(*_graph(s, d))


@query
def covis_summary(s, d):
    vertices, edges = _graph(s, d)
    return matching.covis_summary(vertices, materialize(edges, "edges")).withColumns({c: F.round(c, 6) for c in ("cross_share", "degree_p50", "degree_p95", "reach_p50", "reach_p95", "reach_max")})


@query
def pair_budget(s, d):
    edges = matching.covis_edges(adapter.footprints(s, d).where("footprint_valid"), adapter.frames(s, d))
    return matching.pair_budget(edges.withColumn("iom", F.round("iom", 6)), PAIR_BUDGET)


@query
def matcher_profile(s, d):
    vertices, edges = _graph(s, d)
    return matching.matcher_profile(vertices, materialize(edges, "edges"))


@query
def optical_axis(s, d):
    return parallax.with_axis(adapter.frames(s, d)).select("flight", "frame", *(F.round(c, 6).alias(c) for c in ("ax", "ay", "az")))


def _consecutive(s: SparkSession, d: str) -> DataFrame:
    f = parallax.with_axis(adapter.frames(s, d))
    columns = ("roll_rad", "pitch_rad", "yaw_rad", "ax", "ay", "az")
    return f.select("flight", "frame", *columns, *(F.lag(c).over(audit.by_frame()).alias(f"{c}_0") for c in columns)).where("frame > 0")


@query
def rotation_delta(s, d):
    r = ("roll_rad", "pitch_rad", "yaw_rad")
    turn = parallax.rotation_deg(tuple(F.col(c) for c in r), tuple(F.col(f"{c}_0") for c in r))
    return _consecutive(s, d).select("flight", "frame", F.round(turn, 4).alias("turn_deg"))


@query
def view_angle(s, d):
    a = ("ax", "ay", "az")
    angle = parallax.angle_deg(tuple(F.col(c) for c in a), tuple(F.col(f"{c}_0") for c in a))
    return _consecutive(s, d).select("flight", "frame", F.round(angle, 4).alias("angle_deg"))


def _convergence(s: SparkSession, d: str) -> DataFrame:
    labelled, cells = _stored(s, d)
    return reports.convergence(labelled, cells, adapter.CELL_E, adapter.CELL_N, adapter.ground(s, cells)).withColumn("angle", F.round("angle", 4))


@query
def convergence_by_cell(s, d):
    return _convergence(s, d)


@query
def parallax_metrics(s, d):
    return parallax.parallax_metrics(_convergence(s, d), P.parallax_views, P.parallax_deg).withColumns({c: F.round(c, 2) for c in ("p10", "p50", "p90")} | {"satisfied_share": F.round("satisfied_share", 6)})


def _flat_angles(labelled: DataFrame, cells: DataFrame) -> DataFrame:
    """Over flat ground at the median altitude."""
    return materialize(reports.convergence(labelled, cells, adapter.CELL_E, adapter.CELL_N).withColumn("angle", F.round("angle", 4)), "angles")


@query
def audit_table(s, d):
    found = audit.audit_table(coverage.assign_bins(materialize(_labelled(s, d), "labelled"), AUDIT_BIN_M))
    return found.select("flight", "frame", "cell_x", "cell_y", "bin_rank", F.round("dist_to_nearest_selected_m", 6).alias("dist_m"), "selected", "selection_reason")


@query
def selection_decisions(s, d):
    audited = audit.bin_rank(coverage.assign_bins(_labelled(s, d), AUDIT_BIN_M)).withColumn("coverage_gain_cells", F.col("event_id") % 3)
    found = reports.decisions(audited, 3)
    # null for a flight without marginal frames, which concat_ws alone would turn into an empty text
    marginal = F.when(F.col("marginal_frames").isNotNull(), F.concat_ws(",", F.col("marginal_frames").cast("array<string>")))
    return found.withColumns({"selection_reason_counts": _text("selection_reason_counts"), "marginal_frames": marginal})


@query
def selection_summary(s, d):
    found = reports.summary(*_stored(s, d), P)
    return found.withColumns({c: _text(c) for c in ("reject_counts", "views_histogram")} | {c: F.round(c, 6) for c in ("covered_share", "covered_at_target", "mission_at_target", "mean_views")})


@query
def selection_insight(s, d):
    labelled, cells = _stored(s, d)
    found = reports.insight(labelled, cells, P, _flat_angles(labelled, cells), adapter.CELL_E, adapter.CELL_N)
    found = found.withColumns({c: F.round(c, 2) for c in ("p10", "p50", "p90")} | {"satisfied_share": F.round("satisfied_share", 6), "largest": F.concat_ws(",", F.col("largest").cast("array<string>"))})
    return found.withColumnRenamed("n_low", "n_multi_view_low")


@query
def mission_box(s, d):
    return footprints.mission_box(adapter.frames(s, d))


@query
def cell_ground_heights(s, d):
    """What the angles of each viewed cell are taken over: known ground, or the first viewer's altitude."""
    labelled, cells = _stored(s, d)
    seen = parallax.ground_or_viewer(reports.viewed(labelled, cells), adapter.ground(s, cells))
    return seen.select("flight", "cx", "cy", "ground_z").distinct()


@query
def missing_frames(s, d):
    frames = adapter.frames(s, d)
    return missing_pose_frames(frames, frames.where("event_id % 29 <> 0"))


@query
def init_candidates(s, d):
    made = selection.init_candidates(adapter.frames(s, d).select("flight", "frame", "easting"))
    return made.select("flight", "frame", "selected", "reject_reason", "selection_reason", "quality_score", "cell_x")


@query
def rotation_axes(s, d):
    """Axis-angle rotations made of the yaw and pitch of frames."""
    shots = adapter.frames(s, d).select("flight", "frame", F.col("pitch_rad").alias("rx"), (F.col("yaw_rad") / 2).alias("ry"), F.expr("CASE WHEN frame % 7 = 0 THEN 0D ELSE yaw_rad / 3 END").alias("rz"))
    return parallax.axes_of_rotations(shots).select("flight", "frame", *(F.round(c, 6).alias(c) for c in ("ax", "ay", "az")))


def _matches(s: SparkSession, d: str) -> DataFrame:
    """Parts of one order as a match of images: both directions, with inliers."""
    line = table(s, d, "lineitem").select("l_orderkey", (F.col("l_suppkey") % 200).alias("n"), F.col("l_quantity").cast("long").alias("q"))
    other = line.select("l_orderkey", F.col("n").alias("b"), F.col("q").alias("q2"))
    return line.join(other, "l_orderkey").where("n <> b").groupBy(F.col("n").alias("a"), "b").agg(F.max(F.expr("q + q2 - 40")).alias("inliers"))


@query
def solid_pairs(s, d):
    return matching.solid_pairs(_matches(s, d), LEAST_INLIERS)


@query
def graph_degree_strength(s, d):
    return matching.degree_strength(matching.solid_pairs(_matches(s, d), LEAST_INLIERS))


def _scope(s: SparkSession, d: str) -> DataFrame:
    return s.range(0, 220).select(F.col("id").alias("node"))


@query
def weak_nodes(s, d):
    return matching.weak_nodes(_scope(s, d), matching.solid_pairs(_matches(s, d), 55))


@query
def bad_images(s, d):
    solid = matching.solid_pairs(_matches(s, d), 55)
    weak = matching.weak_nodes(_scope(s, d), solid).select("node", F.lit("weak").alias("flag"))
    absent = _scope(s, d).join(matching.degree_strength(solid), "node", "left_anti").select("node", F.lit("missing").alias("flag"))
    flags = weak.union(absent)
    return flags.groupBy("node").agg(F.max(F.col("flag") == "weak").alias("weak"), F.max(F.col("flag") == "missing").alias("missing"))


@query
def pair_recall_precision(s, d):
    solid = matching.solid_pairs(_matches(s, d), LEAST_INLIERS)
    predicted = solid.where("inliers >= 50").select("a", "b").union(s.range(1000, 1010).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")))
    return matching.recall_precision(predicted, solid).withColumns({c: F.round(c, 6) for c in ("recall", "precision")})


@query
def match_components(s, d):
    return matching.components(matching.solid_pairs(_matches(s, d), 58))


@query
def components_of_images(s, d):
    return matching.components_of(_scope(s, d), matching.solid_pairs(_matches(s, d), 58)).groupBy("component").agg(F.count("*").alias("n"))


@query
def match_images(s, d):
    return matching.match_images(_matches(s, d).where("inliers >= 58").union(s.createDataFrame([(7001, None, 0)], "a long, b long, inliers long")))


@query
def scoreboard(s, d):
    """Suppliers as images of one run, by file name."""
    name = lambda c: F.concat(F.col(c), F.lit(".png")).alias(c)
    matches = _matches(s, d).select(name("a"), name("b"), "inliers")
    named = s.range(0, 210).select(F.concat("id", F.lit(".png")).alias("node"))
    lengths = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("length")).groupBy("length").agg(F.count("*").alias("n"))
    stats = s.range(1).select(F.lit(5.5).alias("average_track_length"), F.lit(None).cast("double").alias("reprojection_error_pixels"), F.lit(210).alias("initial_shots"), F.lit(147).alias("reconstructed_shots"), F.lit(0.5).alias("ce90"), F.lit(None).cast("double").alias("le90"))
    predicted = matching.solid_pairs(matches, 56).select("a", "b").union(s.createDataFrame([("800.png", "801.png")], "a string, b string"))
    found = matching.scoreboard(matches, named, lengths, stats, predicted, 55)
    digits = [c for c, t in found.dtypes if t == "double"]
    # the connectivity has no SQL form; tests hold it against the whole matrix
    return found.withColumns({c: F.round(c, 6) for c in digits}).drop("algebraic_connectivity")


@query
def track_length_median(s, d):
    tracks = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("length"))
    return matching.weighted_median(tracks.groupBy("length").agg(F.count("*").alias("n")), "length", "n")


@query
def health_report(s, d):
    labelled, cells = _stored(s, d)
    found = reports.health(labelled, cells, P, _flat_angles(labelled, cells))
    texts = {c: F.concat_ws(",", F.col(c).cast("array<string>")) for c in ("largest_cluster", "failures", "warnings")}
    return found.withColumns(texts | {c: F.round(c, n) for c, n in (("covered_share", 6), ("covered_at_target", 6), ("mission_at_target", 6), ("mean_views", 6), ("satisfied_share", 6), ("median_convergence_deg", 2))})


@query
def coverage_cull(s, d):
    return selection.coverage_cull(_scored(s, d).where("quality_score IS NOT NULL"), adapter.footprints(s, d).where("footprint_valid"), adapter.CULL_VIEWS)


@query
def select_keyframes_culled(s, d):
    p = replace(P, max_views=adapter.CULL_VIEWS)
    return selection.select_keyframes(adapter.frames(s, d), p, adapter.footprints(s, d)).select("flight", "frame", "selected", "reject_reason", "selection_reason")


@query
def fiedler_value(s, d):
    solid = matching.solid_pairs(_matches(s, d), 50)
    return matching.fiedler_value(solid, matching.components(solid))


def _terrain() -> Terrain:
    import numpy as np

    x = np.arange(600)
    return Terrain((20 + 10 * np.sin(x[None, :] / 15) + 5 * np.cos(x[:, None] / 20)).astype("float32"), -500.0, 3000.0, 10.0)


@query
def terrain_sample(s, d):
    return footprints.sample_terrain(adapter.frames(s, d).select("flight", "frame", "easting", "northing"), _terrain())


CAMERA = Camera(2275.0, 2275.0, 960.0, 540.0, 1920, 1080)


@query
def raymarch_footprints(s, d):
    return footprints.footprints(adapter.frames(s, d), CAMERA, _terrain(), BIN_M, MARGIN_M)


@query
def footprint_views(s, d):
    """From rays to views: footprints of all frames decide the gate, and their cells the views of the selection."""
    frames = adapter.frames(s, d)
    seen = footprints.footprints(frames, CAMERA, _terrain(), BIN_M, MARGIN_M, shapes=False).select("flight", "frame", F.col("valid").alias("footprint_valid"))
    judged = footprints.with_agl(frames, _terrain()).drop("footprint_valid").join(seen.hint("merge"), ["flight", "frame"], "left").withColumn("footprint_valid", F.coalesce("footprint_valid", F.lit(False)))
    chosen = selection.select_keyframes(judged, P).where("selected")
    return footprints.view_counts(chosen, coverage.ground_grid(frames, BIN_M, MARGIN_M), CAMERA, _terrain(), BIN_M)


#: Customers as heights of a raster of so many columns, from these corners; some are unknown.
RASTER_COLS, RASTER_E, RASTER_N, RASTER_CELL = 100, -50.0, 180.0, 20.0
HEIGHTS = f"SELECT CAST(floor(c_custkey / {RASTER_COLS}) AS BIGINT) AS row, c_custkey % {RASTER_COLS} AS col, CASE WHEN c_custkey % 211 <> 5 THEN CAST(c_acctbal / 500 AS FLOAT) END AS z FROM {{customer}}"


def _raster(s: SparkSession, d: str) -> tiled_terrain.Raster:
    heights = s.sql(HEIGHTS, customer=table(s, d, "customer"))
    rows = heights.agg(F.coalesce(F.max("row") + 1, F.lit(0))).first()[0]
    return tiled_terrain.Raster(materialize(tiled_terrain.tiles_of(heights, 32), "tiles"), rows, RASTER_COLS, RASTER_E, RASTER_N, RASTER_CELL, 32, 3)


@query
def tiled_terrain_sample(s, d):
    points = adapter.frames(s, d).select("flight", "frame", "easting", "northing")
    return footprints.sample_terrain(points, _raster(s, d)).withColumn("ground_z", F.round("ground_z", 6))


@query
def tiled_footprints(s, d):
    return footprints.footprints(adapter.frames(s, d), CAMERA, _raster(s, d), BIN_M, MARGIN_M)


def _run_images(s: SparkSession, d: str) -> DataFrame:
    """Orders as images of runs."""
    return table(s, d, "orders").select((F.col("o_custkey") % 20).alias("run"), F.col("o_orderkey").alias("image"))


def _run_selected(s: SparkSession, d: str) -> DataFrame:
    """Every third image of most runs; the last runs selected none."""
    return _run_images(s, d).where("image % 3 = 0 AND run < 15")


def _run_features(s: SparkSession, d: str) -> DataFrame:
    return _run_images(s, d).withColumn("num_features", F.expr("CASE WHEN image % 11 = 0 THEN 0 ELSE image % 1000 END"))


def _run_shots(s: SparkSession, d: str) -> DataFrame:
    return _run_images(s, d).where("image % 4 <> 0 AND run <> 3")


def _run_missing(s: SparkSession, d: str) -> DataFrame:
    return _run_images(s, d).where("image % 50 = 0")


def _run_edges(s: SparkSession, d: str) -> DataFrame:
    """Lines that follow each other in an order's run as edges; some have no weight."""
    line = table(s, d, "lineitem").join(table(s, d, "orders").select("o_orderkey", (F.col("o_custkey") % 20).alias("run")), F.col("l_orderkey") == F.col("o_orderkey"))
    edge = line.select("run", F.col("l_orderkey").alias("a"), (F.col("l_orderkey") + 3 * F.col("l_linenumber")).cast("long").alias("b"), F.col("l_quantity").cast("long").alias("weight"))
    return edge.withColumn("weight", F.expr("CASE WHEN a % 17 = 0 THEN NULL ELSE weight END"))


def _flat(report: DataFrame) -> DataFrame:
    """Quantile columns as seven plain ones each."""
    arrays = [c for c, t in report.dtypes if t.startswith("array")]
    return report.select("*", *(F.col(c)[i].alias(f"{c}_{n}") for c in arrays for i, n in enumerate(("min", "p10", "p25", "p50", "p75", "p90", "max")))).drop(*arrays)


@query
def run_selection_metrics(s, d):
    named = _labelled(s, d).select(F.col("flight").alias("run"), F.expr("CAST((frame * 7) % 1000003 AS BIGINT)").alias("at"), F.col("frame").alias("FrameNumber"), "selected", "easting", "northing", "altamsl", "quality_score")
    return _flat(run_audit.selection_metrics(named))


@query
def run_feature_report(s, d):
    return _flat(run_audit.feature_report(_run_features(s, d), _run_selected(s, d)))


@query
def run_reconstruction_report(s, d):
    return run_audit.reconstruction_report(_run_shots(s, d), _run_missing(s, d), _run_selected(s, d))


@query
def run_tracks_report(s, d):
    return _flat(run_audit.tracks_report(_run_edges(s, d), _run_selected(s, d)))


@query
def run_image_flags(s, d):
    return run_audit.image_flags(_run_features(s, d), _run_shots(s, d), _run_missing(s, d), _run_edges(s, d), _run_selected(s, d))


@query
def best_matcher_profile(s, d):
    """Parts as results of runs: the best of each brand."""
    results = table(s, d, "part").select(F.col("p_brand").alias("run"), F.col("p_partkey").alias("position"), (F.col("p_size") / 64).alias("cross_track_solid_ratio"), ((F.col("p_partkey") % 16) / 16).alias("algebraic_connectivity"), ((F.col("p_partkey") % 5) * 5.0).alias("track_len_mean"), ((F.col("p_partkey") % 7) / 2).alias("reproj_err_px"), (F.col("p_partkey") % 3).alias("match_graph_components"))
    return run_audit.best_profiles(results).select("run", "position", F.round(run_audit.objective(), 6).alias("objective"))
