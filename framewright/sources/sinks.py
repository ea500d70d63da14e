"""Outputs of a selection: geo file, manifest, camera file and audit table."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.geometry import Camera
from framewright.operators import audit, coverage, matching, reports
from framewright.operators.selection import SelectionParams
from framewright.sources.readers import Record, load_scored, scores_are_current
from framewright.storage import materialize


def geo_lines(selected: DataFrame) -> DataFrame:
    """``value``: the lines of a geo file in frame order, without the header."""
    line = F.concat_ws(" ", F.format_string("%06d.png", "frame"), F.col("easting").cast("string"), F.col("northing").cast("string"), F.col("altamsl").cast("string"))
    return selected.orderBy("frame").select(line.alias("value"))


def write_geo(selected: DataFrame, zone: str, path: str) -> None:
    """One flight's geo file; its keyframes are bounded by the selection budget."""
    lines = [r[0] for r in geo_lines(selected).toLocalIterator()]
    if not lines:
        raise ValueError("no keyframe selected")
    Path(path).write_text("\n".join([f"WGS84 UTM {zone}", *lines]) + "\n")


def manifest(labelled: DataFrame) -> DataFrame:
    """One row a flight: counts and the selected frames as JSON."""
    frames = F.array_sort(F.collect_list(F.when(F.col("selected"), F.col("frame"))))
    return labelled.groupBy("flight").agg(F.count("*").alias("n_frames"), F.count_if("selected").alias("n_selected"), F.to_json(frames).alias("selected_frames"))


def write_camera(camera: Camera, path: str) -> None:
    key = f"v2   {camera.width} {camera.height} brown 0.85"
    body = {"projection_type": "brown", "width": camera.width, "height": camera.height, **camera.normalised(), **{k: getattr(camera, k) for k in ("k1", "k2", "p1", "p2", "k3")}}
    Path(path).write_text(json.dumps({key: body}, indent=2))


def write_audit(labelled: DataFrame, path: str) -> None:
    labelled.write.mode("errorifexists").option("header", True).csv(path)


def save_scored(candidates: DataFrame, folder: str, record: Record) -> None:
    """Scores without the columns of a selection, and what they were made of."""
    scores = candidates.drop("cell_x", "cell_y", "selected", "reject_reason", "selection_reason")
    path = Path(folder) / "candidates_scored"
    scores.write.mode("overwrite").parquet(str(path))
    n = candidates.sparkSession.read.parquet(str(path)).count()
    manifest = {"scored_at": datetime.now(timezone.utc).isoformat(), "n_candidates": n, "fingerprint": record.fingerprint()}
    (Path(folder) / "scoring.json").write_text(json.dumps(manifest, indent=2) + "\n")


def load_or_score(spark: SparkSession, record: Record, folder: str, score: Callable[[Record], DataFrame], rescore: bool = False) -> DataFrame:
    """Stored scores if they are of this video, else those that ``score`` gives, which are stored."""
    if rescore or not scores_are_current(folder, record):
        save_scored(score(record), folder, record)
    return load_scored(spark, folder)


def save_footprints(footprints: DataFrame, path: str, digest: str) -> None:
    """Footprints with the digest of the parameters they were made under."""
    footprints.withColumn("params", F.lit(digest)).write.mode("errorifexists").parquet(path)


def write_manifest(labelled: DataFrame, record: Record, run: Path, params: SelectionParams, made_of: tuple[str, ...] = ()) -> None:
    """``run``/build.json of one flight; its selected frames are bounded by the budget.  ``made_of``: what its
    footprints depend on beside the parameters."""
    counts = labelled.agg(F.count("*").alias("n"), F.count_if("selected").alias("k")).first()
    frames = [r.frame for r in labelled.where("selected").select("frame").orderBy("frame").toLocalIterator()]
    body = {"record_path": str(record.path), "slug": record.slug, "stream_id": record.stream_id, "video": str(record.video), "poses_path": str(record.poses_path), "intrinsics": str(record.intrinsics), "run_ts": run.name, "run_dir": f"runs/{run.name}"}
    body |= {"n_candidates": counts.n, "n_selected": counts.k, "selected_frame_numbers": frames, "selection_constants": params.constants(), "footprints_made_of": list(made_of)}
    run.mkdir(parents=True, exist_ok=True)
    (run / "build.json").write_text(json.dumps(body, indent=2) + "\n")


def write_odm_options(folder: str, cameras_path: str, neighbours: int = 0) -> None:
    """``folder``/odm_options.json; the values are fixed ones."""
    body = {"fast_orthophoto": True, "matcher_neighbors": neighbours, "gps_accuracy": 3, "orthophoto_resolution": 5, "use_fixed_camera_params": True, "cameras": cameras_path, "cli_args_if_empty": ["--fast-orthophoto"]}
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "odm_options.json").write_text(json.dumps(body, indent=2) + "\n")


def write_matcher_profile(folder: str, cameras_path: str, vertices: DataFrame, edges: DataFrame, reach_m: float = 33.0, selected: DataFrame | None = None) -> int:
    """Options of one flight with the matcher neighbours that co-visibility recommends and matching_profile.json beside
    them, or, without an edge, with the number of ``selected`` frames (else vertices) within reach.  Returns the neighbours."""
    write_odm_options(folder, cameras_path)
    options = Path(folder) / "odm_options.json"
    if edges.isEmpty():
        found = audit.matcher_neighbours(vertices if selected is None else selected, reach_m).first()
        neighbours = found.neighbours if found else 0
    else:
        profile, about = matching.matcher_profile(vertices, edges).first(), matching.covis_summary(vertices, edges).drop("flight").first()
        neighbours = profile.neighbours
        body = {"profile": {"gps_neighbors": neighbours, "gps_distance_m": profile.distance_m}, "covisibility": about.asDict()}
        (Path(folder) / "matching_profile.json").write_text(json.dumps(body, indent=2) + "\n")
    options.write_text(json.dumps(json.loads(options.read_text()) | {"matcher_neighbors": neighbours}, indent=2) + "\n")
    return neighbours


def write_report(labelled: DataFrame, cells: DataFrame, angles: DataFrame, params: SelectionParams, folder: str, grid: DataFrame | None = None) -> DataFrame:
    """``folder``/selection_audit as CSV, /health and /summary as JSON lines, a line a flight; returns the health that was
    written.  The summary holds all blocks of :func:`reports.whole_summary`; ``grid`` has the origins of the cells."""
    spark = labelled.sparkSession
    audited = materialize(audit.audit_table(coverage.assign_bins(labelled, params.bin_m)), "audited")
    write_audit(audited, f"{folder}/selection_audit")
    found = reports.health(labelled, cells, params, angles)
    found.write.json(f"{folder}/health")
    found = spark.read.schema(found.schema).json(f"{folder}/health")
    reports.whole_summary(audited, cells, params, angles, found, params.bin_m, params.bin_m, grid).write.json(f"{folder}/summary")
    return found
