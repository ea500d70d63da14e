"""Commands over flights and runs.

``resolve-run FOLDER [--run RUN]`` prints a run's folder.  ``build RECORD SCORED TERRAIN OUT`` selects keyframes of scored
frames and writes manifest, geo file, camera, options and report of a new run, failing after the report if the selection
does.  Scores are stored beside the runs with the fingerprint of their video and taken from there while it is the same:
``--rescore`` reads SCORED again, ``--select-only`` never does and refuses scores of another video.  ``prepare RECORD RUN`` writes
camera and options for a run again.  ``report RUN SCORED FOOTPRINTS OUT`` reports on the selection that the run's audit
table holds, or with ``--force`` on one made anew from SCORED.  ``audit-run FOLDER OUT`` writes the audit of every run below.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from dataclasses import fields
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions.geometry import Camera
from framewright.operators import coverage, footprints, matching, reports, selection
from framewright.operators.run_audit import audit_runs
from framewright.sources import readers, sinks
from framewright.storage import materialize, ship_package

P = selection.SelectionParams
#: The parameters that commands take.
OPTIONS = ("bin_m", "spacing_m", "gsd_ratio", "max_views", "max_frames", "target_views", "max_gap_m", "cluster_m", "datum_m", "margin_m", "ray_grid")


def write_audit(spark: SparkSession, root: str, out: str) -> None:
    """``out``/reports as JSON, a line a run, and ``out``/bad_images as CSV; existing folders are an error."""
    reports_, flags = audit_runs(spark, root)
    reports_.write.json(f"{out}/reports")
    flags.write.option("header", True).csv(f"{out}/bad_images")


def _angles(labelled: DataFrame, cells: DataFrame, p: P, ground: DataFrame | None) -> DataFrame:
    """Convergence with cells in metres from the flight's origin, which the positions are moved to as well."""
    grid = coverage.ground_grid(labelled, p.bin_m, p.margin_m)
    moved = labelled.join(grid, "flight").withColumns({"easting": F.col("easting") - F.col("origin_e"), "northing": F.col("northing") - F.col("origin_n")})
    return materialize(reports.convergence(moved, cells, p.bin_m, p.bin_m, ground), "angles")


def _scored(spark: SparkSession, record: readers.Record, store: str, scored_path: str, select_only: bool, rescore: bool) -> DataFrame:
    """The record's scores from the store, or from ``scored_path`` into it."""
    if select_only and not rescore:
        if not readers.scores_are_current(store, record):
            raise ValueError(f"{store} has no scores of {record.video}")
        return readers.load_scored(spark, store)
    return sinks.load_or_score(spark, record, store, lambda _: spark.read.parquet(scored_path), rescore)


def _made_of(camera: Camera, terrain_path: str) -> tuple[str, ...]:
    """What footprints depend on beside the parameters: the camera, and size and time of the terrain's files."""
    files = [Path(f"{terrain_path}{end}").stat() for end in (".npy", ".json")]
    return (repr(camera), *(f"{f.st_size}:{f.st_mtime_ns}" for f in files))


def build(spark: SparkSession, record_path: str, scored_path: str, terrain_path: str, out: str, p: P, run: str | None = None, size: tuple[int, int] = (1920, 1080), select_only: bool = False, rescore: bool = False) -> Path:
    """The folder of the new run.  ``scored_path``: Parquet of frame, easting, northing, altamsl, utm_zone, angles,
    feature_count and sharpness of the record's frames."""
    ship_package(spark)
    record = readers.Record.from_path(record_path)
    camera = readers.read_intrinsics(str(record.intrinsics), *size)
    scored = _scored(spark, record, str(Path(out) / record.slug), scored_path, select_only, rescore).withColumn("flight", F.lit(record.slug))
    box = footprints.mission_box(scored).first()
    if box is None:
        raise ValueError(f"{scored_path} has no frame")
    terrain = readers.terrain_around(spark, terrain_path, (box.min_easting, box.min_northing, box.max_easting, box.max_northing), p.margin_m, p.datum_m)
    found = materialize(footprints.footprints(scored, camera, terrain, p.bin_m, p.margin_m, p.ray_grid, p.least_valid_rays), "footprints")
    cells = materialize(footprints.long_cells(found), "cells")
    frames = footprints.with_footprints(footprints.with_agl(scored, terrain), found)
    labelled = materialize(selection.select_keyframes(frames, p, cells), "labelled")
    grid = coverage.ground_grid(scored, p.bin_m, p.margin_m)
    centres = cells.select("flight", "cx", "cy").distinct().join(grid, "flight")
    centres = centres.select("flight", "cx", "cy", ((F.col("cx") + 0.5) * p.bin_m + F.col("origin_e")).alias("center_e"), ((F.col("cy") + 0.5) * p.bin_m + F.col("origin_n")).alias("center_n"))
    folder = Path(out) / record.slug / "runs" / (run or readers.run_stamp())
    ready = sinks.write_report(labelled, cells, _angles(labelled, cells, p, footprints.cell_ground(centres, terrain)), p, str(folder / "report"), grid)
    made_of = _made_of(camera, terrain_path)
    sinks.save_footprints(found, str(folder / "footprints"), p.digest(*made_of))
    sinks.write_manifest(labelled, record, folder, p, made_of)
    reports.require_passed(ready)
    inputs = folder / "odm_input"
    inputs.mkdir(parents=True, exist_ok=True)
    chosen = labelled.where("selected")
    sinks.write_geo(chosen, labelled.select("utm_zone").first()[0], str(inputs / "geo.txt"))
    sinks.write_camera(camera, str(inputs / "cameras.json"))
    vertices = matching.covis_vertices(chosen, cells)
    sinks.write_matcher_profile(str(inputs), str(inputs / "cameras.json"), vertices, matching.covis_edges(cells.where("footprint_valid"), chosen), selected=chosen)
    return folder


def prepare(spark: SparkSession, record_path: str, run: str, size: tuple[int, int] = (1920, 1080)) -> None:
    """Camera and options of a run that has a geo file: neighbours within reach of its keyframes."""
    from framewright.operators import audit

    record, inputs = readers.Record.from_path(record_path), Path(run) / "odm_input"
    sinks.write_camera(readers.read_intrinsics(str(record.intrinsics), *size), str(inputs / "cameras.json"))
    points = readers.read_geo(spark, str(inputs / "geo.txt")).select(F.lit(record.slug).alias("flight"), F.col("name").alias("frame"), "easting", "northing")
    found = audit.matcher_neighbours(points, 33.0).first()
    sinks.write_odm_options(str(inputs), str(inputs / "cameras.json"), found.neighbours if found else 0)


def report(spark: SparkSession, run: str, scored_path: str, footprints_path: str, out: str, force: bool = False) -> None:
    """The report of a run's selection as its audit table has it, or with ``force`` of one made anew under the run's own
    constants; over flat ground."""
    ship_package(spark)
    manifest = json.loads((Path(run) / "build.json").read_text())
    p = P.from_constants(manifest["selection_constants"])
    found = readers.load_footprints(spark, footprints_path, p.digest(*manifest.get("footprints_made_of", [])))
    cells = materialize(footprints.long_cells(found), "cells")
    if force:
        scored = spark.read.parquet(scored_path).withColumn("flight", F.lit(manifest["slug"]))
        frames = footprints.with_footprints(scored, found)
        frames = frames if "agl_m" in frames.columns else frames.withColumn("agl_m", F.lit(None).cast("double"))
        labelled = selection.select_keyframes(frames, p, cells)
    else:
        saved = Path(run) / "report" / "selection_audit"
        if not saved.exists():
            raise FileNotFoundError(f"{saved} is absent; --force selects anew from scores")
        labelled = readers.load_audit(spark, str(saved)).drop("cell_x", "cell_y", "bin_rank", "dist_to_nearest_selected_m")
    labelled = materialize(labelled, "labelled")
    sinks.write_report(labelled, cells, _angles(labelled, cells, p, None), p, out, coverage.ground_grid(labelled, p.bin_m, p.margin_m))


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="framewright", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    resolve = commands.add_parser("resolve-run")
    resolve.add_argument("folder")
    resolve.add_argument("--run")
    making = commands.add_parser("build")
    for name, given in (("build", "record scored terrain out"), ("prepare", "record run"), ("report", "run scored footprints out"), ("audit-run", "folder out")):
        command = making if name == "build" else commands.add_parser(name)
        for argument in given.split():
            command.add_argument(argument)
    making.add_argument("--run")
    for name in ("--select-only", "--rescore"):
        making.add_argument(name, action="store_true")
    commands.choices["report"].add_argument("--force", action="store_true")
    kinds = {f.name: f.default for f in fields(P)}
    for name in OPTIONS:
        many = isinstance(kinds[name], tuple)
        making.add_argument("--" + name.replace("_", "-"), type=int if many else type(kinds[name]), default=kinds[name], **({"nargs": 2} if many else {}))
    given = parser.parse_args(arguments)
    if given.command == "resolve-run":
        print(readers.resolve_run(given.folder, given.run))
        return
    spark = SparkSession.builder.appName("framewright").getOrCreate()
    if given.command == "build":
        p = P.from_constants({name: getattr(given, name) for name in OPTIONS})
        print(build(spark, given.record, given.scored, given.terrain, given.out, p, given.run, select_only=given.select_only, rescore=given.rescore))
    elif given.command == "prepare":
        prepare(spark, given.record, given.run)
    elif given.command == "report":
        report(spark, given.run, given.scored, given.footprints, given.out, given.force)
    else:
        write_audit(spark, given.folder, given.out)


if __name__ == "__main__":
    main()
