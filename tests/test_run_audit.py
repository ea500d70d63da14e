"""Reports over run folders: each rule on folders built for it, absent and broken files."""

from __future__ import annotations

import json

import pytest

from framewright.operators import run_audit
from framewright.sources import artefacts

SFM = "odm_input/opensfm"


def image(n):
    return f"{n:06d}.png"


class Folder:
    """Builds the artefacts of one run."""

    def __init__(self, root, name):
        self.base = root / name

    def file(self, place, content):
        path = self.base / place
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content))
        return self

    def audit(self, rows, extra=""):
        """rows: (frame, selected, easting, northing, altitude, quality)."""
        lines = [f"northing,FrameNumber,selected,quality_score,easting,altamsl{',' + extra if extra else ''}"]
        lines += [f"{n},{f},{s},{q},{e},{a}{',?' if extra else ''}" for f, s, e, n, a, q in rows]
        return self.file("selection_audit.csv", "\r\n".join(lines))


def reports_of(spark, root):
    reports, flags = run_audit.audit_runs(spark, str(root))
    return {r.run: r.asDict(True) for r in reports.collect()}, flags


def test_selection_metrics(spark, tmp_path):
    # a square of 3 m, then a frame in place and one 0.5 m on; unselected and unreadable rows count as candidates only
    steps = [(7, 0, 0), (9, 3, 0), (14, 3, 3), (15, 3, 3), (40, 3, 3.5)]
    rows = [(f, "yes", e, n, 80 + f, f / 100) for f, e, n in steps]
    Folder(tmp_path, "a").audit([*rows, (3, "no", 9, 9, "x", ""), ("", "", 1, 1, 1, 1)], extra="note")
    got = reports_of(spark, tmp_path)[0]["a"]["selection"]
    assert (got["n_candidates"], got["n_selected"], got["first_frame"], got["last_frame"]) == (7, 5, 7, 40)
    assert got["frame_gap"] == [1, 1.3, 1.75, 3.5, 10.0, 19.0, 25]
    assert got["baseline_m"][0] == 0 and got["baseline_m"][-1] == 3 and (got["n_near_repeats"], got["n_low_baselines"]) == (1, 2)
    assert got["altitude_m"][3] == 94 and got["quality"][-1] == 0.4


def test_feature_and_track_rules(spark, tmp_path):
    counts = {1: 0, 2: 99, 3: 100, 4: 1}
    listed = [{"image": image(n), "num_features": c} for n, c in counts.items()] + [{"image": image(5)}, {}]
    # 1 has 6 edges and weight enough, 2 six light ones, 3 few
    edges = [[image(1), image(n), 40] for n in range(10, 16)] + [[image(2), image(n), 16] for n in range(20, 26)] + [[image(3), image(30), 500], [image(3)]]
    Folder(tmp_path, "all").file(f"{SFM}/reports/features.json", {"image_reports": listed}).file(f"{SFM}/reports/tracks.json", {"num_images": 31, "num_tracks": 4, "view_graph": edges})
    Folder(tmp_path, "some").audit([(n, 1, n, 0, 0, 0) for n in (1, 2, 8)]).file(f"{SFM}/reports/features.json", {"image_reports": listed}).file(f"{SFM}/reports/tracks.json", {"view_graph": edges})
    rows, flags = reports_of(spark, tmp_path)
    features = {r: (rows[r]["features"]["n_images"], rows[r]["features"]["n_zero_features"], rows[r]["features"]["n_low_features"]) for r in rows}
    assert features == {"all": (5, 2, 2), "some": (5, 1, 1)}
    assert rows["all"]["tracks"]["n_edges"] == 14 and rows["all"]["tracks"]["n_tracks"] == 4 and rows["some"]["tracks"]["n_weak"] == 2
    weak = {(r.run, r.image) for r in flags.where("weak_graph").collect()}
    assert {i for r, i in weak if r == "some"} == {image(2), image(8)}
    assert image(1) not in {i for r, i in weak if r == "all"} and {image(2), image(3), image(30)} <= {i for r, i in weak if r == "all"}


def test_reconstruction_rules(spark, tmp_path):
    parts = [{"shots": {image(n): {"rotation": [0, 0, n]} for n in group}} for group in ((1, 2), (2, 5))]
    run = Folder(tmp_path, "r").audit([(n, "TRUE", n, 0, 0, 0) for n in (1, 2, 3)])
    run.file(f"{SFM}/reconstruction.json", parts).file(f"{SFM}/reports/reconstruction.json", {"not_reconstructed_images": [image(9), image(3)], "num_candidate_image_pairs": 44})
    rows, flags = reports_of(spark, tmp_path)
    got = rows["r"]["reconstruction"]
    assert (got["n_shots"], got["n_selected"], got["n_not_reconstructed"], got["selected_ratio"], got["num_candidate_image_pairs"]) == (3, 3, 2, 0.666667, 44)
    assert {r.image for r in flags.where("not_reconstructed").collect()} == {image(3), image(9)}


def test_files_passed_through_and_presence(spark, tmp_path):
    full = Folder(tmp_path, "full").file("build.json", {}).file("odm_input/geo.txt", "WGS84").file("odm_input/odm_orthophoto/odm_orthophoto.tif", "t")
    full.file(f"{SFM}/stats/stats.json", {"reconstruction_statistics": {"average_track_length": 4.5, "observations_count": 12}, "gps_errors": {"ce90": 2}}).file(f"{SFM}/camera_models.json", {"m": 1})
    Folder(tmp_path, "broken").file(f"{SFM}/reports/features.json", "[not json").file(f"{SFM}/stats/stats.json", "none")
    rows, flags = reports_of(spark, tmp_path)
    stats = rows["full"]["stats"]
    assert stats["average_track_length"] == 4.5 and stats["observations_count"] == 12 and stats["reprojection_error_pixels"] is None
    assert json.loads(stats["gps_errors"]) == {"ce90": 2} and stats["camera_errors"] == "{}"
    assert rows["full"]["cameras"] == {"opensfm_camera_models": '{"m": 1}', "exported_cameras": None}
    there = {k for k, v in rows["full"]["artefacts"].items() if v}
    assert there == {"build_json", "geo_txt", "orthophoto", "opensfm_stats", "opensfm"}
    assert rows["broken"]["features"] is None and rows["broken"]["stats"]["average_track_length"] is None and flags.count() == 0


def test_no_artefacts(spark, tmp_path):
    (tmp_path / "x").mkdir()
    rows, flags = reports_of(spark, tmp_path)
    assert rows == {} and flags.count() == 0


def test_an_image_listed_twice_keeps_its_last_count(spark, tmp_path):
    Folder(tmp_path, "r").file(f"{SFM}/reports/features.json", {"image_reports": [{"image": "k", "num_features": n} for n in (8, 3)]})
    assert [(r.image, r.num_features) for r in artefacts.features(spark, str(tmp_path)).collect()] == [("k", 3)]


@pytest.mark.parametrize("sweep", [True, False])
def test_best_profiles(spark, sweep):
    # cross ratio, connectivity, track length, error, components
    known = {("u", 0): (0.2, 0, 0, 0, 1), ("u", 1): (0.4, 0, 2, 0.8, 1), ("u", 2): (0.4, 0.4, 0, 0, 2), ("u", 3): (0.4, 0, 2, 0.8, 1), ("u", 4): (None, 9, 9, 0, 1), ("v", 6): (float("nan"), 0, 0, 0, 1)}
    schema = "run string, position int, cross_track_solid_ratio double, algebraic_connectivity double, track_len_mean double, reproj_err_px double, match_graph_components int"
    rows = spark.createDataFrame([(*k, *(None if x is None else float(x) for x in v[:4]), v[4]) for k, v in known.items()], schema)
    assert {(r.run, r.position) for r in run_audit.best_profiles(rows, sweep).collect()} == {("u", 1 if sweep else 0), ("v", 6)}
    assert run_audit.best_profiles(rows.limit(0), sweep).count() == 0


def test_audit_command(spark, tmp_path):
    from framewright import cli

    Folder(tmp_path / "in", "q").audit([(1, "yes", 0, 0, 0, 0)]).file(f"{SFM}/reconstruction.json", [])
    cli.main(["audit-run", str(tmp_path / "in"), str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out/reports")).count() == 1
    assert "image" in spark.read.option("header", True).csv(str(tmp_path / "out/bad_images")).columns
