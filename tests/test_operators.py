"""Operators that have no SQL form, against brute force, and the files that readers and sinks share."""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pytest

from framewright.functions.geometry import Camera, Terrain, rotation
from framewright.operators import audit, coverage, footprints, matching, parallax, reports, selection
from framewright.sources import readers, sinks
from framewright.streaming import selection_stream

CAMERA = Camera(2000.0, 2000.0, 960.0, 540.0, 1920, 1080)
FLAT = Terrain(np.full((400, 400), 10, "float32"), -1000.0, 2000.0, 10.0)


def _frames(spark, n=6):
    rows = [(1, i, 100.0 + 7 * i, 200.0 + 3 * i, 110.0, 0.02 * i, -1.4 + 0.05 * i, 0.3 * i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, altamsl double, roll_rad double, pitch_rad double, yaw_rad double")


def test_footprints_over_flat_ground(spark):
    """Rays meet flat ground in closed form; cells count from the origin of the ground grid."""
    rows, frames = _frames(spark)
    got = {r.frame: r for r in footprints.footprints(frames, CAMERA, FLAT, 5.0, 500.0).collect()}
    origin = (np.floor((100 - 500) / 5) * 5, np.floor((200 - 500) / 5) * 5)
    rays = CAMERA.rays(CAMERA.sample_grid(48, 27))
    views = Counter()
    for _, frame, e, n, alt, *angles in rows:
        d = rays @ rotation(*angles).T
        t = (10 - alt) / d[:, 2]
        ok = (d[:, 2] < 0) & (t <= 800)
        hit = np.array([e, n]) + t[ok, None] * d[ok, :2]
        cells = {tuple(c) for c in np.floor((hit - origin) / 5).astype(int).tolist()}
        r = got[frame]
        assert r.valid == (ok.mean() >= 0.25) and np.isclose(r.valid_frac, ok.mean()) and r.area_m2 == 25 * len(r.cells)
        assert len(cells ^ {(c.cx, c.cy) for c in r.cells}) <= 0.01 * len(cells)  # points on a border
        assert np.allclose([r.centroid_e, r.centroid_n], hit.mean(axis=0), atol=0.01)
        views.update((c.cx, c.cy) for c in r.cells)
    # and on into coverage
    found = footprints.long_cells(footprints.footprints(frames, CAMERA, FLAT, 5.0, 500.0))
    assert {(r.cx, r.cy): r.views for r in coverage.view_counts(frames, found).collect()} == views
    joined = footprints.with_footprints(frames, footprints.footprints(frames.where("frame < 4"), CAMERA, FLAT, 5.0, 500.0))
    assert {r.frame for r in joined.where("NOT footprint_valid").collect()} >= {4, 5} and joined.count() == 6
    agl = footprints.with_agl(frames, FLAT).collect()
    assert all(r.agl_m == 100 for r in agl)


def test_terrain_must_be_clipped(spark, monkeypatch):
    monkeypatch.setattr(footprints, "MOST_TERRAIN", 1000)
    with pytest.raises(ValueError):
        footprints.footprints(_frames(spark)[1], CAMERA, FLAT, 5.0)


def test_terrain_file_and_window(tmp_path):
    z = np.arange(10_000, dtype="float32").reshape(100, 100)
    np.save(tmp_path / "dtm.npy", z)
    (tmp_path / "dtm.json").write_text(json.dumps({"origin_e": 1000.0, "origin_n": 5000.0, "cell": 10.0, "nodata": 7.0}))
    whole = Terrain(z, 1000.0, 5000.0, 10.0, 7.0, 2.5)
    part = readers.read_terrain(str(tmp_path / "dtm"), (1300.0, 4500.0, 1400.0, 4600.0), 50.0, 2.5)
    e, n = np.meshgrid(np.linspace(1260, 1430, 18), np.linspace(4460, 4640, 19))
    assert part.z.shape == (20, 20) and np.allclose(part.sample(e.ravel(), n.ravel()), whole.sample(e.ravel(), n.ravel()))
    assert readers.read_terrain(str(tmp_path / "dtm"), (0.0, 0.0, 9e9, 9e9)).z.shape == (100, 100)


def _cull_by_hand(frames, cells, floor):
    count = Counter(c for f, _ in frames for c in cells[f])
    kept = []
    for f, q in sorted(frames, key=lambda x: (x[1], x[0])):
        if cells[f] and all(count[c] > floor for c in cells[f]):
            count.subtract(cells[f])
        else:
            kept.append(f)
    return sorted(kept)


def test_coverage_cull_and_its_label(spark):
    rng = np.random.default_rng(4)
    cells = {i: sorted({(int(x), int(y)) for x, y in rng.integers(0, 5, (rng.integers(0, 5), 2))}) for i in range(60)}
    quality = [(i, float(rng.integers(0, 8)) / 8) for i in range(60)]
    frames = spark.createDataFrame([(1, i, 10.0 * i, 0.0, q) for i, q in quality], "flight long, frame long, easting double, northing double, quality_score double")
    long = spark.createDataFrame([(1, i, *c) for i, cs in cells.items() for c in cs], "flight long, frame long, cx long, cy long")
    assert sorted(r.frame for r in selection.coverage_cull(frames, long, 2).collect()) == _cull_by_hand(quality, cells, 2)
    # in the selector: spacing 10 keeps all, the cull what it keeps by hand, the budget the rest
    rows = [(1, i, 10.0 * i, 0.0, 100.0, float(q * 100), 1.0, True, 50.0) for i, q in quality]
    full = spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, altamsl double, feature_count double, sharpness double, footprint_valid boolean, agl_m double")
    p = selection.SelectionParams(spacing_m=10.0, max_views=2, max_frames=10)
    out = {r.frame: (r.selected, r.reject_reason, r.selection_reason) for r in selection.select_keyframes(full, p, long).collect()}
    left = _cull_by_hand(quality, cells, 2)
    assert {f for f, v in out.items() if v[1] == "over_covered"} == set(range(60)) - set(left)
    best = {min(part, key=lambda f: (-quality[f][1], f)) for part in np.array_split(left, 10)}
    assert {f for f, v in out.items() if v[0]} == best and all(out[f][1:] == (None, "keyframe") for f in best)
    assert {v[1] for f, v in out.items() if f in set(left) - best} == {"thinned_by_budget"}


def test_parameters_round_trip():
    p = selection.SelectionParams(spacing_m=9.0, ray_grid=(4, 3))
    assert selection.SelectionParams.from_constants(json.loads(json.dumps(p.constants() | {"unknown": 1}))) == p
    assert p.digest() != selection.SelectionParams().digest()
    assert (selection.SelectionParams().spacing_m, selection.SelectionParams().max_frames, selection.SelectionParams().target_views) == (4.0, 15000, 5)


def test_holes_by_either_way(spark):
    rng = np.random.default_rng(8)
    mission = sorted({(int(x), int(y)) for x, y in rng.integers(0, 14, (120, 2))})
    m = spark.createDataFrame([(f, *c) for f in (1, 2) for c in mission], "flight long, cx long, cy long")
    v = spark.createDataFrame([(1, *c, 5) for c in mission[::4]], "flight long, cx long, cy long, views long")
    one, two = (coverage.coverage_holes(m, v, 3, most=k).orderBy("flight", "rank").collect() for k in (10**6, 0))
    assert one == two and len(one) > 4
    assert sum(r["size"] for r in one if r.flight == 2) == len(mission) and all(r.area_m2 == 25 * r["size"] for r in one)
    largest = one[0]
    assert coverage.hole_totals(coverage.coverage_holes(m, v, 3)).where("flight = 1").first().largest[0] == largest["size"]


def test_full_cells_take_matrix_products(spark):
    rng = np.random.default_rng(5)
    d = rng.normal(size=(90, 3)) + [0, 0, 4]
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    rows = [(1, i, i % 2, 0, *map(float, x)) for i, x in enumerate(d)] + [(1, 99, 7, 7, 0.0, 0.0, 1.0)]
    frame = spark.createDataFrame(rows, "flight long, frame long, cx long, cy long, x double, y double, z double")
    few, hot = ({(r.cx, r.cy): (r.views, round(r.angle, 6)) for r in parallax.convergence_by_cell(frame, k).collect()} for k in (256, 10))
    want = {(k, 0): (45, round(float(np.degrees(np.arccos((d[k::2] @ d[k::2].T).min()))), 6)) for k in (0, 1)}
    assert few == hot == want | {(7, 7): (1, 0.0)}


def test_directions_without_known_ground(spark):
    rows = [(1, 3, 0, 0, 5.0, 5.0, 50.0), (1, 1, 0, 0, 2.5, 2.5, 40.0), (1, 2, 1, 0, 7.5, 2.5, 30.0)]
    views = spark.createDataFrame(rows, "flight long, frame long, cx long, cy long, easting double, northing double, altamsl double")
    ground = spark.createDataFrame([(1, 0, 0, float("nan")), (1, 1, 0, 12.0)], "flight long, cx long, cy long, ground_z double")
    assert {(r.frame, r.ground_z) for r in parallax.ground_or_viewer(views, ground).collect()} == {(3, 40.0), (1, 40.0), (2, 12.0)}
    assert {r.ground_z for r in parallax.ground_or_viewer(views).collect()} == {40.0}
    unit = {r.frame: (r.x, r.y, r.z) for r in parallax.cell_directions(parallax.ground_or_viewer(views, ground), 5.0, 5.0).collect()}
    assert unit[1] == (0.0, 0.0, 0.0) and unit[2] == (0.0, 0.0, 1.0)


def _fiedler_by_hand(edges, nodes):
    a = np.zeros((len(nodes),) * 2)
    for x, y in edges:
        a[nodes.index(x), nodes.index(y)] = a[nodes.index(y), nodes.index(x)] = 1
    d = 1 / np.sqrt(a.sum(axis=0))
    return np.linalg.eigvalsh(np.eye(len(nodes)) - d[:, None] * a * d)[1]


def test_fiedler_value_of_large_graphs(spark):
    """Chains have a closed form: 1 - cos(pi / (n - 1)); a grid is held against its whole matrix."""
    chain = spark.range(9_999).selectExpr("id AS a", "id + 1 AS b")
    r = matching.fiedler_value(chain, matching.components(chain)).first()
    want = 1 - np.cos(np.pi / 9_999)
    assert (r.component, r.n) == (0, 10_000) and abs(r.fiedler / want - 1) < 1e-6
    side = 20
    across = spark.range(side * side).where(f"id % {side} < {side - 1}").selectExpr("id AS a", "id + 1 AS b")
    down = spark.range(side * (side - 1)).selectExpr("id AS a", f"id + {side} AS b")
    grid = across.union(down)
    comp = matching.components(grid)
    want = _fiedler_by_hand([tuple(e) for e in grid.collect()], list(range(side * side)))
    assert abs(matching.fiedler_value(grid, comp, dense=2).first().fiedler / want - 1) < 1e-6
    with pytest.raises(ValueError, match="not known"):  # three steps don't reach across the chain
        matching.fiedler_value(chain.where("a < 40"), matching.components(chain.where("a < 40")), rounds=3, dense=2, sparse=0)


def test_fiedler_value_with_and_without_the_matrix(spark):
    edges = [(i, i + 1) for i in range(1, 8)] + [(1, 5), (2, 7), (20, 21)]
    pairs = spark.createDataFrame(edges, "a long, b long")
    comp = matching.components_of(spark.range(1, 9).union(spark.range(20, 23)).toDF("node"), pairs)
    assert comp.select("component").distinct().count() == 3
    want = _fiedler_by_hand(edges[:-1], list(range(1, 9)))
    for dense, sparse in ((100, 100), (0, 100), (0, 0)):
        r = matching.fiedler_value(pairs, comp, dense=dense, sparse=sparse).first()
        assert (r.component, r.n) == (1, 8) and abs(r.fiedler - want) < 1e-6
    alone = matching.components_of(spark.range(3).toDF("node"), pairs.limit(0))
    assert matching.fiedler_value(pairs.limit(0), alone).first().fiedler == 0
    assert matching.fiedler_value(pairs.limit(0), alone.limit(0)).count() == 0


def test_scoreboard_without_pairs(spark):
    none = spark.createDataFrame([("000001.png", None, 0), ("000002.png", "000001.png", 3)], "a string, b string, inliers long")
    named = spark.createDataFrame([("000009.png",)], "node string")
    stats = spark.range(1).selectExpr(*(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("average_track_length", "reprojection_error_pixels", "initial_shots", "reconstructed_shots", "ce90", "le90")))
    r = matching.scoreboard(none, named, spark.createDataFrame([], "length long, n long"), stats, none.where("false").select("a", "b")).first()
    assert (r.n_images, r.solid_pairs, r.mean_inliers, r.match_graph_components, r.algebraic_connectivity, r.cross_track_solid_ratio, r.recon_shot_frac) == (3, 0, 0.0, 3, 0.0, 0.0, 0.0)
    assert r.covis_recall is None and r.covis_precision is None and r.gps_ce90 is None


def test_covisibility_gate_and_isolated_frames(spark):
    down, back = -1.5, 2.6
    rows = [(1, 0, 0.0, 0.0, down, 0.0), (1, 1, 3.0, 4.0, down, 0.1), (1, 2, 0.0, 0.0, -0.5, 0.0), (1, 3, 0.0, 0.0, -0.5, back), (1, 4, 9.0, 0.0, None, 0.0), (1, 5, 0.0, 0.0, down, 0.0)]
    frames = spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, pitch_rad double, yaw_rad double")
    cells = spark.createDataFrame([(1, f, c, 0, f != 5) for f in range(6) for c in range(3)] + [(1, 9, 0, 0, True)], "flight long, frame long, cx long, cy long, footprint_valid boolean")
    edges = matching.covis_edges(cells.where("footprint_valid"), frames)
    got = {(r.i, r.j): r for r in edges.collect()}
    assert set(got) == {(0, 1), (0, 4), (1, 4), (2, 4), (3, 4)} and got[0, 1].dist_m == 5 and got[0, 4].view_angle_deg is None
    vertices = matching.covis_vertices(frames, cells)
    assert sorted(r.frame for r in vertices.collect()) == [0, 1, 2, 3, 4]
    summary = matching.covis_summary(vertices, edges).first()
    assert (summary.n, summary.n_edges, summary.n_cross, summary.cross_share, summary.degree_max) == (5, 5, 0, 0.0, 4)


def test_failed_health_is_an_exception(spark):
    ok = spark.createDataFrame([(1, True, []), (2, False, ["no frames selected"])], "flight long, passed boolean, failures array<string>")
    reports.require_passed(ok.where("passed"))
    with pytest.raises(reports.SelectionFailed, match="2: no frames selected"):
        reports.require_passed(ok)


def test_health_of_flights_without_selection_or_cells(spark):
    rows = [(1, 0, 0.0, 0.0, 10.0, False), (2, 0, 0.0, 0.0, 10.0, True), (2, 9, 300.0, 0.0, 10.0, True)]
    labelled = spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, altamsl double, selected boolean")
    cells = spark.createDataFrame([(1, 0, 0, 0, True)], "flight long, frame long, cx long, cy long, footprint_valid boolean")
    p = selection.SelectionParams()
    got = {r.flight: r for r in reports.health(labelled, cells, p, reports.convergence(labelled, cells, 5.0, 5.0)).collect()}
    assert got[1].failures == ["no frames selected"] and not got[1].passed and got[1].max_motion_gap_m == 0
    assert got[2].passed and got[2].max_temporal_gap == 9 and got[2].warnings == ["motion gap over the limit"] and got[2].largest_cluster == [0]


def _record(tmp_path):
    folder = tmp_path / "raw" / "flight-a"
    (folder / "_derived").mkdir(parents=True)
    (folder / "intrinsicK.csv").write_text("2000,0,960\n\n0,2010,540\n0,0,1\n-0.1,0.02,0.001,-0.001,0\n")
    (folder / "v.mp4").write_bytes(b"video")
    lines = ["FrameNumber,TimeUS,easting,northing,altamsl,utm_zone,roll_rad,pitch_rad,yaw_rad,extra"]
    lines += [f"{f},{f}00,{e},0,100,33U,0,-1.57,0,{k}" for f, e, k in ((3, 30, "a"), (1, 10, "b"), (3, 99, "c"), (2, "nan", "d"))]
    (folder / "_derived" / "gt_v.csv").write_text("\n".join(lines))
    return folder


def test_records_and_their_readers(spark, tmp_path):
    folder = _record(tmp_path)
    r = readers.Record.from_path(str(folder))
    assert (r.slug, r.stream_id, r.data_root) == ("flight-a", "v", tmp_path)
    poses = readers.read_poses(spark, str(r.poses_path), r.slug)
    assert {(p.FrameNumber, p.easting, p.extra) for p in poses.collect()} == {(1, 10.0, "b"), (2, None, "d"), (3, 30.0, "a")}
    camera = readers.read_intrinsics(str(r.intrinsics), 1920, 1080)
    assert (camera.fx, camera.fy, camera.cx, camera.k1, camera.p2) == (2000, 2010, 960, -0.1, -0.001)
    (folder / "w.mp4").write_bytes(b"")
    assert readers.Record.from_path(str(folder)).stream_id == "v"  # it has no poses
    (folder / "_derived" / "gt_w.csv").write_text("")
    with pytest.raises(ValueError):
        readers.Record.from_path(str(folder))
    with pytest.raises(ValueError):
        readers.read_poses(spark, str(r.intrinsics), "x")
    (folder / "w.mp4").unlink()
    for gone in ("_derived/gt_v.csv", "intrinsicK.csv"):
        (folder / gone).rename(folder / "moved")
        with pytest.raises(FileNotFoundError):
            readers.Record.from_path(str(folder))
    with pytest.raises(FileNotFoundError):
        readers.Record.from_path(str(tmp_path / "nowhere"))


def test_runs_by_name(tmp_path):
    for name in ("20240102030405", "20250102030405", "2025", "x0250102030405"):
        (tmp_path / name).mkdir()
    assert [p.name for p in readers.list_runs(str(tmp_path))] == ["20240102030405", "20250102030405"]
    assert readers.resolve_run(str(tmp_path)).name == "20250102030405" and readers.resolve_run(str(tmp_path), "20240102030405").name == "20240102030405"
    for call in (lambda: readers.resolve_run(str(tmp_path), "20200101000000"), lambda: readers.latest_run(str(tmp_path / "2025"))):
        with pytest.raises(FileNotFoundError):
            call()
    assert readers.list_runs(str(tmp_path / "none")) == [] and len(readers.run_stamp()) == 14


def test_scores_are_stored_for_their_video(spark, tmp_path):
    record, folder, calls = readers.Record.from_path(str(_record(tmp_path))), str(tmp_path / "scores"), []

    def score(r):
        calls.append(r)
        return selection.init_candidates(spark.createDataFrame([(1, 5.0)], "frame long, easting double")).withColumn("selected", selection.F.lit(True))

    for rescore in (False, False, True):
        got = sinks.load_or_score(spark, record, folder, score, rescore).first()
        assert not got.selected and got.easting == 5.0 and got.reject_reason is None
    assert len(calls) == 2
    record.video.write_bytes(b"another video")
    assert not readers.scores_are_current(folder, record)


def test_footprints_of_other_parameters_are_refused(spark, tmp_path):
    sinks.save_footprints(spark.range(2).toDF("frame"), str(tmp_path / "f"), "abc")
    assert readers.load_footprints(spark, str(tmp_path / "f"), "abc").columns == ["frame"]
    with pytest.raises(ValueError):
        readers.load_footprints(spark, str(tmp_path / "f"), "abd")


def test_geo_and_selected_images(spark, tmp_path):
    rows = spark.createDataFrame([(12, 2.5, 3.0, 4.0), (7, 1.0, 2.0, 3.0)], "frame long, easting double, northing double, altamsl double")
    sinks.write_geo(rows, "33U", str(tmp_path / "geo.txt"))
    assert (tmp_path / "geo.txt").read_text().splitlines() == ["WGS84 UTM 33U", "000007.png 1.0 2.0 3.0", "000012.png 2.5 3.0 4.0"]
    assert {tuple(r) for r in readers.read_geo(spark, str(tmp_path / "geo.txt")).collect()} == {("000007.png", 1.0, 2.0), ("000012.png", 2.5, 3.0)}
    with pytest.raises(ValueError):
        sinks.write_geo(rows.limit(0), "33U", str(tmp_path / "none.txt"))
    (tmp_path / "audit.csv").write_text("FrameNumber,selected\n4,no\n5,Yes \n6,TRUE\n")
    (tmp_path / "build.json").write_text(json.dumps({"selected_frame_numbers": [8]}))
    names = lambda a: sorted(r.name for r in readers.selected_images(spark, str(tmp_path / a), str(tmp_path / "build.json")).collect())
    assert names("audit.csv") == ["000005.png", "000006.png"] and names("absent.csv") == ["000008.png"]


def test_matcher_options(spark, tmp_path):
    vertices = spark.createDataFrame([(1, i, 4.0 * i, 0.0) for i in range(30)], "flight long, frame long, easting double, northing double")
    edges = spark.createDataFrame([(1, i, j, 4.0 * (j - i)) for i in range(30) for j in range(i + 1, min(30, i + 11))], "flight long, i long, j long, dist_m double")
    read = lambda n: json.loads((tmp_path / n).read_text())
    assert sinks.write_matcher_profile(str(tmp_path), "c.json", vertices, edges) == 20 == read("odm_options.json")["matcher_neighbors"]
    assert read("matching_profile.json")["profile"]["gps_distance_m"] == 40.0 and read("odm_options.json")["cameras"] == "c.json"
    assert sinks.write_matcher_profile(str(tmp_path), "c.json", vertices, edges.limit(0)) == audit.matcher_neighbours(vertices, 33.0).first().neighbours
    sinks.write_camera(CAMERA, str(tmp_path / "cam.json"))
    assert read("cam.json")["v2   1920 1080 brown 0.85"]["c_x"] == 0


def _report_holds_all_blocks(spark, run, tmp_path):
    """What build wrote, read back, and what report makes of the saved audit table alone."""
    one, again = (spark.read.json(str(p)).first().asDict(recursive=True) for p in (run / "report/summary", tmp_path / "again/summary"))
    chosen = list(range(0, 40, 3))
    for got in (one, again):
        assert got["constants"]["spacing_m"] == 9.0 and got["constants"]["ray_grid"] == [12, 7]
        assert [(g["from_frame"], g["to_frame"], g["gap_m"]) for g in got["temporal_gaps"]] == [(a, b, 9.0) for a, b in zip(chosen, chosen[1:])]
        assert got["coverage_gaps"] == [] and got["n_coverage_gaps"] == 0
        assert got["decisions"]["selection_reason_counts"] == {"keyframe": 14}
        assert got["health"]["passed"] and got["health"]["n_selected"] == 14 and got["health"]["n_mission"] == got["n_mission"]
        holes = got["insight"]["coverage_holes"]
        assert sum(h["size"] for h in holes["largest_holes"]) == holes["n_under_target"] == got["n_mission"] - got["n_at_target"]
        assert got["insight"]["parallax"]["n_covered"] == got["n_covered"] > 0
    heads = [h["centroid_e"] for h in one["insight"]["coverage_holes"]["largest_holes"]]
    assert all(-100 < e < 400 for e in heads)  # on the map, around the flight
    same = {"n_candidates", "n_selected", "reject_counts", "decisions", "temporal_gaps", "quality_min", "views_histogram"}
    assert {k: one[k] for k in same} == {k: again[k] for k in same}


def _scores_of_another_video(spark, folder, tmp_path, cli):
    """Scores are stored once, taken from the store, and refused when the video is another."""
    def build(scored, run, *more):
        cli.main(["build", str(folder), str(tmp_path / scored), str(tmp_path / "dtm"), str(tmp_path / "out"), "--run", run, "--spacing-m", "9", "--ray-grid", "12", "7", *more])
        return json.loads((tmp_path / "out" / "flight-a" / "runs" / run / "build.json").read_text())["n_candidates"]

    spark.read.parquet(str(tmp_path / "scored")).where("frame < 30").write.parquet(str(tmp_path / "fewer"))
    assert build("fewer", "20260101000001") == 40 and build("absent", "20260101000002", "--select-only") == 40
    assert build("fewer", "20260101000003", "--rescore") == 30
    next(folder.glob("*.mp4")).write_bytes(b"another video of the flight")
    with pytest.raises(ValueError, match="no scores of"):
        build("fewer", "20260101000004", "--select-only")


def test_build_prepare_and_report_commands(spark, tmp_path, capsys):
    from framewright import cli

    folder = _record(tmp_path)
    rows = [(i, 100.0 + 3 * i, 200.0, 90.0, "33U", 0.0, -1.5, 1.5, float(i % 5), float(i % 3)) for i in range(40)]
    spark.createDataFrame(rows, "frame long, easting double, northing double, altamsl double, utm_zone string, roll_rad double, pitch_rad double, yaw_rad double, feature_count double, sharpness double").write.parquet(str(tmp_path / "scored"))
    np.save(tmp_path / "dtm.npy", FLAT.z)
    (tmp_path / "dtm.json").write_text(json.dumps({"origin_e": -1000.0, "origin_n": 2000.0, "cell": 10.0}))
    cli.main(["build", str(folder), str(tmp_path / "scored"), str(tmp_path / "dtm"), str(tmp_path / "out"), "--run", "20260101000000", "--spacing-m", "9", "--ray-grid", "12", "7"])
    run = tmp_path / "out" / "flight-a" / "runs" / "20260101000000"
    assert capsys.readouterr().out.strip() == str(run)
    manifest = json.loads((run / "build.json").read_text())
    assert manifest["selected_frame_numbers"] == list(range(0, 40, 3)) and manifest["selection_constants"]["ray_grid"] == [12, 7]
    assert len((run / "odm_input/geo.txt").read_text().splitlines()) == 15
    assert spark.read.json(str(run / "report/health")).first().passed
    neighbours = json.loads((run / "odm_input/odm_options.json").read_text())["matcher_neighbors"]
    assert neighbours >= 8
    cli.main(["prepare", str(folder), str(run)])
    assert json.loads((run / "odm_input/odm_options.json").read_text())["matcher_neighbors"] == 6
    cli.main(["report", str(run), str(tmp_path / "scored"), str(run / "footprints"), str(tmp_path / "again")])
    assert spark.read.json(str(tmp_path / "again/summary")).first().n_selected == 14
    _report_holds_all_blocks(spark, run, tmp_path)
    cli.main(["report", str(run), str(tmp_path / "scored"), str(run / "footprints"), str(tmp_path / "anew"), "--force"])
    assert spark.read.json(str(tmp_path / "anew/summary")).first().n_selected == 14
    cli.main(["resolve-run", str(run.parent)])
    assert capsys.readouterr().out.strip().endswith("20260101000000")
    _scores_of_another_video(spark, folder, tmp_path, cli)


def test_streams(spark, tmp_path):
    rows = [(1, i, float(3 * i), 0.0) for i in range(20)]
    whole = spark.createDataFrame(rows, "flight long, frame long, easting double, northing double")
    for k in range(2):
        whole.where(f"frame DIV 10 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for name, df, mode in (("kept", selection_stream.spacing_stream(arriving, 7.0), "append"), ("views", selection_stream.view_counts_stream(arriving.selectExpr("flight", "frame DIV 7 AS cx", "0L AS cy")), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted(r.frame for r in spark.table("kept").collect()) == sorted(r.frame for r in selection.spacing_superset(whole, 7.0).collect())
    assert {(r.cx, r.views) for r in spark.table("views").collect()} == {(0, 7), (1, 7), (2, 6)}
