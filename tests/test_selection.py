from __future__ import annotations

from framewright.operators import audit, selection


def _line(spark, n, step, quality=lambda i: 0.5):
    return spark.createDataFrame([(1, i, float(i * step), 0.0, quality(i)) for i in range(n)], "flight long, frame long, easting double, northing double, quality_score double")


def test_spacing(spark):
    kept = sorted(r.frame for r in selection.spacing_superset(_line(spark, 60, 2), 8.0).collect())
    assert kept == list(range(0, 60, 4))


def test_budget_keeps_the_best_of_each_stretch(spark):
    frames = _line(spark, 10, 5, lambda i: 1.0 if i in (3, 8) else 0.5)
    assert sorted(r.frame for r in selection.thin_to_cap(frames, 2).collect()) == [3, 8]


def test_coverage_cull(spark):
    frames = _line(spark, 10, 5, lambda i: i / 10)
    cells = spark.createDataFrame([(1, i, 0, y) for i in range(10) for y in (0, 1)], "flight long, frame long, cx long, cy long")
    assert sorted(r.frame for r in selection.coverage_cull(frames, cells, 3).collect()) == [7, 8, 9]


def test_neighbours_on_a_line(spark):
    assert audit.matcher_neighbours(_line(spark, 100, 4), 33.0).first().neighbours == 16
    assert audit.matcher_neighbours(_line(spark, 1, 4), 33.0).first().neighbours == 0


def test_nearest_ignores_coincident_selected(spark):
    rows = [(1, 0, 0.0, 0.0, True), (1, 1, 0.0, 0.0, True), (1, 2, 500.0, 0.0, True), (1, 3, 40.0, 0.0, False), (2, 0, 0.0, 0.0, True)]
    got = audit.nearest_selected(spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, selected boolean")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 0, 500.0), (1, 1, 500.0), (1, 2, 500.0), (1, 3, 40.0), (2, 0, None)], key=str)
