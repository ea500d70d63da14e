"""The coverage cull in rounds against the walk frame by frame."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from framewright.operators import selection


def _walk(frames, cells, floor):
    """Survivors of one flight: frames (quality, frame), cells by frame."""
    count, left = Counter(c for f in frames for c in cells[f[1]]), set()
    for _, f in sorted(frames):
        if cells[f] and all(count[c] > floor for c in cells[f]):
            count.subtract(cells[f])
        else:
            left.add(f)
    return left


def _flights():
    rng, out = np.random.default_rng(8), {}
    for flight, n, width in (("few", 12, 3), ("line", 150, 60), ("crowd", 200, 4), ("ties", 80, 6)):
        cells = {f: {(int(x), int(y)) for x, y in rng.integers(0, width, (rng.integers(0, 7), 2))} for f in range(n)}
        out[flight] = [(float(rng.integers(0, 3) if flight == "ties" else rng.random()), f) for f in range(n)], cells
    out["same"] = [(k / 10, k) for k in range(10)], {k: {(0, 0), (0, 1)} for k in range(10)}
    return out


@pytest.mark.parametrize("floor", [0, 1, 3])
def test_rounds_equal_the_walk(spark, floor):
    flights = _flights()
    frames = spark.createDataFrame([(name, f, q) for name, (fs, _) in flights.items() for q, f in fs], "flight string, frame long, quality_score double")
    cells = spark.createDataFrame([(name, f, *c) for name, (_, cs) in flights.items() for f, own in cs.items() for c in own], "flight string, frame long, cx long, cy long")
    got = {(r.flight, r.frame) for r in selection.coverage_cull(frames, cells, floor).collect()}
    assert got == {(name, f) for name, (fs, cs) in flights.items() for f in _walk(fs, cs, floor)}
    if floor == 3:
        assert {f for name, f in got if name == "same"} == {7, 8, 9}


def test_hovering_takes_two_rounds(spark):
    """20,000 frames over the same four cells: all but the best five go at once, and then those stay."""
    frames = spark.range(20_000).selectExpr("'h' AS flight", "id AS frame", "CAST((id * 7919) % 20011 AS DOUBLE) AS quality_score")
    cells = frames.selectExpr("flight", "frame", "explode(array(0L, 1L)) AS cx").selectExpr("*", "explode(array(0L, 1L)) AS cy")
    gone, rounds = selection.culled(frames, cells, 5)
    assert (gone.count(), rounds) == (19_995, 2)
    best = {r.frame for r in frames.orderBy("quality_score", ascending=False).limit(5).collect()}
    assert {r.frame for r in selection.coverage_cull(frames, cells, 5).collect()} == best
