"""Counts within a radius, and nearest keyframes, of crowded and sparse flights, against all pairs in numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.operators import audit

SCHEMA = "flight string, frame long, easting double, northing double"


def _points(seed=2):
    rng, rows = np.random.default_rng(seed), []
    rows += [("spot", k, *map(float, rng.choice([0.0, 0.5, 10.0], 2))) for k in range(300)]  # many frames a position
    rows += [("disc", k, *map(float, rng.normal(0, 4, 2))) for k in range(500)]
    rows += [("line", k, 3.0 * k, -100.0) for k in range(200)]
    rows += [("grid", k, float(k % 20), float(k // 20)) for k in range(400)]  # distances equal to the radius
    rows += [("lone", 0, 1.0, 1.0), ("line", 900, None, 3.0), ("lone", 1, None, None)]
    return rows


def _counts(rows, radius):
    out = {}
    for flight in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == flight and None not in r]
        p = np.array([r[2:] for r in own])
        d2 = ((p[:, None] - p[None]) ** 2).sum(-1)
        out |= {(flight, r[1]): int(n) - 1 for r, n in zip(own, (d2 <= radius * radius).sum(1), strict=True)}
    return out | {r[:2]: 0 for r in rows if None in r}


@pytest.mark.parametrize("most", [1, 50, 65_536])
def test_counts_equal_all_pairs(spark, most):
    rows = _points()
    points = spark.createDataFrame(rows, SCHEMA)
    for radius in (5.0, 10.0):
        got = audit.neighbour_counts(points, radius, most).collect()
        assert {(r.flight, r.frame): r.n for r in got} == _counts(rows, radius) and len(got) == len(rows)


def test_a_crowd_is_counted_without_its_pairs(spark):
    """60,000 frames that hover within the radius are one box: 3.6 x 10**9 pairs, none of which is made."""
    points = spark.range(60_000).select(F.lit("h").alias("flight"), F.col("id").alias("frame"), (F.rand(1) * 4).alias("easting"), (F.rand(2) * 4).alias("northing"))
    counts = audit.neighbour_counts(points, 33.0)
    assert counts.groupBy("n").count().collect() == [(59_999, 60_000)]
    assert [(r.flight, r.neighbours) for r in audit.matcher_neighbours(points, 33.0).collect()] == [("h", 59_999)]


def test_density_lists_the_first_members(spark):
    rows = _points()
    got = {r.flight: r for r in audit.local_density(spark.createDataFrame(rows, SCHEMA), 5.0, 4).collect()}
    want = _counts(rows, 5.0)
    at = {r[:2]: r[2:] for r in rows}
    for flight, r in got.items():
        n, frame = min((-n, k[1]) for k, n in want.items() if k[0] == flight)
        e, m = at[flight, frame]
        inside = sorted(k[1] for k, p in at.items() if k[0] == flight and None not in p and (p[0] - e) ** 2 + (p[1] - m) ** 2 <= 25.0)
        assert (r.frame, r.population, r.members) == (frame, 1 - n, inside[:4])


def test_nearest_keyframes_equal_all_pairs(spark):
    rng = np.random.default_rng(6)
    rows = [(*r, bool(rng.random() < {"spot": 0.1, "disc": 0.5, "line": 0.05, "grid": 0.02}.get(r[0], 1.0))) for r in _points()]
    rows += [("far", k, *map(float, rng.normal(0, 1, 2)), False) for k in range(50)] + [("far", 50 + k, 1e6 + k, 1e6, True) for k in range(40)]
    rows += [("none", k, float(k), 0.0, False) for k in range(5)] + [("one", 0, 0.0, 0.0, True), ("one", 1, 0.0, 0.0, True), ("one", 2, 3.0, 4.0, False)]
    frames = spark.createDataFrame(rows, f"{SCHEMA}, selected boolean")
    want = {}
    for flight in {r[0] for r in rows}:
        chosen = np.array([r[2:4] for r in rows if r[0] == flight and r[4] and None not in r]).reshape(-1, 2)
        for _, frame, e, n, selected in (r for r in rows if r[0] == flight):
            d = [] if e is None or n is None else [x for x in np.hypot(chosen[:, 0] - e, chosen[:, 1] - n) if x > 0 or not selected]
            want[flight, frame] = round(float(min(d)), 6) if len(d) else None
    got = audit.nearest_selected(frames).collect()
    assert len(got) == len(rows)
    assert [(r, want[r.flight, r.frame]) for r in got if (None if r.dist_m is None else round(r.dist_m, 6)) != want[r.flight, r.frame]] == []
