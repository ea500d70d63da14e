"""Co-visibility of hovering flights: the same edges as by pairs of sets, and few rows on the way."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from framewright.operators import matching

SCHEMA = "flight string, frame long, easting double, northing double, pitch_rad double, yaw_rad double"


def _flights(n_hover):
    """A hovering flight with footprints of different widths, and one that moves."""
    rng, frames, sets = np.random.default_rng(4), [], {}
    for f in range(n_hover):
        w, h, x, y = rng.integers(3, 12), rng.integers(3, 12), *rng.integers(-3, 4, 2)
        frames.append(("hover", f, float(x), float(y), -1.5, float(f % 3)))
        sets["hover", f] = {(int(x + i), int(y + j)) for i in range(w) for j in range(h)}
    for f in range(60):
        frames.append(("line", f, 4.0 * f, 0.0, None if f % 7 == 0 else -1.2, 0.01 * f))
        sets["line", f] = {(4 * f + i, j) for i in range(-6, 7) for j in range(-2, 3)} if f % 11 else set()
    return frames, sets


@pytest.mark.parametrize("most", [40, 512])
def test_edges_equal_pairs_of_sets(spark, monkeypatch, most):
    monkeypatch.setattr(matching.block_overlaps, "__defaults__", (most,))
    rows, sets = _flights(150)
    frames = spark.createDataFrame(rows, SCHEMA)
    cells = spark.createDataFrame([(*k, x, y) for k, s in sets.items() for x, y in s], "flight string, frame long, cx long, cy long")
    got = {(r.flight, r.i, r.j): (r.shared, round(r.iom, 9)) for r in matching.covis_edges(cells, frames, max_angle_deg=None).collect()}
    want = {}
    for (a, i), (b, j) in combinations(sorted(sets), 2):
        n, least = len(sets[a, i] & sets[b, j]), min(len(sets[a, i]), len(sets[b, j]))
        if a == b and n and n / least >= 0.10:
            want[a, i, j] = n, round(n / least, 9)
    assert got == want


def test_few_rows_for_each_pair_of_a_hovering_flight(spark):
    """20,000 frames of one spot would be 2 x 10**8 pairs times the cells that two share; here 1,400 frames stand for them."""
    n, width = 1400, 20
    cells = spark.range(n).selectExpr("'h' AS flight", "id AS frame", f"explode(sequence(0, {width * width - 1})) AS c").selectExpr("flight", "frame", f"CAST(c % {width} + frame % 5 AS BIGINT) AS cx", f"CAST(c DIV {width} + frame % 3 AS BIGINT) AS cy")
    made = matching.block_overlaps(cells)
    pairs = n * (n - 1) // 2
    found = made.selectExpr("count(*) AS rows", "sum(shared) AS shared").first()
    assert pairs <= found.rows <= 4 * pairs
    sets = {f: {(c % width + f % 5, c // width + f % 3) for c in range(width * width)} for f in range(15)}
    of = np.array([[len(sets[a] & sets[b]) for b in range(15)] for a in range(15)])
    kind = np.arange(n) % 15
    assert found.shared == (of[kind][:, kind].sum() - of[kind, kind].sum()) // 2
