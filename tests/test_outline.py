"""Outlines of covered cells against the cells themselves."""

from __future__ import annotations

import random
import re

import pytest

from framewright.operators import outline


def _rings(wkt: str) -> list[list[tuple[float, float]]]:
    return [[tuple(map(float, p.split())) for p in r.split(", ")] for r in re.findall(r"\(([^()]+)\)", wkt)]


def _area(ring) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def _inside(ring, x: float, y: float) -> bool:
    """Whether the upright sides to the right of the point are odd in number."""
    return sum(a[0] == b[0] and a[0] > x and min(a[1], b[1]) < y < max(a[1], b[1]) for a, b in zip(ring, ring[1:])) % 2 == 1


def _parts(cells: set) -> list[set]:
    left, parts = set(cells), []
    while left:
        part, front = set(), [left.pop()]
        while front:
            x, y = front.pop()
            part.add((x, y))
            near = left & {(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)}
            left -= near
            front += near
        parts.append(part)
    return parts


SHAPES = {
    "one": {(0, 0)},
    "touching": {(0, 0), (1, 1)},
    "ring": {(x, y) for x in range(5) for y in range(5)} - {(2, 2)},
    "two holes that touch": {(x, y) for x in range(6) for y in range(6)} - {(2, 2), (3, 3)},
    "closed by a corner": {(0, 0), (1, 0), (2, 0), (2, 1), (0, 1), (0, 2), (1, 2), (1, 3), (2, 3), (3, 3), (3, 2), (3, 1)} - {(2, 1)},
    "island": {(x, y) for x in range(9) for y in range(9)} - {(x, y) for x in range(2, 7) for y in range(2, 7)} | {(4, 4)},
    "holes above each other": {(x, y) for x in range(3) for y in range(30)} - {(1, y) for y in range(1, 29, 2)},
    "long": {(x, 0) for x in range(-700, 700)} | {(699, y) for y in range(90)},
}


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(5)
    noise = {f"noise {share}": {(x, y) for x in range(-12, 12) for y in range(-12, 12) if rng.random() < share} for share in (0.3, 0.5, 0.62, 0.8)}
    return SHAPES | noise


def test_outline_covers_the_cells(spark, shapes):
    rows = [(f, x, y) for f, cells in shapes.items() for x, y in cells]
    rows += rows[:50] + [(None, 1, 1), ("one", None, 0)]
    rings, bends = outline.outline(spark.createDataFrame(rows, "flight string, cx long, cy long"))
    totals: dict[str, int] = {}
    for r in rings.collect():
        totals[r.flight] = totals.get(r.flight, 0) + r.area
        assert r.hole == (r.area < 0)
    assert totals == {f: len(c) for f, c in shapes.items()}
    found: dict[str, list] = {}
    for r in outline.polygons(bends, 1.0, 1.0).collect():
        parts = _rings(r.wkt)
        assert len(parts) == r.n_holes + 1 and _area(parts[0]) > 0 and all(_area(h) < 0 for h in parts[1:])
        assert all(len(set(p[:-1])) == len(p) - 1 and p[0] == p[-1] for p in parts)
        found.setdefault(r.flight, []).append(parts)
    for flight, cells in shapes.items():
        want = sorted(map(sorted, _parts(cells)))
        boxes = [(x, y) for x in range(min(c[0] for c in cells), max(c[0] for c in cells) + 1) for y in range(min(c[1] for c in cells), max(c[1] for c in cells) + 1)]
        got = sorted(sorted(c for c in boxes if _inside(p[0], c[0] + 0.5, c[1] + 0.5) and not any(_inside(h, c[0] + 0.5, c[1] + 0.5) for h in p[1:])) for p in found[flight])
        assert got == want, flight


def test_outline_scale_and_rounds(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 1, 0)], "flight long, cx long, cy long")
    _, bends = outline.outline(cells)
    assert [r.wkt for r in outline.polygons(bends, 50, 10, (100.0, -5.0)).collect()] == ["POLYGON ((200.00 -5.00, 200.00 5.00, 100.00 5.00, 100.00 -5.00, 200.00 -5.00))"]
    strip = spark.range(1000).selectExpr("1 AS flight", "id AS cx", "0 AS cy")
    points = outline.corners(outline.border(strip))
    ranks, rounds = outline.numbered(outline.links(points, outline.F.lit(outline.LEFT)))
    assert ranks.count() == 2002 and ranks.select("ahead").distinct().count() == 2002 and rounds <= 13
    rings, bends = outline.outline(cells.limit(0))
    assert rings.count() == 0 == outline.polygons(bends, 1, 1).count()
