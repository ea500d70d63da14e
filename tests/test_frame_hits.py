"""Rays of many frames at once, against one frame at a time; hulls of many sets against a plain chain; what is looked up and walked."""

from __future__ import annotations

import numpy as np
import pytest

from framewright.functions import geometry
from framewright.functions.geometry import Camera, Ground, Terrain, first_hits, frame_hits, hull_texts, outer_rays, rotation, rotations

RNG = np.random.default_rng(5)
CAMERAS = [Camera(2275.0, 2275.0, 960.0, 540.0, 1920, 1080), Camera(900.0, 910.0, 960.0, 540.0, 1920, 1080, -0.2, 0.03, 0.002, -0.001)]


def hills(kind: str) -> Terrain:
    r, c = np.mgrid[:220, :260]
    z = (20 + 10 * np.sin(c / 9) + 6 * np.cos(r / 13)).astype("float32")
    if kind == "unknown":
        z[100:104], z[40, 50], z[150:152, 90:92] = -9999, np.nan, 95
        return Terrain(z, 1000.0, 5000.0, 10.0, -9999.0, 2.5)
    return Terrain((z * 10).astype("int16") if kind == "whole" else z, 1000.0, 5000.0, 10.0)


def poses(n: int) -> dict[str, np.ndarray]:
    """Over the terrain, around it, below its ground, and some that look up or are unknown."""
    p = {"e": RNG.uniform(500, 4000, n), "n": RNG.uniform(2500, 5400, n), "z": np.where(np.arange(n) % 9 == 0, RNG.uniform(5, 25, n), RNG.uniform(60, 260, n)), "roll": RNG.uniform(-0.3, 0.3, n), "pitch": RNG.uniform(-1.5708, 0.2, n), "yaw": RNG.uniform(-3.2, 3.2, n)}
    p["pitch"][1::7] = -np.pi / 2
    return p


@pytest.mark.parametrize("kind", ["plain", "unknown", "whole"])
@pytest.mark.parametrize("camera", CAMERAS)
def test_hits_equal_those_of_one_frame_at_a_time(kind, camera):
    t, p, rays = hills(kind), poses(120), camera.rays(camera.sample_grid(12, 7))
    turned = rotations(p["roll"], p["pitch"], p["yaw"])
    got = frame_hits(Ground(t), np.array([p["e"], p["n"], p["z"]]), turned, rays, outer_rays(rays))
    met = 0
    for k in range(120):
        turn = rotation(p["roll"][k], p["pitch"][k], p["yaw"][k])
        assert np.allclose(turned[:, :, k], turn, atol=1e-12)
        want = first_hits(t, np.repeat([[p["e"][k], p["n"][k], p["z"][k]]], len(rays), axis=0), rays @ turn.T)
        assert np.allclose(got[:, :, k].T, want, atol=1e-6, equal_nan=True)
        met += np.isfinite(want[:, 0]).sum()
    assert met > 1000


def test_odd_ground_and_frames():
    rays = CAMERAS[0].rays(CAMERAS[0].sample_grid(4, 3))
    down = lambda n: rotations(np.zeros(n), np.full(n, -np.pi / 2), np.zeros(n))
    at = np.array([[1050.0, np.nan, 1050.0], [4950.0, 4950.0, 4950.0], [100.0, 100.0, np.nan]])
    got = frame_hits(Ground(hills("plain")), at, down(3), rays, outer_rays(rays))
    assert np.isfinite(got[:, :, 0]).all() and np.isnan(got[:, :, 1:]).all()
    for z in (np.full((5, 5), np.nan), np.zeros((0, 0)), np.zeros((0, 5))):
        assert np.isnan(frame_hits(Ground(Terrain(z, 1000.0, 5000.0, 10.0)), at, down(3), rays, outer_rays(rays))).all()
    assert frame_hits(Ground(hills("plain")), np.zeros((3, 0)), down(0), rays, outer_rays(rays)).shape == (3, 12, 0)


def chain_wkt(points: np.ndarray) -> str:
    p = np.unique(np.round(points, 2), axis=0)

    def chain(seq):
        out = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out

    ring = [*chain(p)[:-1], *chain(p[::-1])[:-1]] if len(p) > 2 else list(p)
    return "POLYGON ((" + ", ".join(f"{x:.2f} {y:.2f}" for x, y in [*ring, *ring[:1]]) + "))" if len(p) else "POLYGON EMPTY"


def test_hulls_equal_a_plain_chain():
    line = np.arange(40)[:, None] * [2.9, -1.33] + [694.15, 180.44]
    square = np.array([(x, y) for x in range(6) for y in range(6)], float)
    sets = [RNG.normal(0, 100, (800, 2)), np.zeros((0, 2)), line, square, np.array([[7.0, 8.0]] * 3), np.array([[1.0, 2.0], [3.0, -0.001]]), RNG.uniform(0, 0.06, (50, 2)), np.stack([np.arange(200.0), np.arange(200.0) ** 2], axis=1), np.zeros((0, 2))]
    points, which = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = RNG.permutation(len(points))
    assert hull_texts(*points[order].T, which[order], len(sets)) == [chain_wkt(x) for x in sets]
    # too far apart for one number of 64 bits
    assert hull_texts(*(points[order].T + 1e9 * (which[order] % 2)), which[order], len(sets))[3] == "POLYGON ((1000000000.00 1000000000.00, 1000000005.00 1000000000.00, 1000000005.00 1000000005.00, 1000000000.00 1000000005.00, 1000000000.00 1000000000.00))"


def test_few_heights_are_looked_up_and_few_points_walked(monkeypatch):
    """Before, a footprint walked through all its points, and rays of several frames looked up heights from the first step of any."""
    looked, walked = [], []
    sample, chain = Ground.sample, geometry._chain
    monkeypatch.setattr(Ground, "sample", lambda self, e, n, within=False: (looked.append(np.size(e)), sample(self, e, n, within))[1])
    rays = CAMERAS[0].rays(CAMERAS[0].sample_grid(48, 27))
    outer = outer_rays(rays)
    monkeypatch.setattr(geometry, "_chain", lambda points: (walked.append(len(points)), chain(points))[1])
    n = 25
    at = np.array([RNG.uniform(2000, 2600, n), RNG.uniform(3600, 4200, n), np.linspace(60, 300, n)])
    hits = frame_hits(Ground(hills("plain")), at, rotations(np.zeros(n), np.linspace(-1.5, -0.8, n), np.linspace(-3, 3, n)), rays, outer)
    assert np.isfinite(hits).all() and sum(looked) < 6 * len(rays) * n
    texts = hull_texts(*(v.ravel() for v in hits[:2]), np.broadcast_to(np.arange(n), hits.shape[1:]).ravel(), n)
    assert texts[3] == chain_wkt(hits[:2, :, 3].T) and sum(walked) < 0.1 * len(rays) * n
