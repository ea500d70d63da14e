from __future__ import annotations

import numpy as np
import pytest

from framewright.functions.geometry import Camera, Terrain, first_hits, hull_wkt, laplacian_variance, rotation

CAMERA = Camera(1000.0, 1010.0, 960.0, 540.0, 1920, 1080, -0.1, 0.02, 0.001, -0.001, 0.0)
FLAT = Terrain(np.zeros((200, 200), "float32"), -500.0, 1500.0, 10.0)


def test_rays_and_project_are_inverse():
    pixels = CAMERA.sample_grid(7, 5)
    assert np.abs(CAMERA.project(CAMERA.rays(pixels)) - pixels).max() < 1e-3


@pytest.mark.parametrize("angles", [(0.0, -np.pi / 2, 0.3), (0.2, -np.pi / 3, 1.0), (-0.4, -np.pi / 4, -2.0)])
def test_rotation_is_proper(angles):
    r = rotation(*angles)
    assert np.allclose(r @ r.T, np.eye(3)) and np.isclose(np.linalg.det(r), 1)


def test_bilinear_sample():
    t = Terrain(np.arange(1, 10, dtype="float32").reshape(3, 3), 0.0, 100.0, 10.0, datum=5.0)
    got = t.sample(np.array([10.0, 5.0, -1.0]), np.array([90.0, 100.0, 90.0]))
    assert got[:2].tolist() == [10.0, 6.5] and np.isnan(got[2])


def test_first_hits():
    origin = np.array([[0.0, 0.0, 100.0]] * 3)
    rays = np.array([[0, 0, -1.0], [np.sqrt(0.5), 0, -np.sqrt(0.5)], [0, 0, 1.0]])
    hits = first_hits(FLAT, origin, rays)
    assert np.allclose(hits[0], [0, 0, 0], atol=1e-6) and abs(hits[1][0] - 100) < 1 and np.isnan(hits[2]).all()


def test_principal_point_of_a_centred_camera_is_zero():
    n = Camera(2000.0, 2100.0, 960.0, 540.0, 1920, 1080).normalised()
    assert (n["c_x"], n["c_y"]) == (0, 0) and np.isclose(n["focal_x"], 2000 / 1920) and np.isclose(n["focal_y"], 2100 / 1920)


def test_unknown_heights():
    z = np.zeros((50, 50), "float32")
    z[:, 20:24] = -9999  # a strip without data
    z[0, 0], z[3, 3] = np.nan, 60
    t = Terrain(z, 0.0, 490.0, 10.0)
    assert t.bounds() == (0.0, 60.0) and Terrain(np.full((3, 3), np.nan), 0, 0, 1).bounds() == (-np.inf, np.inf)
    assert np.isnan(t.sample(np.array([5.0, 205.0]), np.array([485.0, 100.0]))).all()
    # a slanting ray reaches the ground inside the strip: no hit there, nor one made up behind it
    to = lambda e: np.array([e - 50.0, 0, -60.0]) / np.hypot(e - 50, 60)
    origins = np.array([[50.0, 100.0, 60.0]] * 3)
    hits = first_hits(t, origins, np.stack([to(150.0), to(215.0), to(300.0)]))
    assert np.allclose(hits[0], [150, 100, 0], atol=1e-3) and np.isnan(hits[1]).all() and np.allclose(hits[2], [300, 100, 0], atol=1e-3)


def test_a_wall_hides_what_is_behind_it():
    z = np.zeros((100, 100), "float32")
    z[:, 30:33] = 80
    t = Terrain(z, 0.0, 990.0, 10.0)
    rays = np.array([[1.0, 0, -0.25], [1.0, 0, -2.0], [1.0, 0, 0.1]])
    hits = first_hits(t, np.array([[100.0, 500.0, 100.0]] * 3), rays / np.linalg.norm(rays, axis=1, keepdims=True))
    assert 285 < hits[0][0] < 305 and 0 < hits[0][2] < 80 and np.allclose(hits[1], [150, 500, 0], atol=1e-3) and np.isnan(hits[2]).all()


def test_skipped_steps_change_nothing():
    """Against a march from the camera itself, a millimetre at a time along each ray's last step."""
    x = np.arange(300)
    t = Terrain((20 + 10 * np.sin(x[None, :] / 9) + 5 * np.cos(x[:, None] / 7)).astype("float32"), 0.0, 2990.0, 10.0)
    rays = CAMERA.rays(CAMERA.sample_grid(6, 5)) @ rotation(0.1, -1.0, 0.7).T
    origins = np.array([[1500.0, 1500.0, 300.0]] * len(rays))
    hits = first_hits(t, origins, rays)
    for o, d, h in zip(origins, rays, hits, strict=True):
        far = np.arange(0, 800, 0.05)
        p = o + far[:, None] * d
        under = np.flatnonzero(p[:, 2] <= t.sample(p[:, 0], p[:, 1]))
        assert np.isnan(h).all() if not len(under) else np.linalg.norm(h - p[under[0]]) < 0.5


def test_hull():
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2], [1, 1], [1, 0]], float)
    assert hull_wkt(square) == "POLYGON ((0.00 0.00, 2.00 0.00, 2.00 2.00, 0.00 2.00, 0.00 0.00))"
    assert hull_wkt(np.zeros((0, 2))) == "POLYGON EMPTY"


def test_laplacian():
    assert laplacian_variance(np.full((5, 5), 7)) == 0
