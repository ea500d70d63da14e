"""Camera, terrain and ray kernels in numpy: small helpers for the Arrow functions in operators/footprints.py."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


#: Heights on a side of a block with one bound.
BLOCK = 16
#: Metres between the lookups along a ray, and along which it may meet the ground.
STEP_M, REACH_M = 10.0, 800.0
#: Heights that are kept in 64 bits for lookups; more stay as they are.
MOST_WIDENED = 4 << 20


@dataclass(frozen=True)
class Camera:
    fx: float
    fy: float
    cx: float
    cy: float
    width: int
    height: int
    k1: float = 0.0
    k2: float = 0.0
    p1: float = 0.0
    p2: float = 0.0
    k3: float = 0.0

    def sample_grid(self, nu: int, nv: int) -> np.ndarray:
        u, v = np.meshgrid(np.linspace(0, self.width - 1, nu), np.linspace(0, self.height - 1, nv), indexing="ij")
        return np.stack([u.ravel(), v.ravel()], axis=1)

    def _distort(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Radial factor and tangential shifts of the Brown model."""
        r2 = x * x + y * y
        return 1 + r2 * (self.k1 + r2 * (self.k2 + r2 * self.k3)), 2 * self.p1 * x * y + self.p2 * (r2 + 2 * x * x), self.p1 * (r2 + 2 * y * y) + 2 * self.p2 * x * y

    def project(self, points: np.ndarray) -> np.ndarray:
        x, y = points[:, 0] / points[:, 2], points[:, 1] / points[:, 2]
        radial, dx, dy = self._distort(x, y)
        return np.stack([self.fx * (x * radial + dx) + self.cx, self.fy * (y * radial + dy) + self.cy], axis=1)

    def rays(self, pixels: np.ndarray, steps: int = 8) -> np.ndarray:
        """Unit rays of pixels, undistorted by fixed-point steps."""
        u, v = (pixels[:, 0] - self.cx) / self.fx, (pixels[:, 1] - self.cy) / self.fy
        x, y = u, v
        for _ in range(steps):
            radial, dx, dy = self._distort(x, y)
            x, y = (u - dx) / radial, (v - dy) / radial
        out = np.stack([x, y, np.ones_like(x)], axis=1)
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def normalised(self) -> dict[str, float]:
        """Focal lengths and principal point over the longer side, as reconstruction tools store them."""
        m = max(self.width, self.height)
        return {"focal_x": self.fx / m, "focal_y": self.fy / m, "c_x": (self.cx - self.width / 2) / m, "c_y": (self.cy - self.height / 2) / m}


def rotation(roll: float, pitch: float, yaw: float) -> np.ndarray:
    """Camera to east-north-up: columns right, down, forward; pitch -90 degrees looks straight down."""
    nadir = np.pi / 2 + pitch
    forward = np.array([np.sin(yaw) * np.sin(nadir), np.cos(yaw) * np.sin(nadir), -np.cos(nadir)])
    right = np.cross(forward, [0.0, 0.0, 1.0])
    if np.linalg.norm(right) < 1e-8:
        right = np.array([np.cos(yaw), -np.sin(yaw), 0.0])
    right = right / np.linalg.norm(right)
    down = np.cross(forward, right)
    c, s = np.cos(roll), np.sin(roll)
    return np.stack([c * right + s * down, c * down - s * right, forward], axis=1)


@dataclass(frozen=True)
class Terrain:
    """Heights on a grid: cell (row, column) lies at (origin_e + column * cell, origin_n - row * cell)."""

    z: np.ndarray
    origin_e: float
    origin_n: float
    cell: float
    nodata: float = -9999.0
    datum: float = 0.0

    def sample(self, e: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Bilinear heights; NaN outside and next to missing cells."""
        rows, cols = self.z.shape
        c, r = (np.asarray(e) - self.origin_e) / self.cell, (self.origin_n - np.asarray(n)) / self.cell
        inside = (c >= 0) & (r >= 0) & (c <= cols - 1) & (r <= rows - 1)
        c0, r0 = (np.clip(np.floor(np.where(inside, x, 0)), 0, m - 2).astype(int) for x, m in ((c, cols), (r, rows)))
        fc, fr = np.where(inside, c - c0, 0), np.where(inside, r - r0, 0)
        corner = [self.z[r0 + i, c0 + j].astype(np.float64) for i in (0, 1) for j in (0, 1)]
        value = (corner[0] * (1 - fc) + corner[1] * fc) * (1 - fr) + (corner[2] * (1 - fc) + corner[3] * fc) * fr
        missing = np.any([(x == self.nodata) | ~np.isfinite(x) for x in corner], axis=0)
        return np.where(inside & ~missing, value + self.datum, np.nan)

    def bounds(self) -> tuple[float, float]:
        good = self.z[(self.z != self.nodata) & np.isfinite(self.z)]
        return (float(good.min()) + self.datum, float(good.max()) + self.datum) if good.size else (-np.inf, np.inf)


def _refined(height, t0: np.ndarray, h0: np.ndarray, t1: np.ndarray, h1: np.ndarray) -> np.ndarray:
    """Where between t0 (above the ground by h0) and t1 (below it by -h1) rays meet the ground, by two secants."""
    at = t0 + (t1 - t0) * h0 / (h0 - h1)
    mid = height(at)
    below = mid <= 0
    t0, h0, t1, h1 = np.where(below, t0, at), np.where(below, h0, mid), np.where(below, at, t1), np.where(below, mid, h1)
    refined = t0 + (t1 - t0) * h0 / np.where(h0 == h1, 1, h0 - h1)
    return np.where(np.isfinite(refined), refined, at)


def first_hits(terrain: Terrain, origins: np.ndarray, rays: np.ndarray, step: float = 10.0, reach: float = 800.0) -> np.ndarray:
    """Where each ray first meets the ground, in steps anchored at its origin and one
    secant refinement; NaN rows for rays that start below it, leave it or never meet it.
    A step hits if both its ends have known heights, above and not above the ground;
    missing heights neither hit nor stop a ray."""
    hits = np.full((len(rays), 3), np.nan)
    height = lambda p: p[:, 2] - terrain.sample(p[:, 0], p[:, 1])
    low, high = terrain.bounds()
    down = rays[:, 2] < 0
    # above the highest ground no step can hit, so the first ones are skipped
    first = np.min((origins[down, 2] - high) / -rays[down, 2], initial=reach) if np.isfinite(high) else 0.0
    first = max(0.0, (np.ceil(first / step) - 1) * step)
    before = height(origins + first * rays)
    live = np.flatnonzero(down & ~(before <= 0))
    t_before = np.full(len(rays), first)
    for t in np.arange(first + step, reach + step, step):
        if not len(live):
            break
        point = origins[live] + t * rays[live]
        now = height(point)
        crossed = (now <= 0) & (before[live] > 0)
        if crossed.any():
            k = live[crossed]
            t0, h0, t1, h1 = t_before[k], before[k], np.full(len(k), t), now[crossed]
            at = _refined(lambda at: height(origins[k] + at[:, None] * rays[k]), t0, h0, t1, h1)
            hits[k] = origins[k] + at[:, None] * rays[k]
        before[live], t_before[live] = now, t
        live = live[~crossed & (point[:, 2] >= low - step)]
    return hits


class Ground:
    """Terrain for many lookups at once: the heights of :meth:`Terrain.sample`, unknown ones marked beforehand, and the
    highest ground of each block of ``BLOCK`` by ``BLOCK`` heights, those next to it included."""

    def __init__(self, terrain: Terrain) -> None:
        self.terrain, z = terrain, terrain.z
        self.rows, self.cols = z.shape
        self.low, self.high = terrain.bounds()
        unknown = ~np.isfinite(z) | (z == terrain.nodata)
        if unknown.any():
            z = np.where(unknown, np.nan, z).astype(z.dtype if z.dtype.kind == "f" else np.float64)
        flat = np.ascontiguousarray(z if z.size > MOST_WIDENED else z.astype(np.float64)).ravel()
        self.corners = [flat[k:] for k in (0, 1, self.cols, self.cols + 1)]
        self.blocks = np.full([-(-n // BLOCK) for n in z.shape], -np.inf)
        for k in range(len(self.blocks)):  # a row of blocks at a time, whatever the size of the terrain
            strip = np.fmax.reduce(z[k * BLOCK : (k + 1) * BLOCK + 1].astype(np.float64), axis=0, initial=-np.inf)
            inner = np.fmax.reduceat(strip, np.arange(0, self.cols, BLOCK))
            inner[:-1] = np.fmax(inner[:-1], strip[BLOCK::BLOCK][: len(inner) - 1])
            self.blocks[k] = inner + terrain.datum + 1e-6

    def within(self, e: tuple[float, float], n: tuple[float, float]) -> bool:
        """Whether all of a box, of which these are the least and the most, has four heights around it."""
        t = self.terrain
        return (e[0] - t.origin_e) / t.cell >= 0 and (e[1] - t.origin_e) / t.cell < self.cols - 1 and (t.origin_n - n[1]) / t.cell >= 0 and (t.origin_n - n[0]) / t.cell < self.rows - 1

    def highest(self, e0: float, e1: float, n0: float, n1: float) -> float:
        """No ground in the box is higher."""
        t = self.terrain
        c0, c1, r0, r1 = (max(int(x // (t.cell * BLOCK)), 0) for x in (e0 - t.origin_e - t.cell, e1 - t.origin_e + t.cell + t.cell * BLOCK, t.origin_n - n1 - t.cell, t.origin_n - n0 + t.cell + t.cell * BLOCK))
        return self.blocks[r0:r1, c0:c1].max(initial=-np.inf)

    def sample(self, e: np.ndarray, n: np.ndarray, within: bool = False) -> np.ndarray:
        """Heights, NaN where unknown; ``within`` if all points are known to lie in a box of that name."""
        t = self.terrain
        if min(self.rows, self.cols) < 2:
            return t.sample(e, n) if t.z.size else np.full(np.shape(e), np.nan)
        c, r = (e - t.origin_e) / t.cell, (t.origin_n - n) / t.cell
        if within:
            c0, r0 = np.floor(c), np.floor(r)
        else:
            inside = (c >= 0) & (r >= 0) & (c <= self.cols - 1) & (r <= self.rows - 1)
            c, r = np.where(inside, c, 0), np.where(inside, r, 0)
            c0, r0 = (np.minimum(np.floor(x), m - 2) for x, m in ((c, self.cols), (r, self.rows)))
        c -= c0
        r -= r0
        r0 *= self.cols
        r0 += c0
        at = r0.astype(np.intp)
        z = [x.take(at, mode="clip").astype(np.float64, copy=False) for x in self.corners]
        for k, side in ((0, 1 - c), (1, c), (2, 1 - c), (3, c)):
            z[k] *= side
        z[0] += z[1]
        z[2] += z[3]
        z[0] *= 1 - r
        z[2] *= r
        z[0] += z[2]
        if t.datum:
            z[0] += t.datum
        return z[0] if within else np.where(inside, z[0], np.nan)


def rotations(roll: np.ndarray, pitch: np.ndarray, yaw: np.ndarray) -> np.ndarray:
    """:func:`rotation` of many frames: east, north and up of right, down and forward by frame."""
    nadir = np.pi / 2 + pitch
    east, north, up = np.sin(yaw) * np.sin(nadir), np.cos(yaw) * np.sin(nadir), -np.cos(nadir)
    upright = np.hypot(east, north) < 1e-8
    e, n = np.where(upright, np.cos(yaw), north), np.where(upright, -np.sin(yaw), -east)
    e, n = e / np.sqrt(e * e + n * n), n / np.sqrt(e * e + n * n)
    c, s = np.cos(roll), np.sin(roll)
    right, down, forward = (e, n, np.zeros_like(e)), (-up * n, up * e, east * n - north * e), (east, north, up)
    return np.array([[c * a + s * b, c * b - s * a, f] for a, b, f in zip(right, down, forward, strict=True)])


def outer_rays(rays: np.ndarray) -> np.ndarray:
    """Rays of a camera between which all others lie: corners of their hull in the image."""
    points = rays[:, :2] / rays[:, 2:]
    order = np.lexsort((points[:, 1], points[:, 0]))
    line = [(*p, i) for p, i in zip(points[order].tolist(), order.tolist(), strict=True)]
    return rays[sorted({q[2] for q in (*_chain(line), *_chain(line[::-1]))})]


def _highest_below(ground: Ground, origins: np.ndarray, outer: np.ndarray, reach: float) -> np.ndarray:
    """The highest ground that each frame's rays may meet: of the box around where its outer rays (3, rays, frames) are at the heights of
    the lowest and highest ground, or around all within reach if one of them hardly goes down."""
    e, n, z = origins
    boxes = [e - reach, e + reach, n - reach, n + reach]
    down = outer[2].max(axis=0) < -0.05
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.stack([(z - h) / -outer[2] for h in (ground.low, ground.high)])
    for i, x in enumerate((e, n)):
        at = x + t * outer[i]
        boxes[2 * i] = np.where(down, np.maximum(boxes[2 * i], at.min(axis=(0, 1))), boxes[2 * i])
        boxes[2 * i + 1] = np.where(down, np.minimum(boxes[2 * i + 1], at.max(axis=(0, 1))), boxes[2 * i + 1])
    return np.array([ground.highest(*box) if np.isfinite(box).all() else -np.inf for box in np.transpose(boxes).tolist()])


def frame_hits(ground: Ground, origins: np.ndarray, turned: np.ndarray, rays: np.ndarray, outer: np.ndarray, step: float = STEP_M, reach: float = REACH_M) -> np.ndarray:
    """:func:`first_hits` (3, rays, frames) of all ``rays`` of frames at ``origins`` (3, frames), ``turned`` by :func:`rotations`;
    ``outer``: :func:`outer_rays` of them.

    A ray begins with the last step above all ground that its frame may see.  Rays without a hit go on together, each at its
    own step, to below all ground or the end of their reach."""
    shape, last = (len(rays), origins.shape[1]), int(np.ceil(reach / step))
    hits = np.full((3, shape[0] * shape[1]), np.nan)
    if not np.isfinite(ground.high):  # no height is known
        return hits.reshape(3, *shape)
    far = last * step + step
    with np.errstate(invalid="ignore"):
        within = ground.within(*((x.min() - far, x.max() + far) for x in origins[:2])) if shape[1] else False
    open_ = (origins[2] > -np.inf) & ~(ground.sample(*origins[:2]) >= origins[2])
    high = np.where(open_, _highest_below(ground, origins, np.array([outer @ m for m in turned]), far), -np.inf)
    o = [np.broadcast_to(x, shape).ravel() for x in origins]
    d = [(rays @ m).ravel() for m in turned]
    with np.errstate(divide="ignore", invalid="ignore"):
        k = np.ceil((np.broadcast_to(origins[2] - high, shape).ravel() - 1e-6) / (d[2] * -step))
    k = np.maximum(k, 1)
    live = np.flatnonzero((d[2] < 0) & (k <= last))
    if len(live) < len(k):
        o, d, k = [x[live] for x in o], [x[live] for x in d], k[live]
    before = None
    while len(live):
        t = k * step
        z = t * d[2]
        z += o[2]
        now = z - ground.sample(o[0] + t * d[0], o[1] + t * d[1], within)
        below = np.flatnonzero(now <= 0)
        if len(below):
            own, way = [x[below] for x in o], [x[below] for x in d]
            height = lambda t, own, way: own[2] + t * way[2] - ground.sample(own[0] + t * way[0], own[1] + t * way[1], within)
            t0 = t[below] - step
            h0 = height(t0, own, way) if before is None else before[below]
            if not (crossed := h0 > 0).all():
                below, t0, h0, own, way = below[crossed], t0[crossed], h0[crossed], [x[crossed] for x in own], [x[crossed] for x in way]
            at = _refined(lambda t: height(t, own, way), t0, h0, t[below], now[below])  # noqa: B023
            for i in range(3):
                hits[i, live[below]] = own[i] + at * way[i]
        goes_on = z > ground.low
        goes_on &= k < last
        goes_on[below] = False
        left = np.flatnonzero(goes_on)
        live, o, d, k, before = live[left], [x[left] for x in o], [x[left] for x in d], k[left] + 1, now[left]
    return hits.reshape(3, *shape)


@dataclass(frozen=True)
class HeightBounds:
    """Terrain with the lowest and highest ground of each block of ``BLOCK`` by ``BLOCK`` heights, those next to it included."""

    terrain: Terrain
    lowest: np.ndarray
    highest: np.ndarray

    @classmethod
    def of(cls, terrain: Terrain) -> HeightBounds:
        z = terrain.z.astype(np.float64) + terrain.datum
        known = (terrain.z != terrain.nodata) & np.isfinite(z)
        return cls(terrain, -cls._highest(np.where(known, -z, -np.inf)), cls._highest(np.where(known, z, -np.inf)))

    @staticmethod
    def _highest(z: np.ndarray) -> np.ndarray:
        z = np.pad(z, [(0, -n % BLOCK + 1) for n in z.shape], constant_values=-np.inf)
        corners = np.maximum(np.maximum(z[:-1, :-1], z[1:, :-1]), np.maximum(z[:-1, 1:], z[1:, 1:]))
        rows, cols = (n // BLOCK for n in corners.shape)
        return corners.reshape(rows, BLOCK, cols, BLOCK).max(axis=(1, 3)) + 1e-6

    def block(self, e: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of the blocks of points."""
        t = self.terrain
        at = ((t.origin_n - n) / t.cell, (e - t.origin_e) / t.cell)
        return tuple(np.clip(np.floor(x), 0, max(m - 2, 0)).astype(int) // BLOCK for x, m in zip(at, t.z.shape, strict=True))


def block_hits(ground: HeightBounds, origin: np.ndarray, rays: np.ndarray, mine, step: float = 10.0, reach: float = 800.0) -> tuple[np.ndarray, int]:
    """The first hit of each ray from one origin among the steps whose begin is ``mine``, as rows of ray, way, easting,
    northing and height, and how many heights were looked up.  Steps are those of :func:`first_hits`; only
    steps that begin above the lowest ground of their block and end below the highest of theirs are looked at.  One row of ray -1 if the origin is mine and not above the ground."""
    height = lambda e, n, z: z - ground.terrain.sample(e, n)
    if mine(*origin[:2]) and height(*origin) <= 0:
        return np.array([[-1.0, 0, 0, 0, 0]]), 1
    down, t = np.flatnonzero(rays[:, 2] < 0), np.arange(0, reach + step, step)
    low, high = ground.lowest.min(initial=np.inf), ground.highest.max(initial=-np.inf)
    if not len(down) or low > high:
        return np.zeros((0, 5)), 0
    # the steps of each ray from the one that may end below all highest ground to the one that begins below all lowest
    fall = -rays[down, 2] * step
    begin, end = (np.clip((origin[2] - h) / fall, -1, len(t)).astype(int) for h in (high, low))
    begin, end = np.maximum(begin - 1, 0), np.minimum(end + 1, len(t) - 2)
    count = np.maximum(end - begin + 1, 0)
    ray = np.repeat(np.arange(len(down)), count)
    k = np.arange(len(ray)) - np.repeat(np.cumsum(count) - count, count) + begin[ray]
    at = lambda ray, k: [origin[i] + rays[down[ray], i] * t[k] for i in range(3)]
    own = mine(*at(ray, k)[:2])
    ray, k = ray[own], k[own]
    start, stop = at(ray, k), at(ray, k + 1)
    may = (start[2] > ground.lowest[ground.block(*start[:2])]) & (stop[2] <= ground.highest[ground.block(*stop[:2])])
    ray, k = ray[may], k[may]
    now = height(*at(ray, k + 1))
    sampled, below = len(ray), now <= 0
    ray, k, now = ray[below], k[below], now[below]
    before = height(*at(ray, k))
    sampled, crossed = sampled + len(ray), before > 0
    ray, first = np.unique(ray[crossed], return_index=True)
    k, now, before = k[crossed][first], now[crossed][first], before[crossed][first]
    own = rays[down[ray]]
    way = _refined(lambda x: height(*(origin + x[:, None] * own).T), t[k], before, t[k + 1], now)
    return np.column_stack([down[ray], way, origin + way[:, None] * own]), sampled + len(ray)


def hull_wkt(points: np.ndarray) -> str:
    """Convex hull to two decimals as WKT, collinear points left out."""
    return hull_texts(points[:, 0], points[:, 1], np.zeros(len(points), np.int64), 1)[0]


def hull_texts(e: np.ndarray, n: np.ndarray, which: np.ndarray, sets: int) -> list[str]:
    """:func:`hull_wkt` of many sets of points, and to which set each point belongs.

    A point beyond the line between its neighbours in order is no corner.  Leaving out all such points of all sets at once
    until there are none leaves the lower or upper side of each, exactly in whole hundredths; only these few points are walked one by one."""
    if not len(e):
        return ["POLYGON EMPTY"] * sets
    rounded = [np.rint(v * 100) for v in (e, n)]
    zeros = np.flatnonzero(np.any([(v == 0) & np.signbit(v) for v in rounded], axis=0))  # are written as -0.00
    x, y = (v.astype(np.int64) for v in rounded)
    signed = {(int(which[i]), int(x[i]), int(y[i])): (rounded[0][i] / 100, rounded[1][i] / 100) for i in zeros}
    x0, y0 = int(x.min()), int(y.min())
    wide, high = int(x.max() - x0).bit_length(), int(y.max() - y0).bit_length()
    if sets.bit_length() + wide + high < 64:  # one number in order of all three
        key = np.sort((which.astype(np.int64) << (wide + high)) | ((x - x0) << high) | (y - y0))
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        x, y, which = ((key >> high) & ((1 << wide) - 1)) + x0, (key & ((1 << high) - 1)) + y0, key >> (wide + high)
    else:
        which, x, y = np.unique(np.stack([which, x, y]), axis=1)
    sides = []
    for sign in (1, -1):
        a, b, w = x, y, which
        while len(a) > 2:
            da, db = np.diff(a), np.diff(b)
            kept = np.ones(len(a), bool)
            kept[1:-1] = (sign * (da[:-1] * db[1:] - db[:-1] * da[1:]) >= 0) | (w[2:] != w[:-2])
            if kept.all():
                break
            a, b, w = a[kept], b[kept], w[kept]
        points = list(zip((a / 100).tolist(), (b / 100).tolist(), strict=True))
        if signed:
            points = [signed.get(p, q) for p, q in zip(zip(w.tolist(), a.tolist(), b.tolist(), strict=True), points, strict=True)]
        sides.append((points, np.searchsorted(w, np.arange(sets + 1)).tolist()))

    def text(k: int) -> str:
        low, high = (points[at[k] : at[k + 1]] for points, at in sides)
        ring = [*_chain(low)[:-1], *_chain(high[::-1])[:-1]] or low
        return "POLYGON ((" + ", ".join(["%.2f %.2f" % p for p in (*ring, *ring[:1])]) + "))" if ring else "POLYGON EMPTY"

    return list(map(text, range(sets)))


def _chain(points: list[tuple]) -> list[tuple]:
    """One side of a hull, from points in order."""
    out: list[tuple] = []
    for q in points:
        while len(out) > 1:
            a, b = out[-2], out[-1]
            if (b[0] - a[0]) * (q[1] - a[1]) - (b[1] - a[1]) * (q[0] - a[0]) > 0:
                break
            out.pop()
        out.append(q)
    return out


def laplacian_variance(gray: np.ndarray) -> float:
    """Sharpness of a grey image: variance of its four-neighbour Laplacian, edges mirrored."""
    g = np.pad(gray.astype(np.float64), 1, mode="reflect")
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]).var())
