"""The E8 lattice: nearest points, and the cells that a ball reaches into."""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points of D8, the integer vectors with an even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    step = np.where(off[odd, worst[odd]] >= 0, 1.0, -1.0)
    near[odd, worst[odd]] += step
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row: of D8, or of D8 moved by a half in every coordinate."""
    whole, half = _d8(x), _d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@lru_cache(maxsize=1)
def near_vectors() -> tuple[np.ndarray, np.ndarray]:
    """The 240 lattice vectors of squared length 2 and the 2160 of squared length 4, and the squared lengths."""
    out = []
    for choices, shift in (((-2, -1, 0, 1, 2), 0.0), ((-1.5, -0.5, 0.5, 1.5), 0.5)):
        # Built up coordinate by coordinate, keeping only what can still be short enough.
        part = [()]
        for _ in range(8):
            part = [p + (c,) for p, c in product(part, choices) if sum(v * v for v in p) + c * c <= 4 - (7 - len(p)) * shift * shift]
        out += [p for p in part if sum(v * v for v in p) in (2, 4) and sum(p) % 2 == 0]
    vectors = np.array(out)
    return vectors, (vectors**2).sum(axis=1)


#: Up to this radius (in lattice units) no cell beyond the two shells of ``near_vectors`` can be reached: for a
#: vector v of squared length 6 the largest <d, v> over the Voronoi cell is 2, below 3 - radius * sqrt(6); from 8 on,
#: |v|^2 / 2 - radius * |v| is beyond what |d| <= 1 allows.
MAX_RADIUS = 0.4


def cells_within(x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, lattice point) for every point whose Voronoi cell may come within ``radius`` of a row of ``x``.

    The cell of c + v, c being the row's own, lies beyond the plane halfway to it; it is listed if that plane is
    within the radius. Cells that only their plane, not they, bring near are listed too.
    """
    if radius > MAX_RADIUS:
        raise ValueError(f"radius beyond {MAX_RADIUS}")
    vectors, norm = near_vectors()
    reach = norm / 2 - (radius + 1e-6) * np.sqrt(norm)
    own = decode(x)
    rows, points = [np.arange(len(x))], [own]
    for lo in range(0, len(x), 512):
        dots = (x[lo : lo + 512] - own[lo : lo + 512]) @ vectors.T
        r, v = np.nonzero(dots >= reach)
        rows.append(r + lo)
        points.append(own[r + lo] + vectors[v])
    return np.concatenate(rows), np.concatenate(points)
