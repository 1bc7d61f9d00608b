"""The smooth saturation surface of the Piper fields, as native expressions.

A cubic Clough-Tocher surface (Clough and Tocher 1965; Alfeld 1984) goes through the nodes
of a field: 1 at its corners, 0 at its centre. Slopes at the nodes are those of the network
of cubic curves along the edges that bends least (Nielson 1983). All nodes are constants, so
the coefficients are found once, on import; the triangles around the centre are mirror
images of one another, and one patch serves each field.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[float, float]


def slopes(points: list[Point], values: list[float], edges: list[tuple[int, int]], rounds: int = 2000) -> list[Point]:
    """Slopes at the nodes that minimise the sum over the edges of the squared second
    derivative of the cubic between its ends, found node by node until they stand."""
    out = [(0.0, 0.0)] * len(points)
    for _ in range(rounds):
        moved = 0.0
        for i, (x, y) in enumerate(points):
            xx = xy = yy = rx = ry = 0.0
            for a, b in edges:
                if i not in (a, b):
                    continue
                j = b if a == i else a
                ex, ey = points[j][0] - x, points[j][1] - y
                cube = math.hypot(ex, ey) ** 3
                # the energy is least where 4 d_i = 6 (f_j - f_i) - 2 d_j along the edge
                pull = (6 * (values[j] - values[i]) - 2 * (out[j][0] * ex + out[j][1] * ey)) / cube
                xx, xy, yy = xx + 4 * ex * ex / cube, xy + 4 * ex * ey / cube, yy + 4 * ey * ey / cube
                rx, ry = rx + pull * ex, ry + pull * ey
            det = xx * yy - xy * xy
            new = ((yy * rx - xy * ry) / det, (xx * ry - xy * rx) / det)
            moved = max(moved, math.dist(new, out[i]))
            out[i] = new
        if moved < 1e-14:
            break
    return out


def patch(corners: list[Point], values: list[float], grads: list[Point], across: list[Point | None]) -> dict[tuple[int, int, int, int], float]:
    """Bezier coefficients of one triangle split at its middle, by their four indices (three
    corners and the middle). ``across[k]`` is the middle of the triangle beyond the edge
    opposite corner ``k``; along an edge the slope towards it is linear, so that two patches
    meet smoothly. Without a neighbour the slope from the edge's middle to ours is linear."""
    c: dict[tuple[int, int, int, int], float] = {}

    def unit(*at: int) -> tuple[int, int, int, int]:
        return tuple(at.count(k) for k in range(4))

    for i in range(3):
        c[unit(i, i, i)] = values[i]
        for j in range(3):
            if j != i:
                along = sum(g * (q - p) for g, p, q in zip(grads[i], corners[i], corners[j], strict=True))
                c[unit(i, i, j)] = values[i] + along / 3
    for i in range(3):
        j, k = (i + 1) % 3, (i + 2) % 3
        c[unit(i, i, 3)] = (c[unit(i, i, i)] + c[unit(i, i, j)] + c[unit(i, i, k)]) / 3
    for k in range(3):
        i, j = (k + 1) % 3, (k + 2) % 3
        other = across[k]
        if other is None:
            weight = -0.5
        else:
            b = _barycentric(corners, other)
            weight = (2 * b[j] + b[i] - 1) / (2 - 3 * b[j] - 3 * b[i])
        iii, iij, ijj, jjj = (c[unit(*at)] for at in ((i, i, i), (i, i, j), (i, j, j), (j, j, j)))
        c[unit(i, j, 3)] = (weight * (-iii + 3 * iij - 3 * ijj + jjj) + (-iii + 2 * iij - ijj + c[unit(i, i, 3)] + c[unit(j, j, 3)])) / 2
    for i in range(3):
        j, k = (i + 1) % 3, (i + 2) % 3
        c[unit(i, 3, 3)] = (c[unit(i, i, 3)] + c[unit(i, j, 3)] + c[unit(i, k, 3)]) / 3
    c[unit(3, 3, 3)] = sum(c[unit(i, 3, 3)] for i in range(3)) / 3
    return c


def _barycentric(corners: list[Point], p: Point) -> list[float]:
    (ax, ay), (bx, by), (cx, cy) = corners
    whole = (bx - ax) * (cy - ay) - (cx - ax) * (by - ay)
    one = ((bx - p[0]) * (cy - p[1]) - (cx - p[0]) * (by - p[1])) / whole
    two = ((cx - p[0]) * (ay - p[1]) - (ax - p[0]) * (cy - p[1])) / whole
    return [one, two, 1 - one - two]


def field_patch(corners: list[Point], centre: Point) -> dict[tuple[int, int, int, int], float]:
    """The patch of the triangle of the first two corners and the centre."""
    n = len(corners)
    points, values = [*corners, centre], [1.0] * n + [0.0]
    edges = [(i, (i + 1) % n) for i in range(n)] + [(i, n) for i in range(n)]
    grads = slopes(points, values, edges)

    def middle(i: int) -> Point:
        own = [corners[i % n], corners[(i + 1) % n], centre]
        return sum(p[0] for p in own) / 3, sum(p[1] for p in own) / 3

    # beyond the edges opposite the first corner, the second corner and the centre
    return patch([corners[0], corners[1], centre], [1.0, 1.0, 0.0], [grads[0], grads[1], grads[n]], [middle(1), middle(n - 1), None])


def _sixths(index: tuple[int, ...]) -> int:
    return math.factorial(3) // math.prod(math.factorial(i) for i in index)


def height(c: dict[tuple[int, int, int, int], float], b: list[float]) -> float:
    """The surface at barycentric coordinates ``b`` of the patch."""
    m = min(b)
    at = [x - m for x in b] + [3 * m]
    return sum(_sixths(i) * v * math.prod(x**n for x, n in zip(at, i, strict=True)) for i, v in c.items())


def height_column(c: dict[tuple[int, int, int, int], float], b: list[Column]) -> Column:
    """:func:`height` of three columns."""
    m = F.least(*b)
    at = [x - m for x in b] + [F.lit(3.0) * m]

    def term(index: tuple[int, ...], value: float) -> Column:
        factors = [x for x, n in zip(at, index, strict=True) for _ in range(n)]
        return reduce(lambda p, q: p * q, factors, F.lit(_sixths(index) * value))

    return reduce(lambda p, q: p + q, [term(i, v) for i, v in sorted(c.items())])
