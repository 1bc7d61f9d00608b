"""The smooth saturation surface worked out from its conditions, for the check of the colours.

Slopes solve the linear equations of least bending over the edges; the three cubics of a
triangle solve the equations of their values and slopes at the corners, of smooth contact
inside, and of a straight slope across each side. Nothing is taken from the engine.
"""

from __future__ import annotations

import numpy as np

POWERS = [(i, j) for i in range(4) for j in range(4 - i)]


def _slopes(points, values, edges):
    n = len(points)
    matrix, right = np.zeros((2 * n, 2 * n)), np.zeros(2 * n)
    for a, b in edges:
        e = np.subtract(points[b], points[a])
        weight = 1 / np.linalg.norm(e) ** 3
        rise = values[b] - values[a]
        # second derivatives at both ends of the cubic with these end slopes
        for own, other in ((a, b), (b, a)):
            i, j = slice(2 * own, 2 * own + 2), slice(2 * other, 2 * other + 2)
            matrix[i, i] += 4 * weight * np.outer(e, e)
            matrix[i, j] += 2 * weight * np.outer(e, e)
            right[i] += 6 * weight * rise * e
    return np.linalg.solve(matrix, right).reshape(n, 2)


def _value(p):
    return np.array([p[0] ** i * p[1] ** j for i, j in POWERS])


def _slope(p, d):
    x, y = p
    return np.array([(i * x ** max(i - 1, 0) * y**j) * d[0] + (j * x**i * y ** max(j - 1, 0)) * d[1] for i, j in POWERS])


def triangle(corners, values, grads, others):
    """Coefficients in (x, y) of the cubics opposite corner 0, 1 and 2; ``others`` are the
    middles of the neighbours beyond those sides, or None."""
    corners = [np.array(c) for c in corners]
    middle = sum(corners) / 3
    rows, right = [], []

    def state(parts, value=0.0):
        row = np.zeros(30)
        for k, sign, v in parts:
            row[10 * k : 10 * k + 10] += sign * v
        rows.append(row)
        right.append(value)

    for k in range(3):
        i, j = (k + 1) % 3, (k + 2) % 3
        for c in (i, j):
            state([(k, 1, _value(corners[c]))], values[c])
            for d, g in zip(np.eye(2), grads[c], strict=True):
                state([(k, 1, _slope(corners[c], d))], g)
        # pieces opposite i and j share the line from corner k to the middle
        for t in np.linspace(0, 1, 5):
            p = corners[k] + t * (middle - corners[k])
            state([(i, 1, _value(p)), (j, -1, _value(p))])
            for d in np.eye(2):
                state([(i, 1, _slope(p, d)), (j, -1, _slope(p, d))])
        half = (corners[i] + corners[j]) / 2
        d = (half if others[k] is None else np.array(others[k])) - middle
        state([(k, 1, _slope(half, d)), (k, -0.5, _slope(corners[i], d)), (k, -0.5, _slope(corners[j], d))])
    found, *_ = np.linalg.lstsq(np.array(rows), np.array(right), rcond=None)
    assert np.abs(np.array(rows) @ found - right).max() < 1e-9
    return found.reshape(3, 10)


def field(corners, centre):
    """The two nearest corners and the centre, and the cubics between them."""
    n = len(corners)
    points = [*corners, centre]
    edges = [(i, (i + 1) % n) for i in range(n)] + [(i, n) for i in range(n)]
    grads = _slopes(points, [1.0] * n + [0.0], edges)
    own = [corners[0], corners[1], centre]
    middles = [np.mean([corners[i % n], corners[(i + 1) % n], centre], axis=0) for i in range(n)]
    return own, triangle(own, [1.0, 1.0, 0.0], [grads[0], grads[1], grads[n]], [middles[1], middles[n - 1], None])


def sql(patch, b1: str, b2: str) -> str:
    """The surface at barycentric ``b1`` and ``b2`` (of the two corners) as SQL."""
    (a, b, c), cubics = patch
    x = f"({a[0]!r}::DOUBLE*({b1})+{b[0]!r}::DOUBLE*({b2})+{c[0]!r}::DOUBLE*(1-({b1})-({b2})))"
    y = f"({a[1]!r}::DOUBLE*({b1})+{b[1]!r}::DOUBLE*({b2})+{c[1]!r}::DOUBLE*(1-({b1})-({b2})))"

    def cubic(k):
        return "(" + "+".join("*".join([f"({float(v)!r}::DOUBLE)", *[x] * i, *[y] * j]) for (i, j), v in zip(POWERS, cubics[k], strict=True)) + ")"

    return f"CASE WHEN {b1} <= {b2} AND {b1} <= 1-({b1})-({b2}) THEN {cubic(0)} WHEN {b2} <= 1-({b1})-({b2}) THEN {cubic(1)} ELSE {cubic(2)} END"
