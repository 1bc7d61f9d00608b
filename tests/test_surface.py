"""The smooth saturation surface."""

import math
import random

import numpy as np
import pytest

from seepline.functions import surface
from suite import patches

H = math.sqrt(3) / 2
FIELDS = [([(0.0, 0.0), (0.5, H), (1.0, 0.0)], (0.5, H / 3)), ([(-0.5, 0.0), (0.0, H), (0.5, 0.0), (0.0, -H)], (0.0, 0.0))]


@pytest.mark.parametrize("corners, centre", FIELDS)
def test_agrees_with_its_conditions(corners, centre):
    """At points between the nodes, the patch equals the one solved from its conditions."""
    rng = random.Random(1)
    own, cubics = patches.field(corners, centre)
    patch = surface.field_patch(corners, centre)
    for _ in range(200):
        b = [rng.random() for _ in range(3)]
        b = [x / sum(b) for x in b]
        p = [sum(w * c[k] for w, c in zip(b, own)) for k in (0, 1)]
        want = patches._value(p) @ cubics[int(np.argmin(b))]
        assert surface.height(patch, b) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("corners, centre", FIELDS)
def test_nodes_and_range(corners, centre):
    patch = surface.field_patch(corners, centre)
    assert surface.height(patch, [1, 0, 0]) == pytest.approx(1) and surface.height(patch, [0, 1, 0]) == pytest.approx(1)
    assert surface.height(patch, [0, 0, 1]) == pytest.approx(0, abs=1e-12)
    grid = [surface.height(patch, [i / 30, j / 30, 1 - (i + j) / 30]) for i in range(31) for j in range(31 - i)]
    assert -1e-12 <= min(grid) and max(grid) <= 1 + 1e-12
    assert surface.height(patch, [0, 0.5, 0.5]) != pytest.approx(0.5, abs=1e-2)  # not the linear surface


def test_planes_are_kept():
    points = [(0.0, 0.0), (1.0, 0.2), (0.3, 1.0), (0.4, 0.35)]
    plane = [2 * x - 3 * y + 1 for x, y in points]
    found = surface.slopes(points, plane, [(0, 1), (1, 2), (2, 0), (0, 3), (1, 3), (2, 3)])
    assert np.allclose(found, [(2, -3)] * 4)
