"""Disk aggregates against plain loops, on scattered points and on rows of equal y, with repeated places."""

import numpy as np
import pytest

from stratapoint.functions import disks


def _clouds():
    rng = np.random.default_rng(5)
    scattered = rng.uniform(0, 12, (900, 3))
    rows = np.round(rng.uniform(0, 12, (900, 3)) * 8) / 8
    crowd = np.concatenate([scattered[:50], np.repeat(scattered[50:55], 40, axis=0)])
    return [scattered, rows, crowd, scattered[:1], scattered[:0]]


@pytest.mark.parametrize("which", range(5))
@pytest.mark.parametrize("radius", [0.5, 2.0, 30.0])
def test_against_loops(which, radius, monkeypatch):
    monkeypatch.setattr(disks, "RUNS", 300)
    p = _clouds()[which]
    q = np.concatenate([_clouds()[1][:200, :2] + [100.0, 0.0], _clouds()[1][:150, :2], _clouds()[0][:50, :2]])
    strips = disks.Strips(*p.T, radius)
    got = {n: np.empty(len(q)) for n in ("n", "mean", "var", "min", "max", "median", "pairs")}
    for at, near in strips.around(*q.T):
        got["n"][at], got["mean"][at], got["var"][at], got["median"][at] = near.n, near.mean(), near.variance(), near.median()
        got["min"][at], got["max"][at] = near.extreme(np.minimum, strips.least), near.extreme(np.maximum, strips.most)
        for a, b, who, rows in near.pairs():
            got["pairs"][at][a:b] = np.bincount(who, strips.z[rows], b - a)
    for k, (x, y) in enumerate(q):
        z = p[(p[:, 0] - x) ** 2 + (p[:, 1] - y) ** 2 <= radius * radius, 2]
        assert got["n"][k] == len(z)
        assert got["pairs"][k] == pytest.approx(z.sum())
        for name, value in (("mean", np.mean), ("min", np.min), ("max", np.max), ("median", np.median), ("var", lambda v: np.var(v) if len(v) > 1 else np.nan)):
            want = value(z) if len(z) else np.nan
            assert got[name][k] == pytest.approx(want, nan_ok=True, abs=1e-9)


@pytest.mark.parametrize("which", range(5))
def test_nearest_of_cells(which):
    p = _clouds()[which]
    q = np.concatenate([_clouds()[1][:100, :2], [[40.0, 40.0]]])
    got = disks.nearest2(p[:, 0], p[:, 1], *q.T, 2.0)
    for k, (x, y) in enumerate(q):
        near = (np.abs(np.floor(p[:, 0] / 2) - np.floor(x / 2)) <= 1) & (np.abs(np.floor(p[:, 1] / 2) - np.floor(y / 2)) <= 1)
        d2 = (p[near, 0] - x) ** 2 + (p[near, 1] - y) ** 2
        assert got[k] == pytest.approx(d2.min() if len(d2) else np.inf)
