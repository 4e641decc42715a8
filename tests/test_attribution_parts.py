"""Tree attributions with rows taken in parts."""

import numpy as np

from lendspark.operators import treeshap as ts


def test_attribution_in_parts(monkeypatch):
    """Rows taken in parts, and paths longer than a byte of comparisons."""
    r = np.random.default_rng(3)
    paths = [([(f, 0.2 if f % 2 else None, 0.7 if f % 3 else None) if f % 6 else (f, 0.1, 0.9) for f in range(k)],
              r.normal(size=(1 << k, k))) for k in (1, 4, 9)]
    paths = [([(f, a, u) if (a, u) != (None, None) else (f, 0.5, None) for f, a, u in i], v) for i, v in paths]
    x = r.random((9, 50))
    want = np.zeros_like(x)
    for i, v in paths:
        for row in range(50):
            p = sum(((a is None or x[f, row] > a) and (u is None or x[f, row] <= u)) << j for j, (f, a, u) in enumerate(i))
            for j, (f, _, _) in enumerate(i):
                want[f, row] += v[p, j]
    monkeypatch.setattr(ts, "MET_BYTES", 100)
    assert np.allclose(ts._attributions(x, paths), want)
