import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tableprep.llm import hard_negatives as H
from tableprep.llm import queries

from .helpers import SF, tables

SCHEMA = "vec_id long, embedding array<float>, label int, norm string, q int, angles double"


def brute(rows, divisor, positives=5, negatives=3):
    """The contract row by row, in Python integers."""
    rows = [(i, [math.floor(256 * float(x)) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], []
    for i, v, lab in rows:
        if i % divisor or (i, v, lab) in seen:
            continue
        seen.append((i, v, lab))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in rows)
        for p, j, _ in [s for s in scored if s[2] == lab and s[1] != i][:positives]:
            fit = [(-n, k) for n, k, other in scored if other != lab and 50 * -p <= 100 * -n <= 95 * -p][:negatives]
            out += [(i, j, r, k, H._clip(-p), H._clip(n)) for r, (n, k) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, divisor, **more):
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(3)
    found = H.mine(df, F.col("vec_id") % divisor == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def random_rows(n, width=6, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, width))
    x = centre[rng.integers(0, 3, n)] + 0.3 * rng.normal(size=(n, width))
    return [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(np.float32(x), rng.integers(0, 3, n)))]


@pytest.mark.parametrize("block_bytes", [32_000_000, 500])
def test_same_as_brute_force(spark, block_bytes):
    rows = random_rows(300)
    assert mined(spark, rows, 10, block_bytes=block_bytes) == brute(rows, 10)


def test_edges(spark):
    same = [0.5, 0.25]
    rows = [(0, same, 1), (0, same, 1), (1, same, 1), (2, same, 2), (2, same, 2), (4, [0.3, 0.2], 2), (6, [0.25], 2),
            (5, None, 1), (8, same, None), (None, same, 1), (10, [None, 0.1], 1), (12, [float("nan"), 0.1], 2),
            (14, [float("inf"), 0.1], 2), (16, [], 2), (18, [0.0, 0.0], 1), (20, [-0.5, -0.25], 1), (3, [0.5, 0.2, 9.0], 2)]
    assert mined(spark, rows, 2) == brute(rows, 2)
    assert mined(spark, [], 2) == [] == mined(spark, rows[7:9], 2)
    assert mined(spark, [(0, same, 1), (2, [0.1, 0.2], 2)], 2) == []            # no positive


def test_products_beyond_floats(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x * s)) for x in rng.normal(size=3)], int(i % 3))
            for s in (1e9, 1e20) for i in range(int(s > 1e9) * 40, int(s > 1e9) * 40 + 40)]
    assert mined(spark, rows, 4) == brute(rows, 4)


def test_bounds_hold_and_skip():
    rng = np.random.default_rng(5)
    x = np.floor(256 * H.unit(np.concatenate([rng.normal(size=(200, 16)), 5 + 0.05 * rng.normal(size=(200, 16))])))
    centre = H.reference_directions(x, 6)
    side = H.Side.__new__(H.Side)
    angles = np.arccos(np.clip(H.unit(x) @ centre.T, -1, 1)).astype(np.float32)
    side.q, side.norm, side.ids, side.labels = x, H.norms(x), np.arange(400), np.zeros(400, dtype=int)
    side.cos, side.sin = np.cos(angles).T, np.sin(angles).T
    exact = x @ x.T
    for low, high in ((30_000, 60_000), (50_000, 70_000), (-70_000, -20_000)):
        fits = H.bounds(side, slice(0, 400), side, np.full(400, low), np.full(400, high))
        inside = (exact >= low) & (exact <= high)
        assert not (inside & ~fits).any()
        assert fits.mean() < 0.99
    assert H.bounds(side, slice(0, 1), side, exact[0, :1], exact[0, :1])[0, 0]     # a row against itself: cosine 1


def test_whole_table(spark):
    rows = [(r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in tables(spark, "embeddings").collect()]
    assert sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, SF).collect())) == brute(rows, 50)
