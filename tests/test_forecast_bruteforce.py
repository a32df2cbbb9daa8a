"""The per-group forecast against a brute-force computation on random groups."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from regioncast.operators import predict_linear


def _exact(points, x0):
    n = len(points)
    sx = sum(x for x, _ in points)
    sy = sum(y for _, y in points)
    sxx = sum(x * x for x, _ in points)
    sxy = sum(x * y for x, y in points)
    den = n * sxx - sx * sx
    if den == 0:
        return 0
    slope = Fraction(n * sxy - sx * sy, den)
    value = Fraction(sy, n) + slope * (x0 - Fraction(sx, n))
    return max(0, int(value))  # int() truncates toward zero, like a Java (int) cast


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(11)
    out = {}
    for g in range(400):
        n = rng.choice([1, 2, 3, 5, 8, 20, 31])
        xs = rng.sample(range(1, 366), n) if rng.random() < 0.9 else [rng.randint(1, 365)] * n
        big = rng.random() < 0.2
        ys = [rng.randint(0, 10**9 if big else 50) for _ in xs]
        out[f"g{g}"] = (list(zip(xs, ys)), rng.randint(1, 400))
    return out


def test_exact_forecast_matches_rational_arithmetic(spark, groups):
    rows = [(g, x, y, x0) for g, (pts, x0) in groups.items() for x, y in pts]
    df = spark.createDataFrame(rows, "g string, x int, y bigint, x0 int")
    # ``at`` may use group columns only, so x0 is carried as a key.
    pred = predict_linear(df, ["g", "x0"], F.col("x"), F.col("y"), F.col("x0"))
    got = {r.g: r.pred for r in pred.collect()}
    assert len(got) == len(groups)
    for g, (pts, x0) in groups.items():
        assert got[g] == _exact(pts, x0), (g, pts, x0)


def test_float_forecast_close_to_polyfit(spark, groups):
    rows = [(g, x, y, x0) for g, (pts, x0) in groups.items() for x, y in pts]
    df = spark.createDataFrame(rows, "g string, x int, y bigint, x0 int")
    fit = predict_linear(df, ["g", "x0"], F.col("x"), F.col("y"), F.col("x0"), exact=False, keep_sums=True)
    for r in fit.collect():
        pts, x0 = groups[r.g]
        xs = np.array([p[0] for p in pts], dtype=float)
        if len(pts) < 2 or np.all(xs == xs[0]):
            assert r.pred == 0
            continue
        slope, intercept = np.polyfit(xs, np.array([p[1] for p in pts], dtype=float), 1)
        assert r._slope == pytest.approx(slope, rel=1e-6, abs=1e-6)
        expect = max(0.0, intercept + slope * x0)
        assert abs(r.pred - math.trunc(expect)) <= 1
