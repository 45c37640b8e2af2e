"""Pairs of stations without all pairs: the greatest distance by hulls, near pairs by cells."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rainloom.operators import variogram

POINT = st.tuples(st.integers(-5, 5).map(float), st.integers(-5, 5).map(float))
apart = lambda a, b: math.sqrt((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(POINT, st.tuples(st.floats(-1e3, 1e3), st.floats(-1e3, 1e3))), max_size=30))
def test_the_hull_is_as_wide_as_its_points(points):
    """Points on lines and grids, that repeat, and few of them."""
    want = max((apart(a, b) for a in points for b in points), default=0.0)
    assert variogram.widest(variogram.hull(points)) == pytest.approx(want, rel=1e-12)


def test_greatest_distance_over_partitions(spark):
    rng = random.Random(6)
    points = [(rng.gauss(0, 1e4), rng.gauss(0, 1e4)) for _ in range(3000)]
    df = spark.createDataFrame([(str(k), *p) for k, p in enumerate(points)] + [("none", None, 3.0), ("nan", float("nan"), 1.0)], "station string, x double, y double").repartition(7)
    want = max(apart(a, b) for a in points for b in points[:1500] + points[1500:] if a < b)
    assert variogram.greatest_distance(df) == pytest.approx(want, rel=1e-15)
    assert variogram.greatest_distance(df.limit(0)) == 0.0 and variogram.station_pairs(df.limit(0)).count() == 0
    same = spark.createDataFrame([("a", 1.0, 1.0), ("b", 1.0, 1.0)], "station string, x double, y double")
    assert variogram.station_pairs(same).count() == 0 and variogram.station_pairs(same, 5.0).count() == 1


def test_near_pairs_of_many_stations(spark):
    """100,000 stations would be five billion pairs; 40 metres about each are some thousands."""
    k = F.col("id")
    df = spark.range(100_000).select(k.cast("string").alias("station"), (F.pmod(F.xxhash64(k), F.lit(10_000_019)) / 100).alias("x"), (F.pmod(F.xxhash64(k + 1_000_000), F.lit(10_000_079)) / 100).alias("y")).cache()
    pairs = variogram.station_pairs(df, 60.0, 6)
    found = {(r.s1, r.s2): (r.distance, r.bin) for r in pairs.collect()}
    rows = {r.station: (r.x, r.y) for r in df.collect()}
    cells: dict = {}
    for s, (x, y) in rows.items():
        cells.setdefault((x // 60, y // 60), []).append(s)
    want = {}
    for (i, j), own in cells.items():
        near = [s for di in (-1, 0, 1) for dj in (-1, 0, 1) for s in cells.get((i + di, j + dj), [])]
        want |= {(a, b): d for a in own for b in near if a < b and (d := apart(rows[a], rows[b])) < 60}
    assert {p: d for p, (d, _) in found.items()} == want and all(b == int(d / 10) for d, b in found.values()) and len(want) > 3000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
