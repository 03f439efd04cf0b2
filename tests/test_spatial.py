"""Range joins with busy cells, and nearest rows without a bound, against plain loops."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import spatial

T = dt.datetime(2024, 1, 1)
TARGETS = "storm int, t_lat double, t_lon double, t_ts timestamp, after int"
SAMPLES = "id int, lat double, lon double, ts timestamp"


def plain(targets, samples, box):
    out = []
    for s, t_lat, t_lon, t_ts, after in targets:
        for i, lat, lon, ts in samples:
            near = abs((lon - t_lon + 180) % 360 - 180) <= box.width / 2 and abs(lat - t_lat) <= box.height / 2
            if near and t_ts - dt.timedelta(seconds=box.before) <= ts <= t_ts + dt.timedelta(seconds=after):
                out.append((s, i))
    return sorted(out)


def made(busy):
    """Samples of which nine in ten lie in one cell, a third of these at one place and time."""
    draw = random.Random(11)
    at = lambda: T + dt.timedelta(seconds=draw.randint(0, 90_000))
    rows = []
    for i in range(3000):
        if i % 10:
            rows.append((i, 1.0, 2.0, T) if i % 3 == 0 and busy else (i, draw.uniform(0, 13.9), draw.uniform(0, 13.9), T + dt.timedelta(seconds=draw.randint(0, 21_599))))
        else:
            rows.append((i, draw.uniform(-90, 90), draw.uniform(-180, 360), at()))
    targets = [(s, draw.uniform(-20, 30), draw.uniform(-30, 40), at(), draw.choice([0, 7200, 18_000])) for s in range(40)]
    return [*targets, (98, 15.0, 16.0, T, 0), (99, 1.0, 359.0, T, 3600)], rows


@pytest.mark.parametrize("most", [1_000_000, 60])
def test_range_join_equals_loops(spark, most):
    targets, samples = made(True)
    t = spark.createDataFrame([*targets, (-1, None, 0.0, T, 0)], TARGETS)
    s = spark.createDataFrame([*samples, (-1, None, 0.0, T), (-2, 0.0, None, T), (-3, 0.0, 0.0, None)], SAMPLES).repartition(4)
    box = spatial.Box()
    got = sorted((r.storm, r.id) for r in spatial.range_join(t, s, box, most=most).collect())
    assert got == plain(targets, samples, box)
    assert len(got) > 1000


def test_busy_cells_are_cut(spark):
    targets, samples = made(True)
    t, s = spatial.spread(spark.createDataFrame(targets, TARGETS), spark.createDataFrame(samples, SAMPLES), spatial.Box(), "after", 60)
    sizes = sorted(r["count"] for r in s.groupBy(*spatial.KEY).count().collect())
    assert sum(sizes) == 3000 and sizes[-1] <= 120  # 4 % of the samples at most, where one cell has 90 %
    assert t.count() < 40 * 3 * 3 * 3 * 60
    plain_sizes = spatial.spread(spark.createDataFrame(targets, TARGETS), spark.createDataFrame(samples, SAMPLES), spatial.Box(), "after", 10_000)[1].groupBy(*spatial.KEY).count()
    assert plain_sizes.agg(F.max("count")).first()[0] > 2000


def test_nearest_ever_equals_loops(spark):
    draw = random.Random(2)
    at = lambda: draw.choice([None, *(T + dt.timedelta(seconds=s) for s in range(0, 4000, 40))])
    key = lambda: draw.choice([1, 1, 1, 1, 2, 3, None])
    left = [(key(), i, at()) for i in range(1500)] + [(1, 7, T), (1, 7, T), (9, 8, T)]
    right = [(key(), i, at(), draw.choice([None, "x", "y"])) for i in range(1200)]
    want = []
    for k, i, t in left:
        near = [(abs(t - there), p, there, x) for rk, p, there, x in right if rk == k and there is not None] if t else []
        if near:
            _, p, there, x = min(near, key=lambda n: n[:2])
            want.append((k, i, t, p, there, x))
    l_, r = spark.createDataFrame(left, "k int, id int, ts timestamp").repartition(3), spark.createDataFrame(right, "k int, p int, there timestamp, x string").repartition(3)
    got = [tuple(x) for x in spatial.nearest_ever(l_, r, ["k"], "ts", "there", "p").select("k", "id", "ts", "p", "there", "x").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert spatial.nearest_ever(l_.limit(0), r, ["k"], "ts", "there", "p").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        spatial.nearest_ever(l_, r.withColumnRenamed("x", "id"), ["k"], "ts", "there", "p")


@pytest.mark.parametrize("most", [1_000_000, 30])
def test_value_range_join_equals_loops(spark, most):
    draw = random.Random(6)
    left = [(i, draw.choice([None, draw.uniform(-50, 50), 1.0])) for i in range(60)]
    right = [(i, draw.choice([None, 1.5, 1.5, 1.5, draw.uniform(-50, 50)])) for i in range(500)]
    l_, r = spark.createDataFrame(left, "i int, x double"), spark.createDataFrame(right, "j int, y double").repartition(4)
    got = sorted((p.i, p.j) for p in spatial.value_range_join(l_, r, "x", "y", 2.0, most).select("i", "j").collect())
    assert got == sorted((i, j) for i, x in left for j, y in right if x is not None and y is not None and abs(x - y) <= 2.0)


def test_nearest_value_against_all_pairs_without_making_them(spark):
    import random

    rng = random.Random(5)
    value = lambda: rng.choice([None, float("nan"), float("inf"), *[round(rng.uniform(-90, 90), rng.choice([0, 2])) for _ in range(27)]])
    ls, rs = [(i, value()) for i in range(400)], [(i % 280, value()) for i in range(300)]
    l_, r = spark.createDataFrame([*ls, ls[3]], "i long, x double").repartition(3), spark.createDataFrame(rs, "j long, y double").repartition(4)
    got = sorted((p.i, p.j) for p in spatial.nearest_value(l_, r, "x", "y", 2.0, "j").select("i", "j").collect())
    want = []
    for i, x in [*ls, ls[3]]:
        near = [(abs(x - y), j) for j, y in rs if x is not None and y is not None and abs(x - y) <= 2.0]
        want += [(i, min(near)[1])] if near else []
    assert got == sorted(want)
    assert spatial.nearest_value(l_.limit(0), r, "x", "y", 2.0, "j").count() == spatial.nearest_value(l_, r.limit(0), "x", "y", 2.0, "j").count() == 0
    many = spark.range(200_000)  # 4 * 10 ** 10 pairs within the width
    found = spatial.nearest_value(many.select(F.col("id").alias("i"), (F.col("id") % 7).cast("double").alias("x")), many.select(F.col("id").alias("j"), (F.col("id") % 5).cast("double").alias("y")), "x", "y", 50.0, "j")
    assert [tuple(x) for x in found.groupBy("j").count().orderBy("j").collect()] == [(0, 28572), (1, 28572), (2, 28572), (3, 28571), (4, 85713)]
