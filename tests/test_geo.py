import math
import random

from pyspark.sql import functions as F

from tracklens.functions.geo import circular_diff, haversine_nm, lon_margin_deg, lon_margin_deg_at


def _hav_py(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 3440.065 * math.asin(math.sqrt(max(0.0, a)))


def test_haversine_basics(spark):
    df = spark.createDataFrame([(55.0, 14.0, 55.0001, 14.0), (55.0, 14.0, 55.0, 14.0), (10.0, 20.0, -5.0, 21.0)], "a double, b double, c double, d double")
    r = df.select(
        haversine_nm("a", "b", "c", "d").alias("x"), haversine_nm("c", "d", "a", "b").alias("y")
    ).collect()
    assert abs(r[0].x - 0.0060040) < 1e-6
    assert r[1].x == 0.0
    for row in r:
        assert abs(row.x - row.y) < 1e-12
    assert abs(r[2].x - _hav_py(10.0, 20.0, -5.0, 21.0)) < 1e-9


def test_haversine_null_is_zero_like_original(spark):
    # greatest() skips nulls, so a missing coordinate gives 0.0, not null
    df = spark.createDataFrame([(None, None, 55.0, 14.0)], "a double, b double, c double, d double")
    assert df.select(haversine_nm("a", "b", "c", "d").alias("x")).first().x == 0.0


def test_circular_diff(spark):
    df = spark.createDataFrame([(350.0, 10.0), (0.0, 180.0), (90.0, 90.0)], "x double, y double")
    assert [r.d for r in df.select(circular_diff("x", "y").alias("d")).collect()] == [20.0, 180.0, 0.0]


def test_lon_margin_contains_every_close_point():
    rnd = random.Random(7)
    for _ in range(3000):
        lat = rnd.uniform(-75, 75)
        dist = 0.1
        m = lon_margin_deg_at(lat, dist)
        # a point at the margin edge in longitude, with any latitude offset, is not closer than dist
        dlat = rnd.uniform(-dist / 60.0, dist / 60.0)
        assert _hav_py(lat, 0.0, lat + dlat, m) >= dist * (1 - 1e-9)


def test_lon_margin_column_matches_python(spark):
    df = spark.createDataFrame([(0.0,), (55.2,), (-70.0,), (89.99,)], "lat double")
    got = [r.m for r in df.select(lon_margin_deg(F.col("lat"), 0.1).alias("m")).collect()]
    want = [lon_margin_deg_at(x, 0.1) for x in (0.0, 55.2, -70.0, 89.99)]
    for g, w in zip(got, want):
        assert abs(g - w) < 1e-9 * max(1.0, w)
