"""Nearest sites against all distances."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starmart.operators import nearest


def chord(a, b):
    def point(p):
        y, x = math.radians(p[0]), math.radians(p[1])
        return [6371 * math.cos(y) * math.cos(x), 6371 * math.cos(y) * math.sin(x), 6371 * math.sin(y)]

    return round(math.dist(point(a), point(b)), 6)


def test_nearest_equals_all_distances(spark, plan):
    """Near, far and antipodal places, across the date line and at the poles; repeated ones once."""
    rng = random.Random(5)
    sites = [(rng.uniform(30, 60), rng.uniform(-10, 30)) for _ in range(150)] + [(89.9, 10.0), (0.0, 179.9), (40.0, 5.0), (40.0, 5.0)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(120)]
    points += [(rng.uniform(35, 55), rng.uniform(0, 20)) for _ in range(80)] + [(0.0, -179.9), (-89.0, 0.0), (90.0, 0.0), sites[3], sites[3]]
    found = nearest.nearest(
        spark.createDataFrame([*points, (None, 1.0), (95.0, 1.0)], "lat double, lon double"),
        spark.createDataFrame([*sites, (1.0, None)], "lat double, lon double"))
    got = {(r["lat"], r["lon"]): r for r in found.collect()}
    assert len(got) == len(set(points))
    for p, r in got.items():
        least = min(chord(p, s) for s in sites)
        assert abs(chord(p, (r["site_lat"], r["site_lon"])) - least) <= 2e-6
        assert abs(2 * 6371 * math.asin(min(least / 12742, 1)) - r["km"]) < 1e-3
    none = spark.createDataFrame([], "lat double, lon double")
    assert nearest.nearest(none, found.select("lat", "lon")).count() == 0
    assert nearest.nearest(found.select("lat", "lon"), none).count() == 0


@pytest.mark.parametrize(
    "text, value",
    [("57.05N", 57.05), ("10.33W", -10.33), (" -74.9 ", -74.9), ("3s", -3.0), ("", None), ("x", None), ("5 5", None), (None, None)],
)
def test_degrees(spark, text, value):
    row = spark.createDataFrame([(text,)], "t string").select(nearest.degrees(F.col("t")).alias("d")).first()
    assert row["d"] == value


def test_airports_get_the_least_name_at_the_nearest_place(spark):
    airports = spark.createDataFrame(
        [("A", "10.0, 50.0"), ("B", "-170.5, -10"), ("C", None), ("D", "nowhere"), ("E", "10.0, 50.0")], "ident string, coordinates string")
    cities = spark.createDataFrame(
        [("Y", "y", "50.5N", "10.5E"), ("X", "x", "50.5N", "10.5E"), ("Z", "z", "12S", "170W"), ("Q", "q", None, "1E")],
        "City string, Country string, Latitude string, Longitude string")
    got = {r["ident"]: (r["city"], r["country"]) for r in nearest.airport_cities(airports, cities).collect()}
    assert got == {"A": ("X", "x"), "B": ("Z", "z"), "C": (None, None), "D": (None, None), "E": ("X", "x")}
