"""The nearest of some sites on the earth, by cells of a grid that widen until one is near enough."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import scratch_dir

RADIUS = 6371.0  # of the earth, km
START = 50.0  # edge of the first cells, km


def degrees(text: Column) -> Column:
    """Degrees from text such as ``-74.93``, ``57.05N`` or ``12.5W``; NULL where it is neither."""
    pattern = r"^\s*([+-]?[0-9]+(?:\.[0-9]*)?|[+-]?\.[0-9]+)\s*([NSEWnsew]?)\s*$"
    number = F.regexp_extract(text, pattern, 1).try_cast("double")
    south = F.upper(F.regexp_extract(text, pattern, 2)).isin("S", "W")
    return F.when(south, -number).otherwise(number)


def _placed(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    """The distinct places, as points of the sphere."""
    lat, lon = F.col(latitude), F.col(longitude)
    known = df.where(lat.between(-90, 90) & lon.between(-360, 360)).select(lat.alias("lat"), lon.alias("lon")).distinct()
    y, x = F.radians("lat"), F.radians("lon")
    return known.select(
        "lat", "lon", (F.cos(y) * F.cos(x) * RADIUS).alias("x"), (F.cos(y) * F.sin(x) * RADIUS).alias("y"),
        (F.sin(y) * RADIUS).alias("z"))


def _cell(axis: str, size: float) -> Column:
    return F.floor(F.col(axis) / size).cast("int")


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def nearest(
    points: DataFrame, sites: DataFrame, latitude: str = "lat", longitude: str = "lon", start: float = START
) -> DataFrame:
    """(lat, lon, site_lat, site_lon, km): for each distinct place of ``points`` the nearest of the sites.

    A place looks into its cell and those around it. What it finds there within a cell's edge is
    the nearest of all, for others are farther off; places that find none go on with cells of
    twice the edge, until a cell holds the earth. Distances count to a millimetre, and of equally
    near sites the southernmost, then westernmost counts. Without sites there is no row.
    """
    left, targets = _stored(_placed(points, latitude, longitude), "points"), _stored(_placed(sites, latitude, longitude), "sites")
    found = None
    size = start
    spark = points.sparkSession
    none = spark.createDataFrame([], "lat double, lon double, site_lat double, site_lon double, km double")
    if targets.isEmpty():
        return none
    while True:
        last = size > 2 * RADIUS
        cells = left
        for axis in "xyz":
            own = _cell(axis, size)
            cells = cells.withColumn(f"c{axis}", F.explode(F.array(own - 1, own, own + 1)))
        held = targets.select(
            F.col("lat").alias("site_lat"), F.col("lon").alias("site_lon"),
            *[F.col(a).alias(f"site_{a}") for a in "xyz"], *[_cell(a, size).alias(f"c{a}") for a in "xyz"])
        apart = sum((F.pow(F.col(a) - F.col(f"site_{a}"), 2) for a in "xyz"), F.lit(0.0))
        met = cells.join(held, ["cx", "cy", "cz"]).withColumn("chord", F.round(F.sqrt(apart), 6))
        best = met.groupBy("lat", "lon").agg(F.min(F.struct("chord", "site_lat", "site_lon")).alias("best"))
        best = _stored(best.where(F.col("best.chord") <= (size if not last else 3 * RADIUS)), "near")
        km = 2 * RADIUS * F.asin(F.least(F.col("best.chord") / (2 * RADIUS), F.lit(1.0)))
        near = best.select("lat", "lon", "best.site_lat", "best.site_lon", km.alias("km"))
        found = near if found is None else found.unionByName(near)
        left = left.join(best.select("lat", "lon"), ["lat", "lon"], "left_anti")
        if last:
            return found
        left = _stored(left, "points")
        if left.isEmpty():
            return found
        size *= 2


def airport_cities(airports: DataFrame, cities: DataFrame) -> DataFrame:
    """Airports with the nearest city: ident, city, country, km; without one where either has no place.

    ``airports`` has ident and coordinates, longitude before latitude; ``cities`` City, Country,
    Latitude and Longitude. Of several cities at one place the least name counts.
    """
    parts = F.split("coordinates", ",")
    ports = airports.select(
        "ident", degrees(F.get(parts, F.lit(1))).alias("lat"), degrees(F.get(parts, F.lit(0))).alias("lon"))
    towns = cities.select(
        "City", "Country", degrees(F.col("Latitude")).alias("site_lat"), degrees(F.col("Longitude")).alias("site_lon"))
    named = towns.groupBy("site_lat", "site_lon").agg(F.min(F.struct("City", "Country")).alias("town"))
    near = nearest(ports, towns.withColumnsRenamed({"site_lat": "lat", "site_lon": "lon"}))
    placed = near.join(named, ["site_lat", "site_lon"]).select("lat", "lon", "town", "km")
    return ports.join(placed, ["lat", "lon"], "left").select(
        "ident", F.col("town.City").alias("city"), F.col("town.Country").alias("country"), "km")
