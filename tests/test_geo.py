import math

import pytest
from pyspark.sql import functions as F

from cityloom.functions.geo import EARTH_RADIUS_M, SphereGrid, cosine_law_m, haversine_m, with_lat_lon_from_utm


def forward_utm(lat, lon, zone=10):
    """Forward series to the sixth order, as an independent check."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    a = 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    phi, lam = math.radians(lat), math.radians(lon - (6 * zone - 183))
    e = 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
    xi = math.atan2(t, math.cos(lam))
    eta = math.atanh(math.sin(lam) / math.sqrt(1 + t * t))
    x = eta + sum(c * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, c in enumerate(alpha, 1))
    y = xi + sum(c * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, c in enumerate(alpha, 1))
    return 500000 + 0.9996 * a * x, 0.9996 * a * y


def test_utm_undoes_the_forward_projection(spark):
    points = [(lat, lon) for lat in (49.0, 49.2, 49.31, 50.0) for lon in (-123.5, -123.1, -122.4)]
    rows = [(*forward_utm(lat, lon), lat, lon) for lat, lon in points]
    df = spark.createDataFrame(rows, "x double, y double, lat0 double, lon0 double")
    for r in with_lat_lon_from_utm(df, "x", "y").collect():
        assert abs(r["latitude"] - r["lat0"]) < 2e-8
        assert abs(r["longitude"] - r["lon0"]) < 2e-8


def test_utm_keeps_rows_without_coordinates(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "x double, y double")
    assert [(r["latitude"], r["longitude"]) for r in with_lat_lon_from_utm(df, "x", "y").collect()] == [(None, None)] * 2


def test_formulas_agree_and_scaled_is_larger_by_degrees(spark):
    row = (
        spark.range(1)
        .select(
            haversine_m("49.25D", "-123.1D", "49.26D", "-123.12D").alias("h"),
            cosine_law_m("49.25D", "-123.1D", "49.26D", "-123.12D").alias("c"),
            cosine_law_m("49.25D", "-123.1D", "49.26D", "-123.12D", scaled=True).alias("s"),
        )
        .first()
    )
    assert row["c"] == pytest.approx(row["h"], rel=1e-8)
    assert row["s"] == pytest.approx(math.degrees(row["c"]), rel=1e-12)


def test_scaled_limit_of_500_is_nine_metres(spark):
    step = 7.26 / EARTH_RADIUS_M * 180 / math.pi
    scaled = spark.range(1).select(cosine_law_m("49.25D", "-123D", f"{49.25 + step!r}D", "-123D", scaled=True)).first()[0]
    assert scaled == pytest.approx(415.9, abs=3)


def test_unclamped_coincident_points_can_be_nan(spark):
    df = spark.range(5000).selectExpr("49.2D + id * 0.0000213D AS lat", "-123.2D + id * 0.0000371D AS lon")
    nan = df.filter(F.isnan(cosine_law_m("lat", "lon", "lat", "lon", clamp=False))).count()
    assert nan > 0
    assert df.filter(F.isnan(cosine_law_m("lat", "lon", "lat", "lon"))).count() == 0


def test_cell_bounds_hold(spark):
    grid = SphereGrid(400_000.0, 2)
    pts = [(lat, lon) for lat in (-89.0, -45.0, 0.5, 49.2, 86.0) for lon in (-179.9, -20.0, 0.0, 120.0, 179.9)]
    places = spark.createDataFrame(pts, "lat double, lon double")
    others = places.selectExpr("lat + 1.1D AS lat2", "lon + 0.7D AS lon2").union(
        places.selectExpr("lat - 0.8D", "lon - 2.3D")
    ).filter("lat2 BETWEEN -90 AND 90")
    cells = grid.explode_bounded(places, "lat", "lon", "r", "c")
    hits = cells.join(grid.add_cell(others, "lat2", "lon2", "r", "c"), ["r", "c"]).withColumn(
        "h", F.pow(F.sin(haversine_m("lat", "lon", "lat2", "lon2") / (2 * EARTH_RADIUS_M)), 2)
    )
    assert hits.count() > 20
    assert hits.filter("h < __low * (1 - 1e-9) - 1e-15 OR h > __high * (1 + 1e-9) + 1e-15").count() == 0
