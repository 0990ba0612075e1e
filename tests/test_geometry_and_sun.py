import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafwave.functions.geometry import ecef_to_geodetic, geodetic_to_ecef, with_spherical_coords
from leafwave.functions.solar import residual_correction, sunrise_sunset, with_solar_position
from leafwave.operators.interpolation import clock_interpolate, hermite_interpolate

RX = (4075539.8, 931735.3, 4801629.6)


@pytest.mark.parametrize("lat,lon,alt", [(48.2, 16.37, 200), (-33.9, 151.2, 20), (0, 0, 0), (89.9, -120, 4000)])
def test_geodetic_round_trip(lat, lon, alt):
    got = ecef_to_geodetic(*geodetic_to_ecef(lat, lon, alt))
    assert got == pytest.approx((lat, lon, alt), abs=1e-6)


def test_directions(spark):
    lat, lon, alt = ecef_to_geodetic(*RX)
    zenith = geodetic_to_ecef(lat, lon, alt + 2e7)
    north = geodetic_to_ecef(lat + 10, lon, 2e7)
    below = tuple(-x for x in RX)
    df = spark.createDataFrame([zenith, north, below], "X double, Y double, Z double")
    z, n, b = with_spherical_coords(df, RX).collect()
    assert z["theta"] == pytest.approx(0, abs=1e-6) and z["r"] == pytest.approx(2e7, rel=1e-9)
    assert min(n["phi"], 2 * math.pi - n["phi"]) == pytest.approx(0, abs=1e-6)
    assert b["theta"] is None and b["phi"] is None and b["r"] is None


def test_directions_against_rotation_matrices(spark):
    rng = np.random.default_rng(2)
    sat = rng.normal(size=(200, 3))
    sat = sat / np.linalg.norm(sat, axis=1, keepdims=True) * 2.6e7
    got = with_spherical_coords(spark.createDataFrame(pd.DataFrame(sat, columns=list("XYZ"))), RX).toPandas()
    lat, lon, _ = ecef_to_geodetic(*RX)
    la, lo = math.radians(lat), math.radians(lon)
    turn_z = np.array([[math.cos(lo), math.sin(lo), 0], [-math.sin(lo), math.cos(lo), 0], [0, 0, 1]])
    turn_y = np.array([[math.cos(la), 0, math.sin(la)], [0, 1, 0], [-math.sin(la), 0, math.cos(la)]])
    for _, row in got.iterrows():
        up, east, north = turn_y @ turn_z @ (np.array([row.X, row.Y, row.Z]) - RX)
        if up < 0:
            assert np.isnan(row.theta)
        else:
            r = math.sqrt(up**2 + east**2 + north**2)
            assert row.theta == pytest.approx(math.acos(up / r), abs=1e-9)
            assert row.phi == pytest.approx(math.atan2(east, north) % (2 * math.pi), abs=1e-9)


def test_sun(spark):
    df = spark.createDataFrame([(datetime(2024, 6, 20, 12, 0),), (datetime(2024, 6, 20, 0, 0),)], "epoch timestamp_ntz")
    noon, night = with_solar_position(df, 0.0, 0.0).collect()
    # At the solstice the sun stands 23.4 degrees north of the equator at noon.
    assert noon["solar_elevation"] == pytest.approx(90 - 23.43, abs=0.1)
    assert night["solar_elevation"] < -60
    days = spark.createDataFrame([("2024-03-20",), ("2024-12-21",)], "date string").select(F.to_date("date").alias("date"))
    equinox, winter = sunrise_sunset(days, 48.2, 16.37).orderBy("date").collect()
    length = lambda r: (r["sunset"] - r["sunrise"]).total_seconds() / 3600
    assert length(equinox) == pytest.approx(12, abs=0.3) and length(winter) < 9


def test_residual_correction_is_a_least_squares_fit(spark):
    rng = np.random.default_rng(0)
    t = pd.date_range("2024-01-01", periods=500, freq="37min")
    h = t.hour + t.minute / 60
    v = 3 + 0.2 * h - 0.01 * h**2 + rng.normal(size=500) * 0.1
    df = spark.createDataFrame(pd.DataFrame({"epoch": t, "v": v})).withColumn("epoch", F.col("epoch").cast("timestamp_ntz"))
    got = residual_correction(df, "v").orderBy("epoch").toPandas()["v_corrected"]
    want = v - np.polyval(np.polyfit(h, v, 4), h)
    assert np.allclose(got, want, atol=1e-8)


def test_hermite_reproduces_a_cubic(spark):
    t0 = datetime(2024, 1, 1)
    f = lambda s: 1e-9 * s**3 - 2e-5 * s**2 + 0.3 * s + 7
    d = lambda s: 3e-9 * s**2 - 4e-5 * s + 0.3
    nodes = [(t0 + timedelta(seconds=s), "G01", *[f(s)] * 3, *[d(s)] * 3) for s in range(0, 90000, 900)]
    ephem = spark.createDataFrame(nodes, "epoch timestamp_ntz, sv string, X double, Y double, Z double, Vx double, Vy double, Vz double")
    # Before, inside (across day blocks), on a node and after the data.
    at = [-600, 0, 450, 86399, 86400, 88200, 89100, 89900]
    targets = spark.createDataFrame([(t0 + timedelta(seconds=s), "G01") for s in at], "epoch timestamp_ntz, sv string")
    for row in hermite_interpolate(ephem, targets).collect():
        s = (row["epoch"] - t0).total_seconds()
        assert row["X"] == pytest.approx(f(s), abs=1e-6)
        assert row["Vy"] == pytest.approx(d(s), abs=1e-9)


def test_clock_does_not_cross_jumps(spark):
    t0 = datetime(2024, 1, 1)
    values = [(0, 1e-7), (300, 2e-7), (600, 5e-4), (900, 5.001e-4), (1200, 9e-3)]
    clock = spark.createDataFrame(
        [(t0 + timedelta(seconds=s), "G01", v) for s, v in values], "epoch timestamp_ntz, sv string, clock_offset double"
    )
    at = [150, 450, 750, 1000, 1200, 1300]
    targets = spark.createDataFrame([(t0 + timedelta(seconds=s), "G01") for s in at], "epoch timestamp_ntz, sv string")
    got = {
        (r["epoch"] - t0).total_seconds(): r["clock_offset"] for r in clock_interpolate(clock, targets).collect()
    }
    assert got[150] == pytest.approx(1.5e-7)
    assert got[750] == pytest.approx(5.0005e-4)
    # Across a jump, into a one-point segment and past the end there is nothing.
    assert got[450] is None and got[1000] is None and got[1200] is None and got[1300] is None
