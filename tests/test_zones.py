import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators import zones
from harborline.sources import files


def _box(x0, y0, x1, y1):
    return [[{"x": float(x), "y": float(y)} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))]]


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([("e", _box(10, 0, 14, 2)), ("w", _box(0, 0, 4, 2)), ("x", [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 2.0, "y": 0.0}, {"x": 0.0, "y": 2.0}]])], f"zone_code string, polygon {spatial.POLYGON}")


def test_templates_are_fitted_from_the_west(spark, shapes):
    profiles = spark.createDataFrame([(0, 100.0, 0.0, 90.0, 40.0, 20.0), (1, -5.0, 3.0, 0.0, 8.0, 4.0)], "cluster_id int, centre_x double, centre_y double, axis_degrees double, length_metres double, width_metres double")
    found = zones.fitted(zones.paired(shapes.filter("zone_code <> 'x'"), profiles, 2))
    rows = {r["zone_code"]: r for r in found.select("zone_code", "cluster_id", spatial.bounds(F.col("polygon")).alias("b"), spatial.area(F.col("polygon")).alias("a")).collect()}
    assert rows["w"]["cluster_id"] == 1 and tuple(rows["w"]["b"]) == (-9.0, 1.0, -1.0, 5.0)
    assert rows["e"]["cluster_id"] == 0 and [round(v, 6) for v in rows["e"]["b"]] == [90, -20, 110, 20] and abs(rows["e"]["a"] - 800) < 1e-6
    with pytest.raises(ValueError, match="clusters found"):
        zones.west_to_east(profiles)


def test_shapes_are_checked_and_normalised(shapes):
    assert [tuple(r) for r in zones.invalid(shapes).collect()] == [("x", "outline crosses itself")]
    assert [tuple(r) for r in zones.touching_boxes(shapes).collect()] == [("w", "x")]
    wide = zones.normalised(shapes.filter("zone_code <> 'x'"), 140).select(spatial.bounds(F.col("polygon")).alias("b")).agg(F.max("b.x1") - F.min("b.x0")).first()[0]
    assert abs(wide - 140) < 1e-9


def test_a_slanted_template_is_levelled_before_it_is_fitted(spark, shapes):
    slanted = shapes.filter("zone_code = 'w'").withColumn("polygon", spatial.moved(F.col("polygon"), degrees=30))
    r = slanted.select(spatial.rectangle(F.col("polygon")).alias("r")).first()["r"]
    assert [round(r[k], 6) for k in ("area", "angle", "length", "width")] == [8, 30, 4, 2]
    profile = spark.createDataFrame([(0, 0.0, 0.0, 0.0, 8.0, 6.0)], "cluster_id int, centre_x double, centre_y double, axis_degrees double, length_metres double, width_metres double")
    box = zones.fitted(zones.paired(slanted, profile, 1)).select(spatial.bounds(F.col("polygon")).alias("b")).first()["b"]
    assert [round(v, 6) for v in box] == [-4, -3, 4, 3]


def test_overlap_areas(spark):
    holed = _box(0, 0, 10, 10) + _box(4, 4, 6, 6)
    bent = [[{"x": float(x), "y": float(y)} for x, y in ((5, 0), (20, 0), (20, 10), (15, 10), (15, 5), (5, 5))]]
    given = spark.createDataFrame([("a", holed), ("b", bent), ("c", _box(15, 6, 18, 8)), ("d", _box(10, 7, 15, 9)), ("e", [holed[0][::-1], holed[1]])], f"zone_code string, polygon {spatial.POLYGON}")
    found = {(r["zone_code"], r["other"]): round(r["area"], 9) for r in zones.overlaps(given, 1e-9).collect()}
    # the hole takes 1 of the 25 that a and b share; d only touches
    assert found == {("a", "b"): 24, ("b", "e"): 24, ("a", "e"): 96, ("b", "c"): 6}
    zones.require_apart(given.filter("zone_code in ('a', 'c', 'd')"))
    with pytest.raises(ValueError, match="b and c: 6.00"):
        zones.require_apart(given.filter("zone_code in ('b', 'c')"))


def test_overlap_areas_against_a_grid(spark):
    rng = random.Random(5)
    rings = [[[{"x": r * math.cos(t), "y": r * math.sin(t)} for t, r in ((2 * math.pi * k / 9, rng.uniform(2, 6)) for k in range(9))]] for _ in range(6)]
    given = spark.createDataFrame([(f"z{i}", ring) for i, ring in enumerate(rings)], f"zone_code string, polygon {spatial.POLYGON}")
    points = spark.range(240 * 240).select(((F.col("id") % 240) * 0.05 - 5.975).alias("x"), (F.floor(F.col("id") / 240) * 0.05 - 5.975).alias("y"))
    inside = points.crossJoin(given).filter(spatial.covers(F.col("polygon"), F.col("x"), F.col("y"))).select("x", "y", "zone_code")
    both = inside.join(inside.withColumnRenamed("zone_code", "other"), ["x", "y"]).filter("zone_code < other").groupBy("zone_code", "other").count()
    counted = {(r["zone_code"], r["other"]): r["count"] * 0.0025 for r in both.collect()}
    found = {(r["zone_code"], r["other"]): r["area"] for r in zones.overlaps(given).collect()}
    assert len(found) == 15 and all(abs(found[k] - counted[k]) < 0.3 for k in found)


def test_wkt(spark):
    rows = [("p", "POLYGON((0 0, 4 0, 4 2, 0 2, 0 0),(1 1, 2 1, 2 1.5, 1 1.5, 1 1))"), ("m", "SRID=4326;MULTIPOLYGON Z (((0 0 1, 1e0 0 1, 1 1 1, 0 0 1)), ((-5 -5 0, -4 -5 0, -4 -4 0, -5 -5 0)))"), ("n", None)]
    given = spark.createDataFrame(rows, "zone_code string, wkt string")
    found = files.wkt_zones(given)
    areas = {(r["zone_code"], r["part"]): r["a"] for r in found.select("zone_code", "part", spatial.area(F.col("polygon")).alias("a")).collect()}
    assert areas == {("p", 0): 7.5, ("m", 0): 0.5, ("m", 1): 0.5}
    again = files.wkt_zones(found.select("zone_code", "part", spatial.to_wkt(F.col("polygon")).alias("wkt")).withColumnRenamed("part", "was"))
    assert sorted(r["a"] for r in again.select(spatial.area(F.col("polygon")).alias("a")).collect()) == [0.5, 0.5, 7.5]
    with pytest.raises(Exception, match="no polygon"):
        files.wkt_zones(spark.createDataFrame([("x", "POINT(1 2)")], "zone_code string, wkt string")).collect()


def test_evidence(spark):
    t = lambda m: dt.datetime(2023, 1, 1) + dt.timedelta(minutes=m)
    rows = [(c, c, t(m), 0.1, float(m), 0.0, m >= 30, False, 100.0) for c in (1, 2) for m in range(40)] + [(3, 3, t(m), 0.1, 0.0, 0.0, m > 2, False, 100.0) for m in (1, 2, 3)]
    points = spark.createDataFrame(rows, "validated_call_id long, mmsi long, recorded_at timestamp, speed_knots double, x double, y double, in_berth boolean, near_berth boolean, berth_metres double")
    early = zones.before_berth(points)
    assert early.count() == 60
    best = zones.anchorage(early, eps=1.5, min_samples=3).first()
    assert (best["vessel_count"], best["call_count"], best["point_count"]) == (2, 2, 60)
    assert zones.anchorage(early.filter("mmsi = 1"), eps=1.5, min_samples=2).count() == 0
    assert zones.evidence(points, "manoeuvring_basin").count() == 0
    assert zones.evidence(points.withColumn("speed_knots", F.lit(1.0)), "manoeuvring_basin").count() == 62
