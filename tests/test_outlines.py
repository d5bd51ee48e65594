"""Outlines of tracks and repaired polygons against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators import outlines, spatial_joins, zones

CELL = 20.0


def _disc(radius):
    reach = int(radius / CELL)
    return [(i, j) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1) if math.hypot(i, j) * CELL <= radius]


def _area(xy, buffer, closing):
    """Brute force: the cells that are covered."""
    cells = {(math.floor(x / CELL), math.floor(y / CELL)) for x, y in xy}
    wide = {(a + i, b + j) for a, b in cells for i, j in _disc(buffer)}
    if closing >= CELL:
        wider = {(a + i, b + j) for a, b in wide for i, j in _disc(closing)}
        wide = {c for c in wider if all((c[0] + i, c[1] + j) in wider for i, j in _disc(closing))}
    return wide


def _parts(cells):
    left, found = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            a, b = todo.pop()
            part.add((a, b))
            for c in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if c in left:
                    left.remove(c)
                    todo.append(c)
        found.append(part)
    return found


def _track(seed):
    """A curved fairway with gaps, a loop around a dry place, and a lonely point."""
    rng = np.random.default_rng(seed)
    t = np.concatenate([np.linspace(0, 3, 60), np.linspace(3.2, 6, 60)])
    way = np.stack([t * 700, 300 * np.sin(t)], 1) + rng.normal(0, 15, (120, 2))
    loop = np.stack([5000 + 400 * np.cos(np.linspace(0, 2 * math.pi, 90)), 400 * np.sin(np.linspace(0, 2 * math.pi, 90))], 1)
    return np.concatenate([way, loop, [[-4000.0, -4000.0]]])


@pytest.mark.parametrize(("seed", "buffer", "closing"), [(1, 60.0, 0.0), (2, 60.0, 80.0)])
def test_areas_are_those_of_brute_force(spark, seed, buffer, closing):
    xy = _track(seed)
    points = spark.createDataFrame([(float(x), float(y)) for x, y in xy] + [(None, 1.0)], "x double, y double").repartition(3)
    found = outlines.outlines(points, cell=CELL, buffer=buffer, closing=closing).withColumn("area", spatial.area(F.col("polygon"))).cache()
    expected = sorted(len(p) for p in _parts(_area(xy, buffer, closing)))
    assert sorted(r["cell_count"] for r in found.collect()) == expected and len(expected) >= 3
    for r in found.collect():
        assert r["area"] == r["cell_count"] * CELL * CELL
    hits = spatial_joins.in_polygons(points.dropna(), found.select("part", "polygon"), x="x", y="y", cell=500.0).select("x", "y").distinct().count()
    assert hits == len(set(map(tuple, xy)))
    assert found.filter(F.size("polygon") > 1).count() >= 1  # the loop has a hole
    large = outlines.outlines(points, cell=CELL, buffer=buffer, closing=closing, least_area=CELL * CELL * (expected[0] + 1), holes=False)
    assert large.filter(F.size("polygon") > 1).isEmpty() and large.count() == sum(n > expected[0] for n in expected)


def test_a_straight_track_has_the_area_of_its_buffer(spark):
    points = spark.range(2001).select(F.col("id").cast("double").alias("x"), F.lit(7.0).alias("y"))
    (r,) = outlines.outlines(points, cell=5.0, buffer=100.0).select(spatial.area(F.col("polygon")).alias("a")).collect()
    assert abs(r["a"] / (2000 * 200 + math.pi * 100**2) - 1) < 0.04


def test_rings_touch_but_do_not_cross():
    cells = [(0, 0), (1, 0), (2, 0), (0, 1), (2, 1), (0, 2), (1, 2), (3, 2), (2, 2)]  # a ring of cells, closed
    diagonal = [(0, 0), (1, 1), (1, 0), (2, 1), (2, 2), (1, 2), (0, 2), (0, 1)]
    for area in (cells, [c for c in diagonal if c != (0, 1)], [(0, 0)]):
        sides = []
        for x, y in area:
            for (cx, cy, dx, dy), beside in (((0, 0, 1, 0), (0, -1)), ((1, 0, 0, 1), (1, 0)), ((1, 1, -1, 0), (0, 1)), ((0, 1, 0, -1), (-1, 0))):
                if (x + beside[0], y + beside[1]) not in area:
                    sides.append((x + cx, y + cy, dx, dy))
        found = outlines.rings(iter(sides))
        twice = [sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) for r in found]
        assert sum(twice) == 2 * len(area) and sum(t > 0 for t in twice) == 1


def test_zones_are_drawn_from_evidence(spark):
    rng = np.random.default_rng(4)
    rows = [(float(x), float(y), 1.0, 900.0, False) for x, y in rng.normal(0, 120, (300, 2))] + [(9000.0, 9000.0, 1.0, 900.0, False), (0.0, 0.0, 9.0, 900.0, False)]
    points = spark.createDataFrame(rows, "x double, y double, speed_knots double, berth_metres double, in_berth boolean")
    found = zones.drawn(points, "manoeuvring_basin").collect()
    assert len(found) == 2 and {r["zone_type"] for r in found} == {"manoeuvring_basin"} and all(len(r["polygon"]) == 1 for r in found)
    assert zones.drawn(points, "shipping_channel").count() == 0  # one point is no evidence
    assert zones.drawn(points, "anchorage").count() >= 2


def _ring(*corners):
    return [{"x": float(x), "y": float(y)} for x, y in corners]


SHAPES = {
    "bow": [_ring((0, 0), (2, 2), (2, 0), (0, 2))], "plain": [_ring((0, 0), (4, 0), (4, 4), (0, 4))], "holed": [_ring((0, 0), (4, 0), (4, 4), (0, 4)), _ring((1, 1), (2, 1), (2, 2), (1, 2))],
    "touching": [_ring((0, 0), (4, 0), (4, 4), (2, 0), (0, 4))], "spiked": [_ring((0, 0), (4, 0), (4, 4), (4, 8), (4, 4), (0, 4))], "star": [_ring(*[(math.cos(k * 4 * math.pi / 5), math.sin(k * 4 * math.pi / 5)) for k in range(5)])],
    "hole_over_the_edge": [_ring((0, 0), (4, 0), (4, 4), (0, 4)), _ring((3, 1), (6, 1), (6, 2), (3, 2))], "flat": [_ring((0, 0), (1, 1), (2, 2))], "inner_loop": [_ring((0, 0), (6, 0), (6, 6), (0, 6), (0, 0), (1, 1), (1, 2), (2, 2), (2, 1), (1, 1))]}


@pytest.fixture(scope="module")
def shapes(spark):
    rng = np.random.default_rng(6)
    more = {f"random{i}": [_ring(*rng.uniform(0, 9, (7, 2)))] for i in range(4)}
    return spark.createDataFrame(list((SHAPES | more).items()), f"zone_code string, polygon {spatial.POLYGON}")


def test_repaired_outlines_do_not_cross_and_cover_the_same(spark, shapes):
    found = zones.repaired(shapes, 1e-6).cache()
    assert found.filter(~spatial.is_simple(F.col("polygon"))).isEmpty()
    count = {r["zone_code"]: r["n"] for r in found.groupBy("zone_code").agg(F.count("*").alias("n")).collect()}
    assert (count["bow"], count["plain"], count["holed"], count["touching"], count["spiked"], count["star"], "flat" in count) == (2, 1, 1, 2, 1, 1, False)
    area = {r["zone_code"]: r["a"] for r in found.groupBy("zone_code").agg(F.sum(spatial.area(F.col("polygon"))).alias("a")).collect()}
    assert [round(area[z], 9) for z in ("bow", "plain", "holed", "spiked", "hole_over_the_edge", "inner_loop")] == [2, 16, 15, 16, 17, 35]
    # points are covered by the parts together as by the even-odd rule over the outline as it was
    grid = spark.range(46 * 46).select(((F.col("id") % 46) * 0.2033 - 0.1077).alias("x"), (F.floor(F.col("id") / 46) * 0.2011 - 0.1033).alias("y"))
    inside = lambda df: {(r["zone_code"], r["x"], r["y"]) for r in grid.crossJoin(df).filter(spatial.covers(F.col("polygon"), F.col("x"), F.col("y"))).select("zone_code", "x", "y").collect()}
    assert inside(found) == inside(shapes.filter("zone_code <> 'flat'"))


def test_small_pieces_are_dropped(shapes):
    found = zones.repaired(shapes.filter("zone_code in ('bow', 'plain')"), 1.5).collect()
    assert [(r["zone_code"], r["part"]) for r in found] == [("plain", 0)]
