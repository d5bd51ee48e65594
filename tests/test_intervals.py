"""Joins by time and running sums against brute force, and the plans that make them bearable."""

import datetime as dt
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import intervals, stats

DAY0 = dt.datetime(2023, 1, 1)


def _at(minutes):
    return None if minutes is None else DAY0 + dt.timedelta(minutes=float(minutes))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    points = [(i, int(k), float(t)) for i, (k, t) in enumerate(zip(rng.integers(0, 4, 600), rng.uniform(-3000, 30_000, 600), strict=True))]
    lengths = rng.choice([0, 0.001, 1, 7, 60, 500, 4000, 20_000], 80) * rng.uniform(0.5, 2, 80)
    spans = [(j, int(k), float(a), float(a + n)) for j, (k, a, n) in enumerate(zip(rng.integers(0, 4, 80), rng.uniform(-2000, 30_000, 80), lengths, strict=True))]
    spans += [(90, 0, 500.0, 400.0), (91, None, 0.0, 9e4), (92, 1, None, 100.0), (93, 1, points[5][2], points[5][2]), (94, 2, points[9][2], points[12][2] if points[12][2] > points[9][2] else points[9][2] + 5)]
    return points + [(900, None, 5.0), (901, 1, None), (902, 3, 60.0), (902, 3, 60.0)], spans + [(95, 3, 60.0, 120.0), (96, 3, 0.0, 60.0)]


@pytest.fixture(scope="module")
def tables(spark, rows):
    points, spans = rows
    left = spark.createDataFrame([(i, k, _at(t)) for i, k, t in points], "id int, mmsi int, ts timestamp")
    right = spark.createDataFrame([(j, k, _at(a), _at(b)) for j, k, a, b in spans], "span int, mmsi int, a timestamp, b timestamp")
    return left, right


def _us(minutes):
    return round(minutes * 6e7)


@pytest.mark.parametrize(("keys", "closed", "margin"), [(["mmsi"], True, 0), (["mmsi"], True, 120), (["mmsi"], False, 0), ([], True, 10)])
def test_containment_is_that_of_brute_force(tables, rows, keys, closed, margin):
    points, spans = rows
    expected = Counter()
    for i, k, t in points:
        for j, o, a, b in spans:
            if None in (t, a, b) or keys and (k is None or k != o):
                continue
            x, low, high = _us(t), _us(a) - margin * 60_000_000, _us(b) + margin * 60_000_000
            if low <= x <= high if closed else low < x < high:
                expected[i, j] += 1
    left, right = tables
    right = right if keys else right.drop("mmsi")
    found = intervals.contained(left, right, keys, "ts", "a", "b", before=margin, after=margin, closed=closed)
    assert found.columns == ["id", "mmsi", "ts", "span", "a", "b"]
    assert Counter((r["id"], r["span"]) for r in found.collect()) == expected and sum(expected.values()) > 100


def test_a_busy_vessel_meets_few_pairs_in_vain(spark):
    """10**5 positions and 10**3 calls of one vessel, of minutes to weeks: at most 3 pairs for each row of the result."""
    positions = spark.range(100_000).select(F.lit(7).alias("mmsi"), F.timestamp_seconds(F.lit(1_672_531_200) + F.col("id") * 60).alias("ts"))
    minutes = F.element_at(F.array(*[F.lit(m) for m in (3, 20, 90, 700, 3000, 15_000)]), (F.col("id") % 6 + 1).cast("int"))
    calls = spark.range(1000).select(F.lit(7).alias("mmsi"), F.col("id").alias("call"), F.timestamp_seconds(F.lit(1_672_531_200) + F.col("id") * 5000).alias("a"), minutes.alias("m"))
    calls = calls.select("mmsi", "call", "a", (F.col("a") + F.make_interval(mins=F.col("m"))).alias("b"), "m")
    met = intervals._met(positions, calls, ["mmsi"], "ts", F.col("a"), F.col("b")).groupBy("m").agg(F.count("*").alias("met"), F.count_if((F.col("__at") >= F.col("__low")) & (F.col("__at") <= F.col("__high"))).alias("held"))
    for r in met.collect():
        assert r["met"] <= 3 * r["held"] + 400  # calls of minutes: buckets are no shorter than 67 seconds
    assert intervals.contained(positions, calls, ["mmsi"], "ts", "a", "b").count() == sum(r["held"] for r in met.collect())


def test_intervals_within_spans(spark):
    rng = np.random.default_rng(2)
    gaps = [(i, float(a), float(a + n)) for i, (a, n) in enumerate(zip(rng.uniform(0, 5000, 200), rng.choice([0, 3, 60, 900], 200), strict=True))]
    outages = [(float(a), float(a + n)) for a, n in zip(rng.uniform(0, 5000, 12), rng.choice([2, 100, 1500], 12), strict=True)]
    expected = {i for i, a, b in gaps for s, e in outages if a >= s - 5 and b <= e + 5 and a <= e and b >= s}
    left = spark.createDataFrame([(i, _at(a), _at(b)) for i, a, b in gaps], "id int, a timestamp, b timestamp")
    right = spark.createDataFrame([(_at(s), _at(e)) for s, e in outages], "s timestamp, e timestamp")
    found = [r["id"] for r in intervals.overlapping(left, ["id"], right, "a", "b", "s", "e", slack=5).collect()]
    assert sorted(found) == sorted(expected) and 20 < len(expected) < 200


def _lines(rows):
    """Brute force: for each key its instants with open places and intervals up to the next."""
    out = []
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        instants = sorted({t for r in own for t in r[2:]})
        for t, u in zip(instants, instants[1:], strict=False):
            active = [r for r in own if r[2] <= t and r[3] >= u]
            out.append((key, t, u, len({r[1] for r in active}), len(active)))
    return sorted(out)


@pytest.fixture(scope="module")
def stays():
    rng = np.random.default_rng(3)
    return [(f"T{k}", f"B{p}", _at(a), _at(a + n)) for k, p, a, n in zip(rng.integers(0, 2, 150), rng.integers(0, 3, 150), rng.integers(0, 15_000, 150), rng.choice([1, 45, 1440, 6000], 150), strict=True)]


def test_elementary_intervals_are_those_of_brute_force(spark, stays):
    df = spark.createDataFrame(stays, "terminal string, berth string, s timestamp, e timestamp")
    by_key = intervals.elementary(df, ["terminal"], "s", "e", "berth").collect()
    assert sorted(tuple(r) for r in by_key) == _lines(stays)
    alone = intervals.elementary(df, [], "s", "e", "berth").collect()
    flat = [("all", f"{k}{p}"[2:], a, b) for k, p, a, b in stays]
    assert sorted(tuple(r) for r in alone) == [r[1:] for r in _lines(flat)]


def test_no_window_holds_all_instants(spark, stays):
    df = spark.createDataFrame(stays, "terminal string, berth string, s timestamp, e timestamp")
    plan = intervals.elementary(df, [], "s", "e", "berth")._jdf.queryExecution().optimizedPlan().toString()
    unpartitioned = re.findall(r"windowspecdefinition\((\w+)#\d+L? ASC", plan)  # such a window's first part is its order
    assert "windowspecdefinition" in plan and set(unpartitioned) == {"__day"}


def test_running_sums_cross_days(spark):
    df = spark.createDataFrame([("a", _at(m), m) for m in (5, 10, 1500, 1501, 9000)] + [(None, _at(3), 7), (None, _at(4000), 1)], "k string, at timestamp, v int")
    found = {(r["k"], r["v"]): (r["total"], r["next"]) for r in intervals.running(df, ["k"], "at", {"total": "v"}, "next").collect()}
    assert found == {("a", 5): (5, _at(10)), ("a", 10): (15, _at(1500)), ("a", 1500): (1515, _at(1501)), ("a", 1501): (3016, _at(9000)), ("a", 9000): (12016, None), (None, 7): (7, _at(4000)), (None, 1): (8, None)}


def _histories(rows, days, by_key):
    out = set()
    for d in days:
        for k in {r[0] for r in rows} if by_key else {None}:
            known = [v for o, t, v in rows if None not in (t, v) and t.date() < d and (not by_key or o == k)]
            if known:
                out.add((d, *([k] if by_key else []), len(known), *np.round(np.percentile(known, [50, 75, 90, 95]), 6).tolist()))
    return out


@pytest.mark.parametrize("by_key", [True, False])
@pytest.mark.parametrize("blocks", [256, 3])
def test_histories_of_ties_nulls_and_many_values(spark, monkeypatch, by_key, blocks):
    monkeypatch.setattr(stats, "BLOCKS", blocks)
    rng = np.random.default_rng(5)
    rows = [(["a", "b", None][k], _at(t), float(v)) for k, t, v in zip(rng.integers(0, 3, 400), rng.integers(0, 40_000, 400), rng.choice([1, 2, 2.5, 7], 400) * rng.choice([1, 1, 1, rng.uniform(1, 9)], 400), strict=True)]
    rows += [("a", _at(t), float(v)) for t, v in zip(rng.integers(0, 40_000, 300), rng.normal(50, 20, 300), strict=True)] + [("a", None, 1.0), ("b", _at(5), None), ("c", _at(39_000), 4.0)]
    days = [DAY0.date() + dt.timedelta(days=i) for i in range(-2, 33, 3)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    asked = spark.createDataFrame([(d,) for d in days * 2], "day date")
    found = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in stats.pit_history(asked, "day", df, ["k"] if by_key else [], "t", "v").collect()]
    assert len(found) == len(set(found)) and set(found) == _histories(rows, days, by_key)


def test_histories_hold_no_lists_of_values(spark):
    """Each row of a day is a block or a value of a block, and nothing in the plan gathers values."""
    df = spark.range(3000).select(F.timestamp_seconds(F.lit(1_672_531_200) + F.col("id") * 600).alias("t"), (F.col("id") * 37 % 1000).cast("double").alias("v"))
    days = spark.range(20).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("day"))
    found = stats.pit_history(days, "day", df, [], "t", "v")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and not re.findall(r"windowspecdefinition\((\w+)#\d+L? ASC", plan)
    assert found.count() == 20
