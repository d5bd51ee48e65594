import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.functions import spatial, text
from harborline.operators import checks, clusters, intervals, rank, sessions, spatial_joins, stats
from harborline.plans import calls, catalog_operators, config, enrichment, gates, serve, terminal
from harborline.sources import files, positions
from harborline.streaming import live

RAW = {"MMSI": " 123456789 ", "BaseDateTime": "2023-01-01T00:00:00", "LAT": "29.7", "LON": "-93.9", "SOG": "0.1", "COG": "10.0", "Heading": "20", "VesselName": " A ", "IMO": "IMO9876543", "CallSign": " ", "VesselType": "80.0", "Status": "1", "Length": "290", "Width": "46", "Draft": "11", "Cargo": "80", "TransceiverClass": "A"}


def _raw(spark, *changes):
    rows = [RAW | c for c in changes]
    return spark.createDataFrame([[r[c] for c in positions.COLUMNS] for r in rows], ", ".join(f"{c} string" for c in positions.COLUMNS))


def test_clean_keeps_and_trims(spark):
    (r,) = positions.clean(_raw(spark, {}, {})).collect()
    assert (r["mmsi"], r["vessel_name"], r["call_sign"], r["vessel_type"], r["heading_degrees"]) == (123456789, "A", None, 80, 20.0)


@pytest.mark.parametrize("change", [{"LAT": "95"}, {"LAT": None}, {"MMSI": "12345678"}, {"MMSI": "12345678x"}, {"BaseDateTime": "soon"}, {"LON": "-180.1"}])
def test_clean_drops(spark, change):
    assert positions.clean(_raw(spark, change)).count() == 0


def test_unavailable_readings_are_null(spark):
    (r,) = positions.clean(_raw(spark, {"SOG": "102.3", "COG": "360", "Heading": "511", "Length": "0", "Width": "101", "Draft": "31", "VesselType": "80.5"})).collect()
    assert [r[c] for c in ("speed_knots", "course_degrees", "heading_degrees", "length_metres", "width_metres", "draught_metres", "vessel_type")] == [None] * 7
    (r,) = positions.clean(_raw(spark, {"SOG": "102.2", "COG": "359.9", "Heading": "359", "Length": "500", "Width": "100", "Draft": "30", "LAT": "90"})).collect()
    assert [r[c] for c in ("speed_knots", "course_degrees", "heading_degrees", "length_metres", "width_metres", "draught_metres", "latitude")] == [102.2, 359.9, 359, 500, 100, 30, 90]


def test_load_keeps_known_values(spark, tmp_path):
    silver = positions.clean(_raw(spark, {}, {"BaseDateTime": "2023-01-01T00:10:00", "VesselName": ""}))
    assert positions.validate(silver) == 2
    kinds = "mmsi bigint, imo bigint, vessel_name string, call_sign string, vessel_type bigint, length_metres double, width_metres double, cargo bigint, transceiver_class string"
    vessels = spark.createDataFrame([(123456789, None, "OLD", "CALL", None, None, None, None, None)], kinds)
    held = silver.select(*positions.POSITION).limit(1)
    merged, all_positions = positions.load(silver, vessels, held)
    (v,) = merged.collect()
    assert (v["imo"], v["vessel_name"], v["call_sign"]) == (9876543, "A", "CALL")
    assert all_positions.count() == 2
    with pytest.raises(ValueError, match="missing columns"):
        positions.validate(silver.drop("cargo"))
    _raw(spark, {}).write.csv(str(tmp_path / "raw"), header=True)
    assert spark.read.parquet(positions.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "silver"))).count() == 1


def test_gaps_and_states_break_islands(spark):
    t = lambda m: dt.datetime(2023, 1, 1) + dt.timedelta(minutes=m)
    rows = [(1, t(0), "a"), (1, t(20), "a"), (1, t(41), "a"), (1, t(45), None), (1, t(50), None), (1, t(55), "a")]
    df = spark.createDataFrame(rows, "k int, ts timestamp, zone string")
    by_gap = [r["session_no"] for r in sessions.number_islands(df, ["k"], "ts", 20).orderBy("ts").collect()]
    by_state = [r["n"] for r in sessions.number_islands(df, ["k"], "ts", 20, state="zone", out="n").orderBy("ts").collect()]
    assert by_gap == [1, 1, 2, 2, 2, 2] and by_state == [1, 1, 2, 3, 3, 4]


def test_days_and_elementary_intervals(spark):
    d = lambda day, h=0: dt.datetime(2023, 1, day, h)
    df = spark.createDataFrame([("x", d(1), d(2)), ("x", d(1, 12), d(3)), ("y", d(1, 18), d(1, 20)), ("y", d(4), d(5))], "berth string, s timestamp, e timestamp")
    assert sorted(r["metric_date"].day for r in intervals.by_day(df, "s", "e").collect()) == [1, 1, 1, 2, 4]
    rows = intervals.elementary(df, [], "s", "e", "berth").orderBy("interval_start").collect()
    assert [(r["occupied"], r["active"]) for r in rows] == [(1, 1), (1, 2), (2, 3), (1, 2), (1, 1), (0, 0), (1, 1)]


def test_use_by_day_is_that_of_days_one_by_one(spark):
    rng = np.random.default_rng(2)
    rows = [(_at(int(a)), _at(int(a + n))) for a, n in zip(rng.integers(0, 20_000, 60), rng.choice([0, 1, 30, 1440, 2880, 9000], 60), strict=True)] + [(_at(100_000), _at(100_001)), (None, _at(3)), (_at(5), _at(2))]
    df = spark.createDataFrame(rows, "s timestamp, e timestamp")
    one = intervals.by_day(df.filter("e > s"), "s", "e").groupBy("metric_date").agg(F.count("*").alias("active"), F.sum(intervals.day_overlap_minutes("s", "e", "metric_date")).alias("minutes"))
    expected = sorted((r[0], r[1], round(r[2], 6)) for r in one.collect())
    assert sorted((r[0], r[1], round(r[2], 6)) for r in intervals.daily_use(df, "s", "e").collect()) == expected


def test_history_is_that_of_brute_force(spark):
    rng = np.random.default_rng(3)
    calls_ = [(f"B{i % 3}", _at(int(t)), float(v)) for i, (t, v) in enumerate(zip(rng.integers(0, 9000, 50), rng.uniform(0, 99, 50), strict=True))]
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=i) for i in range(8)]
    df = spark.createDataFrame(calls_, "berth string, t timestamp, v double")
    asked = spark.createDataFrame([(d,) for d in days], "day date")
    for keys in (["berth"], []):
        expected = set()
        for d in days:
            for b in {c[0] for c in calls_} if keys else {None}:
                known = [v for c, t, v in calls_ if t.date() < d and b in (c, None)]
                if known:
                    expected.add((d, *([b] if keys else []), len(known), *np.round(np.percentile(known, [50, 75, 90, 95]), 6).tolist()))
        found = {tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in stats.pit_history(asked, "day", df, keys, "t", "v").collect()}
        assert found == expected


def test_numbers_by_cell_are_those_of_one_window(spark):
    df = spark.range(200).select("id", F.expr("timestamp'2023-01-01' + make_interval(0, 0, 0, 0, cast(id * 37 % 101 as int))").alias("t"))
    number = lambda cell: {r["id"]: r["n"] for r in rank.numbered(df, [F.col("t"), F.col("id")], "n", cell).collect()}
    assert number(F.to_date("t")) == number(None)


def test_distance_and_projection(spark):
    row = spark.range(1).select(
        spatial.distance_m(*map(F.lit, (29.73, -93.87, 29.77, -93.83))).alias("d"), *[c.alias(n) for c, n in zip(spatial.utm(F.lit(29.73), F.lit(-93.87)), ("e", "n"), strict=True)]).first()
    assert abs(row["d"] - 5885.4) < 2
    back = spark.range(1).select(*[c.alias(n) for c, n in zip(spatial.lat_lon(F.lit(row["e"]), F.lit(row["n"])), ("lat", "lon"), strict=True)]).first()
    assert abs(back["lat"] - 29.73) < 1e-8 and abs(back["lon"] + 93.87) < 1e-8


SQUARE = [[{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}, {"x": 0.0, "y": 2.0}], [{"x": 0.5, "y": 0.5}, {"x": 1.5, "y": 0.5}, {"x": 1.5, "y": 1.5}, {"x": 0.5, "y": 1.5}]]


def test_polygons(spark):
    zones = spark.createDataFrame([("z", SQUARE)], f"zone string, polygon {spatial.POLYGON}")
    points = spark.createDataFrame([(1, 0.2, 0.2), (2, 1.0, 1.0), (3, 2.0, 1.0), (4, 2.1, 1.0), (5, 0.0, 0.0)], "id int, longitude double, latitude double")
    assert sorted(r["id"] for r in spatial_joins.in_polygons(points, zones, cell=0.3).collect()) == [1, 3, 5]
    r = zones.select(spatial.area(F.col("polygon")).alias("a"), spatial.centroid(F.col("polygon")).alias("c"), spatial.is_simple(F.col("polygon")).alias("s"), spatial.moved(F.col("polygon"), degrees=90, dx=1, scale_x=2)[0][0].alias("p")).first()
    assert r["a"] == 3.0 and (r["c"]["x"], r["c"]["y"], r["s"]) == (1.0, 1.0, True)
    assert abs(r["p"]["x"] - 3.0) < 1e-9 and abs(r["p"]["y"] + 1.0) < 1e-9


def test_points_in_few_cells_are_not_dealt_by_cell(spark, capsys):
    """Few zones are broadcast, whatever they come from: all points in one cell would otherwise be one task's work."""
    zones = spark.createDataFrame([("z", 1.0, 1.0, 9000.0, SQUARE)], f"zone string, centre_latitude double, centre_longitude double, radius_metres double, polygon {spatial.POLYGON}")
    points = spark.range(1000).select("id", (F.col("id") % 7 / 1000 + 0.01).alias("longitude"), F.lit(0.01).alias("latitude"))
    for found in (spatial_joins.in_polygons(points, zones), spatial_joins.within_distance(points, zones.drop("polygon"))):
        found.explain()
        plan = capsys.readouterr().out
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert spatial_joins.in_polygons(points, zones).count() == 1000


def test_dbscan_is_that_of_brute_force(spark):
    rng = np.random.default_rng(4)
    xy = np.concatenate([rng.normal(c, 5, (40, 2)) for c in ((0, 0), (60, 0), (0, 80))] + [rng.uniform(-200, 200, (20, 2))])
    near = ((xy[:, None] - xy[None]) ** 2).sum(2) <= 64
    core = near.sum(1) >= 6
    label = np.where(core, np.arange(len(xy)), len(xy))
    for _ in range(len(xy)):
        label = np.where(core, np.where(near & core[None], label[None], len(xy)).min(1), len(xy))
    edge = np.where(near & core[None], label[None], len(xy)).min(1)
    names = {x: i for i, x in enumerate(sorted(set(edge) - {len(xy)}))}
    df = spark.createDataFrame([(i, i % 3, float(x), float(y)) for i, (x, y) in enumerate(xy)], "point_id int, mmsi int, x double, y double")
    found = clusters.dbscan(df, 8, 6)
    assert {r["point_id"]: r["cluster_id"] for r in found.collect()} == {i: names.get(x, -1) for i, x in enumerate(edge)}
    assert clusters.summary(found).count() == len(names) == clusters.profiles(found).count()


def _at(minutes):
    return dt.datetime(2023, 1, 1) + dt.timedelta(minutes=minutes)


def test_the_smallest_terminal_from_positions_to_explanation(spark):
    seen = spark.createDataFrame([(123456789, _at(0), 29.73, -93.87, 0.2), (123456789, _at(10), 29.73, -93.87, 0.1)], "mmsi long, recorded_at timestamp, latitude double, longitude double, speed_knots double")
    ring = [[{"x": x, "y": y} for x, y in ((-93.88, 29.72), (-93.86, 29.72), (-93.86, 29.74), (-93.88, 29.74))]]
    zones = spark.createDataFrame([(1, 1, "B1", "berth", 1, dt.date(2020, 1, 1), None, ring)], f"zone_id int, terminal_id int, zone_code string, zone_type string, zone_priority int, valid_from date, valid_to date, polygon {spatial.POLYGON}")
    confirmed = spark.createDataFrame([(1, 123456789, 9876543, "A", 1, _at(0), _at(120))], "validated_call_id long, mmsi long, imo long, vessel_name string, terminal_id int, arrival_time timestamp, departure_time timestamp")
    models = terminal.build(seen, zones, confirmed, keep=lambda name, df: clusters.cut(df))
    (o,) = models["call_operations"].collect()
    assert (o["berth_zone_code"], o["berth_duration_minutes"], o["berth_point_count"], o["stationary_fraction"]) == ("B1", 10.0, 2, 1.0)
    assert (o["berth_detection_confidence"], o["berth_continuity"], o["movement_coverage"]) == ("low", "continuous", "berth_only")
    assert models["zone_episodes"].count() == 1 and models["berth_duration_baseline"].count() == 0
    assert models["risk_explanations_daily"].first()["risk_trend"] == "initial"
    wrong = gates.violations({k: models[k] for k in ("call_operations", "operational_calls", "risk_score_daily", "risk_explanations_daily", "terminal_daily_metrics", "occupancy_intervals", "berth_performance")})
    assert wrong.count() == 0
    assert gates.final_gate(models)["risk_score_daily"] == 1
    assert serve.latest_risk(models["risk_explanations_daily"]).count() == 1
    with pytest.raises(serve.NotFound):
        serve.call(models["call_analytics"], 99)
    with pytest.raises(ValueError, match="limit"):
        serve.recent_calls(models["call_analytics"], 101)
    assert serve.health(spark) == {"status": "ok"}


def test_calls_from_hits_to_confirmation(spark):
    minutes = [*range(0, 500, 10), *range(900, 1400, 10)]
    seen = spark.createDataFrame([(7, _at(m), 29.73, -93.87, 0.1) for m in minutes] + [(7, _at(650), 30.5, -93.87, 9.0)], "mmsi long, recorded_at timestamp, latitude double, longitude double, speed_knots double")
    terminals = spark.createDataFrame([(1, "Sabine Pass LNG", 29.73, -93.87, 5000.0)], "terminal_id int, terminal_name string, latitude double, longitude double, detection_radius_metres double")
    vessels = spark.createDataFrame([(7, 9876543, "A", 80, 290.0, 46.0)], "mmsi long, imo long, vessel_name string, vessel_type int, length_metres double, width_metres double")
    found = calls.port_calls(calls.terminal_hits(seen, terminals))
    assert [(r["port_call_id"], r["position_count"], r["duration_minutes"]) for r in found.orderBy("port_call_id").collect()] == [(1, 50, 490.0), (2, 50, 490.0)]
    probable = calls.probable_calls(found, vessels, terminals, calls.bounds(seen, "recorded_at", "recorded_at"))
    assert [(r["starts_at_boundary"], r["ends_at_boundary"]) for r in probable.orderBy("port_call_id").collect()] == [(True, False), (False, True)]
    gap = calls.gap_analysis(found, seen, terminals).first()
    assert (gap["gap_positions"], gap["positions_outside_radius"], round(gap["gap_hours"], 3)) == (1, 1, 6.833)
    assert calls.repeated_calls(probable).first()["call_count"] == 2
    outage = lambda a, b: spark.createDataFrame([(_at(a), _at(b))], "outage_start timestamp, outage_end timestamp")
    assert calls.validated_calls(probable, outage(600, 700)).count() == 2
    (v,) = calls.validated_calls(probable, outage(494, 896)).collect()
    assert (v["source_port_call_ids"], v["validation_method"], v["duration_minutes"]) == ([1, 2], "merged_across_source_outage", 1390.0)
    registry = spark.createDataFrame([(9876543, "A", "B", "confirmed_lng")], "imo long, ais_vessel_name string, registry_vessel_name string, classification_status string")
    confirmed = calls.confirmed_calls(calls.validated_calls(probable, outage(494, 896)), registry)
    assert confirmed.first()["name_changed"]
    assert calls.reference_positions(seen, confirmed, config.DEFAULT).count() == 101


@pytest.mark.parametrize(("given", "expected"), [
    (("Tank Ship", "LNG", None), ("LNG carrier", "confirmed_lng")), (("Tank Ship", None, "carries Liquefied Natural Gas"), ("LNG carrier", "confirmed_lng")),
    (("Tank Ship", " lpg ", None), ("LPG carrier", "confirmed_non_lng")), (("Tank Ship", "CRUDE OIL", None), ("CRUDE OIL", "confirmed_non_lng")),
    (("Tank Ship", None, None), ("Tank Ship", "needs_review")), ((None, None, None), (None, "unknown"))])
def test_classification(spark, given, expected):
    df = spark.createDataFrame([given], "a string, b string, c string")
    assert tuple(df.select(enrichment.classify(F.col("a"), F.col("b"), F.col("c")).alias("k")).first()["k"]) == expected


def _provider(imo):
    if imo == 2:
        raise TimeoutError("timed out")
    records = {1: {"identification": "IMO 0000001", "service_sub_type": "LNG", "service_type": "Tank Ship"}, 3: {"identification": "3", "service_type": "Tank Ship"}, 4: {"identification": "99", "service_sub_type": "LNG"}}
    return records.get(imo)


def test_queue(spark):
    now = F.to_timestamp(F.lit("2023-02-01 00:00:00"))
    sighted = spark.createDataFrame([(i, i, f"V{i}", _at(i)) for i in range(1, 6)] + [(None, 8, "V8", _at(8))], "imo long, mmsi long, vessel_name string, arrival_time timestamp")
    empty = spark.createDataFrame([], enrichment.QUEUE)
    known = spark.createDataFrame([], "imo long")
    queue = enrichment.enqueue(empty, sighted, known, now)
    assert queue.count() == 5
    taken, queue = enrichment.claim(queue, now, 10)
    queue, found = enrichment.applied(queue, taken, enrichment.looked_up(taken, _provider), now)
    state = {r["imo"]: r for r in queue.collect()}
    assert {k: v["queue_status"] for k, v in state.items()} == {1: "completed", 2: "failed", 3: "needs_review", 4: "needs_review", 5: "needs_review"}
    assert state[2]["last_error"] == "timed out" and state[2]["next_attempt_at"] == dt.datetime(2023, 2, 1, 1) and state[1]["attempt_count"] == 1
    assert {r["imo"] for r in found.collect()} == {1, 3}
    assert enrichment.due(queue, now).count() == 0 and enrichment.due(queue, now + F.expr("interval 1 hour")).count() == 1
    reasons = enrichment.skip_reasons(spark.createDataFrame([(1, "true", None, "1"), (None, "true", None, "1"), (2, "no", None, "2"), (3, "yes", "x", "3"), (4, "1", None, "5")], "imo long, found string, error string, identification string"))
    assert [r["skip_reason"] for r in reasons.collect()] == [None, "no imo", "not found", "error", "identification differs"]


def test_files(spark, tmp_path):
    body = "&amp;lt;record&amp;gt;&amp;lt;identification&amp;gt;55&amp;lt;/identification&amp;gt;&amp;lt;/record&amp;gt;<record><identification>IMO 7</identification><flag>X</flag></record>"
    r = files.parsed_lookups(spark.createDataFrame([("k", 7, body), ("n", 8, "")], "lookup_key string, imo long, body string")).orderBy("lookup_key").collect()
    assert [(x["identification"], x["flag"], x["found"]) for x in r] == [("IMO 7", "X", True), (None, None, False)]
    zones = spark.createDataFrame([("z", SQUARE)], f"zone_code string, polygon {spatial.POLYGON}")
    feature = files.geojson_lines(zones).first()["value"]
    (tmp_path / "z.geojson").write_text('{"type": "FeatureCollection", "features": [' + feature + "]}")
    assert files.geojson_zones(spark, str(tmp_path / "z.geojson")).select("zone_code", spatial.area(F.col("polygon")).alias("a")).first() == ("z", 3.0)
    assert files.adjustments('{"zones": {"z": {"move_x": 3}}}')["z"] == {"move_x": 3.0, "move_y": 0.0, "scale_x": 1.0, "scale_y": 1.0, "rotation": 0.0}
    assert files.export_csv({"z": (zones.select("zone_code"), ["zone_code"])}, str(tmp_path / "out")) == {"z": 1}
    (tmp_path / "r.csv").write_text('imo,name\n12.0,"a\nb"\nx,c\n')
    t = files.reference_csv(spark, str(tmp_path / "r.csv"), "imo bigint, name string", ("imo",))
    assert [tuple(x) for x in t.collect()] == [(12, "a\nb"), (None, "c")]
    with pytest.raises(ValueError, match="missing columns"):
        files.reference_csv(spark, str(tmp_path / "r.csv"), "imo bigint", ("flag",))
    assert text.joined(F.lit("a"), F.lit(" "), F.lit("b")) is not None
    (tmp_path / "q.sql").write_text("select 1 as a,\n 2 as b;\n")
    (tmp_path / "blank.sql").write_text("  \n")
    assert tuple(files.sql_file(spark, str(tmp_path / "q.sql")).first()) == (1, 2)
    with pytest.raises(ValueError, match="empty"):
        files.sql_file(spark, str(tmp_path / "blank.sql"))
    zones.createOrReplaceTempView("known_zones")
    files.require_tables(spark, ["known_zones"])
    with pytest.raises(ValueError, match="missing tables: lost_zones"):
        files.require_tables(spark, ["known_zones", "lost_zones"])


def test_gates_see_lost_calls_and_bounds(spark):
    seen = spark.createDataFrame([(123456789, _at(0), 29.73, -93.87, 0.2), (123456789, _at(10), 29.73, -93.87, 0.1)], "mmsi long, recorded_at timestamp, latitude double, longitude double, speed_knots double")
    ring = [[{"x": x, "y": y} for x, y in ((-93.88, 29.72), (-93.86, 29.72), (-93.86, 29.74), (-93.88, 29.74))]]
    zones = spark.createDataFrame([(1, 1, "B1", "berth", 1, dt.date(2020, 1, 1), None, ring)], f"zone_id int, terminal_id int, zone_code string, zone_type string, zone_priority int, valid_from date, valid_to date, polygon {spatial.POLYGON}")
    confirmed = spark.createDataFrame([(1, 123456789, 9876543, "A", 1, _at(0), _at(120))], "validated_call_id long, mmsi long, imo long, vessel_name string, terminal_id int, arrival_time timestamp, departure_time timestamp")
    models = terminal.build(seen, zones, confirmed, keep=lambda name, df: clusters.cut(df)) | {"confirmed_calls": confirmed}
    # one call is no baseline, so it has no expected duration
    assert sorted(tuple(r)[:2] for r in gates.violations(models).collect()) == [
        ("call_delay_metrics", "baseline_is_founded"), ("call_delay_metrics", "not_null_expected_duration_minutes"),
        ("terminal_duration_baseline", "not_null_median_minutes"), ("terminal_duration_baseline", "percentiles_rise")]
    models |= {"positions": seen}
    nulls, expected = {}, set()
    for name, columns in gates.NOT_NULL.items():
        nulls[name] = spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in models[name].schema])
        expected |= {(name, f"not_null_{c}") for c in columns}
    assert sum(map(len, gates.NOT_NULL.values())) == 121
    assert expected <= {(r["model"], r["check_name"]) for r in gates.violations(nulls).collect()}
    some = {
        "operational_calls": models["operational_calls"].filter("false"), "confirmed_calls": confirmed, "berth_stay_candidates": models["berth_stay_candidates"].union(models["berth_stay_candidates"]),
        "risk_score_daily": models["risk_score_daily"].withColumn("backlog_points", F.lit(11.0)), "terminal_daily_metrics": models["terminal_daily_metrics"].withColumn("max_occupied_berths", F.lit(4))}
    found = {(r["model"], r["check_name"]) for r in gates.violations(some).collect()}
    assert {("operational_calls", "calls_cover_confirmed"), ("berth_stay_candidates", "unique_validated_call_id_zone_code_stay_no"), ("risk_score_daily", "points_in_range"), ("terminal_daily_metrics", "berths_in_range")} <= found


WRONG = {
    "zone_episodes": {"point_count": 0}, "berth_stay_candidates": {"stationary_fraction": 1.5}, "call_zone_timeline": {"duration_minutes": -1.0}, "operational_calls": {"bridged_minutes": -1.0},
    "call_operations": {"observed_berth_minutes": -1.0}, "berth_performance": {"total_calls": 0, "occupied_minutes": -1.0, "utilisation_pct": 101.0}, "occupancy_intervals": {"duration_minutes": 0.0, "occupied_berths": 4},
    "terminal_daily_metrics": {"terminal_utilisation_pct": -1.0, "arrivals": -1, "mean_occupied_berths": 4.0}, "call_analytics": {"estimated_delay_hours": -1.0, "arrival_day_max_occupied_berths": 4},
    "call_delay_metrics": {"estimated_delay_minutes": -1.0, "baseline_sample_size": 0, "p75_minutes": -1.0, "delay_band": "normal"}, "terminal_duration_baseline": {"baseline_calls": 0}, "berth_duration_baseline": {"iqr_minutes": -1.0},
    "historical_duration_baseline_daily": {"berth_history_calls": -1, "expected_minutes": 1.0, "p75_minutes": 0.5}, "risk_features_daily": {"arrivals_3d": -1, "active_scored_calls": 99, "capacity_pressure": 1.5},
    "risk_score_daily": {"risk_score": 101.0, "data_coverage_score": 2.0, "capacity_points": 21.0}, "risk_explanations_daily": {"risk_score": -1.0, "risk_trend": "rising_fast", "primary_driver_points": -1.0}}


def test_every_rule_sees_a_wrong_row(spark):
    """Rows of the least values that break each rule; other columns hold what breaks none."""
    good = {"delay_quality": "review", "baseline_scope": "insufficient_history", "risk_change_1d": 1.0, "expected_duration_minutes": 5.0, "secondary_driver_points": 0.0}
    models, expected = {}, set()
    for name, rules in gates.RULES.items():
        wanted = set(re.findall(r"[a-z_0-9]+", re.sub(r"'[^']*'", "", " ".join(rules.values())))) | set(WRONG[name]) | set(gates.NOT_NULL[name]) | set(gates.KEYS.get(name, []))
        wanted |= {c for m, c in gates.VALUES if m == name}
        values = {c: some[0] for (m, c), some in gates.VALUES.items() if m == name} | good | WRONG[name]
        columns = sorted(c for c in wanted if not c.isdigit() and c not in ("coalesce", "between", "and", "or", "is", "null", "in", "true", "case", "when", "then", "else", "end"))
        models[name] = spark.range(1).select(*[F.lit(values.get(c, "2020-01-01" if c.endswith(("_time", "_date", "_start")) else "2020-01-02" if c.endswith("_end") else 1.0)).alias(c) for c in columns])
        expected |= {(name, rule) for rule in rules}
    assert expected <= {(r["model"], r["check_name"]) for r in gates.violations(models).collect()}


def test_tasks_of_checks_do_not_grow_with_the_table(spark, monkeypatch):
    """Joins and groupings of dq_report are dealt by the number of rows; the session's few partitions would grow with them."""
    monkeypatch.setattr(checks, "TASK_ROWS", 500, raising=False)
    monkeypatch.setattr(checks, "_tagged", lambda df, check, key, old=checks._tagged: old(df, check, key).withColumn("part", F.spark_partition_id()))
    sf_dir = "/root/testdata/sf0.001"
    rows = catalog_operators.table(spark, sf_dir, "lineitem").count()
    parts = catalog_operators.dq_report(spark, sf_dir).filter("check_name = 'ships_after_order'").select("part").distinct().count()
    assert rows / parts < 1000
    lines = checks.dealt(spark.range(20_000).selectExpr("id % 9000 as k", "id"), 20_000, "k")
    assert lines.rdd.getNumPartitions() == 41 and checks.unique(lines, ["k"]).count() == 9000
    assert max(lines.rdd.glom().map(len).collect()) < 1000


def test_checks_tell_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "x")], "k int, v string")
    found = checks.report([checks.unique(df, ["k"]), checks.not_null(df, "v", "k"), checks.accepted(df, "v", ["a"], "k"), checks.holds(df, "k < 2", "k", "small")])
    assert sorted(tuple(r) for r in found.collect()) == [("accepted_v", "2"), ("not_null_v", "1"), ("small", "2"), ("unique_k", "1")]
    with pytest.raises(ValueError, match="a: 0 rows"):
        checks.require({"a": 0}, {"a": 1})


def _replayed(spark, tmp_path, make, name):
    rows = [(1, _at(m), z) for m, z in ((0, "a"), (10, "a"), (50, "a"), (55, "b"), (60, None), (62, None), (300, "a"))] + [(2, _at(1000), "c")]
    path = str(tmp_path / name)
    for i, part in enumerate((rows[:4], rows[4:])):
        spark.createDataFrame(part, "k long, ts timestamp, zone string").coalesce(1).write.mode("append").parquet(path)
        assert i < 2
    stream = spark.readStream.schema("k long, ts timestamp, zone string").parquet(path)
    query = make(stream).writeStream.outputMode("append").format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).collect()


def test_streams_are_the_batch_operators(spark, tmp_path):
    found = _replayed(spark, tmp_path, lambda s: live.gap_sessions(s, ["k"], "ts", "20 minutes"), "gaps")
    assert sorted((r["k"], r["point_count"]) for r in found) == [(1, 1), (1, 2), (1, 4)]
    found = _replayed(spark, tmp_path, lambda s: live.deduplicated(s, ["k"], "ts"), "dedup")
    assert sorted(r["k"] for r in found) == [1, 2]
    found = _replayed(spark, tmp_path, lambda s: live.episodes(s, "k", "ts", "zone", 20), "runs")
    assert sorted((r["key"], r["state"] or "", r["point_count"]) for r in found if r["key"] == 1) == [(1, "", 2), (1, "a", 1), (1, "a", 1), (1, "a", 2), (1, "b", 1)]
