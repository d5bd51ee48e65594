import datetime as dt

from harborline.functions import spatial
from harborline.plans import runner
from harborline.sources import positions


def _feed(path, mmsi, imo, first_minute):
    """A large tanker that lies at the berth for 15 hours."""
    rows = []
    for k in range(90):
        at = dt.datetime(2023, 1, 1) + dt.timedelta(minutes=first_minute + 10 * k)
        given = {"MMSI": mmsi, "BaseDateTime": at.isoformat(), "LAT": 29.73, "LON": -93.87, "SOG": 0.1, "COG": 10, "Heading": 90, "VesselName": "A", "IMO": f"IMO{imo}", "VesselType": 80, "Length": 290, "Width": 46, "Draft": 11}
        rows.append(",".join(str(given.get(c, "")) for c in positions.COLUMNS))
    path.write_text("\n".join([",".join(positions.COLUMNS), *rows]) + "\n")
    return str(path)


def _provider(imo):
    return {"identification": f"IMO {imo}", "service_type": "Tank Ship", "service_sub_type": "LNG", "registry_vessel_name": "A"}


def test_two_runs_over_all_stages(spark, tmp_path):
    terminals = spark.createDataFrame([(1, "Sabine Pass LNG", 29.73, -93.87, 5000.0)], "terminal_id int, terminal_name string, latitude double, longitude double, detection_radius_metres double")
    ring = [[{"x": x, "y": y} for x, y in ((-93.88, 29.72), (-93.86, 29.72), (-93.86, 29.74), (-93.88, 29.74))]]
    zones = spark.createDataFrame([(1, 1, "B1", "berth", 1, dt.date(2020, 1, 1), None, ring)], f"zone_id int, terminal_id int, zone_code string, zone_type string, zone_priority int, valid_from date, valid_to date, polygon {spatial.POLYGON}")
    given = {"zones": zones, "terminals": terminals, "outages": spark.createDataFrame([], "outage_start timestamp, outage_end timestamp"), "provider": _provider}
    one = runner.run(spark, _feed(tmp_path / "a.csv", 123456789, 9876543, 0), str(tmp_path / "one"), **given)
    assert (one["positions"].count(), one["confirmed_calls"].count(), one["vessel_registry"].count()) == (90, 1, 1)
    # the next run knows the first ship and its positions, and looks up the new one only
    two = runner.run(spark, _feed(tmp_path / "b.csv", 123456780, 9876555, 2000), str(tmp_path / "two"), previous=str(tmp_path / "one"), **given)
    assert (two["positions"].count(), two["confirmed_calls"].count(), two["claimed"].count()) == (180, 2, 1)
    assert sorted(r["imo"] for r in two["vessel_registry"].collect()) == [9876543, 9876555]
    assert {r["queue_status"] for r in two["queue"].collect()} == {"completed"}
    assert {p.name for p in (tmp_path / "two" / "exports").iterdir()} == set(runner.EXPORTS)
