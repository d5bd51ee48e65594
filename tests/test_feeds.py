"""Order in feeds, records in XML, and claims of several jobs at once."""

import threading

import pytest
from pyspark.sql import functions as F

from harborline.operators import versions
from harborline.plans import enrichment
from harborline.sources import files, positions


def _line(minute, name, speed="1.0", lat="29.7"):
    given = {"MMSI": "123456789", "BaseDateTime": f"2023-01-01T00:{minute:02d}:00", "LAT": lat, "LON": "-93.9", "SOG": speed, "VesselName": name}
    return ",".join(given.get(c, "") for c in positions.COLUMNS)


def _write(path, lines):
    path.write_text("\n".join([",".join(positions.COLUMNS), *lines]) + "\n")


def test_the_first_row_of_the_feed_stays(spark, tmp_path):
    """Two files; values alone would choose other rows, and an invalid first row doesn't count."""
    _write(tmp_path / "a.csv", [_line(0, "Z", "9.0"), _line(0, "A", "0.0"), _line(1, "bad", lat="95"), _line(1, "M"), _line(1, "B")])
    _write(tmp_path / "b.csv", [_line(0, "0"), _line(2, "Y"), _line(2, "X")])
    found = {r["recorded_at"].minute: r["vessel_name"] for r in positions.clean(positions.read_raw(spark, str(tmp_path))).collect()}
    assert found == {0: "Z", 1: "M", 2: "Y"}
    back = {r["recorded_at"].minute: r["vessel_name"] for r in positions.clean(positions.read_raw(spark, str(tmp_path)).drop(positions.FEED)).collect()}
    assert back == {0: "A", 1: "B", 2: "X"}


def test_the_first_row_of_a_feed_in_many_parts_stays(spark, tmp_path):
    names = [f"{(i * 7919) % 5000:05d}" for i in range(5000)]
    _write(tmp_path / "a.csv", [_line(i % 50, name) for i, name in enumerate(names)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        raw = positions.read_raw(spark, str(tmp_path))
        assert raw.select(f"{positions.FEED}.start").distinct().count() > 10
        found = {r["recorded_at"].minute: r["vessel_name"] for r in positions.clean(raw).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {i: names[i] for i in range(50)}


XML = """<?xml version="1.0"?><env:Envelope xmlns:env="urn:e"><env:set kind="a"><!-- <record><flag>none</flag></record> -->
<d:record id="1" xmlns:d="urn:d"><d:Identification unit="x">IMO 1</d:Identification><FLAG><![CDATA[A & <B>]]></FLAG><record><flag>inner</flag><vessel_name> </vessel_name></record></d:record>
<record><identification>2</identification><flag>A &amp; B &#67;</flag></record></env:set></env:Envelope><record><flag>last</flag></record>"""


def test_records_in_xml(spark):
    get = lambda body, *a: spark.createDataFrame([(body,)], "body string").select(files.xml_records(F.col("body"), ("identification", "flag", "vessel_name"), *a).alias("r")).first()["r"]
    found = get(XML, ("record", "Envelope", "set"))
    assert sorted(map(tuple, found), key=repr) == sorted([("IMO 1", "A & <B>", None), (None, "inner", None), ("2", "A & B C", None), (None, "last", None)], key=repr)
    assert [tuple(r) for r in get(XML)] == [(None, "last", None)]  # the others stand in elements that aren't named
    assert [tuple(r) for r in get("<record><flag>x & y</flag></record>")] == [(None, "x & y", None)]
    assert get("<record><flag>x</record>") == [] and get("") == [] and get(None) is None and get("words") == []


def test_lookups_take_the_ships_own_record(spark):
    escaped = XML.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    twice = escaped.replace("&", "&amp;")
    rows = [("plain", 2, XML), ("once", 2, escaped), ("twice", 2, twice), ("first", 99, XML), ("broken", 1, "<record>"), ("none", 1, None)]
    found = {r["lookup_key"]: (r["identification"], r["flag"], r["found"]) for r in files.parsed_lookups(spark.createDataFrame(rows, "lookup_key string, imo long, body string"), ("record", "Envelope", "set")).collect()}
    own = ("2", "A & B C", True)
    assert found["plain"] == found["once"] == found["twice"] == own and not found["broken"][2] and not found["none"][2] and found["first"][0] != "2"


@pytest.fixture()
def queue(spark, tmp_path):
    now = F.to_timestamp(F.lit("2023-02-01 00:00:00"))
    calls = spark.range(1, 41).select(F.col("id").alias("imo"), F.col("id").alias("mmsi"), F.lit("V").alias("vessel_name"), F.timestamp_seconds("id").alias("arrival_time"))
    assert versions.latest(spark, str(tmp_path / "queue")) == 0
    assert versions.publish(enrichment.enqueue(spark.createDataFrame([], enrichment.QUEUE), calls, spark.createDataFrame([], "imo long"), now).coalesce(1), str(tmp_path / "queue"), 1)
    return str(tmp_path / "queue"), now


def test_two_jobs_never_claim_the_same_row(spark, queue, monkeypatch):
    folder, now = queue
    barrier, lost, taken = threading.Barrier(2), [], {0: [], 1: []}
    real, met = versions.publish, threading.local()

    def publish(df, where, version):
        if not getattr(met, "once", False):
            met.once = True
            barrier.wait(60)  # both have read the same version
        won = real(df, where, version)
        if not won:
            lost.append(version)
        return won

    monkeypatch.setattr(versions, "publish", publish)

    def work(i):
        for _ in range(2):
            taken[i] += [r["lookup_key"] for r in enrichment.claim_shared(spark, folder, now, 10).collect()]

    threads = [threading.Thread(target=work, args=(i,)) for i in taken]
    for t in threads:
        t.start()
    for t in threads:
        t.join(200)
    assert len(lost) >= 1 and len(taken[0]) == len(taken[1]) == 20 and len(set(taken[0] + taken[1])) == 40
    last = versions.read(spark, folder, versions.latest(spark, folder))
    assert versions.latest(spark, folder) == 5 and {(r["queue_status"], r["attempt_count"]) for r in last.collect()} == {("processing", 1)}
    assert enrichment.claim_shared(spark, folder, now, 10).count() == 0 and versions.latest(spark, folder) == 5


def test_changes_are_of_the_last_version(spark, queue):
    folder, _ = queue
    enrichment.settle_shared(spark, folder, lambda q: q.withColumn("queue_status", F.lit("completed")))
    assert versions.latest(spark, folder) == 2 and versions.read(spark, folder, 2).filter("queue_status = 'completed'").count() == 40
    assert not versions.put_if_absent(spark, f"{folder}/versions/{2:010d}", "other") and versions.read(spark, folder, 2).count() == 40
