"""Position feeds: CSV in, cleaned rows out, loaded into vessels and positions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions import text
from harborline.functions.numbers import null_outside
from harborline.operators import checks, merge
from harborline.operators.rank import best_record, first_per_key
from harborline.operators.stats import null_profile

#: Raw column names and ours.
COLUMNS = {
    "MMSI": "mmsi", "BaseDateTime": "recorded_at", "LAT": "latitude", "LON": "longitude", "SOG": "speed_knots", "COG": "course_degrees", "Heading": "heading_degrees",
    "VesselName": "vessel_name", "IMO": "imo", "CallSign": "call_sign", "VesselType": "vessel_type", "Status": "status", "Length": "length_metres", "Width": "width_metres",
    "Draft": "draught_metres", "Cargo": "cargo", "TransceiverClass": "transceiver_class"}
NUMBERS = ("latitude", "longitude", "speed_knots", "course_degrees", "heading_degrees", "length_metres", "width_metres", "draught_metres")
WHOLE = ("vessel_type", "status", "cargo")
TEXTS = ("vessel_name", "imo", "call_sign", "transceiver_class")
#: Ranges beyond which a reading means "not available".
RANGES = {"heading_degrees": (0, 359), "course_degrees": (0, 359.9), "speed_knots": (0, 102.2), "length_metres": (1, 500), "width_metres": (1, 100), "draught_metres": (0, 30)}
VESSEL = ("mmsi", "imo", "vessel_name", "call_sign", "vessel_type", "length_metres", "width_metres", "cargo", "transceiver_class")
POSITION = ("mmsi", "recorded_at", "latitude", "longitude", "speed_knots", "course_degrees", "heading_degrees", "status", "draught_metres")


#: A row's place in the feed: struct<file, start, row>, the file, the first byte of the part of it that a task reads, and the
#: number of the row in the task, which rises within that part.
FEED = "feed_place"


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All columns as text, under a fixed schema (nothing is inferred from the data), and each row's place in the feed. Files
    come in the order of their paths."""
    schema = ", ".join(f"`{c}` string" for c in COLUMNS)
    raw = spark.read.schema(schema).csv(path, header=True)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    return raw.select(*raw.columns, place.alias(FEED))


def profile(raw: DataFrame) -> DataFrame:
    """Columns by number of nulls, most first."""
    return null_profile(raw.drop(FEED)).orderBy(F.desc("null_count"), "column_name")


def clean(raw: DataFrame, place: str = FEED) -> DataFrame:
    """Renamed, cast leniently, without rows that lack a key or have no valid number or place; readings out of range are
    null; one row for each vessel and time, the first valid one in the feed.

    place: a column of raw that orders the feed; it goes. Without it a table has no order, and the first in the order of the
    other columns stays.
    """
    df = raw.withColumnsRenamed(COLUMNS)
    df = df.withColumns({c: text.to_number(F.col(c).cast("string")) for c in NUMBERS} | {c: text.to_whole(F.col(c).cast("string")) for c in WHOLE} | {c: text.blank_to_null(F.col(c).cast("string")) for c in TEXTS})
    df = df.withColumns({"mmsi": F.trim(F.col("mmsi").cast("string")), "recorded_at": text.to_time(F.col("recorded_at").cast("string"))})
    df = df.dropna(subset=["mmsi", "recorded_at", "latitude", "longitude"])
    df = df.filter(F.col("mmsi").rlike("^[0-9]{9}$") & F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    df = df.withColumns({c: null_outside(F.col(c), *r) for c, r in RANGES.items()}).withColumn("mmsi", F.col("mmsi").cast("bigint"))
    rest = [place] if place in df.columns else [c for c in df.columns if c not in ("mmsi", "recorded_at")]
    return first_per_key(df, ["mmsi", "recorded_at"], [F.col(c).asc_nulls_last() for c in rest]).drop(place)


def validate(silver: DataFrame) -> int:
    """Number of rows; raises if there are none or a column is missing."""
    missing = set(COLUMNS.values()) - set(silver.columns)
    if missing:
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    rows = silver.count()
    checks.require({"positions": rows}, {"positions": 1})
    return rows


def load(silver: DataFrame, vessels: DataFrame, positions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vessels with each one's best new record merged in (a known value is never lost), and positions with the new keys."""
    typed = silver.withColumn("imo", text.extract_imo(F.col("imo")))
    best = best_record(typed, ["mmsi"], ["imo", "vessel_name", "vessel_type", "length_metres"], "recorded_at").select(*VESSEL)
    return merge.upsert_coalesce(vessels, best, ["mmsi"]), merge.upsert_ignore(positions, typed.select(*POSITION), ["mmsi", "recorded_at"])


def ingest(spark: SparkSession, raw_path: str, silver_path: str) -> str:
    clean(read_raw(spark, raw_path)).write.mode("overwrite").parquet(silver_path, compression="snappy")
    return silver_path
