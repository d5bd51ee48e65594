"""Other sources and sinks: reference tables, SQL files, zone shapes, lookups in XML, exports."""

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from harborline.functions import spatial, text
from harborline.functions.spatial import POLYGON
from harborline.operators.rank import first_per_key

RECORD_FIELDS = ("identification", "vessel_name", "service_type", "service_sub_type", "cargo_description", "flag", "status")


def reference_csv(spark: SparkSession, path: str, schema: str, required: tuple[str, ...]) -> DataFrame:
    """A small table with quoted line breaks; raises if required columns are missing from its header."""
    header = spark.read.csv(path, header=True, multiLine=True, escape='"').columns
    if missing := set(required) - set(header):
        raise ValueError(f"missing columns: {', '.join(sorted(missing))}")
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    wanted = spark.createDataFrame([], schema).schema
    return raw.select(*[F.expr(f"try_cast(try_cast(`{f.name}` as double) as bigint)").alias(f.name) if f.dataType.simpleString() == "bigint" else F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").alias(f.name) for f in wanted if f.name in header])


def lookup_candidates(table: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The first n keys, each once, without nulls."""
    return first_per_key(table.dropna(subset=[key]), [key], [F.col(c) for c in order]).orderBy(*order).limit(n)


def sql_file(spark: SparkSession, path: str) -> DataFrame:
    """The result of the one statement in a file; raises if the file is blank."""
    statement = "".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()).strip().rstrip(";")
    if not statement:
        raise ValueError(f"the SQL file is empty: {path}")
    return spark.sql(statement)


def require_tables(spark: SparkSession, names: list[str]) -> None:
    """Raises unless tables or views of all names exist."""
    if missing := [n for n in names if not spark.catalog.tableExists(n)]:
        raise ValueError(f"missing tables: {', '.join(missing)}")


def wkt_zones(zones: DataFrame, wkt: str = "wkt") -> DataFrame:
    """zones with part and polygon in place of a WKT column: one row for each polygon; raises in a task on other texts."""
    polygons = spatial.from_wkt(F.col(wkt))
    checked = F.when(polygons.isNull() & F.col(wkt).isNotNull(), F.raise_error(F.concat(F.lit("no polygon: "), F.col(wkt)))).otherwise(polygons)
    return zones.select(*[c for c in zones.columns if c != wkt], F.posexplode(checked).alias("part", "polygon"))


def geojson_zones(spark: SparkSession, path: str) -> DataFrame:
    """zone_code, part, polygon, properties (JSON): one row for each polygon of each feature."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "features array<struct<properties:string,geometry:struct<type:string,coordinates:string>>>").alias("j"))
    each = raw.select(F.explode("j.features").alias("f")).select("f.properties", "f.geometry.type", "f.geometry.coordinates")
    many = F.from_json("coordinates", "array<array<array<array<double>>>>")
    one = F.array(F.from_json("coordinates", "array<array<array<double>>>"))
    parts = each.select("properties", F.posexplode(F.when(F.col("type") == "MultiPolygon", many).otherwise(one)).alias("part", "rings"))
    points = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))).cast(POLYGON)
    return parts.select(F.get_json_object("properties", "$.zone_code").alias("zone_code"), "part", points.alias("polygon"), "properties")


def adjustments(config: str) -> dict[str, dict[str, float]]:
    """move_x, move_y, scale_x, scale_y, rotation for each zone of a JSON text, with defaults."""
    zones = json.loads(config).get("zones", {})
    plain = {"move_x": 0.0, "move_y": 0.0, "scale_x": 1.0, "scale_y": 1.0, "rotation": 0.0}
    return {code: plain | {k: float(v) for k, v in given.items() if k in plain} for code, given in zones.items()}


def xml_records(body: Column, fields: tuple[str, ...], names: tuple[str, ...] = ("record",), depth: int = 4) -> Column:
    """Array of structs, one for each element of the first name in an XML document: its child elements' texts by field, in
    any case of letters and with any namespace. Blank texts and missing children are null.

    names: the record's, and those of elements that records may stand in (records may stand in records too), down to `depth`
    elements below the document. Comments go, CDATA is text, attributes are left aside. A document may be several elements
    in a row. One that is not well-formed has no records; null gives null.
    """
    plain = ", ".join(f"{f}: string" for f in fields)
    kinds = [f"struct<{plain}>"]  # of elements with no level below them, one, two and so on
    for _ in range(depth - 1):
        kinds.append(f"struct<{plain}, " + ", ".join(f"{n}: array<{kinds[-1]}>" for n in names) + ">")
    nothing = F.array().cast(f"array<{kinds[0]}>")
    one = F.regexp_replace(body, r"(?s)<\?xml.*?\?>|<!DOCTYPE[^>]*>", "")
    bare = F.when(one.contains("<![CDATA["), one).otherwise(F.regexp_replace(one, r"&(?!#?\w+;)", "&amp;"))  # a lone & is no XML
    schema = ", ".join(f"{n} array<{kinds[-1]}>" for n in names)
    parsed = F.from_xml(F.concat(F.lit("<all>"), bare, F.lit("</all>")), schema, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})

    def fields_of(e: Column) -> Column:
        return F.struct(*[text.blank_to_null(e[f]).alias(f) for f in fields])

    def below(elements: Column, name: str, levels: int) -> Column:
        """Records among elements and down to so many levels below them."""
        parts = [F.coalesce(F.transform(elements, fields_of), nothing)] if name == names[0] else []
        if levels:
            parts += [F.coalesce(F.flatten(F.transform(elements, child(n, levels - 1))), nothing) for n in names]
        return F.concat(nothing, *parts)

    def child(name: str, levels: int):
        return lambda e: below(e[name], name, levels)

    return F.when(parsed.isNotNull(), F.concat(*[below(parsed[n], n, depth - 1) for n in names]))


def xml_record(body: Column, name: str) -> Column:
    """A field of the first record in a response that was escaped up to three times."""
    return F.get(xml_records(text.unescaped(body), (name,)), F.lit(0))[name]


def parsed_lookups(responses: DataFrame, names: tuple[str, ...] = ("record",)) -> DataFrame:
    """lookup_key, imo, body → one row: of the response's distinct records the one with the ship's number, else the first."""
    records = F.array_distinct(xml_records(text.unescaped(F.col("body")), RECORD_FIELDS, names))
    each = responses.select("lookup_key", "imo", F.posexplode_outer(records).alias("place", "one"))
    fields = each.select("lookup_key", "imo", "place", *[F.col(f"one.{n}").alias(n) for n in RECORD_FIELDS])
    own = F.coalesce(text.digits(F.col("identification")) == F.col("imo").cast("string"), F.lit(False))
    return first_per_key(fields, ["lookup_key"], [own.desc(), F.col("place").asc_nulls_last()]).drop("place").withColumn("found", F.col("identification").isNotNull())


def export_csv(tables: dict[str, tuple[DataFrame, list[str]]], folder: str) -> dict[str, int]:
    """Each table sorted into one CSV file with a header (results of days and calls, not positions); its row counts.
    Arrays, maps and structs become JSON text."""
    counts = {}
    for name, (df, order) in tables.items():
        plain = df.withColumns({c: F.to_json(c) for c, t in df.dtypes if t.startswith(("array", "map", "struct"))})
        seen = Observation()
        rows = plain.orderBy(*order).coalesce(1).observe(seen, F.count("*").alias("rows"))
        rows.write.mode("overwrite").csv(f"{folder}/{name}", header=True)
        counts[name] = seen.get["rows"]
    return counts


def geojson_lines(zones: DataFrame, polygon: str = "polygon") -> DataFrame:
    """One GeoJSON feature a row, from columns and a polygon."""
    rings = F.transform(polygon, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    properties = F.struct(*[F.col(c) for c in zones.columns if c != polygon])
    return zones.select(F.to_json(F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")).alias("geometry"))).alias("value"))
