"""Port calls from positions: detection, selection, outage merging, confirmation."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.numbers import first_match, hours_between, minutes_between, shift
from harborline.operators import intervals, sessions
from harborline.operators.rank import numbered
from harborline.operators.spatial_joins import within_distance
from harborline.operators.stats import in_order, weighted_mean
from harborline.plans.config import DEFAULT, Config


def terminal_hits(positions: DataFrame, terminals: DataFrame) -> DataFrame:
    """Positions within a terminal's detection radius."""
    centres = terminals.select("terminal_id", F.col("latitude").alias("centre_latitude"), F.col("longitude").alias("centre_longitude"), F.col("detection_radius_metres").alias("radius_metres"))
    return within_distance(positions, centres).select("terminal_id", "mmsi", "recorded_at", "speed_knots", "distance_metres")


def port_calls(hits: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Visits: hits of one vessel at one terminal without a gap of more than two hours, long and dense enough."""
    marked = sessions.number_islands(hits, ["terminal_id", "mmsi"], "recorded_at", config.call_gap)
    calls = marked.groupBy("terminal_id", "mmsi", "session_no").agg(
        F.min("recorded_at").alias("arrival_time"), F.max("recorded_at").alias("departure_time"), F.count("*").alias("position_count"),
        F.min("distance_metres").alias("closest_distance_metres"), F.avg("speed_knots").alias("average_speed_knots"), F.max("speed_knots").alias("maximum_speed_knots"),
    ).withColumn("duration_minutes", minutes_between(F.col("arrival_time"), F.col("departure_time")))
    kept = calls.filter((F.col("duration_minutes") >= config.least_call) & (F.col("position_count") >= config.least_positions)).drop("session_no")
    return numbered(kept, [F.col("arrival_time"), F.col("mmsi"), F.col("terminal_id")], "port_call_id", F.to_date("arrival_time"))


def bounds(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row: dataset_start, dataset_end."""
    return df.agg(F.min(start).alias("dataset_start"), F.max(end).alias("dataset_end"))


def probable_calls(calls: DataFrame, vessels: DataFrame, terminals: DataFrame, dataset: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Calls long, slow and near enough, by large tankers, at the terminal; with flags for calls cut by the dataset's ends."""
    minutes, speed, distance, types, length, width = config.probable
    joined = calls.join(terminals.select("terminal_id", "terminal_name"), "terminal_id").join(vessels.select("mmsi", "imo", "vessel_name", "vessel_type", "length_metres", "width_metres"), "mmsi")
    chosen = joined.filter(
        (F.col("terminal_name") == config.terminal_name) & (F.col("duration_minutes") >= minutes) & (F.col("average_speed_knots") <= speed)
        & (F.col("closest_distance_metres") <= distance) & F.col("vessel_type").between(*types)
        & ((F.col("length_metres") >= length) | (F.col("width_metres") >= width)))
    return chosen.crossJoin(F.broadcast(dataset)).withColumns({
        "starts_at_boundary": F.col("arrival_time") <= shift(F.col("dataset_start"), config.edge),
        "ends_at_boundary": F.col("departure_time") >= shift(F.col("dataset_end"), -config.edge),
    }).drop("dataset_start", "dataset_end")


def _pairs(calls: DataFrame) -> DataFrame:
    w = Window.partitionBy("terminal_id", "mmsi").orderBy("arrival_time", "port_call_id")
    return calls.withColumns({"next_call_id": F.lead("port_call_id").over(w), "next_arrival": F.lead("arrival_time").over(w)}).filter("next_call_id is not null")


def gap_analysis(calls: DataFrame, positions: DataFrame, terminals: DataFrame) -> DataFrame:
    """For each call and the vessel's next one at the terminal: hours between, and positions strictly between, near and far."""
    from harborline.functions.spatial import distance_m

    keys = ["terminal_id", "mmsi", "port_call_id", "next_call_id", "departure_time", "next_arrival"]
    pairs = _pairs(calls).select(*keys)
    placed = pairs.join(terminals.select("terminal_id", F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon"), "detection_radius_metres"), "terminal_id")
    between = intervals.contained(positions.select("mmsi", "recorded_at", "latitude", "longitude"), placed, ["mmsi"], "recorded_at", "departure_time", "next_arrival", closed=False)
    near = distance_m(F.col("latitude"), F.col("longitude"), F.col("__lat"), F.col("__lon")) <= F.col("detection_radius_metres")
    counts = between.groupBy("port_call_id").agg(F.count("*").alias("gap_positions"), F.count_if(near).alias("positions_inside_radius"), F.count_if(~near).alias("positions_outside_radius"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gap_positions", "positions_inside_radius", "positions_outside_radius")]
    return placed.join(counts, "port_call_id", "left").select(*keys, *zero, hours_between(F.col("departure_time"), F.col("next_arrival")).alias("gap_hours"))


def repeated_calls(calls: DataFrame) -> DataFrame:
    """Vessels with more than one call."""
    return calls.groupBy("mmsi", "vessel_name").agg(F.count("*").alias("call_count")).filter("call_count > 1").orderBy(F.desc("call_count"), "mmsi")


def validated_calls(probable: DataFrame, outages: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Neighbouring calls become one where the gap between them overlaps an outage and lies in it, give or take 5 minutes."""
    w = Window.partitionBy("terminal_id", "mmsi").orderBy("arrival_time", "port_call_id")
    chained = probable.withColumn("previous_departure", F.lag("departure_time").over(w))
    gaps = chained.filter("previous_departure is not null").select("port_call_id", "previous_departure", "arrival_time")
    bridged = intervals.overlapping(gaps, ["port_call_id"], outages, "previous_departure", "arrival_time", "outage_start", "outage_end", slack=config.outage_slack).withColumn("bridged", F.lit(True))
    started = chained.join(bridged, "port_call_id", "left").withColumn("start", F.when(F.col("bridged"), 0).otherwise(1))
    island = started.withColumn("group_no", F.sum("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    merged = island.groupBy("terminal_id", "mmsi", "group_no").agg(
        F.min("arrival_time").alias("arrival_time"), F.max("departure_time").alias("departure_time"), F.sum("position_count").alias("position_count"),
        F.min("closest_distance_metres").alias("closest_distance_metres"), weighted_mean("average_speed_knots", "position_count").alias("average_speed_knots"),
        F.max("maximum_speed_knots").alias("maximum_speed_knots"), F.bool_or("starts_at_boundary").alias("starts_at_boundary"), F.bool_or("ends_at_boundary").alias("ends_at_boundary"),
        F.count("*").alias("source_call_count"), in_order("port_call_id", "arrival_time").alias("source_port_call_ids"),
        F.max("imo").alias("imo"), F.max("vessel_name").alias("vessel_name"),
    ).withColumns({
        "duration_minutes": minutes_between(F.col("arrival_time"), F.col("departure_time")),
        "validation_method": first_match([(F.col("source_call_count") > 1, "merged_across_source_outage")], "original_probable_call"),
    }).drop("group_no")
    return numbered(merged, [F.col("arrival_time"), F.col("mmsi"), F.col("terminal_id")], "validated_call_id", F.to_date("arrival_time"))


def confirmed_calls(validated: DataFrame, registry: DataFrame) -> DataFrame:
    """Calls of vessels that the registry confirms; with a flag for ships that changed their names."""
    known = registry.filter("classification_status = 'confirmed_lng'").select("imo", "ais_vessel_name", "registry_vessel_name")
    changed = first_match([
        (F.col("registry_vessel_name").isNull() | F.col("ais_vessel_name").isNull(), None),
        (F.upper(F.trim("ais_vessel_name")) != F.upper(F.trim("registry_vessel_name")), True)], False)
    return validated.join(known, "imo").withColumn("name_changed", changed)


def reference_positions(positions: DataFrame, confirmed: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Positions of confirmed calls and two hours around; a position in two calls' margins is there twice."""
    calls = confirmed.select("validated_call_id", "mmsi", "arrival_time", "departure_time")
    return intervals.contained(positions, calls, ["mmsi"], "recorded_at", "arrival_time", "departure_time", before=config.call_margin, after=config.call_margin)
