"""The terminal models: positions to zones, stays, calls, occupancy, baselines, score and explanation.

Each function is one model, DataFrames in and out. Positions meet zones in a grid join; everything after calls is of the
size of calls and days. A table that several models read may be cached by the caller.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.numbers import clamp, first_match, minutes_between, ratio, round_half_up, shift
from harborline.operators import intervals, sessions, stats
from harborline.operators.rank import first_per_key, ranked, unpivoted
from harborline.operators.spatial_joins import in_polygons
from harborline.plans.config import DEFAULT, Config


def zone_hits(positions: DataFrame, zones: DataFrame) -> DataFrame:
    """Positions in zones that are valid on their day: from valid_from on, before valid_to."""
    hits = in_polygons(positions, zones)
    day = F.to_date("recorded_at")
    valid = (F.col("valid_from").isNull() | (day >= F.col("valid_from"))) & (F.col("valid_to").isNull() | (day < F.col("valid_to")))
    return hits.filter(valid).select("mmsi", "recorded_at", "speed_knots", "zone_id", "terminal_id", "zone_code", "zone_type", "zone_priority")


def primary_zone(hits: DataFrame) -> DataFrame:
    """Of a position's zones the one of lowest priority number, then code."""
    return first_per_key(hits, ["mmsi", "recorded_at"], [F.col("zone_priority").asc_nulls_last(), F.col("zone_code")])


def zone_state(positions: DataFrame, primary: DataFrame) -> DataFrame:
    """All positions; outside of zones with a null zone, so that leaving one breaks an episode."""
    zones = primary.select("mmsi", "recorded_at", "zone_code", "zone_type")
    return positions.select("mmsi", "recorded_at", "speed_knots").join(zones, ["mmsi", "recorded_at"], "left")


def zone_episodes(state: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Stays in one zone. Numbers count the runs outside of zones too, which are then left out."""
    marked = sessions.number_islands(state, ["mmsi"], "recorded_at", config.episode_gap, state="zone_code", out="episode_number")
    return sessions.summarise(marked.filter("zone_code is not null"), ["mmsi", "episode_number", "zone_code", "zone_type"], "recorded_at", "speed_knots")


def berth_stays(primary: DataFrame, calls: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Stays at berths around a call: no gap of more than 20 minutes within."""
    spans = calls.select("validated_call_id", "mmsi", "arrival_time", "departure_time")
    near = intervals.contained(primary.filter("zone_type = 'berth'"), spans, ["mmsi"], "recorded_at", "arrival_time", "departure_time", before=config.call_margin, after=config.call_margin)
    keys = ["validated_call_id", "zone_code"]
    marked = sessions.number_islands(near, keys, "recorded_at", config.episode_gap, out="stay_no")
    return sessions.summarise(marked, [*keys, "stay_no"], "recorded_at", "speed_knots", [stats.share_below("speed_knots", config.stationary_speed).alias("stationary_fraction"), F.max("mmsi").alias("mmsi"), F.max("terminal_id").alias("terminal_id")])


def operational_calls(confirmed: DataFrame, stays: DataFrame) -> DataFrame:
    """Each confirmed call with its dominant berth: its stays there put together, how sure and how continuous they are.

    A call without a berth stays, with nulls; by the ladders below it is of low confidence and for review.
    """
    keys = ["validated_call_id", "zone_code"]
    order = Window.partitionBy(*keys).orderBy("start_time")
    gaps = stays.withColumn("gap", minutes_between(F.lag("end_time").over(order), F.col("start_time")))
    merged = gaps.groupBy(*keys).agg(
        F.min("start_time").alias("berth_arrival_time"), F.max("end_time").alias("berth_departure_time"), F.count("*").alias("fragment_count"),
        F.sum("point_count").alias("berth_point_count"), F.sum("duration_minutes").alias("observed_berth_minutes"), F.max("terminal_id").alias("terminal_id"),
        stats.weighted_mean_of_all("stationary_fraction", "point_count").alias("stationary_fraction"),
        F.coalesce(F.max("gap"), F.lit(0.0)).alias("largest_internal_gap_minutes"),
    )
    best = first_per_key(merged, ["validated_call_id"], [F.desc("berth_point_count"), F.desc("observed_berth_minutes"), F.asc("zone_code")]).withColumnRenamed("zone_code", "berth_zone_code")
    elapsed = minutes_between(F.col("berth_arrival_time"), F.col("berth_departure_time"))
    joined = confirmed.drop("terminal_id").join(best, "validated_call_id", "left").withColumn("berth_duration_minutes", elapsed)
    confidence = first_match([
        ((F.col("stationary_fraction") >= 0.95) & (F.col("berth_duration_minutes") >= 360) & (F.col("berth_point_count") >= 20), "high"),
        ((F.col("stationary_fraction") >= 0.80) & (F.col("berth_duration_minutes") >= 60), "medium")], "low")
    continuity = first_match([
        (F.col("fragment_count") == 1, "continuous"), (F.col("largest_internal_gap_minutes") <= 60, "minor_gaps"), (F.col("largest_internal_gap_minutes") <= 360, "moderate_gap")], "review")
    return joined.withColumns({
        "berth_duration": F.col("berth_departure_time") - F.col("berth_arrival_time"),
        "bridged_minutes": F.greatest(F.col("berth_duration_minutes") - F.col("observed_berth_minutes"), F.lit(0.0)),
        "arrival_difference_minutes": minutes_between(F.col("arrival_time"), F.col("berth_arrival_time")),
        "departure_difference_minutes": minutes_between(F.col("departure_time"), F.col("berth_departure_time")),
        "berth_detection_confidence": confidence, "berth_continuity": continuity,
    }).withColumnsRenamed({"arrival_time": "original_arrival_time", "departure_time": "original_departure_time"})


def zone_timeline(primary: DataFrame, operational: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Zone episodes of each call, two hours around it, and the phase of the call that they belong to."""
    spans = operational.select("validated_call_id", "mmsi", "original_arrival_time", "original_departure_time", "berth_arrival_time", "berth_departure_time")
    near = intervals.contained(primary, spans, ["mmsi"], "recorded_at", "original_arrival_time", "original_departure_time", before=config.call_margin, after=config.call_margin)
    marked = sessions.number_islands(near, ["validated_call_id"], "recorded_at", config.episode_gap, state="zone_code", out="episode_number")
    rows = sessions.summarise(marked, ["validated_call_id", "episode_number", "zone_code"], "recorded_at", "speed_knots", [F.max("zone_type").alias("zone_type"), F.max("berth_arrival_time").alias("berth_arrival_time"), F.max("berth_departure_time").alias("berth_departure_time")])
    phase = first_match([
        ((F.col("zone_type") == "berth") & (F.col("start_time") <= F.col("berth_departure_time")) & (F.col("end_time") >= F.col("berth_arrival_time")), "berth"),
        (F.col("end_time") < F.col("berth_arrival_time"), "inbound"), (F.col("start_time") > F.col("berth_departure_time"), "outbound")], "berth_transition")
    return rows.withColumn("movement_phase", phase)


#: The types of zones that a call's movements pass, by the name of the stage.
STAGES = {"approach": "approach", "channel": "shipping_channel", "manoeuvre": "manoeuvring_basin"}


def call_operations(operational: DataFrame, timeline: DataFrame) -> DataFrame:
    """Each call with its movements: conditional aggregates of the timeline in one pass, transits, cycle, flags, coverage.

    The cycle is that from the first zone detection to the last; calls seen at their berth only have one too.
    """
    phase = {p: F.col("movement_phase") == p for p in ("inbound", "outbound")}
    stage = {(p, s): phase[p] & (F.col("zone_type") == z) for p in phase for s, z in STAGES.items()}
    first = lambda on, out: F.min(F.when(on, F.col("start_time"))).alias(out)
    last = lambda on, out: F.max(F.when(on, F.col("end_time"))).alias(out)
    aggs: list[Column] = [
        F.min("start_time").alias("first_zone_detection_time"), F.max("end_time").alias("last_zone_detection_time"),
        first(phase["inbound"], "inbound_start_time"), *[first(stage["inbound", s], f"inbound_{s}_time") for s in STAGES],
        first(phase["outbound"], "outbound_start_time"), *[first(stage["outbound", s], f"outbound_{s}_time") for s in ("manoeuvre", "channel")],
        last(stage["outbound", "approach"], "outbound_approach_exit_time"), last(phase["outbound"], "outbound_end_time"),
        *[F.count_if(on).alias(f"{p}_episode_count") for p, on in phase.items()], *[F.count_if(on).alias(f"{p}_{s}_episodes") for (p, s), on in stage.items()],
        F.count_if(F.col("duration_minutes") < 2).alias("very_short_episode_count"), F.count("*").alias("total_timeline_episodes")]
    calls = operational.drop("original_arrival_time", "original_departure_time", "berth_duration", "arrival_difference_minutes", "departure_difference_minutes")
    joined = calls.join(timeline.groupBy("validated_call_id").agg(*aggs), "validated_call_id", "left")
    flags = {f"has_{p}_{s}": F.col("outbound_approach_exit_time" if (p, s) == ("outbound", "approach") else f"{p}_{s}_time").isNotNull() for p, s in stage}
    arrived, left = F.col("inbound_start_time").isNotNull(), F.col("outbound_end_time").isNotNull()
    return joined.withColumns(flags | {
        "inbound_transit_minutes": minutes_between(F.col("inbound_start_time"), F.col("berth_arrival_time")),
        "outbound_transit_minutes": minutes_between(F.col("berth_departure_time"), F.col("outbound_end_time")),
        "observed_terminal_cycle_minutes": minutes_between(F.col("first_zone_detection_time"), F.col("last_zone_detection_time")),
        "movement_coverage": first_match([(arrived & left, "full"), (arrived, "inbound_only"), (left, "outbound_only")], "berth_only")})


def eligible(operations: DataFrame) -> DataFrame:
    """Calls that baselines may rest on."""
    return operations.filter("movement_coverage = 'full' and berth_detection_confidence = 'high' and berth_continuity <> 'review'")


_BASELINE = {"sample_size": "baseline_calls", "p50_minutes": "median_minutes"}


def berth_baseline(operations: DataFrame) -> DataFrame:
    return stats.baseline(eligible(operations), ["berth_zone_code"], "berth_duration_minutes").withColumnsRenamed(_BASELINE)


def terminal_baseline(operations: DataFrame) -> DataFrame:
    return stats.baseline(eligible(operations), [], "berth_duration_minutes").withColumnsRenamed(_BASELINE)


def call_delays(operations: DataFrame, dataset: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Each call against the baseline of its berth (of the terminal, where the berth has fewer than 5 calls).

    The baseline rests on the whole sample, later calls too: it describes, it doesn't forecast.
    """
    names = {"baseline_calls": "baseline_sample_size", "median_minutes": "expected_duration_minutes", "p75_minutes": "p75_minutes", "p90_minutes": "p90_minutes", "p95_minutes": "p95_minutes", "iqr_minutes": "baseline_iqr_minutes"}
    berth = berth_baseline(operations).select("berth_zone_code", *[F.col(c).alias(f"__berth_{c}") for c in names])
    whole = terminal_baseline(operations).select(*[F.col(c).alias(f"__all_{c}") for c in names])
    joined = operations.join(berth, "berth_zone_code", "left").crossJoin(F.broadcast(whole)).crossJoin(F.broadcast(dataset))
    own = F.col("__berth_baseline_calls") >= config.least_history
    pick = {out: F.when(own, F.col(f"__berth_{c}")).otherwise(F.col(f"__all_{c}")) for c, out in names.items()}
    variance = F.col("berth_duration_minutes") - F.col("expected_duration_minutes")
    measured = joined.withColumns(pick | {
        "baseline_scope": F.when(own, "berth").otherwise("terminal"),
        "left_censored": F.col("berth_arrival_time") <= shift(F.col("dataset_start"), config.edge),
        "right_censored": F.col("berth_departure_time") >= shift(F.col("dataset_end"), -config.edge),
    }).withColumns({"duration_variance_minutes": variance, "estimated_delay_minutes": F.greatest(variance, F.lit(0.0))})
    quality = first_match([
        (F.col("left_censored") | F.col("right_censored"), "censored"),
        (F.col("berth_continuity") == "review", "review"), (F.col("berth_continuity") == "moderate_gap", "usable_with_gap"), (F.col("berth_detection_confidence") != "high", "lower_confidence")], "usable")
    band = first_match([
        (F.col("delay_quality").isin("censored", "review", "lower_confidence"), "unscored"),
        (F.col("berth_duration_minutes") <= F.col("p75_minutes"), "normal"), (F.col("berth_duration_minutes") <= F.col("p90_minutes"), "elevated"), (F.col("berth_duration_minutes") <= F.col("p95_minutes"), "high")], "severe")
    return measured.withColumn("delay_quality", quality).withColumns({"estimated_delay_hours": F.col("estimated_delay_minutes") / 60.0, "delay_band": band}).drop(
        *[f"__{p}_{c}" for p in ("berth", "all") for c in names])


def berth_performance(delays: DataFrame, dataset: DataFrame) -> DataFrame:
    """Berths: calls by band, durations, occupied minutes (overlapping calls once) and share of the dataset's time."""
    delays = delays.drop("dataset_start", "dataset_end")
    bounded = delays.filter("berth_zone_code is not null").crossJoin(F.broadcast(dataset))
    open_spans = intervals.clip(bounded, "berth_arrival_time", "berth_departure_time", F.col("dataset_start"), F.col("dataset_end"))
    line = intervals.sweep_line(open_spans, ["berth_zone_code"], "clipped_start", "clipped_end")
    occupied = line.filter("occupancy > 0 and until is not null").groupBy("berth_zone_code").agg(F.sum(minutes_between(F.col("at"), F.col("until"))).alias("occupied_minutes"))
    scored = F.col("delay_band") != "unscored"
    counts = delays.filter("berth_zone_code is not null").groupBy("berth_zone_code").agg(
        F.count("*").alias("total_calls"), F.count_if(scored).alias("scored_calls"), F.count_if(F.col("delay_band") == "elevated").alias("elevated_calls"),
        F.count_if(F.col("delay_band") == "high").alias("high_delay_calls"), F.count_if(F.col("delay_band") == "severe").alias("severe_delay_calls"),
        F.percentile("berth_duration_minutes", 0.5).alias("median_duration_minutes"), F.percentile("berth_duration_minutes", 0.9).alias("p90_duration_minutes"),
        F.avg(F.when(scored, F.col("estimated_delay_minutes"))).alias("mean_estimated_delay_minutes"))
    minutes = minutes_between(F.col("dataset_start"), F.col("dataset_end"))
    return counts.join(occupied, "berth_zone_code", "left").crossJoin(F.broadcast(dataset)).withColumn("utilisation_pct", ratio(F.col("occupied_minutes") * 100.0, minutes, None)).drop("dataset_start", "dataset_end")


def occupancy_intervals(operations: DataFrame, dataset: DataFrame) -> DataFrame:
    """interval_start, interval_end, occupied_berths, active_calls between neighbouring arrivals and departures."""
    bounded = operations.filter("berth_zone_code is not null").crossJoin(F.broadcast(dataset))
    spans = intervals.clip(bounded, "berth_arrival_time", "berth_departure_time", F.col("dataset_start"), F.col("dataset_end"))
    found = intervals.elementary(spans, [], "clipped_start", "clipped_end", "berth_zone_code").withColumnsRenamed({"occupied": "occupied_berths", "active": "active_calls"})
    return found.withColumn("duration_minutes", minutes_between(F.col("interval_start"), F.col("interval_end")))


def daily_metrics(occupancy: DataFrame, delays: DataFrame, dataset: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """A row for each day of the dataset: arrivals, departures, berth use. Each day counts as a full one, the edges too."""
    days = intervals.calendar(dataset, "dataset_start", "dataset_end")
    used = intervals.by_day(occupancy, "interval_start", "interval_end")
    overlap = intervals.day_overlap_minutes("interval_start", "interval_end", "metric_date")
    use = used.groupBy("metric_date").agg(F.sum(overlap * F.col("occupied_berths")).alias("minutes"), F.max("occupied_berths").alias("peak"))
    inbound, outbound = F.col("movement_coverage").isin("full", "inbound_only"), F.col("movement_coverage").isin("full", "outbound_only")
    arrived = delays.filter(inbound).groupBy(F.to_date("berth_arrival_time").alias("metric_date")).agg(
        F.count("*").alias("arrivals"), F.avg(F.when(F.col("delay_band") != "unscored", F.col("estimated_delay_minutes"))).alias("mean_arrival_delay_minutes"),
        F.count_if(F.col("delay_band") == "severe").alias("severe_delay_arrivals"))
    left = delays.filter(outbound).groupBy(F.to_date("berth_departure_time").alias("metric_date")).agg(F.count("*").alias("departures"))
    joined = days.join(use, "metric_date", "left").join(arrived, "metric_date", "left").join(left, "metric_date", "left")
    none = lambda c, zero=0: F.coalesce(F.col(c), F.lit(zero))
    return joined.select(
        "metric_date", none("arrivals").alias("arrivals"), none("departures").alias("departures"), none("minutes", 0.0).alias("occupied_berth_minutes"),
        none("peak").cast("long").alias("max_occupied_berths"), (none("minutes", 0.0) / (config.capacity * 1440.0) * 100.0).alias("terminal_utilisation_pct"),
        (none("minutes", 0.0) / 1440.0).alias("mean_occupied_berths"), "mean_arrival_delay_minutes", none("severe_delay_arrivals").alias("severe_delay_arrivals"))


def call_analytics(delays: DataFrame, daily: DataFrame) -> DataFrame:
    """Calls with the terminal's metrics on the day of arrival."""
    day = daily.select(
        F.col("metric_date").alias("arrival_metric_date"), F.col("arrivals").alias("arrival_day_terminal_arrivals"), F.col("departures").alias("arrival_day_terminal_departures"),
        F.col("max_occupied_berths").alias("arrival_day_max_occupied_berths"), F.col("terminal_utilisation_pct").alias("arrival_day_terminal_utilisation_pct"), F.col("mean_occupied_berths").alias("arrival_day_mean_occupied_berths"))
    return delays.withColumn("arrival_metric_date", F.to_date("berth_arrival_time")).join(day, "arrival_metric_date", "left")


def historical_baseline(daily: DataFrame, operations: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """For each day and berth what was known before the day began: the berth's calls, else the terminal's, else nothing."""
    days, calls = daily.select("metric_date"), eligible(operations)
    berths = operations.filter("berth_zone_code is not null").select("berth_zone_code").distinct()
    grid = days.crossJoin(berths)
    own = stats.pit_history(days, "metric_date", calls, ["berth_zone_code"], "berth_departure_time", "berth_duration_minutes")
    whole = stats.pit_history(days, "metric_date", calls, [], "berth_departure_time", "berth_duration_minutes")
    names = ("history_calls", "p50_minutes", "p75_minutes", "p90_minutes", "p95_minutes")
    joined = grid.join(own.select("metric_date", "berth_zone_code", *[F.col(c).alias(f"own_{c}") for c in names]), ["metric_date", "berth_zone_code"], "left").join(
        whole.select("metric_date", *[F.col(c).alias(f"all_{c}") for c in names]), "metric_date", "left")
    n_own, n_all = (F.coalesce(F.col(f"{p}_history_calls"), F.lit(0)) for p in ("own", "all"))
    scope = first_match([(n_own >= config.least_history, "historical_berth"), (n_all >= config.least_history, "historical_terminal")], "insufficient_history")
    pick = lambda c: F.when(F.col("baseline_scope") == "historical_berth", F.col(f"own_{c}")).when(F.col("baseline_scope") == "historical_terminal", F.col(f"all_{c}"))
    return joined.withColumn("baseline_scope", scope).select(
        "metric_date", "berth_zone_code", n_own.alias("berth_history_calls"), n_all.alias("terminal_history_calls"), "baseline_scope",
        pick("p50_minutes").alias("expected_minutes"), *[pick(f"p{p}_minutes").alias(f"p{p}_minutes") for p in (75, 90, 95)])


def risk_features(daily: DataFrame, operations: DataFrame, history: DataFrame, delays: DataFrame, dataset: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Signals of each day from calls at berth on it, measured at its end against what was known at its start."""
    calls = operations.select("validated_call_id", "berth_zone_code", "berth_arrival_time", "berth_departure_time", "berth_detection_confidence", "berth_continuity").crossJoin(F.broadcast(dataset))
    active = intervals.by_day(calls, "berth_arrival_time", "berth_departure_time").join(daily.select("metric_date"), "metric_date").join(history, ["metric_date", "berth_zone_code"], "left")
    ended = F.least(F.col("berth_departure_time"), F.date_add("metric_date", 1).cast("timestamp"))
    censored = F.col("berth_arrival_time") <= shift(F.col("dataset_start"), config.edge)
    known = F.col("baseline_scope") != "insufficient_history"
    sure = ~censored & (F.col("berth_detection_confidence") == "high") & (F.col("berth_continuity") != "review") & known
    elapsed = F.col("elapsed")
    late = F.col("sure") & (elapsed > F.col("p75_minutes"))
    unscored = censored | (F.col("berth_detection_confidence") != "high") | (F.col("berth_continuity") == "review") | ~known | F.col("expected_minutes").isNull()
    summary = active.withColumns({"elapsed": F.greatest(minutes_between(F.col("berth_arrival_time"), ended), F.lit(0.0)), "sure": sure, "unscored": unscored}).groupBy("metric_date").agg(
        F.count("*").alias("active_calls"), F.count_if(F.col("sure") & F.col("expected_minutes").isNotNull()).alias("active_scored_calls"), F.count_if("unscored").alias("active_unscored_calls"),
        F.count_if(late).alias("active_delayed_calls"), F.count_if(F.col("sure") & (elapsed > F.col("p95_minutes"))).alias("active_severe_calls"),
        F.avg(F.when(late & F.col("expected_minutes").isNotNull(), F.greatest(elapsed - F.col("expected_minutes"), F.lit(0.0)) / 60.0)).alias("active_mean_delay_hours"),
        (F.max("elapsed") / 60.0).alias("max_active_elapsed_hours"))
    gone = delays.filter("delay_band <> 'unscored'").groupBy(F.to_date("berth_departure_time").alias("metric_date")).agg(
        F.count_if(F.col("delay_band").isin("elevated", "high", "severe")).alias("delayed_departures"), F.count_if(F.col("delay_band") == "severe").alias("severe_departures"))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("active_calls", "active_scored_calls", "active_unscored_calls", "active_delayed_calls", "active_severe_calls", "delayed_departures", "severe_departures")}
    joined = daily.join(summary, "metric_date", "left").join(gone, "metric_date", "left").withColumns(zero)
    trailing = stats.trailing("metric_date", 3)
    rolled = joined.withColumns({
        "arrivals_3d": F.sum("arrivals").over(trailing), "departures_3d": F.sum("departures").over(trailing),
        "utilisation_3d_avg": F.avg("terminal_utilisation_pct").over(trailing), "severe_departures_3d": F.sum("severe_departures").over(trailing)})
    share = lambda c: ratio(F.col(c).cast("double"), F.col("active_scored_calls"))
    return rolled.withColumns({
        "capacity_pressure": clamp(F.col("terminal_utilisation_pct") / 100.0), "berth_saturation": clamp(F.col("max_occupied_berths") / float(config.capacity)),
        "active_delay_share": share("active_delayed_calls"), "active_severe_share": share("active_severe_calls"),
        "unscored_active_share": ratio(F.col("active_unscored_calls").cast("double"), F.col("active_calls")),
        "vessel_balance_3d": F.col("arrivals_3d") - F.col("departures_3d"), "positive_vessel_balance_3d": F.greatest(F.col("arrivals_3d") - F.col("departures_3d"), F.lit(0))})


SIGNALS = ("capacity", "saturation", "active_delay", "active_severe", "delay_intensity", "utilisation_3d", "backlog")


def risk_score(features: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Points for each signal, their sum from 0 to 100, its level (of the sum before rounding), and how well it is founded."""
    signal = {
        "capacity": F.col("capacity_pressure"), "saturation": F.col("berth_saturation"), "active_delay": clamp(F.col("active_delay_share")), "active_severe": clamp(F.col("active_severe_share")),
        "delay_intensity": clamp(F.coalesce(F.col("active_mean_delay_hours"), F.lit(0.0)) / config.full_delay_hours),
        "utilisation_3d": clamp(F.col("utilisation_3d_avg") / 100.0), "backlog": clamp(F.col("vessel_balance_3d") / config.full_backlog)}
    points = {f"__{s}": signal[s] * config.weights[s] for s in SIGNALS}
    raw = features.withColumns(points).withColumn("__score", clamp(sum((F.col(f"__{s}") for s in SIGNALS), F.lit(0.0)), 0.0, 100.0))
    level = first_match([(F.col("__score") < top, name) for top, name in config.levels], config.top_level)
    share = F.col("unscored_active_share")
    rounded = {f"{s}_points": round_half_up(F.col(f"__{s}"), 1) for s in SIGNALS}
    return raw.withColumns(rounded | {
        "risk_score": round_half_up(F.col("__score"), 1), "risk_level": level, "data_coverage_score": round_half_up(1.0 - share, 3),
        "score_confidence": first_match([(share <= 0.20, "high"), (share <= 0.50, "medium")], "low")}).drop(*points, "__score")


def _text(x: Column, digits: int = 1) -> Column:
    return F.round(x.cast("decimal(38,10)"), digits).cast(f"decimal(20,{digits})").cast("string")


def risk_explanations(score: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """What moved the score: trend, and up to three drivers by points, then name; from rounded scores and points."""
    w = Window.orderBy("metric_date")
    base = score.withColumns({"previous_risk_score": F.lag("risk_score").over(w), "previous_risk_level": F.lag("risk_level").over(w)})
    berths = F.col("max_occupied_berths")
    texts = {
        "capacity": ("capacity", F.concat(F.lit("Terminal utilisation "), _text(F.col("terminal_utilisation_pct")), F.lit("%"))),
        "saturation": ("berth_saturation", F.when(berths == config.capacity, F.lit(f"All {config.capacity} berths occupied at peak")).otherwise(F.concat(berths.cast("string"), F.lit(f" of {config.capacity} berths occupied at peak")))),
        "active_delay": ("active_delay", F.concat(F.col("active_delayed_calls").cast("string"), F.lit(" active call(s) above normal-duration threshold"))),
        "active_severe": ("active_severe", F.concat(F.col("active_severe_calls").cast("string"), F.lit(" active severe-duration call(s)"))),
        "delay_intensity": ("delay_intensity", F.concat(F.lit("Mean active excess duration "), _text(F.coalesce("active_mean_delay_hours", F.lit(0.0))), F.lit(" h"))),
        "utilisation_3d": ("utilisation_3d", F.concat(F.lit("Trailing 3-day utilisation "), _text(F.col("utilisation_3d_avg")), F.lit("%"))),
        "backlog": ("backlog", F.concat(F.lit("3-day net vessel balance +"), F.col("vessel_balance_3d").cast("bigint").cast("string")))}
    long = unpivoted(base, ["metric_date"], [{"driver": F.lit(key), "points": F.col(f"{s}_points"), "text": text} for s, (key, text) in texts.items()], "points > 0")
    order = ranked(long, ["metric_date"], [F.desc("points"), F.asc("driver")])
    places = ("primary", "secondary", "tertiary")
    pivot = [F.max(F.when(F.col("rank") == i, F.col(c))).alias(f"{p}_driver{e}") for i, p in enumerate(places, 1) for c, e in (("text", ""), ("points", "_points"))]
    joined = base.join(order.groupBy("metric_date").agg(*pivot), "metric_date", "left")
    change = F.col("risk_score").cast("decimal(10,1)") - F.col("previous_risk_score").cast("decimal(10,1)")
    trend = first_match([(change.isNull(), "initial"), (change >= 10, "rising_fast"), (change >= 3, "rising"), (change <= -10, "falling_fast"), (change <= -3, "falling")], "stable")
    return joined.withColumns({
        "risk_change_1d": change.cast("double"), "risk_trend": trend,
        "risk_headline": F.concat(F.upper("risk_level"), F.lit(" — "), _text(F.col("risk_score")), F.lit(" / 100")),
        "risk_explanation": F.concat(F.lit("Primary drivers: "), F.concat_ws("; ", F.coalesce("primary_driver", F.lit("none")), "secondary_driver", "tertiary_driver"))}).drop("previous_risk_score")


def build(positions: DataFrame, zones: DataFrame, confirmed: DataFrame, config: Config = DEFAULT, keep=lambda name, df: df) -> dict[str, DataFrame]:
    """All models by name. keep(name, df) may write or cache a model that several others read."""
    m: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        m[name] = keep(name, df)
        return m[name]

    dataset = put("dataset_bounds", positions.agg(F.min("recorded_at").alias("dataset_start"), F.max("recorded_at").alias("dataset_end")))
    hits = put("position_zone_hits", zone_hits(positions, zones))
    primary = put("position_primary_zone", primary_zone(hits))
    put("zone_episodes", zone_episodes(put("position_zone_state", zone_state(positions, primary)), config))
    stays = put("berth_stay_candidates", berth_stays(primary, confirmed, config))
    operational = put("operational_calls", operational_calls(confirmed, stays))
    operations = put("call_operations", call_operations(operational, put("call_zone_timeline", zone_timeline(primary, operational, config))))
    m |= analytics(operations, dataset, config, keep)
    return m


def analytics(operations: DataFrame, dataset: DataFrame, config: Config = DEFAULT, keep=lambda name, df: df) -> dict[str, DataFrame]:
    """The models after call operations, by name."""
    m: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        m[name] = keep(name, df)
        return m[name]

    put("berth_duration_baseline", berth_baseline(operations))
    put("terminal_duration_baseline", terminal_baseline(operations))
    delays = put("call_delay_metrics", call_delays(operations, dataset, config))
    put("berth_performance", berth_performance(delays, dataset))
    daily = put("terminal_daily_metrics", daily_metrics(put("occupancy_intervals", occupancy_intervals(operations, dataset)), delays, dataset, config))
    put("call_analytics", call_analytics(delays, daily))
    history = put("historical_duration_baseline_daily", historical_baseline(daily, operations, config))
    features = put("risk_features_daily", risk_features(daily, operations, history, delays, dataset, config))
    score = put("risk_score_daily", risk_score(features, config))
    put("risk_explanations_daily", risk_explanations(score, config))
    return m
