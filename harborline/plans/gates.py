"""Gates of a run, and the data-quality checks of the models."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators import checks

#: Fixed values below: keys, value lists, columns and bounds of the data tests. By model, the columns that are unique together.
KEYS = {
    "confirmed_calls": ["validated_call_id"],
    "call_operations": ["validated_call_id"], "operational_calls": ["validated_call_id"], "call_delay_metrics": ["validated_call_id"], "call_analytics": ["validated_call_id"],
    "berth_duration_baseline": ["berth_zone_code"], "berth_performance": ["berth_zone_code"], "terminal_daily_metrics": ["metric_date"], "historical_duration_baseline_daily": ["metric_date", "berth_zone_code"],
    "risk_features_daily": ["metric_date"], "risk_score_daily": ["metric_date"], "risk_explanations_daily": ["metric_date"], "position_primary_zone": ["mmsi", "recorded_at"], "zone_episodes": ["mmsi", "episode_number"],
    "position_zone_state": ["mmsi", "recorded_at"], "call_zone_timeline": ["validated_call_id", "episode_number"], "berth_stay_candidates": ["validated_call_id", "zone_code", "stay_no"]}
VALUES = {
    ("call_zone_timeline", "movement_phase"): ["inbound", "berth", "berth_transition", "outbound"],
    ("operational_calls", "berth_detection_confidence"): ["high", "medium", "low"], ("operational_calls", "berth_continuity"): ["continuous", "minor_gaps", "moderate_gap", "review"],
    ("call_operations", "movement_coverage"): ["full", "inbound_only", "outbound_only", "berth_only"], ("call_operations", "berth_detection_confidence"): ["high", "medium", "low"],
    ("call_operations", "berth_continuity"): ["continuous", "minor_gaps", "moderate_gap", "review"], ("call_delay_metrics", "baseline_scope"): ["berth", "terminal"], ("call_delay_metrics", "delay_band"): ["normal", "elevated", "high", "severe", "unscored"],
    ("call_delay_metrics", "delay_quality"): ["usable", "usable_with_gap", "lower_confidence", "review", "censored"], ("risk_score_daily", "risk_level"): ["low", "moderate", "elevated", "high", "critical"],
    ("risk_score_daily", "score_confidence"): ["high", "medium", "low"], ("risk_explanations_daily", "risk_trend"): ["initial", "rising_fast", "rising", "stable", "falling", "falling_fast"],
    ("historical_duration_baseline_daily", "baseline_scope"): ["historical_berth", "historical_terminal", "insufficient_history"]}
#: By model, the columns that must not be null.
NOT_NULL = {
    "positions": ["mmsi", "recorded_at"], "confirmed_calls": ["validated_call_id", "mmsi", "arrival_time", "departure_time"],
    "position_zone_hits": ["mmsi", "recorded_at", "zone_code", "zone_priority"], "position_primary_zone": ["mmsi", "recorded_at", "zone_code", "zone_priority"],
    "position_zone_state": ["mmsi", "recorded_at"], "zone_episodes": ["mmsi", "episode_number", "zone_code", "start_time", "end_time", "point_count"],
    "berth_stay_candidates": ["validated_call_id", "mmsi", "zone_code", "stay_no", "start_time", "end_time", "point_count"],
    "operational_calls": ["validated_call_id", "mmsi", "original_arrival_time", "original_departure_time"],
    "call_zone_timeline": ["validated_call_id", "episode_number", "zone_code", "start_time", "end_time", "point_count", "movement_phase"],
    "call_operations": ["validated_call_id", "mmsi", "berth_zone_code", "berth_arrival_time", "berth_departure_time", "movement_coverage"],
    "berth_duration_baseline": ["berth_zone_code", "baseline_calls", "median_minutes"], "terminal_duration_baseline": ["baseline_calls", "median_minutes"],
    "call_delay_metrics": ["validated_call_id", "mmsi", "baseline_scope", "baseline_sample_size", "expected_duration_minutes", "delay_quality", "delay_band"],
    "berth_performance": ["berth_zone_code", "total_calls", "scored_calls", "occupied_minutes", "utilisation_pct"],
    "occupancy_intervals": ["interval_start", "interval_end", "occupied_berths", "active_calls", "duration_minutes"],
    "terminal_daily_metrics": ["metric_date", "arrivals", "departures", "occupied_berth_minutes", "max_occupied_berths", "terminal_utilisation_pct"],
    "call_analytics": ["validated_call_id", "mmsi", "berth_zone_code", "berth_arrival_time", "berth_departure_time", "delay_band", "delay_quality", "movement_coverage", "arrival_metric_date"],
    "historical_duration_baseline_daily": ["metric_date", "berth_zone_code", "berth_history_calls", "terminal_history_calls", "baseline_scope"],
    "risk_features_daily": ["metric_date", "arrivals", "departures", "terminal_utilisation_pct", "capacity_pressure", "berth_saturation", "active_calls", "active_scored_calls", "active_unscored_calls", "active_delayed_calls", "active_severe_calls", "active_delay_share", "active_severe_share", "unscored_active_share"],
    "risk_score_daily": ["metric_date", "risk_score", "risk_level", "capacity_points", "saturation_points", "active_delay_points", "active_severe_points", "delay_intensity_points", "utilisation_3d_points", "backlog_points", "data_coverage_score", "score_confidence"],
    "risk_explanations_daily": ["metric_date", "risk_score", "risk_level", "score_confidence", "risk_trend", "risk_headline", "risk_explanation"]}
_POINTS = {"capacity": 20, "saturation": 10, "active_delay": 20, "active_severe": 15, "delay_intensity": 10, "utilisation_3d": 15, "backlog": 10}
_RISING = "p25_minutes <= median_minutes and median_minutes <= p75_minutes and p75_minutes <= p90_minutes and p90_minutes <= p95_minutes"


def _positive(*columns: str) -> str:
    return " and ".join(f"coalesce({c}, 0) >= 0" for c in columns)


#: By model, what must hold in every row; a null on one side of a comparison doesn't violate it. Shares of sums of doubles
#: may be a millionth over their bound.
RULES = {
    "zone_episodes": {"episode_is_valid": "end_time >= start_time and duration_minutes >= 0 and point_count > 0"},
    "berth_stay_candidates": {"stay_is_valid": "end_time >= start_time and duration_minutes >= 0 and point_count > 0 and coalesce(stationary_fraction, 0) between 0 and 1"},
    "call_zone_timeline": {"episode_is_valid": "end_time >= start_time and duration_minutes >= 0 and point_count > 0"},
    "operational_calls": {"call_is_valid": "coalesce(berth_departure_time >= berth_arrival_time, true) and " + _positive("berth_duration_minutes", "bridged_minutes") + " and coalesce(berth_point_count, 1) > 0 and coalesce(fragment_count, 1) > 0 and coalesce(stationary_fraction, 0) between 0 and 1"},
    "call_operations": {"call_is_valid": "coalesce(berth_departure_time >= berth_arrival_time, true) and " + _positive("berth_duration_minutes", "observed_berth_minutes", "bridged_minutes") + " and coalesce(berth_point_count, 1) > 0 and coalesce(fragment_count, 1) > 0 and coalesce(stationary_fraction, 0) between 0 and 1"},
    "berth_duration_baseline": {"percentiles_rise": f"baseline_calls > 0 and {_RISING} and iqr_minutes >= 0"}, "terminal_duration_baseline": {"percentiles_rise": f"baseline_calls > 0 and {_RISING} and iqr_minutes >= 0"},
    "call_delay_metrics": {
        "delay_not_negative": _positive("estimated_delay_minutes", "estimated_delay_hours"), "baseline_is_founded": "baseline_sample_size > 0 and expected_duration_minutes > 0",
        "percentiles_rise": "p75_minutes >= expected_duration_minutes and p90_minutes >= p75_minutes and p95_minutes >= p90_minutes",
        "unscored_by_quality": "(delay_band = 'unscored') = (delay_quality in ('censored', 'review', 'lower_confidence'))"},
    "berth_performance": {
        "counts_are_valid": "total_calls > 0 and scored_calls <= total_calls and " + _positive("scored_calls", "elevated_calls", "high_delay_calls", "severe_delay_calls"),
        "durations_are_valid": _positive("occupied_minutes", "median_duration_minutes", "mean_estimated_delay_minutes") + " and p90_duration_minutes >= median_duration_minutes", "share_in_range": "utilisation_pct between 0 and 100.000001"},
    "occupancy_intervals": {"interval_is_positive": "interval_end > interval_start and duration_minutes > 0", "berths_in_range": "occupied_berths between 0 and 3 and active_calls >= 0"},
    "terminal_daily_metrics": {
        "share_in_range": "terminal_utilisation_pct between 0 and 100.000001", "counts_not_negative": _positive("arrivals", "departures", "severe_delay_arrivals"),
        "berths_in_range": "occupied_berth_minutes >= 0 and max_occupied_berths between 0 and 3 and mean_occupied_berths between 0 and 3.000001"},
    "call_analytics": {
        "call_is_valid": "coalesce(berth_departure_time >= berth_arrival_time, true) and " + _positive("berth_duration_minutes", "estimated_delay_minutes", "estimated_delay_hours"),
        "arrival_day_in_range": _positive("arrival_day_terminal_arrivals", "arrival_day_terminal_departures") + " and coalesce(arrival_day_max_occupied_berths, 0) between 0 and 3 and coalesce(arrival_day_terminal_utilisation_pct, 0) between 0 and 100.000001 and coalesce(arrival_day_mean_occupied_berths, 0) between 0 and 3.000001"},
    "historical_duration_baseline_daily": {
        "counts_not_negative": _positive("berth_history_calls", "terminal_history_calls"),
        "known_with_history_only": "(baseline_scope = 'insufficient_history') = (expected_minutes is null) and (baseline_scope = 'insufficient_history') = (p75_minutes is null) and (baseline_scope = 'insufficient_history') = (p90_minutes is null) and (baseline_scope = 'insufficient_history') = (p95_minutes is null)",
        "percentiles_rise": "expected_minutes <= p75_minutes and p75_minutes <= p90_minutes and p90_minutes <= p95_minutes"},
    "risk_features_daily": {
        "counts_not_negative": _positive("arrivals", "departures", "active_calls", "active_scored_calls", "active_unscored_calls", "active_delayed_calls", "active_severe_calls", "delayed_departures", "severe_departures", "arrivals_3d", "departures_3d", "severe_departures_3d", "positive_vessel_balance_3d"),
        "counts_in_order": "active_scored_calls <= active_calls and active_unscored_calls <= active_calls and active_delayed_calls <= active_scored_calls and active_severe_calls <= active_scored_calls and active_severe_calls <= active_delayed_calls",
        "shares_in_range": "terminal_utilisation_pct between 0 and 100.000001 and " + " and ".join(f"{c} between 0 and 1" for c in ("capacity_pressure", "berth_saturation", "active_delay_share", "active_severe_share", "unscored_active_share"))},
    "risk_score_daily": {"score_in_range": "risk_score between 0 and 100", "coverage_in_range": "data_coverage_score between 0 and 1", "points_in_range": " and ".join(f"{n}_points between 0 and {most}" for n, most in _POINTS.items())},
    "risk_explanations_daily": {
        "score_in_range": "risk_score between 0 and 100",
        "trend_fits_change": "case risk_trend when 'initial' then risk_change_1d is null when 'rising_fast' then risk_change_1d >= 10 when 'rising' then risk_change_1d >= 3 and risk_change_1d < 10 when 'falling_fast' then risk_change_1d <= -10 when 'falling' then risk_change_1d <= -3 and risk_change_1d > -10 when 'stable' then risk_change_1d < 3 and risk_change_1d > -3 else true end",
        "drivers_in_order": _positive("primary_driver_points", "secondary_driver_points", "tertiary_driver_points") + " and coalesce(primary_driver_points >= secondary_driver_points, true) and coalesce(secondary_driver_points >= tertiary_driver_points, true)"}}


def violations(models: dict[str, DataFrame]) -> DataFrame:
    """model, check_name, violation_key of everything that is wrong in the models given; no rows if all holds. Give
    positions and confirmed_calls too, to see calls that the models lose."""
    out = []
    for name, df in models.items():
        found = []
        if keys := KEYS.get(name):
            found.append(checks.unique(df, keys))
        first = (KEYS.get(name) or df.columns)[0]
        found += [checks.accepted(df, column, values, first) for (model, column), values in VALUES.items() if model == name]
        found += [checks.not_null(df, column, first) for column in NOT_NULL.get(name, [])]
        found += [checks.holds(df, rule, first, check) for check, rule in RULES.get(name, {}).items()]
        out += [x.withColumn("model", F.lit(name)) for x in found]
    if {"call_operations", "operational_calls"} <= models.keys():
        out.append(checks.covers(models["call_operations"], models["operational_calls"], ["validated_call_id"], "operations_cover_calls").withColumn("model", F.lit("call_operations")))
    if {"operational_calls", "confirmed_calls"} <= models.keys():
        out.append(checks.covers(models["operational_calls"], models["confirmed_calls"], ["validated_call_id"], "calls_cover_confirmed").withColumn("model", F.lit("operational_calls")))
    return checks.report(out).select("model", "check_name", "violation_key")


def final_gate(models: dict[str, DataFrame]) -> dict[str, int]:
    """Row counts of the five published tables; raises if one is empty or a score is out of range."""
    names = ("call_analytics", "berth_performance", "terminal_daily_metrics", "risk_score_daily", "risk_explanations_daily")
    counts = {n: models[n].count() for n in names}
    counts["scores_out_of_range"] = models["risk_score_daily"].filter("risk_score not between 0 and 100").count()
    checks.require(counts, dict.fromkeys(names, 1), {"scores_out_of_range": 0})
    return counts


def load_gate(positions: DataFrame, queue: DataFrame) -> dict[str, int]:
    """Positions there, all with a place, and no lookup stuck under way."""
    row = positions.agg(F.count("*").alias("positions"), F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("without_place")).first()
    counts = {"positions": row["positions"], "without_place": row["without_place"], "stuck": queue.filter("queue_status = 'processing'").count()}
    checks.require(counts, {"positions": 1}, {"without_place": 0, "stuck": 0})
    return counts
