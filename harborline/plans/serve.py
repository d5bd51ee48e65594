"""Read queries behind the endpoints: whitelisted columns, bounded limits, one row or none."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.operators.rank import top

RISK = ("metric_date", "risk_score", "risk_level", "score_confidence", "risk_change_1d", "previous_risk_level", "risk_trend", "primary_driver", "primary_driver_points", "secondary_driver", "secondary_driver_points", "tertiary_driver", "tertiary_driver_points", "risk_headline", "risk_explanation")
CALL = ("validated_call_id", "mmsi", "imo", "vessel_name", "terminal_id", "berth_zone_code", "berth_arrival_time", "berth_departure_time", "berth_duration_minutes", "expected_duration_minutes", "estimated_delay_minutes", "delay_band", "delay_quality")


class NotFound(LookupError):
    """No row has the key."""


def health(spark) -> dict[str, str]:
    return {"status": "ok" if spark.sql("select 1 as one").first()["one"] == 1 else "error"}


def _one(df: DataFrame, column: str, value) -> DataFrame:
    found = df.filter(F.col(column) == F.lit(value)).limit(1)
    if found.isEmpty():
        raise NotFound(f"{column} {value}")
    return found


def latest_risk(explanations: DataFrame) -> DataFrame:
    return explanations.select(*RISK).orderBy(F.desc("metric_date")).limit(1)


def risk_history(explanations: DataFrame, limit: int = 30) -> DataFrame:
    return top(explanations.select(*RISK), [F.desc("metric_date")], limit, 1, 90)


def risk_on(explanations: DataFrame, day: str) -> DataFrame:
    return _one(explanations.select(*RISK), "metric_date", day)


def recent_calls(calls: DataFrame, limit: int = 25) -> DataFrame:
    return top(calls.select(*CALL), [F.col("berth_arrival_time").desc_nulls_last(), F.desc("validated_call_id")], limit, 1, 100)


def call(calls: DataFrame, number: int) -> DataFrame:
    return _one(calls.select(*CALL), "validated_call_id", number)


def berths(performance: DataFrame) -> DataFrame:
    return performance.orderBy("berth_zone_code")


def terminal_days(daily: DataFrame, limit: int = 30) -> DataFrame:
    return top(daily, [F.desc("metric_date")], limit, 1, 90)


def daily_movements(daily: DataFrame) -> DataFrame:
    """metric_date, movement, calls: arrivals and departures below each other, as charts want them."""
    return daily.select("metric_date", "arrivals", "departures").unpivot("metric_date", ["arrivals", "departures"], "movement", "calls")
