"""Islands in irregular observations: breaks by gap and by change of state."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.numbers import minutes_between


def number_islands(df: DataFrame, keys: list[str], ts: str, max_gap: float, *, state: str | None = None, out: str = "session_no") -> DataFrame:
    """df with an island number within keys, from 1. A row starts an island if it is the first, if the time since the last
    row is more than max_gap minutes, or if its state (null is a state) differs from the last one's."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gap = minutes_between(F.lag(ts).over(w), F.col(ts))
    breaks: Column = F.lag(ts).over(w).isNull() | (gap > max_gap)
    if state:
        breaks = breaks | ~F.lag(state).over(w).eqNullSafe(F.col(state))
    starts = df.withColumn("__start", F.when(breaks, 1).otherwise(0))
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return starts.withColumn(out, F.sum("__start").over(running)).drop("__start")


def summarise(df: DataFrame, keys: list[str], ts: str, value: str | None = None, extra: list[Column] | None = None) -> DataFrame:
    """A row for each group: start_time, end_time, duration_minutes, point_count, and avg/min/max of a value."""
    measures = [F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), minutes_between(F.min(ts), F.max(ts)).alias("duration_minutes"), F.count("*").alias("point_count")]
    if value:
        measures += [F.avg(value).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value")]
    return df.groupBy(*keys).agg(*measures, *(extra or []))
