"""The batch operators on streams: cleaned feeds, gap sessions, daily counts, and episodes that end on a change of state."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, keys: list[str], ts: str, lateness: str = "1 day") -> DataFrame:
    """The first row of each key; keys are remembered as long as late rows may come."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def gap_sessions(stream: DataFrame, keys: list[str], ts: str, gap: str, lateness: str = "0 seconds") -> DataFrame:
    """keys, start_time, end_time (last event's time), point_count: ends once the watermark is a gap behind."""
    window = F.session_window(ts, gap)
    return stream.withWatermark(ts, lateness).groupBy(*keys, window.alias("w")).agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"), F.count("*").alias("point_count")).drop("w")


def daily_counts(stream: DataFrame, keys: list[str], ts: str, lateness: str = "1 day") -> DataFrame:
    return stream.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, "1 day").alias("w")).agg(F.count("*").alias("events")).select(*keys, F.to_date("w.start").alias("day"), "events")


EPISODE = "key long, state string, start_time timestamp, end_time timestamp, point_count long"


def episodes(stream: DataFrame, key: str, ts: str, state: str, max_gap_minutes: float, lateness: str = "0 seconds") -> DataFrame:
    """Finished runs of one state without a long gap. A key keeps its open run only; rows of a trigger are put in order.

    Rows that are older than what their key has seen are left out; the last run of a key ends by time-out of the watermark.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    gap = pd.Timedelta(minutes=max_gap_minutes)

    def run(k: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        done = []
        current = list(held.get) if held.exists else None
        if held.hasTimedOut:
            held.remove()
            yield pd.DataFrame([[k[0], current[0], pd.Timestamp(current[1], unit="us"), pd.Timestamp(current[2], unit="us"), current[3]]], columns=["key", "state", "start_time", "end_time", "point_count"])
            return
        rows = pd.concat(list(frames)).sort_values(ts)
        for at, what in zip(rows[ts], rows[state], strict=True):
            micros, what = at.value // 1000, None if pd.isna(what) else what
            if current and micros < current[2]:
                continue
            if current and current[0] == what and micros - current[2] <= gap.value // 1000:
                current[2], current[3] = micros, current[3] + 1
            else:
                if current:
                    done.append(current)
                current = [what, micros, micros, 1]
        held.update(tuple(current))
        held.setTimeoutTimestamp(current[2] // 1000 + int(gap.total_seconds() * 1000) + 1)
        yield pd.DataFrame([[k[0], s, pd.Timestamp(a, unit="us"), pd.Timestamp(b, unit="us"), n] for s, a, b, n in done], columns=["key", "state", "start_time", "end_time", "point_count"])

    return stream.withWatermark(ts, lateness).groupBy(key).applyInPandasWithState(
        run, EPISODE, "state string, first long, last long, n long", "append", GroupStateTimeout.EventTimeTimeout)
