"""Queries for the models, with one SQL chain each for calls and for positions."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions import spatial
from harborline.operators import rank, sessions
from harborline.plans import calls as call_plans
from harborline.plans import enrichment, gates, serve, terminal
from harborline.plans.catalog_operators import MINUTES, R4, events, ntz, r4, table
from harborline.plans.config import Config

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- calls to scores -------------------------------------------------------------------------------------------------

CHAIN = f"""
with m as (select user_id, ts, case when lag(ts) over w is null or {MINUTES.format(a='lag(ts) over w', b='ts')} > 720 then 1 else 0 end as s from events window w as (partition by user_id order by ts)),
n as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding)::bigint as session_no from m),
c as (select user_id, session_no, min(ts) as a, max(ts) as b, count(*) as points from n group by 1, 2 having count(*) >= 3),
ops as (select row_number() over (order by a, user_id)::bigint as validated_call_id, user_id as mmsi, 'B' || (user_id % 3 + 1) as berth_zone_code, a as berth_arrival_time, b as berth_departure_time,
  {MINUTES.format(a='a', b='b')} as berth_duration_minutes, case when points >= 4 then 'high' else 'medium' end as berth_detection_confidence,
  case session_no % 7 when 0 then 'review' when 1 then 'moderate_gap' when 2 then 'minor_gaps' else 'continuous' end as berth_continuity,
  case session_no % 5 when 0 then 'inbound_only' when 1 then 'outbound_only' when 2 then 'berth_only' else 'full' end as movement_coverage from c),
ds as (select min(ts) as dataset_start, max(ts) as dataset_end from events),
el as (select * from ops where movement_coverage = 'full' and berth_detection_confidence = 'high' and berth_continuity <> 'review'),
bb as (select berth_zone_code, count(*)::bigint as n, quantile_cont(berth_duration_minutes, 0.5) as p50, quantile_cont(berth_duration_minutes, 0.75) as p75, quantile_cont(berth_duration_minutes, 0.9) as p90, quantile_cont(berth_duration_minutes, 0.95) as p95, quantile_cont(berth_duration_minutes, 0.75) - quantile_cont(berth_duration_minutes, 0.25) as iqr from el group by 1),
tb as (select count(*)::bigint as n, quantile_cont(berth_duration_minutes, 0.5) as p50, quantile_cont(berth_duration_minutes, 0.75) as p75, quantile_cont(berth_duration_minutes, 0.9) as p90, quantile_cont(berth_duration_minutes, 0.95) as p95, quantile_cont(berth_duration_minutes, 0.75) - quantile_cont(berth_duration_minutes, 0.25) as iqr from el),
d0 as (select ops.*, case when bb.n >= 5 then 'berth' else 'terminal' end as baseline_scope, case when bb.n >= 5 then bb.n else tb.n end as baseline_sample_size, case when bb.n >= 5 then bb.p50 else tb.p50 end as expected,
  case when bb.n >= 5 then bb.p75 else tb.p75 end as p75, case when bb.n >= 5 then bb.p90 else tb.p90 end as p90, case when bb.n >= 5 then bb.p95 else tb.p95 end as p95, case when bb.n >= 5 then bb.iqr else tb.iqr end as iqr,
  berth_arrival_time <= dataset_start + interval 10 minutes as left_censored, berth_departure_time >= dataset_end - interval 10 minutes as right_censored,
  case when berth_arrival_time <= dataset_start + interval 10 minutes or berth_departure_time >= dataset_end - interval 10 minutes then 'censored' when berth_continuity = 'review' then 'review' when berth_continuity = 'moderate_gap' then 'usable_with_gap' when berth_detection_confidence <> 'high' then 'lower_confidence' else 'usable' end as delay_quality
  from ops left join bb using (berth_zone_code) cross join tb cross join ds),
dl as (select *, greatest(berth_duration_minutes - expected, 0) as delay, case when delay_quality in ('censored', 'review', 'lower_confidence') then 'unscored' when berth_duration_minutes <= p75 then 'normal' when berth_duration_minutes <= p90 then 'elevated' when berth_duration_minutes <= p95 then 'high' else 'severe' end as delay_band from d0),
cl as (select berth_zone_code, greatest(berth_arrival_time, dataset_start) as s, least(berth_departure_time, dataset_end) as e from ops, ds where least(berth_departure_time, dataset_end) > greatest(berth_arrival_time, dataset_start)),
i0 as (select t, lead(t) over (order by t) as u from (select s as t from cl union select e from cl)),
oi as (select t as interval_start, u as interval_end, count(distinct berth_zone_code)::bigint as occupied_berths, count(berth_zone_code)::bigint as active_calls from i0 left join cl on s < u and e > t where u is not null group by 1, 2),
cal as (select unnest(generate_series(dataset_start::date, dataset_end::date, interval 1 day))::date as metric_date from ds),
du as (select metric_date, sum(greatest((epoch_us(least(interval_end, metric_date + interval 1 day)) - epoch_us(greatest(interval_start, metric_date::timestamp))) / 6e7, 0) * occupied_berths) as minutes, max(occupied_berths) as peak from cal join oi on interval_end > metric_date and interval_start < metric_date + interval 1 day group by 1),
da as (select berth_arrival_time::date as metric_date, count(*) as arrivals, avg(delay) filter (where delay_band <> 'unscored') as mean_delay, count(*) filter (where delay_band = 'severe') as severe from dl where movement_coverage in ('full', 'inbound_only') group by 1),
dd as (select berth_departure_time::date as metric_date, count(*) as departures from dl where movement_coverage in ('full', 'outbound_only') group by 1),
dm as (select metric_date, coalesce(arrivals, 0)::bigint as arrivals, coalesce(departures, 0)::bigint as departures, coalesce(minutes, 0.0) as occupied_berth_minutes, coalesce(peak, 0)::bigint as max_occupied_berths, coalesce(minutes, 0.0) / 4320.0 * 100.0 as terminal_utilisation_pct, coalesce(minutes, 0.0) / 1440.0 as mean_occupied_berths, mean_delay as mean_arrival_delay_minutes, coalesce(severe, 0)::bigint as severe_delay_arrivals from cal left join du using (metric_date) left join da using (metric_date) left join dd using (metric_date)),
ho as (select metric_date, berth_zone_code, count(*)::bigint as n, quantile_cont(berth_duration_minutes, 0.5) as p50, quantile_cont(berth_duration_minutes, 0.75) as p75, quantile_cont(berth_duration_minutes, 0.9) as p90, quantile_cont(berth_duration_minutes, 0.95) as p95 from cal join el on berth_departure_time < metric_date group by 1, 2),
ht as (select metric_date, count(*)::bigint as n, quantile_cont(berth_duration_minutes, 0.5) as p50, quantile_cont(berth_duration_minutes, 0.75) as p75, quantile_cont(berth_duration_minutes, 0.9) as p90, quantile_cont(berth_duration_minutes, 0.95) as p95 from cal join el on berth_departure_time < metric_date group by 1),
hs as (select g.metric_date, g.berth_zone_code, coalesce(ho.n, 0) as berth_history_calls, coalesce(ht.n, 0) as terminal_history_calls,
  case when coalesce(ho.n, 0) >= 5 then 'historical_berth' when coalesce(ht.n, 0) >= 5 then 'historical_terminal' else 'insufficient_history' end as baseline_scope,
  case when ho.n >= 5 then ho.p50 when ht.n >= 5 then ht.p50 end as expected_minutes, case when ho.n >= 5 then ho.p75 when ht.n >= 5 then ht.p75 end as p75_minutes, case when ho.n >= 5 then ho.p90 when ht.n >= 5 then ht.p90 end as p90_minutes, case when ho.n >= 5 then ho.p95 when ht.n >= 5 then ht.p95 end as p95_minutes
  from (select metric_date, berth_zone_code from cal, (select distinct berth_zone_code from ops)) g left join ho on g.metric_date = ho.metric_date and g.berth_zone_code = ho.berth_zone_code left join ht on g.metric_date = ht.metric_date),
ac as (select dm.metric_date, greatest((epoch_us(least(berth_departure_time, dm.metric_date + interval 1 day)) - epoch_us(berth_arrival_time)) / 6e7, 0) as elapsed, berth_arrival_time <= dataset_start + interval 10 minutes as lc, berth_detection_confidence as conf, berth_continuity as cont, hs.baseline_scope as scope, expected_minutes, p75_minutes, p95_minutes
  from dm join ops on berth_arrival_time < dm.metric_date + interval 1 day and berth_departure_time > dm.metric_date left join hs on hs.metric_date = dm.metric_date and hs.berth_zone_code = ops.berth_zone_code cross join ds),
au as (select metric_date, count(*)::bigint as active_calls, count(*) filter (where sure and expected_minutes is not null)::bigint as active_scored_calls, count(*) filter (where not sure or expected_minutes is null)::bigint as active_unscored_calls, count(*) filter (where sure and elapsed > p75_minutes)::bigint as active_delayed_calls, count(*) filter (where sure and elapsed > p95_minutes)::bigint as active_severe_calls,
  avg(greatest(elapsed - expected_minutes, 0) / 60.0) filter (where sure and elapsed > p75_minutes) as active_mean_delay_hours, max(elapsed) / 60.0 as max_active_elapsed_hours from (select *, not lc and conf = 'high' and cont <> 'review' and scope <> 'insufficient_history' as sure from ac) group by 1),
co as (select berth_departure_time::date as metric_date, count(*) filter (where delay_band in ('elevated', 'high', 'severe'))::bigint as delayed_departures, count(*) filter (where delay_band = 'severe')::bigint as severe_departures from dl where delay_band <> 'unscored' group by 1),
f0 as (select dm.*, coalesce(active_calls, 0) as active_calls, coalesce(active_scored_calls, 0) as active_scored_calls, coalesce(active_unscored_calls, 0) as active_unscored_calls, coalesce(active_delayed_calls, 0) as active_delayed_calls, coalesce(active_severe_calls, 0) as active_severe_calls, active_mean_delay_hours, max_active_elapsed_hours, coalesce(delayed_departures, 0) as delayed_departures, coalesce(severe_departures, 0) as severe_departures from dm left join au using (metric_date) left join co using (metric_date)),
ft as (select *, (sum(arrivals) over w)::bigint as arrivals_3d, (sum(departures) over w)::bigint as departures_3d, avg(terminal_utilisation_pct) over w as utilisation_3d_avg, (sum(severe_departures) over w)::bigint as severe_departures_3d,
  case when active_scored_calls > 0 then active_delayed_calls / active_scored_calls else 0.0 end as active_delay_share, case when active_scored_calls > 0 then active_severe_calls / active_scored_calls else 0.0 end as active_severe_share, case when active_calls > 0 then active_unscored_calls / active_calls else 0.0 end as unscored_active_share from f0 window w as (order by metric_date rows between 2 preceding and current row)),
p0 as (select *, arrivals_3d - departures_3d as vessel_balance_3d, least(greatest(terminal_utilisation_pct / 100.0, 0), 1) * 20 as q1, least(greatest(max_occupied_berths / 3.0, 0), 1) * 10 as q2, least(active_delay_share, 1) * 20 as q3, least(active_severe_share, 1) * 15 as q4, least(greatest(coalesce(active_mean_delay_hours, 0) / 24.0, 0), 1) * 10 as q5, least(greatest(utilisation_3d_avg / 100.0, 0), 1) * 15 as q6, least(greatest((arrivals_3d - departures_3d) / 2.0, 0), 1) * 10 as q7 from ft),
p1 as (select *, least(greatest(0.0 + q1 + q2 + q3 + q4 + q5 + q6 + q7, 0), 100) as raw from p0),
sc as (select *, {', '.join(f"cast(round(cast(q{i} as decimal(38,10)), 1) as double) as {n}_points" for i, n in enumerate(terminal.SIGNALS, 1))}, cast(round(cast(raw as decimal(38,10)), 1) as double) as risk_score, case when raw < 25 then 'low' when raw < 50 then 'moderate' when raw < 70 then 'elevated' when raw < 85 then 'high' else 'critical' end as risk_level, cast(round(cast(1.0 - unscored_active_share as decimal(38,10)), 3) as double) as data_coverage_score, case when unscored_active_share <= 0.20 then 'high' when unscored_active_share <= 0.50 then 'medium' else 'low' end as score_confidence from p1),
dr as (select metric_date, 'capacity' as k, capacity_points as p, 'Terminal utilisation ' || cast(round(cast(terminal_utilisation_pct as decimal(38,10)), 1) as decimal(20,1)) || '%' as txt from sc
  union all select metric_date, 'berth_saturation', saturation_points, case when max_occupied_berths = 3 then 'All 3 berths occupied at peak' else max_occupied_berths || ' of 3 berths occupied at peak' end from sc
  union all select metric_date, 'active_delay', active_delay_points, active_delayed_calls || ' active call(s) above normal-duration threshold' from sc
  union all select metric_date, 'active_severe', active_severe_points, active_severe_calls || ' active severe-duration call(s)' from sc
  union all select metric_date, 'delay_intensity', delay_intensity_points, 'Mean active excess duration ' || cast(round(cast(coalesce(active_mean_delay_hours, 0) as decimal(38,10)), 1) as decimal(20,1)) || ' h' from sc
  union all select metric_date, 'utilisation_3d', utilisation_3d_points, 'Trailing 3-day utilisation ' || cast(round(cast(utilisation_3d_avg as decimal(38,10)), 1) as decimal(20,1)) || '%' from sc
  union all select metric_date, 'backlog', backlog_points, '3-day net vessel balance +' || vessel_balance_3d from sc),
rk as (select *, row_number() over (partition by metric_date order by p desc, k) as r from dr where p > 0),
pv as (select metric_date, max(txt) filter (where r = 1) as d1, max(p) filter (where r = 1) as x1, max(txt) filter (where r = 2) as d2, max(p) filter (where r = 2) as x2, max(txt) filter (where r = 3) as d3, max(p) filter (where r = 3) as x3 from rk group by 1),
ex as (select sc.*, lag(risk_level) over (order by sc.metric_date) as previous_risk_level, cast(risk_score as decimal(10,1)) - cast(lag(risk_score) over (order by sc.metric_date) as decimal(10,1)) as chg, d1, x1, d2, x2, d3, x3 from sc left join pv on sc.metric_date = pv.metric_date)
"""


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = sessions.number_islands(events(spark, sf_dir), ["user_id"], "ts", 720)
    c = sessions.summarise(marked, ["user_id", "session_no"], "ts").filter("point_count >= 3")
    ladder = lambda n, values, last: F.when(F.lit(False), "").when(F.col("session_no") % n == 0, values[0]).when(F.col("session_no") % n == 1, values[1]).when(F.col("session_no") % n == 2, values[2]).otherwise(last)
    named = c.select(
        "session_no", F.col("user_id").alias("mmsi"), F.concat(F.lit("B"), (F.col("user_id") % 3 + 1).cast("string")).alias("berth_zone_code"), F.col("start_time").alias("berth_arrival_time"), F.col("end_time").alias("berth_departure_time"),
        F.col("duration_minutes").alias("berth_duration_minutes"), F.when(F.col("point_count") >= 4, "high").otherwise("medium").alias("berth_detection_confidence"),
        ladder(7, ("review", "moderate_gap", "minor_gaps"), "continuous").alias("berth_continuity"), ladder(5, ("inbound_only", "outbound_only", "berth_only"), "full").alias("movement_coverage"))
    return rank.numbered(named, [F.col("berth_arrival_time"), F.col("mmsi")], "validated_call_id", F.to_date("berth_arrival_time")).drop("session_no")


def _dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return call_plans.bounds(events(spark, sf_dir), "ts", "ts")


def _models(spark: SparkSession, sf_dir: str, *cached: str) -> dict[str, DataFrame]:
    """The chain; what several models read is written once, by a checkpoint, as a deployment would by tables."""
    from harborline.operators.clusters import cut

    return terminal.analytics(cut(_operations(spark, sf_dir)), _dataset(spark, sf_dir), keep=lambda name, df: cut(df) if name in cached else df)


_DELAYS = {"expected": "expected_duration_minutes", "delay": "estimated_delay_minutes", "berth_duration_minutes - expected": "duration_variance_minutes", "delay / 60": "estimated_delay_hours", "p75": "p75_minutes", "p90": "p90_minutes", "p95": "p95_minutes", "iqr": "baseline_iqr_minutes"}


@query(CHAIN + f"select validated_call_id, mmsi, baseline_scope, baseline_sample_size, {', '.join(R4.format(k) + ' as ' + v for k, v in _DELAYS.items())}, left_censored, right_censored, delay_quality, delay_band from dl")
def delay_bands_fallback(spark, sf_dir):
    d = _models(spark, sf_dir)["call_delay_metrics"]
    return d.select("validated_call_id", "mmsi", "baseline_scope", "baseline_sample_size", *[r4(F.col(c)).alias(c) for c in _DELAYS.values()], "left_censored", "right_censored", "delay_quality", "delay_band")


@query(CHAIN + f", z as (select berth_zone_code, s, e from cl), ev as (select berth_zone_code, s as t, 1 as d from z union all select berth_zone_code, e, -1 from z), g as (select berth_zone_code, t, sum(d) as d from ev group by 1, 2), o as (select berth_zone_code, t, sum(d) over (partition by berth_zone_code order by t rows unbounded preceding) as occ, lead(t) over (partition by berth_zone_code order by t) as u from g), oc as (select berth_zone_code, sum((epoch_us(u) - epoch_us(t)) / 6e7) as minutes from o where occ > 0 and u is not null group by 1) select berth_zone_code, count(*)::bigint as total_calls, count(*) filter (where delay_band <> 'unscored')::bigint as scored_calls, count(*) filter (where delay_band = 'severe')::bigint as severe_delay_calls, {R4.format('quantile_cont(berth_duration_minutes, 0.5)')} as median, {R4.format('quantile_cont(berth_duration_minutes, 0.9)')} as p90, {R4.format('avg(delay) filter (where delay_band <> $$unscored$$)')} as mean_delay, {R4.format('max(minutes)')} as occupied_minutes, {R4.format('max(minutes) * 100.0 / max((epoch_us(dataset_end) - epoch_us(dataset_start)) / 6e7)')} as utilisation_pct from dl join oc using (berth_zone_code) cross join ds group by 1")
def berth_performance(spark, sf_dir):
    b = _models(spark, sf_dir)["berth_performance"]
    return b.select("berth_zone_code", "total_calls", "scored_calls", "severe_delay_calls", r4(F.col("median_duration_minutes")).alias("median"), r4(F.col("p90_duration_minutes")).alias("p90"), r4(F.col("mean_estimated_delay_minutes")).alias("mean_delay"), r4(F.col("occupied_minutes")).alias("occupied_minutes"), r4(F.col("utilisation_pct")).alias("utilisation_pct"))


@query(CHAIN + f"select interval_start, interval_end, occupied_berths, active_calls, {R4.format(MINUTES.format(a='interval_start', b='interval_end'))} as duration_minutes from oi")
def occupancy_elementary_intervals(spark, sf_dir):
    return ntz(_models(spark, sf_dir)["occupancy_intervals"].withColumn("duration_minutes", r4(F.col("duration_minutes"))))


_DAILY = ("occupied_berth_minutes", "terminal_utilisation_pct", "mean_occupied_berths", "mean_arrival_delay_minutes")


@query(CHAIN + f"select metric_date, arrivals, departures, max_occupied_berths, severe_delay_arrivals, {', '.join(R4.format(c) + ' as ' + c for c in _DAILY)} from dm")
def terminal_daily_metrics(spark, sf_dir):
    d = _models(spark, sf_dir, "call_delay_metrics")["terminal_daily_metrics"]
    return d.select("metric_date", "arrivals", "departures", "max_occupied_berths", "severe_delay_arrivals", *[r4(F.col(c)).alias(c) for c in _DAILY])


@query(CHAIN + f"select validated_call_id, berth_arrival_time::date as arrival_metric_date, dm.arrivals as day_arrivals, dm.max_occupied_berths as day_peak, {R4.format('dm.terminal_utilisation_pct')} as day_utilisation, delay_band from dl left join dm on berth_arrival_time::date = dm.metric_date")
def call_analytics(spark, sf_dir):
    c = _models(spark, sf_dir, "call_delay_metrics", "terminal_daily_metrics")["call_analytics"]
    return c.select("validated_call_id", "arrival_metric_date", F.col("arrival_day_terminal_arrivals").alias("day_arrivals"), F.col("arrival_day_max_occupied_berths").alias("day_peak"), r4(F.col("arrival_day_terminal_utilisation_pct")).alias("day_utilisation"), "delay_band")


_HISTORY = ("expected_minutes", "p75_minutes", "p90_minutes", "p95_minutes")


@query(CHAIN + f"select metric_date, berth_zone_code, berth_history_calls, terminal_history_calls, baseline_scope, {', '.join(R4.format(c) + ' as ' + c for c in _HISTORY)} from hs")
def pit_baseline_daily(spark, sf_dir):
    h = _models(spark, sf_dir, "terminal_daily_metrics")["historical_duration_baseline_daily"]
    return h.select("metric_date", "berth_zone_code", "berth_history_calls", "terminal_history_calls", "baseline_scope", *[r4(F.col(c)).alias(c) for c in _HISTORY])


_ALL = ("call_delay_metrics", "occupancy_intervals", "terminal_daily_metrics", "historical_duration_baseline_daily", "risk_features_daily", "risk_score_daily")
_COUNTS = ("active_calls", "active_scored_calls", "active_unscored_calls", "active_delayed_calls", "active_severe_calls", "delayed_departures", "severe_departures", "arrivals_3d", "departures_3d", "severe_departures_3d")
_SHARES = ("active_mean_delay_hours", "max_active_elapsed_hours", "active_delay_share", "active_severe_share", "utilisation_3d_avg")


@query(CHAIN + f"select metric_date, {', '.join(_COUNTS)}, {', '.join(R4.format(c) + ' as ' + c for c in _SHARES)} from ft")
def risk_features_daily(spark, sf_dir):
    f = _models(spark, sf_dir, *_ALL)["risk_features_daily"]
    return f.select("metric_date", *_COUNTS, *[r4(F.col(c)).alias(c) for c in _SHARES])


@query(CHAIN + f"select metric_date, risk_score, risk_level, {', '.join(f'{s}_points' for s in terminal.SIGNALS)}, data_coverage_score, score_confidence from sc")
def risk_score_daily(spark, sf_dir):
    s = _models(spark, sf_dir, *_ALL)["risk_score_daily"]
    return s.select("metric_date", "risk_score", "risk_level", *[f"{n}_points" for n in terminal.SIGNALS], "data_coverage_score", "score_confidence")


_EXPLAINED = """metric_date, risk_score, risk_level, score_confidence, chg::double as risk_change_1d, previous_risk_level, case when chg is null then 'initial' when chg >= 10 then 'rising_fast' when chg >= 3 then 'rising' when chg <= -10 then 'falling_fast' when chg <= -3 then 'falling' else 'stable' end as risk_trend,
d1 as primary_driver, x1 as primary_driver_points, d2 as secondary_driver, x2 as secondary_driver_points, d3 as tertiary_driver, x3 as tertiary_driver_points, upper(risk_level) || ' — ' || cast(risk_score as decimal(20,1)) || ' / 100' as risk_headline, 'Primary drivers: ' || concat_ws('; ', coalesce(d1, 'none'), d2, d3) as risk_explanation"""


@query(CHAIN + f"select {_EXPLAINED} from ex")
def risk_explanations_daily(spark, sf_dir):
    return _models(spark, sf_dir, *_ALL)["risk_explanations_daily"].select(*serve.RISK)


@query(CHAIN + f"select {_EXPLAINED} from ex order by metric_date desc limit 1")
def latest_risk(spark, sf_dir):
    return serve.latest_risk(_models(spark, sf_dir, *_ALL)["risk_explanations_daily"])


@query(CHAIN + f"select {_EXPLAINED} from ex order by metric_date desc limit 30")
def risk_history(spark, sf_dir):
    return serve.risk_history(_models(spark, sf_dir, *_ALL)["risk_explanations_daily"])


@query(CHAIN + f"select metric_date, arrivals, departures, {', '.join(R4.format(c) + ' as ' + c for c in _DAILY)} from dm order by metric_date desc limit 14")
def terminal_days(spark, sf_dir):
    d = serve.terminal_days(_models(spark, sf_dir, "call_delay_metrics")["terminal_daily_metrics"], 14)
    return d.select("metric_date", "arrivals", "departures", *[r4(F.col(c)).alias(c) for c in _DAILY])


@query(CHAIN + "select metric_date, 'arrivals' as movement, arrivals as calls from dm union all select metric_date, 'departures', departures from dm")
def daily_movements(spark, sf_dir):
    return serve.daily_movements(_models(spark, sf_dir, "call_delay_metrics")["terminal_daily_metrics"])


# --- positions to calls ----------------------------------------------------------------------------------------------

_CONFIG = Config(call_gap=720, episode_gap=720, call_margin=120, least_call=30)
_box = lambda x0, x1, y0, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
#: zone_code, type, priority, valid from, valid to, outer ring (convex, counter-clockwise), hole.
_ZONED = [
    ("A", "berth", 10, "2024-01-08", None, _box(-93.9003, -93.8703, 29.7103, 29.7403), None),
    ("B", "berth", 10, None, None, [(-93.8803, 29.7203), (-93.8403, 29.7253), (-93.8353, 29.7453), (-93.8753, 29.7403)], None),
    ("C", "approach", 30, None, None, _box(-94.0003, -93.8203, 29.6003, 29.9003), _box(-93.8603, -93.8303, 29.6953, 29.7153)),
    ("D", "shipping_channel", 20, None, None, [(-93.9303, 29.7503), (-93.7903, 29.7553), (-93.7903, 29.7653), (-93.9303, 29.7603)], None),
    ("E", "manoeuvring_basin", 15, "2023-01-01", "2025-01-01", [(-93.8603, 29.7403), (-93.8203, 29.7403), (-93.8403, 29.7553)], None),
    ("F", "anchorage", 25, None, "2024-01-20", _box(-93.8203, -93.8003, 29.6903, 29.7503), None)]


def _inside(ring: list[tuple[float, float]]) -> str:
    """A convex ring as half planes."""
    return " and ".join(f"({x1} - ({x0})) * (lat - ({y0})) - ({y1} - ({y0})) * (lon - ({x0})) >= 0" for (x0, y0), (x1, y1) in zip(ring, [*ring[1:], ring[0]], strict=True))


_HITS = " union all ".join(
    f"select mmsi, recorded_at, speed_knots, '{code}' as zone_code, '{kind}' as zone_type, {order} as zone_priority from pos where {_inside(ring)}" + (f" and not ({_inside(hole)})" if hole else "")
    + (f" and recorded_at::date >= date '{low}'" if low else "") + (f" and recorded_at::date < date '{high}'" if high else "")
    for code, kind, order, low, high, ring, hole in _ZONED)
POSITIONS = f"""
with pos as (select user_id as mmsi, ts as recorded_at, value / 490.0 as speed_knots, -93.92 + (event_id * 37 % 1000) / 1000.0 * 0.12 as lon, 29.69 + (event_id * 91 % 1000) / 1000.0 * 0.08 as lat from events),
m as (select mmsi, recorded_at, case when lag(recorded_at) over w is null or {MINUTES.format(a='lag(recorded_at) over w', b='recorded_at')} > 720 then 1 else 0 end as s from pos window w as (partition by mmsi order by recorded_at)),
n as (select *, sum(s) over (partition by mmsi order by recorded_at rows unbounded preceding) as k from m),
calls as (select row_number() over (order by min(recorded_at), mmsi)::bigint as validated_call_id, mmsi, min(recorded_at) as arrival_time, max(recorded_at) as departure_time from n group by mmsi, k having count(*) >= 3),
hits as ({_HITS}),
pz as (select * from (select *, row_number() over (partition by mmsi, recorded_at order by zone_priority, zone_code) as r from hits) where r = 1),
st as (select pos.mmsi, pos.recorded_at, pos.speed_knots, zone_code, zone_type from pos left join pz using (mmsi, recorded_at)),
e1 as (select *, case when lag(recorded_at) over w is null or {MINUTES.format(a='lag(recorded_at) over w', b='recorded_at')} > 720 or lag(zone_code) over w is distinct from zone_code then 1 else 0 end as s from st window w as (partition by mmsi order by recorded_at)),
e2 as (select *, sum(s) over (partition by mmsi order by recorded_at rows unbounded preceding)::bigint as episode_number from e1),
b1 as (select validated_call_id, zone_code, pz.recorded_at, speed_knots from pz join calls on pz.mmsi = calls.mmsi and recorded_at between arrival_time - interval 2 hours and departure_time + interval 2 hours where zone_type = 'berth'),
b2 as (select *, case when lag(recorded_at) over w is null or {MINUTES.format(a='lag(recorded_at) over w', b='recorded_at')} > 720 then 1 else 0 end as s from b1 window w as (partition by validated_call_id, zone_code order by recorded_at)),
b3 as (select *, sum(s) over (partition by validated_call_id, zone_code order by recorded_at rows unbounded preceding)::bigint as stay_no from b2),
stay as (select validated_call_id, zone_code, stay_no, min(recorded_at) as a, max(recorded_at) as b, {MINUTES.format(a='min(recorded_at)', b='max(recorded_at)')} as dur, count(*) as points, avg(case when speed_knots < 0.5 then 1.0 else 0.0 end) as frac from b3 group by 1, 2, 3),
s2 as (select *, {MINUTES.format(a='lag(b) over (partition by validated_call_id, zone_code order by a)', b='a')} as gap from stay),
mg as (select validated_call_id, zone_code, min(a) as a, max(b) as b, count(*) as fragments, sum(points) as points, sum(dur) as observed, sum(frac * points) / sum(points) as frac, coalesce(max(gap), 0) as largest from s2 group by 1, 2),
bs as (select * from (select *, row_number() over (partition by validated_call_id order by points desc, observed desc, zone_code) as r from mg) where r = 1),
oc as (select calls.*, zone_code as berth_zone_code, a, b, fragments, points, frac, largest, {MINUTES.format(a='a', b='b')} as elapsed, observed from calls left join bs using (validated_call_id)),
oc2 as (select *, case when frac >= 0.95 and elapsed >= 360 and points >= 20 then 'high' when frac >= 0.80 and elapsed >= 60 then 'medium' else 'low' end as confidence, case when fragments = 1 then 'continuous' when largest <= 60 then 'minor_gaps' when largest <= 360 then 'moderate_gap' else 'review' end as continuity from oc),
t1 as (select validated_call_id, pz.recorded_at, pz.zone_code, pz.zone_type, a, b from pz join oc2 on pz.mmsi = oc2.mmsi and recorded_at between arrival_time - interval 2 hours and departure_time + interval 2 hours),
t2 as (select *, case when lag(recorded_at) over w is null or {MINUTES.format(a='lag(recorded_at) over w', b='recorded_at')} > 720 or lag(zone_code) over w is distinct from zone_code then 1 else 0 end as s from t1 window w as (partition by validated_call_id order by recorded_at)),
t3 as (select *, sum(s) over (partition by validated_call_id order by recorded_at rows unbounded preceding)::bigint as k from t2),
tl as (select validated_call_id, k as episode_number, zone_code, max(zone_type) as zone_type, min(recorded_at) as x, max(recorded_at) as y, max(a) as a, max(b) as b from t3 group by 1, 2, 3),
tp as (select *, case when zone_type = 'berth' and x <= b and y >= a then 'berth' when y < a then 'inbound' when x > b then 'outbound' else 'berth_transition' end as movement_phase from tl)
"""


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = lambda k: (F.col("event_id") * k % 1000) / 1000.0
    return events(spark, sf_dir).select(F.col("user_id").alias("mmsi"), F.col("ts").alias("recorded_at"), (F.col("value") / 490.0).alias("speed_knots"), (share(37) * 0.12 - 93.92).alias("longitude"), (share(91) * 0.08 + 29.69).alias("latitude"))


def _typed_zones(spark: SparkSession) -> DataFrame:
    rings = lambda *r: [[{"x": x, "y": y} for x, y in ring] for ring in r if ring]
    rows = [(i, 1, code, kind, order, low, high, rings(ring, hole)) for i, (code, kind, order, low, high, ring, hole) in enumerate(_ZONED, 1)]
    typed = spark.createDataFrame(rows, f"zone_id int, terminal_id int, zone_code string, zone_type string, zone_priority int, valid_from string, valid_to string, polygon {spatial.POLYGON}")
    return typed.withColumns({c: F.col(c).cast("date") for c in ("valid_from", "valid_to")})


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = sessions.number_islands(_positions(spark, sf_dir), ["mmsi"], "recorded_at", 720)
    c = marked.groupBy("mmsi", "session_no").agg(F.min("recorded_at").alias("arrival_time"), F.max("recorded_at").alias("departure_time"), F.count("*").alias("n")).filter("n >= 3")
    return rank.numbered(c, [F.col("arrival_time"), F.col("mmsi")], "validated_call_id", F.to_date("arrival_time")).select("validated_call_id", "mmsi", "arrival_time", "departure_time")


def _primary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terminal.primary_zone(terminal.zone_hits(_positions(spark, sf_dir), _typed_zones(spark)))


def _operational(spark: SparkSession, sf_dir: str, primary: DataFrame | None = None) -> DataFrame:
    from harborline.operators.clusters import cut

    calls = cut(_calls(spark, sf_dir))
    return terminal.operational_calls(calls, terminal.berth_stays(primary or _primary(spark, sf_dir), calls, _CONFIG))


@query(POSITIONS + "select mmsi, recorded_at, zone_code, zone_type from hits")
def position_zone_hits(spark, sf_dir):
    return ntz(terminal.zone_hits(_positions(spark, sf_dir), _typed_zones(spark)).select("mmsi", "recorded_at", "zone_code", "zone_type"))


@query(POSITIONS + "select mmsi, recorded_at, zone_code from st")
def position_zone_state(spark, sf_dir):
    return ntz(terminal.zone_state(_positions(spark, sf_dir), _primary(spark, sf_dir)).select("mmsi", "recorded_at", "zone_code"))


@query(POSITIONS + f"select mmsi, episode_number, zone_code, min(recorded_at) as start_time, max(recorded_at) as end_time, count(*)::bigint as point_count, {R4.format('avg(speed_knots)')} as avg_speed from e2 where zone_code is not null group by 1, 2, 3")
def zone_episodes(spark, sf_dir):
    e = terminal.zone_episodes(terminal.zone_state(_positions(spark, sf_dir), _primary(spark, sf_dir)), _CONFIG)
    return ntz(e.select("mmsi", F.col("episode_number").cast("long").alias("episode_number"), "zone_code", "start_time", "end_time", "point_count", r4(F.col("avg_value")).alias("avg_speed")))


@query(POSITIONS + f"select validated_call_id, zone_code, stay_no, a as start_time, b as end_time, points::bigint as point_count, {R4.format('frac')} as stationary_fraction from stay")
def berth_stays(spark, sf_dir):
    s = terminal.berth_stays(_primary(spark, sf_dir), _calls(spark, sf_dir), _CONFIG)
    return ntz(s.select("validated_call_id", "zone_code", F.col("stay_no").cast("long").alias("stay_no"), "start_time", "end_time", "point_count", r4(F.col("stationary_fraction")).alias("stationary_fraction")))


_BERTH = {"largest": "largest_internal_gap_minutes", "observed": "observed_berth_minutes", "greatest(elapsed - observed, 0)": "bridged_minutes", "elapsed": "berth_duration_minutes", "frac": "stationary_fraction"}
_DIFFERENCES = {MINUTES.format(a="arrival_time", b="a"): "arrival_difference_minutes", MINUTES.format(a="departure_time", b="b"): "departure_difference_minutes"}
_CALL = "validated_call_id, mmsi, case when berth_zone_code is not null then 1 end as terminal_id, berth_zone_code, a as berth_arrival_time, b as berth_departure_time, fragments::bigint as fragment_count, points::bigint as berth_point_count, confidence as berth_detection_confidence, continuity as berth_continuity"
_CALL_COLUMNS = ("validated_call_id", "mmsi", "terminal_id", "berth_zone_code", "berth_arrival_time", "berth_departure_time", "fragment_count", "berth_point_count", "berth_detection_confidence", "berth_continuity")


def _rounded(columns: dict[str, str]) -> str:
    return ", ".join(f"{R4.format(k)} as {v}" for k, v in columns.items())


@query(POSITIONS + f"select {_CALL}, {_rounded(_BERTH | _DIFFERENCES)}, arrival_time as original_arrival_time, departure_time as original_departure_time from oc2")
def dominant_berth(spark, sf_dir):
    o = _operational(spark, sf_dir)
    return ntz(o.select(*_CALL_COLUMNS, *[r4(F.col(c)).alias(c) for c in (_BERTH | _DIFFERENCES).values()], "original_arrival_time", "original_departure_time"))


@query(POSITIONS + "select validated_call_id, episode_number, zone_code, x as start_time, y as end_time, movement_phase from tp")
def timeline_phases(spark, sf_dir):
    from harborline.operators.clusters import cut

    primary = cut(_primary(spark, sf_dir))  # stays and timeline read it
    t = terminal.zone_timeline(primary, _operational(spark, sf_dir, primary), _CONFIG)
    return ntz(t.select("validated_call_id", F.col("episode_number").cast("long").alias("episode_number"), "zone_code", "start_time", "end_time", "movement_phase"))


_IN, _OUT = "movement_phase = 'inbound'", "movement_phase = 'outbound'"
_TIMES = {
    "first_zone_detection_time": "min(x)", "last_zone_detection_time": "max(y)", "inbound_start_time": f"min(x) filter (where {_IN})",
    "inbound_approach_time": f"min(x) filter (where {_IN} and zone_type = 'approach')", "inbound_channel_time": f"min(x) filter (where {_IN} and zone_type = 'shipping_channel')",
    "inbound_manoeuvre_time": f"min(x) filter (where {_IN} and zone_type = 'manoeuvring_basin')", "outbound_start_time": f"min(x) filter (where {_OUT})",
    "outbound_manoeuvre_time": f"min(x) filter (where {_OUT} and zone_type = 'manoeuvring_basin')", "outbound_channel_time": f"min(x) filter (where {_OUT} and zone_type = 'shipping_channel')",
    "outbound_approach_exit_time": f"max(y) filter (where {_OUT} and zone_type = 'approach')", "outbound_end_time": f"max(y) filter (where {_OUT})"}
_EPISODES = {f"{p}_{n}_episodes": f"{w} and zone_type = '{z}'" for p, w in (("inbound", _IN), ("outbound", _OUT)) for n, z in (("approach", "approach"), ("channel", "shipping_channel"), ("manoeuvre", "manoeuvring_basin"))}
_EPISODES |= {"inbound_episode_count": _IN, "outbound_episode_count": _OUT, "very_short_episode_count": MINUTES.format(a="x", b="y") + " < 2", "total_timeline_episodes": "true"}
_FLAGS = {f"has_{c.removesuffix('_time').removesuffix('_exit')}": c for c in ("inbound_approach_time", "inbound_channel_time", "inbound_manoeuvre_time", "outbound_manoeuvre_time", "outbound_channel_time", "outbound_approach_exit_time")}
_MOVES = {MINUTES.format(a="inbound_start_time", b="a"): "inbound_transit_minutes", MINUTES.format(a="b", b="outbound_end_time"): "outbound_transit_minutes", MINUTES.format(a="first_zone_detection_time", b="last_zone_detection_time"): "observed_terminal_cycle_minutes"}


@query(POSITIONS + f""", mv as (select validated_call_id, {', '.join(f"{v} as {k}" for k, v in _TIMES.items())}, {', '.join(f"(count(*) filter (where {v}))::bigint as {k}" for k, v in _EPISODES.items())} from tp group by 1)
select {_CALL}, {_rounded(_BERTH | _MOVES)}, {', '.join(_TIMES)}, {', '.join(_EPISODES)}, {', '.join(f"{v} is not null as {k}" for k, v in _FLAGS.items())},
case when inbound_start_time is not null and outbound_end_time is not null then 'full' when inbound_start_time is not null then 'inbound_only' when outbound_end_time is not null then 'outbound_only' else 'berth_only' end as movement_coverage
from oc2 left join mv using (validated_call_id)""")
def call_operations_conditional_aggs(spark, sf_dir):
    from harborline.operators.clusters import cut

    positions, calls = _positions(spark, sf_dir), _calls(spark, sf_dir)
    kept = ("position_primary_zone", "operational_calls")  # what several models read, as a deployment keeps in tables
    o = terminal.build(positions, _typed_zones(spark), cut(calls), _CONFIG, keep=lambda name, df: cut(df) if name in kept else df)["call_operations"]
    return ntz(o.select(*_CALL_COLUMNS, *[r4(F.col(c)).alias(c) for c in (_BERTH | _MOVES).values()], *_TIMES, *_EPISODES, *_FLAGS, "movement_coverage"))


@query(CHAIN + """select 'terminal_daily_metrics' as model, 'berths_in_range' as check_name, metric_date::varchar as violation_key from dm where max_occupied_berths + 1 > 3
union all select 'call_delay_metrics', 'not_null_delay_band', validated_call_id::varchar from dl where delay_band = 'severe'
union all select 'risk_score_daily', 'unique_metric_date', metric_date::varchar from sc where risk_level = 'high'""")
def model_violations(spark, sf_dir):
    """The data tests over all models of the calls, three of which are damaged: a berth too many, bands lost, days doubled."""
    m = _models(spark, sf_dir, *_ALL)
    daily = m["terminal_daily_metrics"].withColumn("max_occupied_berths", F.col("max_occupied_berths") + 1)
    delays = m["call_delay_metrics"].withColumn("delay_band", F.when(F.col("delay_band") != "severe", F.col("delay_band")))
    score = m["risk_score_daily"].unionByName(m["risk_score_daily"].filter("risk_level = 'high'"))
    return gates.violations(m | {"terminal_daily_metrics": daily, "call_delay_metrics": delays, "risk_score_daily": score})


# --- port calls ------------------------------------------------------------------------------------------------------

_OUTAGES = [("2024-01-05 00:00:00", "2024-01-06 12:00:00"), ("2024-01-14 06:00:00", "2024-01-15 06:00:00"), ("2024-01-22 00:00:00", "2024-01-24 00:00:00")]
_OUT_SQL = ", ".join(f"(timestamp '{a}', timestamp '{b}')" for a, b in _OUTAGES)
PORT = f"""
with m as (select user_id as mmsi, ts, value, case when lag(ts) over w is null or {MINUTES.format(a='lag(ts) over w', b='ts')} > 480 then 1 else 0 end as s from events window w as (partition by user_id order by ts)),
n as (select *, sum(s) over (partition by mmsi order by ts rows unbounded preceding) as k from m),
pc as (select row_number() over (order by min(ts), mmsi)::bigint as port_call_id, mmsi, min(ts) as arrival_time, max(ts) as departure_time, count(*)::bigint as position_count, avg(value) as average_speed, max(value) as maximum_speed from n group by mmsi, k having count(*) >= 2),
ou(a, b) as (values {_OUT_SQL}),
ch as (select *, lag(departure_time) over (partition by mmsi order by arrival_time) as prev from pc),
br as (select *, case when prev is not null and exists (select 1 from ou where prev >= ou.a - interval 5 minutes and arrival_time <= ou.b + interval 5 minutes and prev <= ou.b and arrival_time >= ou.a) then 0 else 1 end as st from ch),
gr as (select *, sum(st) over (partition by mmsi order by arrival_time rows unbounded preceding) as g from br)
"""


def _port_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = events(spark, sf_dir).select(F.lit(1).alias("terminal_id"), F.col("user_id").alias("mmsi"), F.col("ts").alias("recorded_at"), F.col("value").alias("speed_knots"), F.lit(100.0).alias("distance_metres"))
    return call_plans.port_calls(hits, Config(call_gap=480, least_call=0, least_positions=2))


@query(PORT + f"select row_number() over (order by min(arrival_time), mmsi)::bigint as validated_call_id, mmsi, min(arrival_time) as arrival_time, max(departure_time) as departure_time, {R4.format('sum(average_speed * position_count) / sum(position_count)')} as average_speed, max(maximum_speed) as maximum_speed, count(*)::bigint as source_call_count, array_to_string(array_agg(port_call_id order by arrival_time), ',') as source_ids, case when count(*) > 1 then 'merged_across_source_outage' else 'original_probable_call' end as validation_method from gr group by mmsi, g")
def outage_merge_validated(spark, sf_dir):
    calls = _port_calls(spark, sf_dir).withColumns({"starts_at_boundary": F.lit(False), "ends_at_boundary": F.lit(False), "imo": F.col("mmsi"), "vessel_name": F.lit("v")})
    outages = spark.createDataFrame(_OUTAGES, "a string, b string").select(F.to_timestamp("a").alias("outage_start"), F.to_timestamp("b").alias("outage_end"))
    v = call_plans.validated_calls(calls, outages)
    return ntz(v.select("validated_call_id", "mmsi", "arrival_time", "departure_time", r4(F.col("average_speed_knots")).alias("average_speed"), F.col("maximum_speed_knots").alias("maximum_speed"), "source_call_count", F.array_join(F.col("source_port_call_ids").cast("array<string>"), ",").alias("source_ids"), "validation_method"))


@query(PORT + f", nx as (select *, lead(port_call_id) over w as next_call_id, lead(arrival_time) over w as next_arrival from pc window w as (partition by mmsi order by arrival_time)) select nx.port_call_id, next_call_id, {R4.format('(epoch_us(next_arrival) - epoch_us(departure_time)) / 36e8')} as gap_hours, count(events.ts)::bigint as gap_positions from nx left join events on user_id = mmsi and ts > departure_time and ts < next_arrival where next_call_id is not null group by 1, 2, 3")
def gap_analysis_open_interval(spark, sf_dir):
    terminals = spark.createDataFrame([(1, 29.73, -93.87, 5000.0)], "terminal_id int, latitude double, longitude double, detection_radius_metres double")
    g = call_plans.gap_analysis(_port_calls(spark, sf_dir), _positions(spark, sf_dir), terminals)
    return g.select("port_call_id", "next_call_id", r4(F.col("gap_hours")).alias("gap_hours"), "gap_positions")


@query("""select o_orderkey, c_name, o_orderdate <= b.a + interval 10 minutes as starts_at_boundary, o_orderdate >= b.b - interval 10 minutes as ends_at_boundary from orders join customer on o_custkey = c_custkey cross join (select min(o_orderdate) as a, max(o_orderdate) as b from orders) b where o_totalprice >= 100000 and (c_acctbal >= 5000 or o_orderstatus = 'F')""")
def probable_calls(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    calls = o.select(
        F.col("o_orderkey").alias("port_call_id"), F.col("o_custkey").alias("mmsi"), F.lit(1).alias("terminal_id"), F.col("o_totalprice").alias("duration_minutes"), F.lit(0.5).alias("average_speed_knots"), F.lit(10.0).alias("closest_distance_metres"),
        F.when(F.col("o_orderstatus") == "F", 50.0).otherwise(0.0).alias("wide"), F.col("o_orderdate").cast("timestamp").alias("arrival_time"), F.col("o_orderdate").cast("timestamp").alias("departure_time"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mmsi"), F.col("c_custkey").alias("imo"), F.col("c_name").alias("vessel_name"), F.lit(80).alias("vessel_type"), F.col("c_acctbal").alias("length_metres"))
    terminals = spark.createDataFrame([(1, "T")], "terminal_id int, terminal_name string")
    config = Config(terminal_name="T", probable=(100000, 1.0, 2000, (80, 89), 5000, 40))
    bounds = o.agg(F.min("o_orderdate").cast("timestamp").alias("dataset_start"), F.max("o_orderdate").cast("timestamp").alias("dataset_end"))
    large = call_plans.probable_calls(calls.filter("wide = 0"), c.withColumn("width_metres", F.lit(0.0)), terminals, bounds, config)
    wide = call_plans.probable_calls(calls.filter("wide > 0"), c.withColumn("width_metres", F.lit(50.0)), terminals, bounds, config)
    return large.unionByName(wide).select(F.col("port_call_id").alias("o_orderkey"), F.col("vessel_name").alias("c_name"), "starts_at_boundary", "ends_at_boundary")


@query("""select s_suppkey as k, case when s_suppkey % 4 = 0 then 'processing' else 'pending' end as queue_status, s_suppkey % 3 as attempts from supplier where s_suppkey % 2 = 0 and s_suppkey % 5 <> 0 union all select s_suppkey, 'pending', 0 from supplier where s_suppkey % 2 = 1 and s_suppkey % 5 <> 0 union all select s_suppkey, 'failed', s_suppkey % 3 from supplier where s_suppkey % 10 = 0""")
def enqueue_unseen(spark, sf_dir):
    s, k = table(spark, sf_dir, "supplier"), F.col("s_suppkey")
    status = F.when(k % 10 == 0, "failed").when(k % 4 == 0, "processing").otherwise("failed")
    queue = s.filter(k % 2 == 0).select(
        F.concat(F.lit("imo:"), k.cast("string")).alias("lookup_key"), k.alias("imo"), k.alias("mmsi"), F.lit("old").alias("vessel_name"), status.alias("queue_status"), (k % 3).cast("int").alias("attempt_count"),
        F.lit(None).cast("timestamp").alias("last_attempt_at"), F.lit(None).cast("timestamp").alias("next_attempt_at"), F.lit("e").alias("last_error"), F.to_timestamp(F.lit("2024-01-01")).alias("created_at"))
    calls = s.select(k.alias("imo"), k.alias("mmsi"), F.col("s_name").alias("vessel_name"), F.to_timestamp(F.lit("2024-01-02")).alias("arrival_time"))
    q = enrichment.enqueue(queue, calls, s.filter(k % 5 == 0).select(k.alias("imo")), F.to_timestamp(F.lit("2024-01-03")))
    return q.select(F.col("imo").alias("k"), "queue_status", F.col("attempt_count").cast("long").alias("attempts"))


