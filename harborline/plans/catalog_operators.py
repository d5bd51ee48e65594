"""Queries for single operators."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborline.functions import numbers, spatial, text
from harborline.operators import checks, clusters, intervals, merge, outlines, rank, sessions, spatial_joins, stats, zones
from harborline.plans import calls as call_plans
from harborline.plans import enrichment, terminal
from harborline.sources import files, positions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def ntz(df: DataFrame) -> DataFrame:
    """Times without zone, as in the tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, t in df.dtypes if t == "timestamp"})


def r4(x) -> F.Column:
    return numbers.round_half_up(x, 4)


R4 = "cast(round(cast({} as decimal(38,10)), 4) as double)"
MINUTES = "(epoch_us({b}) - epoch_us({a})) / 6e7"


@query(f"""
with m as (select user_id, ts, value, case when lag(ts) over w is null or {MINUTES.format(a='lag(ts) over w', b='ts')} > 720 then 1 else 0 end as s from events window w as (partition by user_id order by ts)),
n as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding)::bigint as session_no from m)
select user_id, session_no, min(ts) as start_time, max(ts) as end_time, {R4.format(MINUTES.format(a='min(ts)', b='max(ts)'))} as duration_minutes, count(*)::bigint as point_count, {R4.format('avg(value)')} as avg_value, max(value) as max_value
from n group by 1, 2 having count(*) >= 3 and {MINUTES.format(a='min(ts)', b='max(ts)')} >= 30""")
def gap_sessions_port_calls(spark, sf_dir):
    marked = sessions.number_islands(events(spark, sf_dir), ["user_id"], "ts", 720)
    found = sessions.summarise(marked, ["user_id", "session_no"], "ts", "value").filter("point_count >= 3 and duration_minutes >= 30")
    return ntz(found.select("user_id", F.col("session_no").cast("long"), "start_time", "end_time", r4(F.col("duration_minutes")).alias("duration_minutes"), "point_count", r4(F.col("avg_value")).alias("avg_value"), "max_value"))


@query(f"""
with e as (select *, case when event_type <> 'error' then event_type end as zone from events),
m as (select *, case when lag(ts) over w is null or {MINUTES.format(a='lag(ts) over w', b='ts')} > 720 or lag(zone) over w is distinct from zone then 1 else 0 end as s from e window w as (partition by user_id order by ts)),
n as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding)::bigint as episode_number from m)
select user_id, episode_number, zone, min(ts) as start_time, max(ts) as end_time, count(*)::bigint as point_count, min(value) as min_value, max(value) as max_value from n where zone is not null group by 1, 2, 3""")
def state_episodes(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("zone", F.when(F.col("event_type") != "error", F.col("event_type")))
    marked = sessions.number_islands(e, ["user_id"], "ts", 720, state="zone", out="episode_number").filter("zone is not null")
    return ntz(sessions.summarise(marked.withColumn("episode_number", F.col("episode_number").cast("long")), ["user_id", "episode_number", "zone"], "ts", "value").drop("duration_minutes", "avg_value"))


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity from (select *, row_number() over (partition by l_orderkey, l_linenumber order by l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) as r from lineitem) where r = 1""")
def dedup_keep_first(spark, sf_dir):
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")]
    return rank.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("""select event_id, case when value between 10 and 400 then value end as value, try_cast(json_extract_string(props, '$.k') as bigint) as k, upper(trim(event_type)) as event_type from events where user_id is not null and ts is not null""")
def clean_range_null(spark, sf_dir):
    e = table(spark, sf_dir, "events").dropna(subset=["user_id", "ts"])
    return e.select("event_id", numbers.null_outside(F.col("value"), 10, 400).alias("value"), text.to_whole(F.get_json_object("props", "$.k")).alias("k"), F.upper(F.trim("event_type")).alias("event_type"))


@query("""select distinct on (user_id) user_id, event_id, event_type, value from (select *, case when event_type = 'purchase' then value end as paid, case when event_type <> 'error' then event_type end as kind from events) order by user_id, (paid is not null) desc, (kind is not null) desc, ts desc""")
def best_record_per_key(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumns({"paid": F.when(F.col("event_type") == "purchase", F.col("value")), "kind": F.when(F.col("event_type") != "error", F.col("event_type"))})
    return rank.best_record(e, ["user_id"], ["paid", "kind"], "ts").select("user_id", "event_id", "event_type", "value")


@query("""
with c as (select count(*) as n, count(*) filter (where event_type = 'error') as a, count(*) filter (where value > 400) as b, 0 as d from events)
select * from (select 'event_id' as column_name, d::bigint as null_count, n::bigint as total_rows from c union all select 'kind', a::bigint, n::bigint from c union all select 'value', b::bigint, n::bigint from c)""")
def null_profile(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"), F.when(F.col("value") <= 400, F.col("value")).alias("value"))
    return stats.null_profile(e)


@query("""select doc_id, nullif(regexp_extract(text, '([0-9]{7})', 1), '')::bigint as imo, nullif(ltrim(regexp_replace(text, '[^0-9]', '', 'g'), '0'), '') as digits, lower(trim(source)) in ('src1', 'src2') as chosen, nullif(trim(lang), '') as lang from documents""")
def text_helpers(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", text.extract_imo(F.col("text")).alias("imo"), text.digits(F.col("text")).alias("digits"), F.lower(F.trim("source")).isin("src1", "src2").alias("chosen"), text.blank_to_null(F.col("lang")).alias("lang"))


@query(f"""select l_suppkey as berth, count(*)::bigint as sample_size, {R4.format('quantile_cont(l_extendedprice, 0.25)')} as p25, {R4.format('quantile_cont(l_extendedprice, 0.5)')} as p50, {R4.format('quantile_cont(l_extendedprice, 0.75)')} as p75, {R4.format('quantile_cont(l_extendedprice, 0.9)')} as p90, {R4.format('quantile_cont(l_extendedprice, 0.95)')} as p95, {R4.format('quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25)')} as iqr from lineitem group by 1""")
def duration_baseline_by_group(spark, sf_dir):
    b = stats.baseline(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice")
    return b.select(F.col("l_suppkey").alias("berth"), "sample_size", *[r4(F.col(f"p{p}_minutes")).alias(f"p{p}") for p in (25, 50, 75, 90, 95)], r4(F.col("iqr_minutes")).alias("iqr"))


@query(f"""select count(*)::bigint as sample_size, cast(round(cast(avg(value) as decimal(38,10)), 2) as double) as mean_minutes, {R4.format('quantile_cont(value, 0.5)')} as p50, {R4.format('quantile_cont(value, 0.95)')} as p95 from events""")
def duration_baseline_global(spark, sf_dir):
    return stats.baseline(table(spark, sf_dir, "events"), [], "value").select("sample_size", "mean_minutes", r4(F.col("p50_minutes")).alias("p50"), r4(F.col("p95_minutes")).alias("p95"))


@query(f"""select user_id, {R4.format("sum(v * n) / nullif(sum(case when v is not null then n end), 0)")} as weighted, {R4.format("sum(v * n) / nullif(sum(n), 0)")} as weighted_all, {R4.format("avg(case when v is null then null when v < 50 then 1.0 else 0.0 end)")} as share_below
from (select user_id, case when event_type <> 'error' then value end as v, (event_id % 7 + 1)::bigint as n from events) group by 1""")
def weighted_mean(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"), (F.col("event_id") % 7 + 1).alias("n"))
    return e.groupBy("user_id").agg(r4(stats.weighted_mean("v", "n")).alias("weighted"), r4(stats.weighted_mean_of_all("v", "n")).alias("weighted_all"), r4(stats.share_below("v", 50)).alias("share_below"))


@query("""select user_id, array_to_string(array_agg(event_id order by ts), ',') as events from events group by 1""")
def ordered_array_agg(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(stats.in_order("event_id", "ts").cast("array<string>"), ",").alias("events"))


@query("""select event_type, bool_or(value > 489) as any_high, count(distinct user_id)::bigint as users, count(*) filter (where value < 100)::bigint as low, min(ts) filter (where value > 400) as first_high, max(value) filter (where user_id % 2 = 0) as max_even from events group by 1""")
def conditional_aggregates(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.bool_or(F.col("value") > 489).alias("any_high"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("value") < 100).alias("low"),
        F.min(F.when(F.col("value") > 400, F.col("ts"))).alias("first_high"), F.max(F.when(F.col("user_id") % 2 == 0, F.col("value"))).alias("max_even"))


@query("""select o_custkey as mmsi, o_orderpriority as vessel_name, count(*)::bigint as call_count from orders group by 1, 2 having count(*) > 1""")
def repeated_keys_having(spark, sf_dir):
    return call_plans.repeated_calls(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("mmsi"), F.col("o_orderpriority").alias("vessel_name")))


_OLD = "select s_suppkey as k, s_name as name, case when s_suppkey % 3 = 0 then null else s_acctbal end as balance, case when s_suppkey % 4 = 0 then 'processing' else 'failed' end as status from supplier"
_NEW = "select s_suppkey + 3 as k, case when s_suppkey % 2 = 0 then null else upper(s_name) end as name, s_acctbal + 1 as balance, 'pending' as status from supplier"


def _old_new(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    old = s.select(k.alias("k"), F.col("s_name").alias("name"), F.when(k % 3 != 0, F.col("s_acctbal")).alias("balance"), F.when(k % 4 == 0, "processing").otherwise("failed").alias("status"))
    new = s.select((k + 3).alias("k"), F.when(k % 2 != 0, F.upper("s_name")).alias("name"), (F.col("s_acctbal") + 1).alias("balance"), F.lit("pending").alias("status"))
    return old, new


@query(f"select coalesce(n.k, o.k) as k, coalesce(n.name, o.name) as name, coalesce(n.balance, o.balance) as balance, coalesce(n.status, o.status) as status from ({_OLD}) o full join ({_NEW}) n on o.k = n.k")
def upsert_coalesce(spark, sf_dir):
    return merge.upsert_coalesce(*_old_new(spark, sf_dir), ["k"])


@query(f"select * from ({_OLD}) o where k not in (select k from ({_NEW})) union all select * from ({_NEW}) n")
def upsert_overwrite(spark, sf_dir):
    return merge.upsert_overwrite(*_old_new(spark, sf_dir), ["k"])


@query(f"select * from ({_OLD}) o union all select * from ({_NEW}) n where k not in (select k from ({_OLD}))")
def upsert_ignore(spark, sf_dir):
    return merge.upsert_ignore(*_old_new(spark, sf_dir), ["k"])


@query(f"select * from ({_OLD}) o where k not in (select k from ({_NEW})) or status = 'processing' union all select * from ({_NEW}) n where k not in (select k from ({_OLD}) where status = 'processing')")
def upsert_conditional(spark, sf_dir):
    return merge.upsert_where(*_old_new(spark, sf_dir), ["k"], F.col("o.status") == "processing")


@query(f"select o.k, case when n.k is not null then n.name else o.name end as name, o.balance, o.status from ({_OLD}) o left join ({_NEW}) n on o.k = n.k")
def update_from(spark, sf_dir):
    old, new = _old_new(spark, sf_dir)
    return merge.replace_columns(old, new.select("k", "name"), ["k"])


@query("""select 'no_urgent_order' as check_name, c_custkey::varchar as violation_key from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority like '1%')""")
def enqueue_anti_join(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority like '1%'").select(F.col("o_custkey").alias("c_custkey"))
    return checks.covers(urgent, table(spark, sf_dir, "customer"), ["c_custkey"], "no_urgent_order")


@query("""select p_partkey, case when lng then 'LNG carrier' when sub = 'LPG' then 'LPG carrier' when sub is not null then p_sub else kind end as vessel_type,
case when lng then 'confirmed_lng' when sub in ('LPG', 'CRUDE OIL', 'OIL', 'CHEMICAL', 'PRODUCT', 'PETROLEUM PRODUCT') then 'confirmed_non_lng' when sub is not null or kind is not null then 'needs_review' else 'unknown' end as classification_status
from (select *, upper(nullif(trim(p_sub), '')) as sub, nullif(trim(p_kind), '') as kind, coalesce(upper(trim(p_sub)) = 'LNG', false) or contains(lower(coalesce(p_name, '')), 'lng vessel') as lng
  from (select p_partkey, p_name, case p_size % 7 when 0 then 'LNG' when 1 then 'Lpg' when 2 then 'Crude Oil' when 3 then ' ' when 4 then p_type end as p_sub, case when p_size % 2 = 0 then p_brand end as p_kind from part))""")
def classification_ladder(spark, sf_dir):
    size = F.col("p_size") % 7
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(size == 0, "LNG").when(size == 1, "Lpg").when(size == 2, "Crude Oil").when(size == 3, " ").when(size == 4, F.col("p_type")).alias("sub"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("kind"))
    return p.select("p_partkey", enrichment.classify(F.col("kind"), F.col("sub"), F.col("p_name")).alias("c")).select("p_partkey", "c.*")


@query("""select o_orderkey, case when renamed is null then null else renamed <> upper(trim(c_name)) end as name_changed from orders join (select *, case c_custkey % 3 when 0 then upper(c_name) when 1 then 'OTHER' end as renamed from customer) on o_custkey = c_custkey where c_mktsegment = 'BUILDING'""")
def registry_confirm_join(spark, sf_dir):
    k = F.col("c_custkey") % 3
    registry = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("imo"), F.col("c_name").alias("ais_vessel_name"), F.when(k == 0, F.upper("c_name")).when(k == 1, "OTHER").alias("registry_vessel_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "confirmed_lng").otherwise("unknown").alias("classification_status"))
    calls = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("imo"))
    return call_plans.confirmed_calls(calls, registry).select("o_orderkey", "name_changed")


def _points(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", (F.col("embedding")[0].cast("double") * 0.2 - 93.87).alias("longitude"), (F.col("embedding")[1].cast("double") * 0.2 + 29.73).alias("latitude"))


_POINTS = "select vec_id, label, embedding[1]::double * 0.2 - 93.87 as lon, embedding[2]::double * 0.2 + 29.73 as lat from embeddings"


@query(f"""
with p as ({_POINTS}), c(k, clat, clon, radius) as (values (1, 29.73, -93.87, 2500.0), (2, 29.75, -93.85, 4000.0)),
d as (select vec_id, k, radius, 1 - 0.0066943799901413165 * pow(sin(radians((lat + clat) / 2)), 2) as q, radians(clat - lat) as dy, radians(clon - lon) as dx, cos(radians((lat + clat) / 2)) as cs from p, c),
e as (select vec_id, k, radius, sqrt(pow(6378137.0 * (1 - 0.0066943799901413165) / pow(sqrt(q), 3) * dy, 2) + pow(6378137.0 / sqrt(q) * cs * dx, 2)) as m from d)
select vec_id, k, cast(round(cast(m as decimal(38,10)), 3) as double) as metres from e where m <= radius""")
def distance_join(spark, sf_dir):
    c = spark.createDataFrame([(1, 29.73, -93.87, 2500.0), (2, 29.75, -93.85, 4000.0)], "k int, centre_latitude double, centre_longitude double, radius_metres double")
    found = spatial_joins.within_distance(_points(spark, sf_dir), c)
    return found.select("vec_id", "k", numbers.round_half_up(F.col("distance_metres"), 3).alias("metres"))


_ZONES = [("A", 10, [(-93.90, 29.70), (-93.86, 29.70), (-93.86, 29.76), (-93.90, 29.76)]), ("B", 10, [(-93.88, 29.72), (-93.84, 29.72), (-93.84, 29.74), (-93.88, 29.74)]), ("C", 30, [(-94.0, 29.6), (-93.7, 29.6), (-93.7, 29.9), (-94.0, 29.9)])]
_ZONES_SQL = "select * from (values ('A', 10, -93.90, -93.86, 29.70, 29.76), ('B', 10, -93.88, -93.84, 29.72, 29.74), ('C', 30, -94.0, -93.7, 29.6, 29.9)) z(zone_code, zone_priority, x0, x1, y0, y1)"


def _zones(spark):
    rows = [(code, order, [[{"x": x, "y": y} for x, y in ring]]) for code, order, ring in _ZONES]
    return spark.createDataFrame(rows, f"zone_code string, zone_priority int, polygon {spatial.POLYGON}")


@query(f"select vec_id, zone_code from ({_POINTS}) p join ({_ZONES_SQL}) z on lon between x0 and x1 and lat between y0 and y1")
def point_in_polygon(spark, sf_dir):
    return spatial_joins.in_polygons(_points(spark, sf_dir), _zones(spark)).select("vec_id", "zone_code")


@query(f"select vec_id, zone_code, zone_priority from (select *, row_number() over (partition by vec_id order by zone_priority, zone_code) as r from ({_POINTS}) p join ({_ZONES_SQL}) z on lon between x0 and x1 and lat between y0 and y1) where r = 1")
def primary_zone_priority(spark, sf_dir):
    hits = spatial_joins.in_polygons(_points(spark, sf_dir), _zones(spark))
    return rank.first_per_key(hits, ["vec_id"], [F.col("zone_priority"), F.col("zone_code")]).select("vec_id", "zone_code", "zone_priority")


@query(f"select label, {R4.format('case when half < 0 then half + 180 else half end')} as axis, {R4.format('sqrt(c * c + s * s)')} as concentration from (select label, c, s, degrees(atan2(s, c)) / 2 as half from (select label, avg(cos(2 * radians(d))) as c, avg(sin(2 * radians(d))) as s from (select label, degrees(atan2(embedding[2]::double, embedding[1]::double)) as d from embeddings) group by 1))")
def heading_axis(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.degrees(F.atan2(F.col("embedding")[1].cast("double"), F.col("embedding")[0].cast("double"))).alias("d"))
    axis, concentration = spatial.axis_mean(F.col("d"))
    return e.groupBy("label").agg(r4(axis).alias("axis"), r4(concentration).alias("concentration"))


@query(f"select label, {R4.format('degrees(0.5 * atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)))')} as axis, {R4.format('quantile_cont(x, 0.98) - quantile_cont(x, 0.02)')} as spread from (select label, embedding[1]::double as x, embedding[2]::double as y from embeddings) group by 1")
def pca_axis(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return e.groupBy("label").agg(r4(spatial.principal_axis(F.col("x"), F.col("y"))).alias("axis"), r4(F.percentile("x", 0.98) - F.percentile("x", 0.02)).alias("spread"))


@query("""with recursive p as (select vec_id as id, embedding[1]::double as x, embedding[2]::double as y from embeddings),
n as (select a.id as a, b.id as b from p a join p b on pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 0.02::double * 0.02::double),
c as (select a as id from n group by 1 having count(*) >= 5),
l as (select n.a, n.b from n join c x on x.id = n.a join c y on y.id = n.b),
r as (select id, id as root from c union select l.b, r.root from r join l on l.a = r.id),
m as (select id, min(root) as label from r group by 1),
e as (select a as id, min(label) as edge from n join m on m.id = n.b group by 1),
d as (select e.id, coalesce(m.label, edge) as label from e left join m using (id)),
o as (select label, row_number() over (order by label) - 1 as cluster_id from (select distinct label from d))
select p.id as point_id, coalesce(cluster_id, -1)::bigint as cluster_id from p left join d using (id) left join o using (label)""")
def dbscan_clusters(spark, sf_dir):
    p = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return clusters.dbscan(p, 0.02, 5).select("point_id", "cluster_id")


_CLUSTERED = "select label as cluster_id, vec_id, embedding[1]::double * 1000 as x, embedding[2]::double * 1000 as y from embeddings"


def _clustered(spark, sf_dir):
    at = lambda i: F.col("embedding")[i].cast("double") * 1000
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("cluster_id"), "vec_id", at(0).alias("x"), at(1).alias("y"))


@query(f"select cluster_id, count(*)::bigint as point_count, count(distinct vec_id % 50)::bigint as vessel_count, {R4.format('avg(x)')} as centre_x, {R4.format('avg(y)')} as centre_y from ({_CLUSTERED}) where cluster_id >= 0 group by 1")
def cluster_summary(spark, sf_dir):
    c = clusters.summary(_clustered(spark, sf_dir).withColumn("mmsi", F.col("vec_id") % 50))
    return c.select("cluster_id", "point_count", "vessel_count", r4(F.col("centre_x")).alias("centre_x"), r4(F.col("centre_y")).alias("centre_y"))


@query(f"""
with p as ({_CLUSTERED}), c as (select cluster_id, avg(x) as cx, avg(y) as cy, 0.5 * atan2(2 * covar_samp(x, y), var_samp(x) - var_samp(y)) as t from p where cluster_id >= 0 group by 1),
a as (select cluster_id, cx, t, (x - cx) * cos(t) + (y - cy) * sin(t) as u, (y - cy) * cos(t) - (x - cx) * sin(t) as v from p join c using (cluster_id)),
f as (select cluster_id, any_value(cx) as cx, any_value(t) as t, count(*)::bigint as point_count, quantile_cont(u, 0.98) - quantile_cont(u, 0.02) as u, quantile_cont(v, 0.98) - quantile_cont(v, 0.02) as v from a group by 1)
select row_number() over (order by cx, cluster_id)::bigint as place, cluster_id, point_count, {R4.format('degrees(t)')} as axis_degrees, {R4.format('greatest(u + 30, 80)')} as length_metres, {R4.format('greatest(v + 30, 40)')} as width_metres from f""")
def cluster_profiles_west_to_east(spark, sf_dir):
    c = zones.west_to_east(clusters.profiles(_clustered(spark, sf_dir)), 10)  # as many labels as the table has, or an error
    return c.select(F.col("place").cast("long").alias("place"), "cluster_id", "point_count", *[r4(F.col(n)).alias(n) for n in ("axis_degrees", "length_metres", "width_metres")])


@query(f"""with c as (select distinct floor(x / 20)::bigint as cx, floor(y / 20)::bigint as cy from ({_CLUSTERED})), d as (select i, j from range(-3, 4) a(i), range(-3, 4) b(j) where sqrt(i * i + j * j) * 20 <= 60),
w as (select distinct cx + i as cx, cy + j as cy from c, d), n as (select cx + i as cx, cy + j as cy, count(*) as n from w, d group by 1, 2),
k as (select cx + i as cx, cy + j as cy, count(*) as n from n, d group by 1, 2 having count(*) = (select count(*) from d))
select count(*)::bigint as cells, count(*) * 400.0::double as area from k""")
def evidence_outlines(spark, sf_dir):
    """Points widened by 60, gaps of 120 closed, parts traced; the areas of the polygons make up the cells."""
    found = outlines.outlines(_clustered(spark, sf_dir), cell=20.0, buffer=60.0, closing=60.0)
    return found.agg(F.sum("cell_count").alias("cells"), F.sum(spatial.area(F.col("polygon"))).alias("area"))


_RAW_SQL = """select 366000000 + user_id as mmsi, case when event_id % 11 <> 0 then ts end as recorded_at, case when event_type <> 'error' then value / 5 end as latitude, -value / 2 as longitude,
case when value between 0 and 102.2 then value end as speed_knots, case when value * 1.5 between 0 and 359.9 then value * 1.5 end as course_degrees, case when value between 0 and 359 then value end as heading_degrees,
case when event_id % 3 <> 0 then event_type end as vessel_name, 'IMO ' || (1000000 + user_id) as imo, (case event_id % 4 when 0 then 0 when 2 then 1 end)::bigint as status, (case when event_id % 2 = 0 then 80 end)::bigint as vessel_type,
case when value between 1 and 500 then value end as length_metres, case when value between 1 and 100 then value end as width_metres, case when value between 0 and 30 then value end as draught_metres from events"""


def _raw_positions(spark, sf_dir, *more):
    """A feed as text, with what feeds have: blanks, words for numbers, fractions for codes, readings out of range."""
    e, n, value = table(spark, sf_dir, "events"), F.col("event_id"), F.col("value")
    text_of = {
        "MMSI": F.concat(F.lit(" "), (F.lit(366000000) + F.col("user_id")).cast("string")), "BaseDateTime": F.when(n % 11 == 0, "n/a").otherwise(F.col("ts").cast("string")), "LAT": F.when(F.col("event_type") == "error", "").otherwise((value / 5).cast("string")),
        "LON": (-value / 2).cast("string"), "SOG": value.cast("string"), "COG": (value * 1.5).cast("string"), "Heading": value.cast("string"), "VesselName": F.when(n % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" "))),
        "IMO": F.concat(F.lit("IMO "), (F.lit(1000000) + F.col("user_id")).cast("string")), "CallSign": F.lit(None).cast("string"), "VesselType": F.when(n % 2 == 0, "80.0").otherwise("8x"), "Status": ((n % 4) / 2).cast("string"),
        "Length": value.cast("string"), "Width": value.cast("string"), "Draft": value.cast("string"), "Cargo": F.lit(""), "TransceiverClass": F.lit("A")}
    return e.select(*[c.alias(name) for name, c in text_of.items()], *more)


_POSITIONS_SQL = f"""select distinct on (mmsi, recorded_at) * from ({_RAW_SQL}) where recorded_at is not null and latitude between -90 and 90 and longitude between -180 and 180
order by mmsi, recorded_at, latitude, longitude, speed_knots, course_degrees, heading_degrees, vessel_name nulls last, imo, vessel_type nulls last, status nulls last"""


@query(_POSITIONS_SQL)
def cleaned_positions(spark, sf_dir):
    return ntz(positions.clean(_raw_positions(spark, sf_dir)).drop("call_sign", "cargo", "transceiver_class"))


@query(f"""with n as (select distinct on (mmsi) mmsi, imo[5:]::bigint as imo, vessel_name, vessel_type, length_metres from ({_POSITIONS_SQL})
order by mmsi, vessel_name is not null desc, vessel_type is not null desc, length_metres is not null desc, recorded_at desc),
o as (select distinct 366000000 + user_id + 5 as mmsi, user_id as imo, 'KNOWN' as vessel_name, 70::bigint as vessel_type, 77.0::double as length_metres from events)
select coalesce(n.mmsi, o.mmsi) as mmsi, coalesce(n.imo, o.imo) as imo, coalesce(n.vessel_name, o.vessel_name) as vessel_name, coalesce(n.vessel_type, o.vessel_type) as vessel_type, coalesce(n.length_metres, o.length_metres) as length_metres from n full join o using (mmsi)""")
def loaded_vessels(spark, sf_dir):
    raw = _raw_positions(spark, sf_dir)
    typed = positions.clean(raw)
    user = F.col("user_id")
    known = {"mmsi": user + 366_000_005, "imo": user, "vessel_name": F.lit("KNOWN"), "call_sign": F.lit(None).cast("string"), "vessel_type": F.lit(70).cast("bigint"), "length_metres": F.lit(77.0), "width_metres": F.lit(None).cast("double"), "cargo": F.lit(None).cast("bigint"), "transceiver_class": F.lit("A")}
    old = table(spark, sf_dir, "events").select("user_id").distinct().select(*[known[c].alias(c) for c in positions.VESSEL])
    vessels, _ = positions.load(typed, old, typed.limit(0).select(*positions.POSITION))
    return vessels.select("mmsi", "imo", "vessel_name", "vessel_type", "length_metres")


@query("""select distinct on (mmsi, recorded_at) mmsi, recorded_at, latitude, vessel_name, status from (select *, date_trunc('day', recorded_at) as day from (""" + _RAW_SQL.replace("select 366000000", "select event_id, 366000000", 1) + """)) r(event_id, mmsi, exact, latitude, longitude, speed_knots, course_degrees, heading_degrees, vessel_name, imo, status, vessel_type, length_metres, width_metres, draught_metres, recorded_at)
where recorded_at is not null and latitude between -90 and 90 and longitude between -180 and 180 order by mmsi, recorded_at, event_id desc""")
def first_in_feed(spark, sf_dir):
    """Times cut to days make many rows of one key; the feed runs backwards, so neither values nor times tell which is first."""
    raw = _raw_positions(spark, sf_dir, "event_id").withColumns({"BaseDateTime": F.date_trunc("day", F.try_to_timestamp("BaseDateTime")).cast("string"), positions.FEED: -F.col("event_id")})
    return ntz(positions.clean(raw.drop("event_id")).select("mmsi", "recorded_at", "latitude", "vessel_name", "status"))


@query("""select s_suppkey as k, s_suppkey as imo, case when s_suppkey % 4 = 3 then null when s_suppkey % 3 = 1 or s_suppkey = 0 then 'IMO ' || (s_suppkey + 1) else 'IMO 00' || s_suppkey end as identification,
case when s_suppkey % 4 <> 3 then s_name || ' & <sons>' end as vessel_name, case when s_suppkey % 4 <> 3 and s_suppkey % 2 = 0 then s_nationkey::varchar end as flag, s_suppkey % 4 <> 3 as found from supplier""")
def xml_lookups(spark, sf_dir):
    """Responses with attributes, comments, CDATA, wrappers, escapes, and records that stand in others or aren't the ship's."""
    k, name = F.col("s_suppkey"), F.col("s_name")
    flag = F.when(k % 2 == 0, F.concat(F.lit("<flag code='x'>"), F.col("s_nationkey").cast("string"), F.lit("</flag><!-- <flag>none</flag> -->"))).otherwise("<flag> </flag>")
    record = lambda number: F.concat(F.lit('<v:record id="1" xmlns:v="urn:v"><Identification>IMO '), number, F.lit("</Identification><vessel_name><![CDATA["), name, F.lit(" & <sons>]]></vessel_name>"), flag)
    other, own = record((k + 1).cast("string")), record(F.concat(F.lit("00"), k.cast("string")))
    two = F.concat(F.lit("<?xml version='1.0'?><set>"), other, F.when(k % 3 == 0, own).when(k % 3 == 2, F.concat(F.lit("</v:record>"), own)).otherwise(""), F.lit("</v:record>"), F.when(k % 3 == 0, "</v:record>").otherwise(""), F.lit("</set>"))
    escaped = F.replace(F.replace(F.replace(two, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    body = F.when(k % 4 == 3, "<set><record><identification>broken</set>").when(k % 4 == 1, escaped).otherwise(two)
    found = files.parsed_lookups(table(spark, sf_dir, "supplier").select(k.alias("lookup_key"), k.alias("imo"), body.alias("body")), ("record", "set"))
    return found.select(F.col("lookup_key").alias("k"), "imo", "identification", "vessel_name", "flag", "found")


@query("""select o_custkey, o_orderkey from (select distinct on (o_custkey) * from orders order by o_custkey, o_orderdate, o_orderkey) order by o_orderdate, o_orderkey limit 100""")
def lookup_candidates(spark, sf_dir):
    return files.lookup_candidates(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 100).select("o_custkey", "o_orderkey")


@query("""with q as (select s_suppkey as k, 'imo:' || s_suppkey as lookup_key, case s_suppkey % 3 when 0 then 'pending' when 1 then 'failed' else 'completed' end as queue_status, s_suppkey % 4 as attempts,
  case when s_suppkey % 3 = 1 then timestamp '2024-01-01' + to_days((s_suppkey % 5)::int) end as next_attempt_at, timestamp '2024-01-01' + to_days((s_suppkey % 7)::int) as created_at from supplier),
t as (select lookup_key from q where queue_status = 'pending' or queue_status = 'failed' and next_attempt_at <= timestamp '2024-01-03' order by created_at, lookup_key limit 20)
select k, case when t.lookup_key is not null then 'processing' else queue_status end as queue_status, (attempts + (t.lookup_key is not null)::int)::bigint as attempts from q left join t using (lookup_key)""")
def queue_claim(spark, sf_dir):
    k = F.col("s_suppkey")
    day = lambda n: F.to_timestamp(F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int")))
    queue = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("imo:"), k.cast("string")).alias("lookup_key"), k.alias("imo"), F.when(k % 3 == 0, "pending").when(k % 3 == 1, "failed").otherwise("completed").alias("queue_status"), (k % 4).cast("int").alias("attempt_count"),
        F.lit(None).cast("timestamp").alias("last_attempt_at"), F.when(k % 3 == 1, day(k % 5)).alias("next_attempt_at"), day(k % 7).alias("created_at"))
    _, marked = enrichment.claim(queue, F.to_timestamp(F.lit("2024-01-03")), 20)
    return marked.select(F.col("imo").alias("k"), "queue_status", F.col("attempt_count").cast("long").alias("attempts"))


@query("""with r as (select s_suppkey as k, case when s_suppkey % 5 <> 0 then s_suppkey end as imo, case s_suppkey % 3 when 0 then 'no' when 1 then ' TRUE ' else 'yes' end as found, case s_suppkey % 4 when 0 then ' ' when 1 then 'timeout' end as error,
  case when s_suppkey % 7 <> 0 then s_suppkey end as own from supplier)
select k, case when imo is null then 'no imo' when trim(error) <> '' then 'error' when found = 'no' then 'not found' when own is null then 'identification differs' end as skip_reason from r""")
def skip_reasons(spark, sf_dir):
    k = F.col("s_suppkey")
    results = table(spark, sf_dir, "supplier").select(
        k.alias("k"), F.when(k % 5 != 0, k).alias("imo"), F.when(k % 3 == 0, "no").when(k % 3 == 1, " TRUE ").otherwise("yes").alias("found"), F.when(k % 4 == 0, " ").when(k % 4 == 1, "timeout").alias("error"),
        F.when(k % 7 != 0, F.concat(F.lit("IMO 00"), k.cast("string"))).otherwise("other").alias("identification"))
    return enrichment.skip_reasons(results).select("k", "skip_reason")


_LINES = "select l_orderkey, l_linenumber, l_suppkey, least(o_orderdate, l_shipdate) as s, greatest(o_orderdate, l_shipdate) as e from lineitem join orders on l_orderkey = o_orderkey"


def _lines(spark, sf_dir):
    """Lines as intervals between order and shipping, whichever comes first."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", F.col("l_suppkey"), F.least("o_orderdate", "l_shipdate").cast("timestamp").alias("s"), F.greatest("o_orderdate", "l_shipdate").cast("timestamp").alias("e"))


_SWEEP = f"""
with x as ({_LINES}), ev as (select l_suppkey, s as t, 1 as d from x union all select l_suppkey, e, -1 from x), g as (select l_suppkey, t, sum(d) as d from ev group by 1, 2),
o as (select l_suppkey, t, sum(d) over (partition by l_suppkey order by t rows unbounded preceding) as occ, lead(t) over (partition by l_suppkey order by t) as nxt from g)"""


@query(_SWEEP + f"""
select l_suppkey, {R4.format("sum((epoch_us(nxt) - epoch_us(t)) / 6e7) filter (where occ > 0)")} as occupied_minutes, max(occ)::bigint as peak from o where nxt is not null group by 1""")
def sweepline_utilisation(spark, sf_dir):
    line = intervals.sweep_line(_lines(spark, sf_dir), ["l_suppkey"], "s", "e").filter("until is not null")
    minutes = F.sum(F.when(F.col("occupancy") > 0, numbers.minutes_between(F.col("at"), F.col("until"))))
    return line.groupBy("l_suppkey").agg(r4(minutes).alias("occupied_minutes"), F.max("occupancy").alias("peak"))


@query(f"""
with x as ({_LINES}), days as (select l_suppkey, unnest(generate_series(date_trunc('day', s), case when e > s then e - interval 1 microsecond else s end, interval 1 day))::date as day, s, e from x where e > s)
select day, count(*)::bigint as active, {R4.format("sum((epoch_us(least(e, day + interval 1 day)) - epoch_us(greatest(s, day::timestamp))) / 6e7)")} as minutes from days group by 1""")
def daily_occupancy(spark, sf_dir):
    used = intervals.daily_use(_lines(spark, sf_dir), "s", "e", "day")
    return used.select("day", "active", r4(F.col("minutes")).alias("minutes"))


@query(f"""
with x as ({_LINES}), a as (select s::date as day, count(*) as n from x group by 1), d as (select e::date as day, count(*) as n from x group by 1),
c as (select unnest(generate_series((select min(s) from x)::date, (select max(e) from x)::date, interval 1 day))::date as day)
select day, coalesce(a.n, 0)::bigint as arrivals, coalesce(d.n, 0)::bigint as departures from c left join a using (day) left join d using (day)""")
def daily_arrivals_departures(spark, sf_dir):
    x = _lines(spark, sf_dir)
    days = intervals.calendar(x.agg(F.min("s").alias("a"), F.max("e").alias("b")), "a", "b", "day")
    n = lambda c, out: x.groupBy(F.to_date(c).alias("day")).agg(F.count("*").alias(out))
    joined = days.join(n("s", "arrivals"), "day", "left").join(n("e", "departures"), "day", "left")
    return joined.select("day", F.coalesce("arrivals", F.lit(0)).alias("arrivals"), F.coalesce("departures", F.lit(0)).alias("departures"))


@query(f"""
with m as (select user_id, ts, value, case when lag(ts) over w is null or {MINUTES.format(a='lag(ts) over w', b='ts')} > 720 then 1 else 0 end as s from events window w as (partition by user_id order by ts)),
n as (select *, sum(s) over (partition by user_id order by ts rows unbounded preceding)::bigint as session_no from m),
c as (select user_id, session_no, min(ts) as a, max(ts) as b from n group by 1, 2)
select e.event_id, c.user_id, c.session_no from events e join c on e.user_id = c.user_id and e.ts between c.a - interval 2 hours and c.b + interval 2 hours""")
def containment_join(spark, sf_dir):
    marked = sessions.number_islands(events(spark, sf_dir), ["user_id"], "ts", 720)
    calls = marked.groupBy("user_id", F.col("session_no").cast("long").alias("session_no")).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return intervals.contained(events(spark, sf_dir).select("event_id", "user_id", "ts"), calls, ["user_id"], "ts", "a", "b", before=120, after=120).select("event_id", "user_id", "session_no")


@query("""select day, event_type, clicks, total from (select ts::date as day, event_type, count(*)::bigint as clicks from events group by 1, 2) join (select ts::date as day, count(*)::bigint as total from events group by 1) using (day)""")
def derived_date_join(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("metric_date", F.to_date("ts"))
    zero = {c: F.lit(0) for c in ("departures", "max_occupied_berths", "terminal_utilisation_pct", "mean_occupied_berths")}
    daily = e.groupBy("metric_date").agg(F.count("*").alias("arrivals")).withColumns(zero)
    joined = terminal.call_analytics(e.select("event_type", F.col("ts").alias("berth_arrival_time")), daily)
    return joined.groupBy(F.col("arrival_metric_date").alias("day"), "event_type").agg(F.count("*").alias("clicks"), F.max("arrival_day_terminal_arrivals").alias("total"))


@query(f"""select day, events_3d, {R4.format('mean_3d')} as mean_3d, previous from (select day, sum(n) over w::bigint as events_3d, avg(n) over w as mean_3d, lag(n) over (order by day)::bigint as previous from (select ts::date as day, count(*) as n from events group by 1) window w as (order by day rows between 2 preceding and current row))""".replace("sum(n) over w::bigint", "(sum(n) over w)::bigint").replace("lag(n) over (order by day)::bigint", "(lag(n) over (order by day))::bigint"))
def trailing_3d(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    w = stats.trailing("day", 3)
    return daily.select("day", F.sum("n").over(w).alias("events_3d"), r4(F.avg("n").over(w)).alias("mean_3d"), F.lag("n").over(Window.orderBy("day")).alias("previous"))


@query("""with c as (select user_id, event_type, count(*) as n from events group by 1, 2), r as (select *, row_number() over (partition by user_id order by n desc, event_type) as k from c)
select user_id, max(event_type) filter (where k = 1) as first_type, max(event_type) filter (where k = 2) as second_type, max(event_type) filter (where k = 3) as third_type from r group by 1""")
def pivot_top3(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    r = rank.ranked(c, ["user_id"], [F.desc("n"), F.asc("event_type")])
    return r.groupBy("user_id").agg(*[F.max(F.when(F.col("rank") == k, F.col("event_type"))).alias(n) for k, n in enumerate(("first_type", "second_type", "third_type"), 1)])


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'tax' as driver, l_tax as points from lineitem where l_tax > 0 union all select l_orderkey, l_linenumber, l_partkey, l_suppkey, 'discount', l_discount from lineitem where l_discount > 0""")
def unpivot_drivers(spark, sf_dir):
    rows = [{"driver": F.lit(n), "points": F.col(c)} for n, c in (("tax", "l_tax"), ("discount", "l_discount"))]
    return rank.unpivoted(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], rows, "points > 0")


@query("""select user_id, ts as at from (select user_id, min(ts) as ts from events group by 1 union select user_id, max(ts) from events group by 1)""")
def union_distinct_instants(spark, sf_dir):
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return intervals.instants(spans, ["user_id"], "first", "last")


@query("""select event_id, user_id, ts, value from events order by value desc, event_id limit 25""")
def history_limit(spark, sf_dir):
    return rank.top(table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), [F.desc("value"), F.asc("event_id")], 25)


@query("""select o_orderkey, row_number() over (order by o_orderdate, o_orderkey)::bigint as call_id from orders""")
def surrogate_ids(spark, sf_dir):
    return rank.numbered(table(spark, sf_dir, "orders"), [F.col("o_orderdate"), F.col("o_orderkey")], "call_id", F.col("o_orderdate")).select("o_orderkey", "call_id")


@query("""select 'unique_l_orderkey_l_linenumber' as check_name, l_orderkey || '|' || l_linenumber as violation_key from lineitem group by l_orderkey, l_linenumber having count(*) > 1
union all select 'accepted_l_returnflag', l_orderkey::varchar from lineitem where l_returnflag not in ('A', 'N')
union all select 'ships_after_order', l_orderkey::varchar from lineitem join orders on l_orderkey = o_orderkey where not (l_shipdate >= o_orderdate)
union all select 'customers_have_orders', c_custkey::varchar from customer where c_custkey not in (select o_custkey from orders)
union all select 'not_null_kind', event_id::varchar from events where event_type = 'error'
union all select 'references_l_suppkey', l_suppkey::varchar from lineitem where l_suppkey not in (select s_suppkey from supplier where s_acctbal > 0)""")
def dq_report(spark, sf_dir):
    li, o, e = (table(spark, sf_dir, n) for n in ("lineitem", "orders", "events"))
    lines, orders = li.count(), o.count()  # reads no column
    both = checks.dealt(li, lines, "l_orderkey").join(checks.dealt(o, lines, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return checks.report([
        checks.unique(checks.dealt(li, lines, "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]), checks.accepted(li, "l_returnflag", ["A", "N"], "l_orderkey"), checks.holds(both, "l_shipdate >= o_orderdate", "l_orderkey", "ships_after_order"),
        checks.covers(checks.dealt(o.select(F.col("o_custkey").alias("c_custkey")), orders, "c_custkey"), table(spark, sf_dir, "customer"), ["c_custkey"], "customers_have_orders"),
        checks.not_null(e.withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type"))), "kind", "event_id"),
        checks.references(li, "l_suppkey", table(spark, sf_dir, "supplier").filter("s_acctbal > 0"), "s_suppkey")])


@query("""select (select count(*) from events)::bigint as events, (select count(*) from orders)::bigint as orders, (select count(*) from supplier where s_acctbal > 0)::bigint as suppliers""")
def multi_scalar_counts(spark, sf_dir):
    return checks.counts({"events": table(spark, sf_dir, "events"), "orders": table(spark, sf_dir, "orders"), "suppliers": table(spark, sf_dir, "supplier").filter("s_acctbal > 0")})
