"""Intervals as two columns: clipping, days, sweep lines, elementary intervals, joins by time.

None of the joins here is a nested loop over two tables: joins by containment meet in buckets of time. Sums by day take
steps at an interval's first and last days; only what needs a row for each day of an interval (`by_day`) makes them. Running
sums over instants go through windows of one day and one window over days, whether there are keys or not.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborline.functions.numbers import minutes_between, shift


def clip(df: DataFrame, start: str, end: str, low, high, *, out: tuple[str, str] = ("clipped_start", "clipped_end")) -> DataFrame:
    """Intervals cut to [low, high]; those that have nothing left go."""
    cut = df.withColumns({out[0]: F.greatest(F.col(start), low), out[1]: F.least(F.col(end), high)})
    return cut.filter(F.col(out[1]) > F.col(out[0]))


def calendar(bounds: DataFrame, start: str, end: str, out: str = "metric_date") -> DataFrame:
    """A row for each day that [start, end] touches. bounds: one row."""
    days = F.sequence(F.to_date(start), F.to_date(end), F.expr("interval 1 day"))
    return bounds.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).select(F.explode(days).alias(out))


def by_day(df: DataFrame, start: str, end: str, out: str = "metric_date") -> DataFrame:
    """df once for each day d with end > d and start < d + 1 day."""
    last = F.greatest(F.to_date(F.col(end) - F.expr("interval 1 microsecond")), F.to_date(start))
    touched = F.col(end) > F.date_trunc("day", F.col(start)).cast(df.schema[start].dataType)
    return df.filter(touched).withColumn(out, F.explode(F.sequence(F.to_date(start), last, F.expr("interval 1 day"))))


def daily_use(df: DataFrame, start: str, end: str, out: str = "metric_date") -> DataFrame:
    """out, active (intervals that touch the day), minutes (that they cover of it), for each day that any touches.

    An interval gives four rows at most, however long it is: steps where it starts and ends to touch days and to cover them in
    full, and the minutes of its first and last day. Steps are summed by day; the running sums go over days alone.
    """
    low, high = F.col(start).cast("timestamp"), F.col(end).cast("timestamp")
    first, last = F.to_date(low), F.to_date(high - F.expr("interval 1 microsecond"))
    step = lambda day, active, full, minutes: F.struct(day.alias(out), F.lit(active).alias("active"), F.lit(full).alias("full"), minutes.alias("minutes"))
    none = F.lit(0.0)
    one = [step(first, 1, 0, minutes_between(low, F.least(high, F.date_add(first, 1).cast("timestamp")))), step(F.date_add(last, 1), -1, 0, none)]
    more = [step(F.date_add(first, 1), 0, 1, none), step(last, 0, -1, minutes_between(last.cast("timestamp"), high))]
    steps = df.filter(high > low).select(F.inline(F.when(last > first, F.array(*one, *more)).otherwise(F.array(*one))))
    sums = steps.groupBy(out).agg(*[F.sum(c).alias(c) for c in ("active", "full", "minutes")])
    days = calendar(sums.agg(F.min(out).alias("low"), F.max(out).alias("high")), "low", "high", out)
    running = Window.orderBy(out).rowsBetween(Window.unboundedPreceding, 0)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return days.join(sums, out, "left").select(
        out, F.sum(zero("active")).over(running).alias("active"), (F.sum(zero("full")).over(running) * 1440.0 + zero("minutes")).alias("minutes"),
    ).filter("active > 0")


def day_overlap_minutes(start: str, end: str, day: str):
    low, high = F.col(day).cast("timestamp"), F.date_add(day, 1).cast("timestamp")
    return F.greatest(minutes_between(F.greatest(F.col(start).cast("timestamp"), low), F.least(F.col(end).cast("timestamp"), high)), F.lit(0.0))


def running(df: DataFrame, keys: list[str], at: str, sums: dict[str, str], until: str | None = None) -> DataFrame:
    """df (one row for each instant of the keys) with sums from the keys' first row to this one (new name: column), and
    with the next row's time.

    Days are summed first, and their totals go through a window of days; rows only go through windows of one day.
    """
    placed = df.withColumn("__day", F.to_date(at))
    before = Window.partitionBy(*keys).orderBy("__day")
    days = placed.groupBy(*keys, "__day").agg(*[F.sum(c).alias(out) for out, c in sums.items()], F.min(at).alias("__first"))
    offsets = days.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.col("__day").alias("__of_day"), F.lead("__first").over(before).alias("__next"),
        *[F.coalesce(F.sum(out).over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__before_{out}") for out in sums])
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in [("__day", "__of_day"), *[(k, f"__of_{k}") for k in keys]]]
    within = Window.partitionBy(*keys, "__day").orderBy(at)
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    added = [(F.col(f"__before_{out}") + F.sum(c).over(upto)).alias(out) for out, c in sums.items()]
    following = [F.coalesce(F.lead(at).over(within), F.col("__next")).alias(until)] if until else []
    return placed.join(offsets, same).select(*df.columns, *added, *following)


def instants(df: DataFrame, keys: list[str], start: str, end: str, out: str = "at") -> DataFrame:
    """keys, out: every time at which an interval of the keys starts or ends, once."""
    return df.select(*keys, F.explode(F.array(start, end)).alias(out)).distinct()


def _steps(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, at, step: how many intervals more are open from an instant on."""
    step = lambda t, n: F.struct(F.col(t).alias("at"), F.lit(n).alias("step"))
    return df.select(*keys, F.inline(F.array(step(start, 1), step(end, -1)))).groupBy(*keys, "at").agg(F.sum("step").alias("step"))


def sweep_line(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """keys, at, occupancy, until: how many intervals are open from each instant to the next one of its keys."""
    return running(_steps(df, keys, start, end), keys, "at", {"occupancy": "step"}, "until").drop("step")


def elementary(df: DataFrame, keys: list[str], start: str, end: str, place: str) -> DataFrame:
    """keys, interval_start, interval_end, occupied (distinct places), active (intervals): between neighbouring instants.

    Several intervals at one place count once as occupied: places have sums of their own, and an instant's change is that of
    the places that open or close.
    """
    each = running(_steps(df, [*keys, place], start, end), [*keys, place], "at", {"occupancy": "step"})
    opened = (F.col("occupancy") > 0).cast("int") - (F.col("occupancy") > F.col("step")).cast("int")
    changes = each.groupBy(*keys, "at").agg(F.sum(opened).alias("places"), F.sum("step").alias("intervals"))
    line = running(changes, keys, "at", {"occupied": "places", "active": "intervals"}, "interval_end")
    return line.filter("interval_end is not null").select(*keys, F.col("at").alias("interval_start"), "interval_end", "occupied", "active")


#: Lengths of intervals are told apart by powers of 8 microseconds, those under 8**9 (134 seconds) are one class.
LEAST_CLASS = 9


def _micros(t: Column) -> Column:
    return F.unix_micros(t.cast("timestamp"))


def _bucket(micros: Column, length_class: Column) -> Column:
    """The number of a bucket of half a class's least length."""
    return F.call_function("shiftright", micros, (length_class * 3 - 1).cast("int"))


def _met(points: DataFrame, spans: DataFrame, keys: list[str], ts: str, start: Column, end: Column) -> DataFrame:
    """points and spans that share keys and a bucket of time, with __at and the span's __low and __high in microseconds."""
    sized = spans.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in spans.columns], _micros(start).alias("__low"), _micros(end).alias("__high")).filter("__low <= __high")
    size = F.greatest(F.floor((F.length(F.bin(F.col("__high") - F.col("__low"))) - 1) / 3).cast("int"), F.lit(LEAST_CLASS))
    classed = sized.withColumn("__class", size)
    right = classed.withColumn("__bucket", F.explode(F.sequence(_bucket(F.col("__low"), F.col("__class")), _bucket(F.col("__high"), F.col("__class")))))
    classes = classed.agg(F.array_sort(F.collect_set("__class")).alias("__classes"))  # one row, of some ten numbers
    left = points.withColumn("__at", _micros(F.col(ts))).crossJoin(F.broadcast(classes)).withColumn("__of", F.explode("__classes")).withColumn("__in", _bucket(F.col("__at"), F.col("__of")))
    same = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__of") == F.col("__class"), F.col("__in") == F.col("__bucket")]
    return left.join(right, same).drop(*[f"__{k}" for k in keys], "__classes", "__of", "__in", "__class", "__bucket")


def contained(points: DataFrame, spans: DataFrame, keys: list[str], ts: str, start: str, end: str, *, before: float = 0.0, after: float = 0.0, closed: bool = True) -> DataFrame:
    """points with the spans of the same keys (there may be none) that hold their time, widened by some minutes; open or
    closed ends. Null keys and times meet nothing.

    Spans are told apart by their length. A class's buckets of time are half as long as its shortest span, so a span lies in
    18 of them at most, and points that meet it in one are seldom outside: there are at most about twice as many pairs as
    rows in the result, however many spans a key has. A point lies in one bucket of each class that there is.
    """
    met = _met(points, spans, keys, ts, shift(F.col(start), -before), shift(F.col(end), after))
    at, low, high = F.col("__at"), F.col("__low"), F.col("__high")
    return met.filter((at >= low) & (at <= high) if closed else (at > low) & (at < high)).drop("__at", "__low", "__high")


def overlapping(df: DataFrame, ids: list[str], spans: DataFrame, start: str, end: str, span_start: str, span_end: str, *, slack: float = 0.0) -> DataFrame:
    """The ids of df's closed intervals that overlap some span and lie within it, give or take `slack` minutes. What lies in a
    span starts in it, so these are starts contained in spans."""
    outer = spans.select(F.col(span_start).alias("__s"), F.col(span_end).alias("__e"))
    found = contained(df.select(*ids, F.col(start).alias("__start"), F.col(end).alias("__end")), outer, [], "__start", "__s", "__e", before=slack, after=slack)
    fits = (F.col("__end") <= shift(F.col("__e"), slack)) & (F.col("__start") <= F.col("__e")) & (F.col("__end") >= F.col("__s"))
    return found.filter(fits).select(*ids).distinct()
