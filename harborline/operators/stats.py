"""Aggregates: exact percentiles, weighted means, point-in-time baselines, profiles."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from harborline.functions.numbers import round_half_up

PROBS = (0.25, 0.5, 0.75, 0.9, 0.95)


def percentiles(value: str, probs: tuple[float, ...] = PROBS, suffix: str = "_minutes") -> list[Column]:
    """Exact interpolated percentiles as p25<suffix> and so on."""
    return [F.percentile(value, p).alias(f"p{round(100 * p)}{suffix}") for p in probs]


def baseline(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, sample_size, mean_minutes (2 decimals), p25..p95, iqr_minutes; without keys one row."""
    aggs = [F.count("*").alias("sample_size"), round_half_up(F.avg(value), 2).alias("mean_minutes"), *percentiles(value)]
    rows = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return rows.withColumn("iqr_minutes", F.col("p75_minutes") - F.col("p25_minutes"))


def weighted_mean(value: str, weight: str) -> Column:
    """Rows without a value have no weight."""
    return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(F.when(F.col(value).isNotNull(), F.col(weight))), F.lit(0))


def weighted_mean_of_all(value: str, weight: str) -> Column:
    """Rows without a value keep their weight."""
    return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0))


def share_below(value: str, limit: float) -> Column:
    return F.avg(F.when(F.col(value).isNull(), None).when(F.col(value) < limit, 1.0).otherwise(0.0))


def in_order(value: str, by: str) -> Column:
    """The values as a list, in the order of another column."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(by), F.col(value)))), lambda s: s[value])


def trailing(order: str, rows: int, keys: list[str] | None = None) -> WindowSpec:
    """The last rows up to this one. Without keys one window holds all rows: for tables of days."""
    return (Window.partitionBy(*keys) if keys else Window).orderBy(order).rowsBetween(1 - rows, 0)


def null_profile(df: DataFrame) -> DataFrame:
    """column_name, null_count, total_rows for each column; one pass over the table."""
    counts = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns])
    return counts.select(F.explode(each).alias("x"), "n").select("x.column_name", "x.null_count", F.col("n").alias("total_rows"))


#: Blocks that a key's values are cut into, and the percentiles that histories tell.
BLOCKS, HISTORY_PERCENTS = 256, (50, 75, 90, 95)


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which some may be null, or none given; the right side's keys go."""
    named = right.withColumnsRenamed({k: f"__of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys] or [F.lit(True)]
    return left.join(named, same, how).drop(*[f"__of_{k}" for k in keys])


def _known(counts: DataFrame, asked: DataFrame, group: list[str], day: str) -> DataFrame:
    """asked, with __c: the rows of its group that were counted on earlier days; only where there are any."""
    both = counts.withColumn("__asked", F.lit(False)).unionByName(asked.withColumns({"__n": F.lit(0).cast("long"), "__asked": F.lit(True)}), allowMissingColumns=True)
    earlier = Window.partitionBy(*group).orderBy(F.unix_date(day)).rangeBetween(Window.unboundedPreceding, -1)
    return both.withColumn("__c", F.sum("__n").over(earlier)).filter(F.col("__asked") & (F.col("__c") > 0)).drop("__n", "__asked")


def pit_history(days: DataFrame, day: str, df: DataFrame, keys: list[str], ended: str, value: str) -> DataFrame:
    """day, keys, history_calls and p50, p75, p90, p95 of the values of all rows that ended before the day began; for days with any.

    Each key's values are cut once, at quantiles, into BLOCKS blocks in their order. Counts by block and day, summed over the
    days, tell in which block each percentile of a day lies, and how many values in it are less; the counts of that block's
    values tell which value it is. No task holds a key's values, and no day repeats those of earlier days: there are a day's
    blocks, and at most eight blocks' values, to look at. Null values and ends don't count.
    """
    counted = df.filter(F.col(ended).isNotNull() & F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v"), F.to_date(ended).alias(day)).agg(F.count("*").alias("__n"))
    cuts = counted.groupBy(*keys).agg(F.percentile_approx("__v", [i / BLOCKS for i in range(1, BLOCKS)], 100 * BLOCKS).alias("__cuts"))
    placed = _matched(counted, cuts, keys).withColumn("__block", F.size(F.filter("__cuts", lambda c: c < F.col("__v")))).drop("__cuts")

    blocks = placed.groupBy(*keys, "__block", day).agg(F.sum("__n").alias("__n"))
    grid = blocks.select(*keys, "__block").distinct().crossJoin(days.select(day).distinct())
    order = Window.partitionBy(*keys, day)
    by_block = _known(blocks, grid, [*keys, "__block"], day).withColumns({
        "__upto": F.sum("__c").over(order.orderBy("__block").rowsBetween(Window.unboundedPreceding, 0)), "__total": F.sum("__c").over(order)})
    place = lambda p: (F.col("__total") - 1) * F.lit(p / 100)
    asks = [F.struct(F.lit(f"{end}{p}").alias("of"), f(place(p)).cast("long").alias("at")) for p in HISTORY_PERCENTS for end, f in (("low", F.floor), ("high", F.ceil))]
    before = F.col("__upto") - F.col("__c")
    within = lambda a, start: (a["at"] >= start) & (a["at"] < start + F.col("__c"))
    inside = F.transform(F.filter(F.array(*asks), lambda a: within(a, before)), lambda a: F.struct(a["of"].alias("of"), (a["at"] - before).alias("at")))
    hit = by_block.withColumn("__asks", inside).filter(F.size("__asks") > 0).drop("__c", "__upto")

    values = _matched(hit, placed.select(*keys, "__block", "__v").distinct(), [*keys, "__block"])
    upto = F.sum("__c").over(Window.partitionBy(*keys, "__block", day).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    by_value = _known(placed, values, [*keys, "__block", "__v"], day).withColumn("__upto", upto)
    found = by_value.select(day, *keys, "__total", "__v", F.explode(F.filter("__asks", lambda a: within(a, F.col("__upto") - F.col("__c")))["of"]).alias("__of"))
    ends = found.groupBy(day, *keys, "__total").agg(*[F.max(F.when(F.col("__of") == f"{e}{p}", F.col("__v"))).alias(f"__{e}{p}") for p in HISTORY_PERCENTS for e in ("low", "high")])
    low, high = (lambda p: F.col(f"__low{p}")), (lambda p: F.col(f"__high{p}"))
    return ends.select(day, *keys, F.col("__total").alias("history_calls"), *[(low(p) + (high(p) - low(p)) * (place(p) - F.floor(place(p)))).alias(f"p{p}_minutes") for p in HISTORY_PERCENTS])
