r"""Mixing sources to target weights by weighted fair queueing.

Each source serves its documents in a shuffled order (md5 of seed and doc_id), round after round, `rounds` times at most.
A copy's virtual finish time is the source's words served up to it, divided by the source's weight; of the copy itself
half is counted, so that it stands where its middle word is served. The copies of all sources are sorted by it into
ranges, which are then sorted on their own; running sums of words over ranges and within them give each copy's place in
the queue, which is truncated at the budget, the size of all documents: the last copy stays if at least half of it lies
before the budget. So a source's share is off its target by half a document at most, and by what the last copy leaves.
When a source has served all rounds, the others go on, which reshares its excess by weight.

Sums have two levels: a source's shuffled order is cut into about sqrt(rows) cells, virtual time into about as many
ranges, so a source with a third of all rows is no hot window. The queue is made of row numbers, sources and sizes, which
are read from the texts once; only the copies that are taken are joined with their texts and sorted.

The level of virtual time at which the budget is used up, sum(least(weight * level, rounds * size)) = budget, follows from
the sources' sizes: it gives the targets, and copies beyond it by more than the largest document aren't made, as the queue
is truncated before them.

Sources go by code point, null last, and weigh 1, 2, 3 and so on again. A null or empty text has size 0, takes nothing and
stays once. Rows with equal doc_ids are separate rows; of those with one size and source it isn't defined which is served
first. Without rows, or words, nothing is taken. Extra columns are carried along, whatever their names. The table of
sources is metadata and goes through one window; documents don't.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harborline.llm import native
from harborline.llm.store import written

WEIGHTS, ROUNDS, SEED = (1, 2, 3), 3, "mix-1"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, rounds: int = ROUNDS) -> DataFrame:
    """(source, source_size) with weight, target and level, the virtual time at which the budget is used up."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("weight", F.element_at(F.lit(list(weights)).cast("array<bigint>"), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    capped = weighed.withColumns({"cap": F.lit(rounds) * F.col("source_size"), "ratio": F.lit(rounds) * F.col("source_size") / F.col("weight")})
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    levels = capped.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest))
    # sources below the level are served in full; the first above it tells the level
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_size", "level"))).over(whole)["level"]
    return levels.withColumn("v", F.coalesce(level, F.lit(0.0))).select(
        "source", "source_size", "weight", F.least(F.col("weight") * F.col("v"), F.col("cap").cast("double")).alias("target"), F.col("v").alias("level"))


def _running(rows: DataFrame, keys: list[str], cell: str, order: list, size: str, out: str) -> DataFrame:
    """rows with `out`, the sum of `size` up to each row by (cell, order) within keys: sums of cells, then within a cell."""
    parts = rows.groupBy(*keys, cell).agg(F.sum(size).alias("part"))  # without keys, as many rows as cells in one window
    along = Window.partitionBy(*keys).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*keys, cell, F.coalesce(F.sum("part").over(along), F.lit(0)).alias("start"))
    within = Window.partitionBy(*keys, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(starts, [*keys, cell]).withColumn(out, F.col("start") + F.sum(size).over(within)).drop("start")


def queue(docs: DataFrame, row: str, *, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = WEIGHTS, rounds: int = ROUNDS, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """Two tables that know docs' rows by the number in the column `row`.

    plan: row, key, source, size, source_size, weight, target, copies; for each row.
    taken: row, round, virtual_finish, queue_end; for each copy that the mix takes. Rows without words have none.
    """
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null"))).cast("binary"))
    named = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))
    rows = written(docs.select(F.col(row).alias("row"), F.col(key).alias("key"), F.col(source).alias("source"), named.alias("of"), place.alias("place"), native.n_words(native.whole(text)).alias("size")), "mix-sizes")
    count, budget, largest = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("size"), F.lit(0))).first()
    cells = max(1, math.isqrt(count))
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, rounds)
    aims = written(aims.withColumn("of", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))).drop("source"), "mix-targets")
    hashed = F.conv(F.substring("place", 1, 8), 16, 10).cast("long")
    shuffled = rows.filter("size > 0").select("row", "of", "place", "size", F.floor(hashed * cells / (1 << 32)).cast("int").alias("cell"))
    served = _running(shuffled, ["of"], "cell", ["place", "size", "row"], "size", "served").join(aims, "of")
    copies = served.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    middle = (2 * ((F.col("round") - 1) * F.col("source_size") + F.col("served")) - F.col("size")) / (2 * F.col("weight"))
    copies = copies.withColumn("virtual_finish", middle).filter(F.col("virtual_finish") <= F.col("level") + largest + 1)
    ranges = F.floor(F.col("virtual_finish") / F.greatest("level", F.lit(1.0)) * cells).cast("long")
    copies = copies.select("row", "of", "place", "size", "round", "virtual_finish", ranges.alias("range"))
    queued = _running(copies, [], "range", ["virtual_finish", "of", "place", "size", "round", "row"], "size", "queue_end")
    taken = written(queued.filter(2 * F.col("queue_end") - F.col("size") <= 2 * budget).select("row", "round", "virtual_finish", "queue_end"), "mix-taken")
    often = taken.groupBy("row").agg(F.count("*").cast("int").alias("copies"))
    plan = rows.join(aims, "of").join(often, "row", "left").withColumn("copies", F.coalesce("copies", F.when(F.col("size") == 0, 1).otherwise(0)))
    return plan.select("row", "key", "source", "size", "source_size", "weight", "target", "copies"), taken


def schedule(docs: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """A row for each row of docs: key, source, size, source_size, weight, target, copies (taken as often)."""
    row = native.name(docs, "__row")
    plan, _ = queue(docs.withColumn(row, F.monotonically_increasing_id()), row, key=key, **options)
    return plan.select(F.col("key").alias(key), "source", "size", "source_size", "weight", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The copies that the mix takes, sorted by virtual finish time: docs' columns, round and virtual_finish (with
    underscores in front where docs have such columns). Rows without words come first, in round 1 at time 0."""
    row, round_, finish = (native.name(docs, x) for x in ("__row", "round", "virtual_finish"))
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")  # so that numbers don't change
    plan, taken = queue(numbered, row, **options)
    empty = plan.filter("size = 0").select("row", F.lit(1).alias("round"), F.lit(0.0).alias("virtual_finish"))
    copies = taken.select("row", "round", "virtual_finish").unionByName(empty).toDF(row, round_, finish)
    copies = written(copies, "mix-copies")  # its size tells whether texts must be shuffled to meet it
    return numbered.join(copies, row).select(*docs.columns, round_, finish).orderBy(finish)


def digest(planned: DataFrame) -> DataFrame:
    return planned.select(F.col("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5('mix-1:' || coalesce(doc_id::varchar, 'null')) as place, coalesce('s' || source, 'n') as named, row_number() over () as n
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight from s),
r as (select *, 3 * source_size as cap, (3 * source_size)::double / weight as ratio from w),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0))::double
             / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as level from r),
v as (select coalesce(min(level) filter (where level <= ratio and ratio = (select min(ratio) from l where level <= ratio)), 0.0) as v from l),
t as (select l.source, source_size, weight, least(weight * v.v, cap::double) as target from l, v),
c as (select d.*, t.source_size, t.weight, t.target,
             sum(size) over (partition by d.source order by place, size, n rows unbounded preceding)::bigint as served
      from d join t on d.source is not distinct from t.source),
q as (select n, named, place, size, k, (2 * ((k - 1) * source_size + served) - size)::double / (2 * weight) as finish
      from c, (select unnest([1, 2, 3]) as k) where size > 0),
z as (select n, size, sum(size) over (order by finish, named, place, size, k, n rows unbounded preceding) as queue_end from q),
x as (select n, count(*) as copies from z where 2 * queue_end - size <= 2 * (select sum(size) from d) group by n)
select doc_id, size, source_size, target, (size * coalesce(copies, 0))::bigint as taken
from c left join x using (n)"""
