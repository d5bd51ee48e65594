"""Neighbours in key order without one global window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from harborline.llm import native
from harborline.llm.store import written

SEGMENTS = 64


def _segment(key: Column, bounds: list, low: int = 0) -> Column:
    """Number of bounds <= key, by comparisons in a balanced tree."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key < F.lit(bounds[mid]), _segment(key, bounds[:mid], low)).otherwise(_segment(key, bounds[mid + 1 :], low + mid + 1))


def range_bucket(df: DataFrame, key: str, buckets: int) -> Column:
    """A bucket number that rises with a numeric key: quantile segments (their bounds are the only rows collected), each
    cut into equal steps. A null key is in bucket 0; keys that aren't numbers are an error."""
    if not isinstance(df.schema[key].dataType, NumericType):
        raise ValueError(f"{key}: only numeric keys have ranges")
    steps = max(1, -(-buckets // SEGMENTS))
    points = [i / SEGMENTS for i in range(SEGMENTS + 1)]
    found = df.agg(F.percentile_approx(key, points, 1000).alias("q")).first()["q"]
    if not found:
        return F.lit(0)
    edges = sorted(set(found))
    segment = _segment(F.col(key), edges[1:-1])
    starts = F.array(*[F.lit(x) for x in edges])
    low, high = F.get(starts, segment), F.get(starts, segment + 1)
    step = F.floor((F.col(key) - low) / F.greatest(high - low, F.lit(1)) * steps)
    inner = F.least(F.greatest(step, F.lit(0)), F.lit(steps - 1))
    return F.when(F.col(key).isNull(), 0).otherwise(segment * steps + inner).cast("int")


def with_next(df: DataFrame, key: str, buckets: int) -> tuple[DataFrame, str, str]:
    """df's rows with a bucket column, and with each bucket's successor: the first rows of the next bucket with rows come
    once more, marked as guests, behind the last row of a bucket; behind the last bucket come the first one's.

    Returns the rows and the names of the bucket and guest columns. A window over the bucket, ordered by guest and key,
    then sees every row's neighbour.
    """
    bucket, guest = native.name(df, "__bucket"), native.name(df, "__guest")
    placed = df.withColumn(bucket, range_bucket(df, key, buckets))
    firsts = placed.groupBy(F.col(bucket).alias("of")).agg(F.min(key).alias("low"), F.count(F.when(F.col(key).isNull(), 1)).alias("nulls"))
    order = Window.orderBy("of")  # a row for each bucket
    host = F.coalesce(F.lag("of").over(order), F.max("of").over(Window.partitionBy()))
    hosts = firsts.select(F.when(F.col("nulls") == 0, F.col("low")).alias("__low"), host.alias("__host"))
    hosts = written(hosts, "bucket-hosts")  # its size tells whether rows must be shuffled to meet it
    guests = placed.join(hosts, F.col(key).eqNullSafe(F.col("__low"))).drop(bucket, "__low").withColumnRenamed("__host", bucket)
    return placed.withColumn(guest, F.lit(False)).unionByName(guests.withColumn(guest, F.lit(True))), bucket, guest
