"""One row per key, surrogate numbers, top rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; the order should leave no ties."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter("__rank = 1").drop("__rank")


def best_record(df: DataFrame, keys: list[str], wanted: list[str], newest: str) -> DataFrame:
    """Of each key the row that has the wanted columns (earlier ones count more), then the newest."""
    return first_per_key(df, keys, [*[F.col(c).isNotNull().desc() for c in wanted], F.col(newest).desc_nulls_last()])


def numbered(df: DataFrame, order: list[Column], out: str, cell: Column | None = None) -> DataFrame:
    """A surrogate number over all rows. With a cell that rises with the order (such as the day of a time), rows are numbered
    within cells, and only the counts of cells go through one window; without one, all rows do."""
    if cell is None:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("long"))
    placed = df.withColumn("__cell", cell)
    before = F.sum("n").over(Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = placed.groupBy("__cell").agg(F.count("*").alias("n")).select(F.col("__cell").alias("__of"), F.coalesce(before, F.lit(0)).alias("__before"))
    number = F.col("__before") + F.row_number().over(Window.partitionBy("__cell").orderBy(*order))
    return placed.join(starts, F.col("__cell").eqNullSafe(F.col("__of"))).withColumn(out, number.cast("long")).drop("__cell", "__of", "__before")


def ranked(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top(df: DataFrame, order: list[Column], n: int, low: int = 1, high: int = 100) -> DataFrame:
    """The first n rows; n outside the allowed range is an error, as for the endpoints that use it."""
    if not low <= n <= high:
        raise ValueError(f"limit must be between {low} and {high}")
    return df.orderBy(*order).limit(n)


def unpivoted(df: DataFrame, keys: list[str], rows: list[dict[str, Column]], keep: str) -> DataFrame:
    """For each row of df the given rows (columns by name), of which those stay for which `keep` holds."""
    each = F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows])
    return df.select(*keys, F.inline(each)).filter(keep)
