"""Data-quality checks: each gives the violating rows, with the check's name; none means it holds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a task, where their number is known: hash maps and sorts of a task then stay as they are, however large the input.
TASK_ROWS = 1 << 18


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df, of so many rows, dealt by keys into parts of TASK_ROWS rows or less on average. Grouping by the keys then needs
    neither a map of all keys in each reading task nor more rows in a task as the table grows."""
    return df if rows <= TASK_ROWS else df.repartition(rows // TASK_ROWS + 1, *keys)


def _tagged(df: DataFrame, check: str, key: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check_name"), key.cast("string").alias("violation_key"))


def not_null(df: DataFrame, column: str, key: str) -> DataFrame:
    return _tagged(df.filter(F.col(column).isNull()), f"not_null_{column}", F.col(key))


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    doubled = df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")
    return _tagged(doubled, f"unique_{'_'.join(columns)}", F.concat_ws("|", *columns))


def accepted(df: DataFrame, column: str, values: list[str], key: str) -> DataFrame:
    return _tagged(df.filter(F.col(column).isNotNull() & ~F.col(column).isin(values)), f"accepted_{column}", F.col(key))


def holds(df: DataFrame, rule: str, key: str, name: str) -> DataFrame:
    """Rows for which a condition is false; a null condition doesn't violate."""
    return _tagged(df.filter(~F.expr(rule)), name, F.col(key))


def covers(child: DataFrame, parent: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Keys of parent that child lacks."""
    return _tagged(parent.join(child, keys, "left_anti"), name, F.concat_ws("|", *keys))


def references(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    orphan = child.filter(F.col(column).isNotNull()).join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")
    return _tagged(orphan, f"references_{column}", F.col(column))


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the number of rows of each table."""
    each = [df.agg(F.count("*").alias(name)) for name, df in tables.items()]
    return reduce(DataFrame.crossJoin, each)


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(counts: dict[str, int], at_least: dict[str, int], exactly: dict[str, int] | None = None) -> None:
    """A gate on row counts; raises with all that is wrong."""
    wrong = [f"{k}: {counts[k]} rows, at least {n} expected" for k, n in at_least.items() if counts[k] < n]
    wrong += [f"{k}: {counts[k]}, expected {n}" for k, n in (exactly or {}).items() if counts[k] != n]
    if wrong:
        raise ValueError("; ".join(wrong))
