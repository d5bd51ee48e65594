"""Upserts of keyed tables as full rewrites: old and new rows in, the merged table out."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _both(old: DataFrame, new: DataFrame, keys: list[str], pick) -> DataFrame:
    left = old.withColumn("__in_old", F.lit(True)).alias("o")
    right = new.select(*old.columns).withColumn("__in_new", F.lit(True)).alias("n")
    joined = left.join(right, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    out = [F.coalesce(F.col(f"n.{k}"), F.col(f"o.{k}")).alias(k) if k in keys else pick(k).alias(k) for k in old.columns]
    return joined.select(*out)


def upsert_coalesce(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A new value that isn't null wins; else the old one stays."""
    return _both(old, new, keys, lambda c: F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")))


def upsert_overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """A new row replaces the old one, nulls too."""
    return _both(old, new, keys, lambda c: F.when(F.col("n.__in_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")))


def upsert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows with new keys are added."""
    return old.unionByName(new.select(*old.columns).join(old.select(*keys), keys, "left_anti"))


def upsert_where(old: DataFrame, new: DataFrame, keys: list[str], keep_old: Column) -> DataFrame:
    """A new row replaces the old one, unless keep_old (over columns o.*) holds."""
    kept = F.col("o.__in_old") & F.coalesce(keep_old, F.lit(False))
    return _both(old, new, keys, lambda c: F.when(F.col("n.__in_new") & ~F.coalesce(kept, F.lit(False)), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")))


def replace_columns(old: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """old, with the other columns of changes in place where the key matches."""
    names = [c for c in changes.columns if c not in keys]
    right = changes.select(*keys, *[F.col(c).alias(f"__{c}") for c in names], F.lit(True).alias("__hit"))
    joined = old.join(right, keys, "left")
    return joined.select(*[F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c) for c in old.columns])
