"""Vessel enrichment: classification, the work queue, and what lookups change. Time is a parameter, lookups are a function."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions import text
from harborline.functions.numbers import first_match
from harborline.operators import merge, versions
from harborline.operators.rank import best_record

#: Subtypes that are known not to be LNG, and what cargo texts say of LNG ships.
NON_LNG_SUBTYPES = ("LPG", "CRUDE OIL", "OIL", "CHEMICAL", "PRODUCT", "PETROLEUM PRODUCT")
LNG_CARGO = ("lng vessel", "liquefied natural gas")
QUEUE = "lookup_key string, imo bigint, mmsi bigint, vessel_name string, queue_status string, attempt_count int, last_attempt_at timestamp, next_attempt_at timestamp, last_error string, created_at timestamp"
LOOKUP = "lookup_key string, found boolean, failed string, identification string, registry_vessel_name string, service_type string, service_sub_type string, cargo_description string, flag string, status string"
ERROR_CHARS = 2000


def classify(service_type: Column, sub_type: Column, cargo: Column) -> Column:
    """struct<vessel_type, classification_status>; only explicit evidence confirms."""
    kind, sub = text.blank_to_null(service_type), text.blank_to_null(sub_type)
    upper, low = F.upper(sub), F.lower(F.coalesce(cargo, F.lit("")))
    lng = F.coalesce(upper == "LNG", F.lit(False)) | low.contains(LNG_CARGO[0]) | low.contains(LNG_CARGO[1])
    status = first_match([(lng, "confirmed_lng"), (upper.isin(*NON_LNG_SUBTYPES), "confirmed_non_lng"), (sub.isNotNull() | kind.isNotNull(), "needs_review")], "unknown")
    named = F.when(lng, "LNG carrier").when(upper == "LPG", "LPG carrier").when(sub.isNotNull(), sub_type).otherwise(kind)
    return F.struct(named.alias("vessel_type"), status.alias("classification_status"))


def enqueue(queue: DataFrame, calls: DataFrame, registry: DataFrame, now: Column) -> DataFrame:
    """The queue with the ships of calls that the registry lacks. A known row gets the latest call's names, no error and
    no waiting time, and starts anew as pending unless it is under way; its attempts stay."""
    latest = best_record(calls.filter("imo is not null").select("imo", "mmsi", "vessel_name", "arrival_time"), ["imo"], [], "arrival_time")
    unseen = latest.join(registry.select("imo"), "imo", "left_anti")
    new = unseen.select(F.concat(F.lit("imo:"), F.col("imo").cast("string")).alias("lookup_key"), *[F.col(c).alias(f"new_{c}") for c in ("imo", "mmsi", "vessel_name")])
    joined = queue.withColumn("__old", F.lit(True)).join(new, "lookup_key", "full_outer")
    hit, old = F.col("new_imo").isNotNull(), F.col("__old").isNotNull()
    under_way = F.coalesce(F.col("queue_status") == "processing", F.lit(False))
    out = {
        "queue_status": F.when(hit & ~under_way, "pending").otherwise(F.col("queue_status")), "attempt_count": F.coalesce("attempt_count", F.lit(0)),
        "created_at": F.when(old, F.col("created_at")).otherwise(now.cast("timestamp"))}
    out |= {c: F.when(hit, F.col(f"new_{c}")).otherwise(F.col(c)) for c in ("imo", "mmsi", "vessel_name")}
    out |= {c: F.when(~hit, F.col(c)) for c in ("next_attempt_at", "last_error")}
    return joined.withColumns(out).select(queue.columns)


def due(queue: DataFrame, now: Column) -> DataFrame:
    return queue.filter((F.col("queue_status") == "pending") | ((F.col("queue_status") == "failed") & (F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= now))))


def claim(queue: DataFrame, now: Column, limit: int) -> tuple[DataFrame, DataFrame]:
    """The first rows that are due, and the queue with them marked as under way; for one writer. `claim_shared` is for several."""
    taken = due(queue, now).orderBy("created_at", "lookup_key").limit(limit)
    marks = taken.select("lookup_key", F.lit("processing").alias("queue_status"), (F.col("attempt_count") + 1).alias("attempt_count"), now.cast("timestamp").alias("last_attempt_at"))
    return taken, merge.replace_columns(queue, marks, ["lookup_key"])


def claim_shared(spark: SparkSession, folder: str, now: Column, limit: int, tries: int = 20) -> DataFrame:
    """The first rows of the queue in a folder of versions that are due, marked there as under way.

    Each try reads the last version, marks rows and publishes the next one. Where another job has published it meanwhile, what
    was taken is given up and taken anew from the version that won, so no two jobs hold the same row.
    """
    for _ in range(tries):
        version = versions.latest(spark, folder)
        queue = versions.read(spark, folder, version)
        keys = [r["lookup_key"] for r in due(queue, now).orderBy("created_at", "lookup_key").select("lookup_key").limit(limit).collect()]  # at most `limit`
        taken = F.col("lookup_key").isin(keys) if keys else F.lit(False)
        marks = {"queue_status": F.lit("processing"), "attempt_count": F.col("attempt_count") + 1, "last_attempt_at": now.cast("timestamp")}
        marked = queue.withColumns({c: F.when(taken, v).otherwise(F.col(c)) for c, v in marks.items()})
        if not keys or versions.publish(marked, folder, version + 1):
            return queue.filter(taken)
    raise TimeoutError(f"{tries} other claims came first")


def settle_shared(spark: SparkSession, folder: str, change: Callable[[DataFrame], DataFrame], tries: int = 20) -> None:
    """Replaces the queue by change(queue), of the version that is the last when it is published."""
    for _ in range(tries):
        version = versions.latest(spark, folder)
        if versions.publish(change(versions.read(spark, folder, version)), folder, version + 1):
            return
    raise TimeoutError(f"{tries} other changes came first")


def looked_up(claimed: DataFrame, provider: Callable[[int], dict | None]) -> DataFrame:
    """provider(imo) for each claimed row with a number: a record, None, or an exception, whose text is kept."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ("identification", "registry_vessel_name", "service_type", "service_sub_type", "cargo_description", "flag", "status")
        for frame in frames:
            rows = []
            for key, imo in zip(frame["lookup_key"], frame["imo"], strict=True):
                row = {"lookup_key": key, "found": False, "failed": None} | dict.fromkeys(names)
                try:
                    if record := provider(int(imo)):
                        row |= {"found": True} | {n: record.get(n) for n in names}
                except Exception as error:  # noqa: BLE001 any failure of a lookup is a result of that lookup
                    row["failed"] = str(error)[:ERROR_CHARS] or type(error).__name__
                rows.append(row)
            yield pd.DataFrame(rows, columns=["lookup_key", "found", "failed", *names])

    return claimed.filter("imo is not null").select("lookup_key", "imo").mapInPandas(run, LOOKUP)


def applied(queue: DataFrame, claimed: DataFrame, results: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """The queue after lookups, and registry rows (imo, mmsi, names, types, status) of those that gave one.

    No number, no record, or a record of another ship: review. A failed lookup: again in an hour. A sure class: completed.
    """
    joined = claimed.select("lookup_key", "imo", "mmsi", "vessel_name").join(results, "lookup_key", "left")
    kind = classify(F.col("service_type"), F.col("service_sub_type"), F.col("cargo_description"))
    own = F.coalesce(text.digits(F.col("identification")) == F.col("imo").cast("string"), F.lit(False))
    rows = joined.withColumns({"kind": kind, "usable": F.coalesce(F.col("found"), F.lit(False)) & own})
    sure = F.col("kind.classification_status").isin("confirmed_lng", "confirmed_non_lng")
    status = first_match([
        (F.col("imo").isNull(), "needs_review"), (F.col("failed").isNotNull(), "failed"), (~F.col("usable"), "needs_review"), (sure, "completed")], "needs_review")
    reason = first_match([(F.col("imo").isNull(), "no imo"), (F.coalesce(F.col("found"), F.lit(False)) == F.lit(False), "not found"), (~F.col("usable"), "identification differs")])
    changes = rows.select(
        "lookup_key", status.alias("queue_status"), F.when(F.col("failed").isNotNull(), now.cast("timestamp") + F.expr("interval 1 hour")).alias("next_attempt_at"),
        F.coalesce("failed", reason).alias("last_error"))
    found = rows.filter("usable").select(
        "imo", "mmsi", F.col("vessel_name").alias("ais_vessel_name"), "registry_vessel_name", "service_type", "service_sub_type", "cargo_description", "flag", "status", "kind.vessel_type", "kind.classification_status")
    return merge.replace_columns(queue, changes, ["lookup_key"]), found


def skip_reasons(results: DataFrame) -> DataFrame:
    """Offline lookup results (imo, found, error, identification) with skip_reason; null where the row can be loaded."""
    reason = first_match([
        (F.col("imo").isNull(), "no imo"), (text.blank_to_null(F.col("error")).isNotNull(), "error"), (~text.truthy(F.col("found").cast("string")), "not found"),
        (~F.coalesce(text.digits(F.col("identification")) == text.digits(F.col("imo").cast("string")), F.lit(False)), "identification differs")])
    return results.withColumn("skip_reason", reason)


def status_counts(df: DataFrame, column: str = "queue_status") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)
