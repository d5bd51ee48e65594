"""One run over all stages: feed → vessels and positions → calls → lookups → gates → models → exports.

Each run writes its tables to a folder of its own and reads the last run's from theirs, so a run that is lost halfway
harms nothing and is simply repeated.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.functions import text
from harborline.operators import merge
from harborline.plans import calls, enrichment, gates, terminal
from harborline.plans.config import DEFAULT, Config
from harborline.sources import files, positions

REGISTRY = "imo bigint, mmsi bigint, ais_vessel_name string, registry_vessel_name string, service_type string, service_sub_type string, cargo_description string, flag string, status string, vessel_type string, classification_status string"
EXPORTS = ("call_analytics", "berth_performance", "terminal_daily_metrics", "risk_score_daily", "risk_explanations_daily")


def run(
        spark: SparkSession, raw_csv: str, folder: str, *, zones: DataFrame, terminals: DataFrame, outages: DataFrame, previous: str | None = None,
        provider: Callable[[int], dict | None] | None = None, limit: int = 50, config: Config = DEFAULT) -> dict[str, DataFrame]:
    """All tables and models by name, written below folder, and the published five as CSV files in its exports.

    previous is the last run's folder; without a provider no ship is looked up. Raises where a gate fails.
    """
    out: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.parquet(path)
        return out[name]

    def last(name: str, empty: DataFrame) -> DataFrame:
        return spark.read.parquet(f"{previous}/{name}") if previous else empty

    silver = spark.read.parquet(positions.ingest(spark, raw_csv, f"{folder}/silver"))
    positions.validate(silver)
    typed = silver.withColumn("imo", text.extract_imo(F.col("imo"))).limit(0)
    vessels, seen = positions.load(silver, last("vessels", typed.select(*positions.VESSEL)), last("positions", typed.select(*positions.POSITION)))
    vessels, seen = put("vessels", vessels), put("positions", seen)

    found = put("port_calls", calls.port_calls(calls.terminal_hits(seen, terminals), config))
    probable = put("probable_calls", calls.probable_calls(found, vessels, terminals, calls.bounds(seen, "recorded_at", "recorded_at"), config))
    validated = put("validated_calls", calls.validated_calls(probable, outages, config))

    now = F.lit(spark.range(1).select(F.current_timestamp()).first()[0])
    registry = last("vessel_registry", spark.createDataFrame([], REGISTRY))
    queue = put("queue_before_lookups", enrichment.enqueue(last("queue", spark.createDataFrame([], enrichment.QUEUE)), validated, registry, now))
    if provider:
        taken, queue = enrichment.claim(queue, now, limit)
        taken = put("claimed", taken)
        results = put("lookup_results", enrichment.looked_up(taken, provider))
        queue, new = enrichment.applied(queue, taken, results, now)
        registry = merge.upsert_overwrite(registry, new, ["imo"])
    registry, queue = put("vessel_registry", registry), put("queue", queue)
    gates.load_gate(seen, queue)

    confirmed = put("confirmed_calls", calls.confirmed_calls(validated, registry))
    models = terminal.build(seen, zones, confirmed, config, keep=put)
    gates.final_gate(models)
    files.export_csv({name: (models[name], gates.KEYS[name]) for name in EXPORTS}, f"{folder}/exports")
    return out
