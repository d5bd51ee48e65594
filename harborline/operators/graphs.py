"""Connected components by contraction; tables that cut long lineages."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of our own only where a local session names none."""
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not given:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        given = context.getCheckpointDir()
    return given.rstrip("/")


def _tables(spark: SparkSession) -> str:
    """A folder for each application, so that cleaning up after one leaves others alone."""
    return f"{shared_folder(spark)}/harborline-operators/{spark.sparkContext.applicationId}"


def cut(df: DataFrame) -> DataFrame:
    """df's rows from a table in the shared folder: nothing is computed again, and Spark knows the table's size, which the
    estimates of a loop's joins would otherwise multiply without end."""
    path = f"{_tables(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Deletes what `cut` has written in this application; results that read it must have been written elsewhere."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_tables(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node that a link (undirected) names: nodes that links join have one root, itself among them.

    In each round a node points to the neighbour of the least hash, if that is less than its own; hashes keep these chains
    short. Chains are shortened to their ends, links then join ends, and equal ones become one. At least half of the nodes
    that have links left are gone after a round, so rounds are few, whatever the shape of the graph.
    """
    pair = lambda x, y: F.struct(F.xxhash64(x).alias("order"), F.col(x).alias("node"), F.xxhash64(y).alias("other_order"), F.col(y).alias("other"))
    both = links.select(F.inline(F.array(pair(a, b), pair(b, a)))).distinct()
    live = cut(both)
    found = cut(live.select("node", F.col("node").alias("root")).distinct())
    live = live.filter(F.col("node") != F.col("other"))
    while not live.isEmpty():
        own, least = F.struct(F.max("order").alias("order"), F.max("node").alias("node")), F.min(F.struct(F.col("other_order").alias("order"), F.col("other").alias("node")))
        points = cut(live.groupBy("node").agg(F.least(own, least)["node"].alias("to")))
        while True:
            ahead = points.select(F.col("node").alias("to"), F.col("to").alias("end"))
            jumped = cut(points.join(ahead, "to").select("node", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")))
            points = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        found = cut(found.join(points.withColumnsRenamed({"node": "root", "to": "end"}), "root", "left").select("node", F.coalesce("end", "root").alias("root")))
        first = live.join(points, "node").select(F.col("to").alias("node"), "other")
        ends = first.join(points.withColumnRenamed("node", "other").withColumnRenamed("to", "end"), "other").select("node", F.col("end").alias("other"))
        live = cut(ends.filter(F.col("node") != F.col("other")).distinct().select(F.xxhash64("node").alias("order"), "node", F.xxhash64("other").alias("other_order"), "other"))
    return found
