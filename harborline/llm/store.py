"""Tables cut out of a lineage, in the folder that all executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of our own only where it is unset and Spark runs in one process."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not given:
        given = spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        given = spark.sparkContext.getCheckpointDir()
    return given


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows, read back from Parquet: later steps neither compute them again nor depend on any executor."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/harborline/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Deletes all tables that `written` has made in the session's shared folder. Results that haven't been written
    elsewhere read them, and so do other jobs with the same folder: call it when they are done."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/harborline")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
