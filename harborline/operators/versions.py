"""Tables in versions: writers that may run at once, of whom one wins each version."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_if_absent(spark: SparkSession, path: str, content: str) -> bool:
    """Makes a small file in one step; False if there is one of that name, whose content then stays.

    The content is written aside and then moved (linked, in a local folder) to its name, which fails where the name is
    taken; so no reader sees a part of it, and of several writers one succeeds.
    """
    jvm, target, fs = _hadoop(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(content.encode())
    out.close()
    try:
        if fs.getUri().getScheme() == "file":
            local = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(local(target), local(aside))
        else:
            options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri()).rename(aside, target, options)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()):
            return False
        raise
    finally:
        fs.delete(aside, False)
    return True


def latest(spark: SparkSession, folder: str) -> int:
    """The number of the last version; 0 if there is none."""
    jvm, where, fs = _hadoop(spark, f"{folder}/versions")
    if not fs.exists(where):
        return 0
    return max((int(f.getPath().getName()) for f in fs.listStatus(where) if not f.getPath().getName().startswith(".")), default=0)


def read(spark: SparkSession, folder: str, version: int) -> DataFrame:
    _, where, fs = _hadoop(spark, f"{folder}/versions/{version:010d}")
    file = fs.open(where)
    name = bytes(file.readAllBytes()).decode()
    file.close()
    return spark.read.parquet(f"{folder}/{name}")


def publish(df: DataFrame, folder: str, version: int) -> bool:
    """Writes df as this version of the table; False, and nothing is changed, if another writer has made it meanwhile."""
    spark = df.sparkSession
    _, where, fs = _hadoop(spark, f"{folder}/versions")
    fs.mkdirs(where)
    name = f"data-{version:010d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}")
    if put_if_absent(spark, f"{folder}/versions/{version:010d}", name):
        return True
    _, made, fs = _hadoop(spark, f"{folder}/{name}")
    fs.delete(made, True)
    return False
