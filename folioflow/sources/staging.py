"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where none is set and the session is local, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="folioflow-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The table, written and read back, so that a lost executor costs tasks and not the steps before."""
    path, schema = f"{shared_folder(df.sparkSession)}/tables/{name}-{uuid.uuid4().hex}", df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def spread(df: DataFrame) -> DataFrame:
    """The rows of a few small files, dealt over all cores; other tables as they are.

    A file is read by as many tasks as it has row groups, so a table in fewer files than there are cores and of less than a
    split per core would leave most of them idle in costly per-row work. A large table has splits enough, and isn't shuffled.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not files or len(files) >= cores:
        return df
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    size = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
    split = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores) if size < cores * split else df
