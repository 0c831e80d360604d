"""Tables written to the session's shared folder in the middle of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the session (spark.checkpoint.dir). Only where none is set and the session is local, as in
    tests, a local one is made."""
    root = spark.conf.get("spark.checkpoint.dir", None) or getattr(spark, "_scratch", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        root = spark._scratch = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df and reads it again: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
