"""Where jobs keep tables between two steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder of ``spark.checkpoint.dir``.

    A session without that setting keeps it beside its tables, in the warehouse, which driver and
    executors share as well. The folder goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to a new folder and read from there."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
