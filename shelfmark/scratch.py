"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """The folder that all executors share.  Where none is set, one of this process's own, as in tests on one machine; an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfmark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found


def stash(df: DataFrame, name: str, *partition: str) -> DataFrame:
    """Writes a table to the shared folder, by partitions if asked for, and reads it again, so a lost executor costs no more than this step."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/shelfmark/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition) if partition else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
