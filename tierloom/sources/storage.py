"""Cutting lineage through the shared folder the cluster names.

Tables written here belong to one run of one driver. Its folder goes when the
driver ends (a hook of the file system), or earlier when the owner calls
``release`` after storing the results that read from it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def checkpoint_root(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``, else the session's warehouse folder.

    The warehouse of a cluster must not be a machine's own disk: executors
    would not see each other's files there, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    one_machine = spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")
    if not warehouse or not one_machine and file_system(spark, warehouse)[0].getUri().getScheme() == "file":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return warehouse.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This driver's own folder below the shared one."""
    return f"{checkpoint_root(spark)}/tierloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in this run's folder."""
    folder = run_folder(spark)
    files, place = file_system(spark, folder)
    if files.mkdirs(place):
        files.deleteOnExit(place)
    return f"{folder}/{uuid.uuid4().hex}"


def release(spark: SparkSession, path: str | None = None) -> None:
    """Remove one table of this run, or by default all of them."""
    files, place = file_system(spark, path or run_folder(spark))
    files.delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from the written table.

    Later passes read only the columns they need, and rows keep the values
    they were written with even if executors are lost.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
