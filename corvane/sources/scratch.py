"""Intermediate tables: written once to the folder that all executors share, and read again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def application_folder(spark: SparkSession) -> str:
    """This application's folder under spark.checkpoint.dir, or under a local one where that is unset and the master is local, as in tests;
    on a cluster a local folder would be unreadable elsewhere, so that is an error. It is deleted when the driver's JVM ends."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not spark.conf.get("spark.checkpoint.dir", None) and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="corvane-"))
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or context.getCheckpointDir()}/{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(context._jsc.hadoopConfiguration())
    if not store.exists(path):
        store.mkdirs(path)
        store.deleteOnExit(path)
    return folder


def scratch_folder(spark: SparkSession, name: str) -> str:
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows as a Parquet table in the scratch folder.

    What several branches of a plan read is computed once, survives the loss of executors, and has known sizes for the planner.
    """
    path = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)
