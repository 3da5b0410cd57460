"""Shared storage between steps of a job, and code for its workers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. A temporary one only where everything runs on this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if not known:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        known = context.getCheckpointDir()
    return known


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that every later step sees the same rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/steps/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: sent as an archive, once, unless they start where it lies anyway."""
    package = os.path.dirname(os.path.realpath(__file__))
    root = os.path.dirname(package)
    starts = [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    context = spark.sparkContext
    if root in map(os.path.realpath, starts) or getattr(context, "_rollcall_sent", False):
        return
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="spark-"), "rollcall"), "zip", root, os.path.basename(package))
    context.addPyFile(archive)
    context._rollcall_sent = True
