"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as ``spark.checkpoint.dir`` names it.

    A local session without the setting gets a temporary folder; a cluster without it is an error.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tradeloom-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark, path = frame.sparkSession, new_folder(frame.sparkSession, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
