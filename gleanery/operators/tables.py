"""Tables in the shared folder, and cutting lineage between the rounds of an iteration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset, one beside the warehouse."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints")
    return context.getCheckpointDir().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df from a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
