"""The raw archive: every record of every run as JSON, partitioned by run and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(records: DataFrame, path: str, run_id: Column, source: str, id_: str, pulled_at: Column) -> None:
    """Add records to the archive; run_id may be a literal or a column, so several runs can be added together."""
    payload = F.to_json(F.struct(*records.columns))
    out = records.select(run_id.alias("run_id"), F.col(source).alias("source_id"), F.col(id_).cast("string").alias("external_id"), pulled_at.alias("pulled_at"), payload.alias("payload"))
    out.write.mode("append").partitionBy("run_id", "source_id").parquet(path)


def scan(spark: SparkSession, path: str, run_id, schema: str) -> DataFrame:
    """One run's records; the run is a partition, so the others are not read."""
    rows = spark.read.parquet(path).where(F.col("run_id") == F.lit(run_id))
    return rows.select("source_id", "external_id", F.from_json("payload", schema).alias("r")).select("source_id", "external_id", "r.*")


def registry(documents: DataFrame, doc: str, schema: str, required: list[str], defaults: dict) -> DataFrame:
    """Registry documents (JSON) as rows: defaults for what is left out, rows without a required field refused."""
    rows = documents.select(F.from_json(doc, schema).alias("r")).select("r.*")
    return rows.na.drop("any", subset=required).na.fill(defaults)
