"""Versioned tables in the shared folder: what a reader sees changes at once, when the last pointer is written.

A table is a folder with one folder per write, ``data/write=<n>``, and ``pointers``, JSON lines that name for each
version the write that holds each partition. A write adds its own folder first and its pointer last; a reader takes the
newest pointer and the folders it names, so it never meets half a write, and a write that fails leaves no trace but an
unnamed folder. Rewriting a partition (a rerun of a source in a run) replaces that partition alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("version long, key string, write string").json(f"{path}/pointers")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def version(spark: SparkSession, path: str) -> int:
    """The newest version, 0 if there is none."""
    return (_pointers(spark, path).agg(F.max("version")).first()[0] or 0) if _exists(spark, f"{path}/pointers") else 0


def replace(rows: DataFrame, path: str, partition: list[str]) -> int:
    """Make the partitions that rows have consist of these rows; others stay. Returns the new version.

    Partitions are few (a source in a run): their keys, not their rows, come to the manifest.
    """
    spark = rows.sparkSession
    before = version(spark, path)
    write = uuid.uuid4().hex
    key = F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in partition)))
    rows.withColumn("_key", key).write.parquet(f"{path}/data/write={write}")
    mine = spark.read.parquet(f"{path}/data/write={write}").select(F.col("_key").alias("key")).distinct().withColumn("write", F.lit(write))
    kept = mine
    if before:
        old = _pointers(spark, path).where(F.col("version") == before).select("key", "write")
        kept = old.join(mine.select("key"), "key", "left_anti").unionByName(mine)
    kept.select(F.lit(before + 1).alias("version"), "key", "write").coalesce(1).write.mode("append").json(f"{path}/pointers")
    return before + 1


def read(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """The table as of a version, by default the newest."""
    named = _pointers(spark, path).where(F.col("version") == (at if at is not None else version(spark, path)))
    folders = [r["write"] for r in named.select("write").distinct().collect()]  # a folder per write that is still in use
    rows = spark.read.option("basePath", f"{path}/data").parquet(*(f"{path}/data/write={w}" for w in folders))
    return rows.join(named.select(F.col("key").alias("_key"), "write"), ["_key", "write"], "left_semi").drop("_key", "write")


def source_runs(results: DataFrame, path: str) -> int:
    """Upsert results(run, source_id, status, n, pulled_at, error) per run and source, the last row of a key in time of pulling."""
    order = F.struct("pulled_at", "status", "n", "error")
    rest = [c for c in results.columns if c not in ("run", "source_id")]
    last = results.groupBy("run", "source_id").agg(F.max_by(F.struct(*rest), order).alias("r")).select("run", "source_id", "r.*")
    return replace(last, path, ["run", "source_id"])


def last_good(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, last_successful_pull, last_event_count) of each source's newest run that ended well."""
    ok = read(spark, path).where("status = 'ok'")
    return ok.groupBy("source_id").agg(F.max("pulled_at").alias("last_successful_pull"), F.max_by("n", "pulled_at").alias("last_event_count"))
