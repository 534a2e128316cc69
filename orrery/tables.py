"""Intermediate tables that several operators of one plan read: written to the folder that executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local session gets a new local one, set from then on; with
    any other master that is an error, as its executors would not share a local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            return found.get().rstrip("/")
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        path = tempfile.mkdtemp(prefix="orrery-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as Parquet in the shared folder, read back: its lineage ends there and lost executors don't repeat it."""
    path = f"{shared_folder(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, key: str, tag: str, parts: int | None = None) -> DataFrame:
    """df written in buckets of ``key``: aggregates, windows, grouped kernels and joins by the key that read it later
    need no exchange of their own, however many of them there are."""
    spark, name = df.sparkSession, f"{tag}_{uuid.uuid4().hex}"
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{shared_folder(spark)}/{name}"
    df.repartition(parts, key).write.bucketBy(parts, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def spread(df: DataFrame, *keys: str, times: int = 1) -> DataFrame:
    """df dealt by keys to as many tasks as the session's exchanges have, or ``times`` as many. Where a grouped kernel works
    long on few bytes, the number of tasks must not follow the bytes, as adaptive execution would have it."""
    return df.repartition(times * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
