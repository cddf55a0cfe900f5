"""Intermediate tables in the shared folder that the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[tempfile.TemporaryDirectory] = []


def scratch_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only in local mode where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    if not _local:
        _local.append(tempfile.TemporaryDirectory(prefix="millrace-"))
    return _local[0].name


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and read them back, so that lost executors cost no recomputation
    and later reads see the same rows in the same partitions."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a scan to all cores when it has fewer partitions than there are cores.

    For costly work per row on a small or unsplittable file; a scan that is large enough is left
    as it is. Not for plans with a shuffle or for streams.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
