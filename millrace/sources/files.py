"""Batch file scans."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")


def read_files(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Scan csv (with a header), json or parquet. A given schema saves the inference pass over
    text files."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":  # strings of any length
        reader = reader.option("maxStringLen", 2**31 - 1)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", True)
    return reader.format(fmt).load(path)


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_document(spark: SparkSession, path: str, document: dict) -> None:
    """A small JSON document as a folder of one text file; an existing one is not replaced."""
    spark.createDataFrame([(json.dumps(document, default=float),)], "value string").coalesce(1).write.text(path)


def read_document(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def merge_sources(sources: Mapping[str, DataFrame], name: str = "source") -> DataFrame:
    """Union by column name over several sources, NULL where one lacks a column, with the
    source's key in `name`."""
    tagged = [df.withColumn(name, F.lit(key)) for key, df in sources.items()]
    merged = tagged[0]
    for df in tagged[1:]:
        merged = merged.unionByName(df, allowMissingColumns=True)
    return merged


def read_resources(spark: SparkSession, path: str, column: str = "value") -> DataFrame:
    """One JSON resource per line."""
    return spark.read.text(path).select(F.col("value").alias(column))
