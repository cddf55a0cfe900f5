"""Batch sinks: lake tables, dead letters, topics, warehouse, object store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

MODES = {"append": "append", "replace": "overwrite"}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Append to or overwrite a table; `fmt="delta"` where the Delta connector is installed."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"Unknown write mode: {mode}")
    writer = df.write.format(fmt).mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_dead_letters(letters: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_table(letters, path, "append", fmt)


def publish_options(brokers: str) -> dict[str, str]:
    """Producer settings: all replicas acknowledge, three retries, gzip."""
    return {
        "kafka.bootstrap.servers": brokers,
        "kafka.acks": "all",
        "kafka.retries": "3",
        "kafka.retry.backoff.ms": "500",
        "kafka.request.timeout.ms": "30000",
        "kafka.compression.type": "gzip",
    }


UNROUTED = "dead-letter"


def publish(messages: DataFrame, brokers: str, unrouted: str = UNROUTED) -> None:
    """Send (key, value, topic) rows to Kafka; needs the Kafka connector.

    Rows without a topic, events of unknown type, go to the topic `unrouted` in the same pass.
    """
    routed = messages.fillna(unrouted, ["topic"]).selectExpr(
        "CAST(key AS BINARY) AS key", "CAST(value AS BINARY) AS value", "topic"
    )
    routed.write.format("kafka").options(**publish_options(brokers)).save()


def publish_files(
    messages: DataFrame, path: str, fmt: str = "parquet", mode: str = "append", unrouted: str = UNROUTED
) -> None:
    """The same rows as files, one folder per topic."""
    write_table(messages.fillna(unrouted, ["topic"]), path, mode, fmt, ["topic"])


def warehouse_url(server: str, database: str, port: int = 1433) -> str:
    return (
        f"jdbc:sqlserver://{server}:{port};database={database};encrypt=true;"
        "trustServerCertificate=false;authentication=ActiveDirectoryServicePrincipal"
    )


def load_warehouse(
    df: DataFrame,
    url: str,
    table: str,
    schema: str = "dbo",
    if_exists: str = "append",
    batch_rows: int = 1000,
    partitions: int = 16,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Write rows over JDBC from the executors, at most `partitions` connections at a time."""
    if if_exists not in MODES:
        raise ValueError(f"Unknown if_exists: {if_exists}")
    options = {"batchsize": str(batch_rows), "numPartitions": str(partitions), **(properties or {})}
    df.write.jdbc(url, f"{schema}.{table}", MODES[if_exists], options)


def object_uri(account: str, container: str, path: str) -> str:
    return f"abfss://{container}@{account}.dfs.core.windows.net/{path.lstrip('/')}"


def object_url(account: str, container: str, path: str) -> str:
    return f"https://{account}.dfs.core.windows.net/{container}/{path.lstrip('/')}"


def export_objects(df: DataFrame, uri: str, fmt: str = "parquet") -> str:
    """Replace what is at a Hadoop URI with the rows; returns the URI."""
    write_table(df, uri, "overwrite", fmt)
    return uri


def upload(df: DataFrame, account: str, container: str, path: str, fmt: str = "parquet") -> str:
    """Export to a cloud container and return the https address."""
    export_objects(df, object_uri(account, container, path), fmt)
    return object_url(account, container, path)
