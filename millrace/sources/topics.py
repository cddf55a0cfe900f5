"""Event topics: schemas, stream and batch sources, and a file-backed stand-in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}

# Fields of each topic in schema order, and the topic of each event type.
FIELDS = {
    "user-actions": "event_id string, event_type string, user_id string, action string, timestamp string",
    "orders": "event_id string, event_type string, order_id string, user_id string, amount double, "
    "currency string, status string, timestamp string",
    "page-views": "event_id string, event_type string, user_id string, page string, duration_ms int, "
    "timestamp string",
}
TOPIC_OF = {"user_action": "user-actions", "order": "orders", "page_view": "page-views"}

ENVELOPE = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def schema_of(topic: str) -> T.StructType | None:
    """Declared fields of a topic; None for a topic nobody declared."""
    declared = FIELDS.get(topic)
    if declared is None:
        return None
    fields = [part.strip().split(" ") for part in declared.split(",")]
    return T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in fields])


def topic_names(topics: str | Sequence[str]) -> list[str]:
    """Topics from a list or a comma-separated text, without surrounding blanks."""
    parts = topics.split(",") if isinstance(topics, str) else topics
    return [p.strip() for p in parts if p.strip()]


def kafka_options(
    brokers: str,
    topics: str | Sequence[str],
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    if starting not in ("latest", "earliest"):
        raise ValueError(f"Unknown starting position: {starting}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topic_names(topics)),
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic_stream(spark: SparkSession, brokers: str, topics: str | Sequence[str], **options) -> DataFrame:
    """Kafka stream source; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **options)).load()


def read_topic_batch(spark: SparkSession, brokers: str, topics: str | Sequence[str]) -> DataFrame:
    """All messages held now, as a batch."""
    return spark.read.format("kafka").options(**kafka_options(brokers, topics, "earliest")).load()


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ENVELOPE,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same columns from files that land in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def first_messages(raw: DataFrame, n: int | None) -> DataFrame:
    """At most n messages of a batch, all when n is None. A stream is bounded per trigger by
    `max_offsets_per_trigger` or `max_files_per_trigger`."""
    return raw if n is None else raw.limit(n)
