"""JSON events: build, route, parse, validate, and set aside what cannot be processed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import iso_utc
from millrace.sources.topics import TOPIC_OF

REQUIRED = ("event_id", "event_type", "timestamp")
DEAD_LETTER = ("dlq_reason", "dlq_error_type", "original_message")


#: JSON strings of any length; the parser's own limit is 20 million characters.
_WHOLE = {"maxStringLen": "2147483647"}


def event_json(fields: Mapping[str, Column]) -> Column:
    """An event as JSON text; NULL fields are left out."""
    return F.to_json(F.struct(*[e.alias(n) for n, e in fields.items()]))


def action_fields(event_id: Column, user_id: Column, action: Column, at: Column) -> dict[str, Column]:
    """Fields of a user action."""
    return {
        "event_type": F.lit("user_action"),
        "event_id": event_id.cast("string"),
        "user_id": user_id.cast("string"),
        "action": action,
        "timestamp": iso_utc(at),
    }


def order_fields(
    event_id: Column,
    order_id: Column,
    user_id: Column,
    amount: Column,
    status: Column,
    at: Column,
    currency: str = "USD",
) -> dict[str, Column]:
    """Fields of an order, the amount rounded to cents."""
    return {
        "event_type": F.lit("order"),
        "event_id": event_id.cast("string"),
        "order_id": order_id.cast("string"),
        "user_id": user_id.cast("string"),
        "amount": F.round(amount.cast("double"), 2),
        "currency": F.lit(currency),
        "status": status,
        "timestamp": iso_utc(at),
    }


def page_view_fields(
    event_id: Column, user_id: Column, page: Column, duration_ms: Column, at: Column
) -> dict[str, Column]:
    """Fields of a page view."""
    return {
        "event_type": F.lit("page_view"),
        "event_id": event_id.cast("string"),
        "user_id": user_id.cast("string"),
        "page": page,
        "duration_ms": duration_ms.cast("int"),
        "timestamp": iso_utc(at),
    }


def topic_for(event_type: Column) -> Column:
    """Topic of an event type, NULL for an unknown type."""
    routed = F.lit(None).cast("string")
    for kind, topic in TOPIC_OF.items():
        routed = F.when(event_type == kind, F.lit(topic)).otherwise(routed)
    return routed


def to_messages(events: DataFrame, key: str = "event_id", event_type: str = "event_type") -> DataFrame:
    """(key, value, topic): every row as a JSON message for the topic of its type."""
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"),
        topic_for(F.col(event_type)).alias("topic"),
    )


def unroutable(messages: DataFrame) -> DataFrame:
    """Dead letters for messages whose type has no topic."""
    return messages.where(F.col("topic").isNull()).select(
        F.lit("No topic for the event type").alias("dlq_reason"),
        F.lit("KeyError").alias("dlq_error_type"),
        F.col("value").alias("original_message"),
    )


def parse_events(raw: DataFrame, schema: T.StructType, at: Column | None = None, corrupt: str | None = None) -> DataFrame:
    """Envelope (value, topic, timestamp) to typed columns.

    Rows are never lost: text that is no JSON object gives NULL fields, a mistyped field only
    that field. `corrupt` names a column that keeps the text of rows with such damage.
    """
    text = F.col("value").cast("string")
    if corrupt:
        wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        data = F.from_json(text, wide, _WHOLE | {"columnNameOfCorruptRecord": corrupt})
    else:
        data = F.from_json(text, schema, _WHOLE)
    return (
        raw.select(F.col("topic"), F.col("timestamp").alias("kafka_ts"), data.alias("data"))
        .select("topic", "kafka_ts", "data.*")
        .withColumn("ingested_at", F.current_timestamp() if at is None else at)
    )


def is_json(text: Column) -> Column:
    """True for exactly one JSON value without anything after it.

    Wrapping the text in an array and in an object shows trailing text, which the parsers
    otherwise ignore. Only text that the strict parser refuses is looked at for single quotes:
    what remains then are objects with repeated keys, which are JSON.
    """
    wrapped = F.coalesce(F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False)) & (
        F.coalesce(F.size(F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}")))) == 1, F.lit(False))
    )
    outside_strings = F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    strict = F.when(F.try_parse_json(text).isNotNull(), F.lit(True)).otherwise(~outside_strings.contains("'"))
    return F.when(wrapped, F.coalesce(strict, F.lit(False))).otherwise(F.lit(False))


def check_events(raw: DataFrame, value: str = "value", required: Sequence[str] = REQUIRED) -> DataFrame:
    """Add `error_type` and `error_reason`, both NULL for a valid event.

    A required field counts as present when its key is there, whatever its value.
    """
    text = F.col(value).cast("string")
    wanted = sorted(required)
    keyed = raw.withColumn("_keys", F.json_object_keys(text)).withColumn("_json", is_json(text))
    absent = F.array_except(F.array(*[F.lit(r) for r in wanted]), F.col("_keys"))
    listed = F.concat(
        F.lit("Message is missing required fields: {"),
        F.array_join(F.transform(absent, lambda k: F.concat(F.lit("'"), k, F.lit("'"))), ", "),
        F.lit("}"),
    )
    kind = (
        F.when(~F.col("_json"), "JSONDecodeError")
        .when(F.col("_keys").isNull(), "TypeError")
        .when(F.size(absent) > 0, "ValueError")
    )
    reason = (
        F.when(~F.col("_json"), "Message is not valid JSON")
        .when(F.col("_keys").isNull(), "Message is not a JSON object")
        .when(F.size(absent) > 0, listed)
    )
    return keyed.select(*raw.columns, kind.alias("error_type"), reason.alias("error_reason"))


def valid_events(checked: DataFrame) -> DataFrame:
    """Events that passed, all source columns kept, flagged as processed."""
    return (
        checked.where(F.col("error_type").isNull())
        .drop("error_type", "error_reason")
        .withColumn("processed", F.lit(True))
    )


def mark_processed(value: Column) -> Column:
    """The event's own JSON with the flag added; unknown fields stay, an old flag is replaced."""
    body = F.regexp_replace(F.rtrim(value), r"\}\s*$", "")
    flag = F.lit('"processed": true}')
    keys = F.json_object_keys(value)
    others = F.map_filter(F.from_json(value, "map<string, variant>", _WHOLE), lambda k, _: k != "processed")
    renewed = F.to_json(F.map_concat(others, F.create_map(F.lit("processed"), F.parse_json(F.lit("true")))))
    return (
        F.when(F.array_contains(keys, "processed"), renewed)
        .when(F.size(keys) == 0, F.concat(body, flag))
        .otherwise(F.concat(body, F.lit(", "), flag))
    )


def dead_letters(checked: DataFrame, value: str = "value") -> DataFrame:
    return checked.where(F.col("error_type").isNotNull()).select(
        F.col("error_reason").alias("dlq_reason"),
        F.col("error_type").alias("dlq_error_type"),
        F.col(value).cast("string").alias("original_message"),
    )
