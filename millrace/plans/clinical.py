"""Clinical ingest from JSON lines to tables and the patient store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.fhir import ERRORS, TABLES, classify, errors_of, table_of
from millrace.operators.buckets import BucketedTable
from millrace.operators.patients import append_versions, latest_by_key
from millrace.operators.views import PatientCounts


def store_batch(
    resources: DataFrame,
    base: str,
    batch_id: int,
    sequence: str | None = None,
    column: str = "value",
    envelope: bool = False,
    fmt: str = "parquet",
    buckets: int | None = None,
) -> dict[str, str]:
    """Parse a batch once and write its tables, its errors and its patient versions.

    Every output folder carries the batch id and is replaced when the batch is replayed.
    `sequence` names the column that orders versions; by default the order in the batch.
    With `buckets` the batch is also brought into the patient table (`patient_table`) and the counts of facts per patient
    (`patient_counts`), which cost what the batch touches.
    """
    ordered = resources
    if sequence is None:
        ordered = resources.withColumn("sequence", F.monotonically_increasing_id())
    elif sequence != "sequence":
        ordered = resources.withColumn("sequence", F.col(sequence))
    spark = resources.sparkSession
    parsed = f"{base}/parsed/batch_id={int(batch_id)}"
    classify(ordered, column, envelope).write.mode("overwrite").partitionBy("outcome").parquet(parsed)
    stored = spark.read.parquet(parsed)
    paths = {}
    for table in TABLES.values():
        rows = table_of(stored, table, keep=("sequence",))
        paths[table] = f"{base}/{table}"
        append_versions(rows, paths[table], batch_id, fmt)
    paths[ERRORS] = f"{base}/{ERRORS}"
    append_versions(errors_of(stored, column), paths[ERRORS], batch_id, fmt)
    if buckets is not None:
        versions = table_of(stored, "patients", keep=("sequence",)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        patient_table(spark, base, buckets).merge(versions, batch_id)
        facts = {t: table_of(stored, t) for t in ("encounters", "observations", "conditions")}
        patient_counts(spark, base, buckets).add(batch_id, facts)
    return paths


def patient_table(spark: SparkSession, base: str, buckets: int = 64) -> BucketedTable:
    """Last version of every patient; later batches win, within a batch the later row."""
    return BucketedTable(
        spark, f"{base}/patient_table", "patient_id", lambda rows: latest_by_key(rows, "patient_id", ["batch_id", "sequence"]), buckets
    )


def patient_counts(spark: SparkSession, base: str, buckets: int = 64) -> PatientCounts:
    return PatientCounts(spark, f"{base}/patient_counts", buckets)


def start_clinical_stream(
    stream: DataFrame, base: str, checkpoint: str, available_now: bool = False, interval: str = "30 seconds", **options
) -> StreamingQuery:
    """The same for a stream of resources, one batch at a time."""
    writer = stream.writeStream.foreachBatch(
        lambda batch, batch_id: store_batch(batch, base, batch_id, **options)
    ).option("checkpointLocation", checkpoint)
    triggered = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return triggered.start()
