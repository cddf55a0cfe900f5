"""Run log: an append-only table of runs and the metrics derived from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, status string, rows_extracted bigint, rows_loaded bigint, "
    "duration_seconds double, run_ts timestamp"
)
# Upper bounds of the duration buckets, in seconds.
BUCKETS = (30, 60, 120, 300, 600, 1800, 3600)
SUCCESS, FAILURE = "success", "failure"


def append_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    success: bool,
    rows_extracted: int = 0,
    rows_loaded: int = 0,
    duration_seconds: float = 0.0,
    run_ts: datetime | None = None,
    fmt: str = "parquet",
) -> None:
    row = (
        run_id,
        SUCCESS if success else FAILURE,
        int(rows_extracted),
        int(rows_loaded),
        float(duration_seconds),
        run_ts or datetime.now(timezone.utc),
    )
    spark.createDataFrame([row], SCHEMA).write.format(fmt).mode("append").save(path)


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))


def row_totals(log: DataFrame) -> DataFrame:
    """Rows extracted and loaded by successful runs."""
    ok = F.col("status") == SUCCESS
    return log.agg(
        *[
            F.coalesce(F.sum(F.when(ok, F.col(c))), F.lit(0)).alias(c)
            for c in ("rows_extracted", "rows_loaded")
        ]
    )


def duration_histogram(log: DataFrame, buckets: Sequence[float] = BUCKETS) -> DataFrame:
    """(le, count, sum): runs no longer than each bound, cumulative, closed by +Inf."""
    took = F.col("duration_seconds")
    bounds = [(f"{b:g}", took <= b) for b in buckets] + [("+Inf", F.lit(True))]
    counted = log.agg(
        F.coalesce(F.sum(took), F.lit(0.0)).alias("_sum"),
        *[F.count_if(inside).alias(f"_b{i}") for i, (_, inside) in enumerate(bounds)],
    )
    cells = [
        F.struct(F.lit(label).alias("le"), F.col(f"_b{i}").alias("count"), F.col("_sum").alias("sum"))
        for i, (label, _) in enumerate(bounds)
    ]
    return counted.select(F.inline(F.array(*cells)))


def last_run(log: DataFrame) -> DataFrame:
    """Time of the latest run, successful or not."""
    return log.agg(F.max("run_ts").alias("last_run"))
