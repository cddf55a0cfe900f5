"""Batch runs: extract, clean, load, with counts taken while writing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, Observation, SparkSession

from millrace.operators.cleaning import clean_and_count
from millrace.operators.quality import CRITICAL_COLUMNS, validate
from millrace.operators.runlog import append_run
from millrace.sinks.tables import write_table
from millrace.sources.files import hadoop, read_files


def run_etl(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    file_format: str = "csv",
    write_mode: str = "append",
    schema=None,
    target_format: str = "parquet",
    partition_by: Sequence[str] = (),
    run_log: str | None = None,
    run_id: str | None = None,
    replay_safe: bool = False,
    at: Column | None = None,
) -> dict:
    """One pass from source to table. Rows extracted and loaded are counted by the write itself.

    With `replay_safe` the rows go to `<target>/run_id=<id>`, which a retry of the same run
    replaces instead of appending twice. Success and failure both reach the run log.
    """
    name = run_id or uuid.uuid4().hex
    started = time.monotonic()
    try:
        seen = Observation()
        cleaned = clean_and_count(read_files(spark, source_path, file_format, schema), seen, at)
        if replay_safe:
            write_table(cleaned, f"{target_path}/run_id={name}", "overwrite", target_format, partition_by)
        else:
            write_table(cleaned, target_path, write_mode, target_format, partition_by)
        result = {"run_id": name, "rows_extracted": seen.get["extracted"], "rows_loaded": seen.get["loaded"]}
    except Exception as error:
        if run_log:
            try:
                append_run(spark, run_log, name, False, duration_seconds=time.monotonic() - started)
            except Exception as lost:  # must not hide why the run failed
                error.add_note(f"The run log could not be written either: {lost}")
        raise
    result["duration_seconds"] = time.monotonic() - started
    if run_log:
        append_run(spark, run_log, name, True, result["rows_extracted"], result["rows_loaded"], result["duration_seconds"])
    return result


def validate_then_run(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    file_format: str = "csv",
    not_null: Sequence[str] = CRITICAL_COLUMNS,
    schema=None,
    **options,
) -> dict:
    """Check the raw source and run only when every expectation holds."""
    raw = read_files(spark, source_path, file_format, schema)
    schema = schema or raw.schema  # inferred once, for both steps
    checked = validate(raw, not_null)
    return {"validation": checked, **run_etl(spark, source_path, target_path, file_format, schema=schema, **options)}


def publish_if_valid(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    file_format: str = "csv",
    not_null: Sequence[str] = CRITICAL_COLUMNS,
    schema=None,
    run_id: str | None = None,
    at: Column | None = None,
) -> dict:
    """Write, audit, publish: one pass over the source writes the cleaned rows aside and counts what the expectations ask
    (rows, and rows without a critical column). Only if all hold, one rename shows them as `<target>/run_id=<id>`.

    A run that fails or is cut off leaves nothing that a reader of the target sees: folders whose names begin with `_` are
    not read. Running an id again replaces what it left aside; an id that is published already is refused.
    """
    name = run_id or uuid.uuid4().hex
    raw = read_files(spark, source_path, file_format, schema)
    lost = [c for c in not_null if c not in raw.columns]
    if lost:
        raise ValueError(f"Data quality check failed with {len(lost)} violation(s): no column {', '.join(lost)}")
    aside, shown = f"{target_path}/_staged/run_id={name}", f"{target_path}/run_id={name}"
    system, place = hadoop(spark, shown)
    if system.exists(place):
        raise FileExistsError(f"Run {name} is published already")
    seen = Observation()
    write_table(clean_and_count(raw, seen, at, not_null), aside, "overwrite")
    counts = seen.get
    results = [{"rule": "rows", "success": counts["extracted"] > 0, "unexpected": 0}]
    results += [{"rule": f"not_null:{c}", "success": counts[f"missing_{i}"] == 0, "unexpected": counts[f"missing_{i}"]} for i, c in enumerate(not_null)]
    failed = [r for r in results if not r["success"]]
    if failed:
        raise ValueError(f"Data quality check failed with {len(failed)} violation(s). Nothing was published.")
    if not system.rename(hadoop(spark, aside)[1], place):
        raise OSError(f"Run {name} could not be published")
    return {"run_id": name, "rows_extracted": counts["extracted"], "rows_loaded": counts["loaded"], "results": results}
