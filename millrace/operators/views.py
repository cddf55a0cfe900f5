"""Patient view kept up to date: a batch of facts costs its own size."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.buckets import BucketedTable
from millrace.operators.patients import _committed, _numbers, bare_id

COUNTS = ("n_encounters", "n_observations", "n_conditions")
COUNT_SCHEMA = "patient_id string, " + ", ".join(f"{c} bigint" for c in COUNTS)


def add_up(counts: DataFrame) -> DataFrame:
    return counts.groupBy("patient_id").agg(*[F.sum(c).alias(c) for c in COUNTS])


def count_facts(facts: Mapping[str, DataFrame]) -> DataFrame:
    """One row per patient with its number of `encounters`, `observations` and `conditions`; a table may be left out.

    All tables are added up in one shuffle, combined before it. Facts without a patient are not counted.
    """
    unknown = set(facts) - {c[2:] for c in COUNTS}
    if unknown:
        raise ValueError(f"No such fact tables: {sorted(unknown)}")
    if not facts:
        raise ValueError("No fact tables given")
    ones = [
        table.select(
            bare_id(F.col("patient_id").cast("string")).alias("patient_id"),
            *[F.lit(1 if c == f"n_{name}" else 0).cast("bigint").alias(c) for c in COUNTS],
        )
        for name, table in facts.items()
    ]
    return add_up(reduce(DataFrame.unionAll, ones).where("patient_id IS NOT NULL"))


class PatientCounts:
    """Counts per patient and batch in `<path>/batches/batch_id=<n>`, folded into a bucketed table by `compact`.

    A replayed batch replaces its counts. Reading adds the folded table and the batches after it; patients are not scanned
    until `view` joins them.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.folded = BucketedTable(spark, f"{self.path}/folded", "patient_id", add_up, buckets)

    def add(self, batch_id: int, facts: Mapping[str, DataFrame]) -> None:
        """Count one batch's facts. A batch that was folded already is not counted again."""
        if batch_id > self._folded_to(self.folded.manifest()):
            count_facts(facts).write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={int(batch_id)}")

    def _folded_to(self, manifest: dict) -> int:
        return -1 if manifest["last_batch"] is None else manifest["last_batch"]

    def _after(self, last: int, upto: int | None = None) -> list[int]:
        done = _numbers(self.spark, f"{self.path}/batches", "batch_id", done=True)
        return [n for n in done if n > last and (upto is None or n <= upto)]

    def _batches(self, numbers: list[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], COUNT_SCHEMA)
        return self.spark.read.schema(COUNT_SCHEMA).parquet(*[f"{self.path}/batches/batch_id={n}" for n in numbers])

    def read(self) -> DataFrame:
        pinned = self.folded.manifest()
        later = self._batches(self._after(self._folded_to(pinned)))
        if not pinned["version"]:
            return add_up(later)
        return add_up(self.folded.read(pinned["version"]).select(*later.columns).unionAll(later))

    def compact(self, upto: int | None = None, checkpoint: str | None = None) -> int | None:
        """Fold batches up to `upto`, or up to the last one that the stream of `checkpoint` has committed, into the table
        in one merge; returns the last folded batch. Without either the caller says that no batch will be replayed.

        It ends before the first batch whose write is in progress or was cut off.
        """
        if checkpoint is not None:
            safe = _committed(self.spark, checkpoint)
            upto = safe if upto is None else min(upto, safe)
        last = self._folded_to(self.folded.manifest())
        done = self._after(last, upto)
        broken = min((n for n in _numbers(self.spark, f"{self.path}/batches", "batch_id") if n > last and n not in set(self._after(last))), default=None)
        ready = [n for n in done if broken is None or n < broken]
        if ready:
            self.folded.merge(self._batches(ready), ready[-1])
            last = ready[-1]
        return None if last < 0 else last

    def view(self, patients: DataFrame) -> DataFrame:
        """Every patient with its counts, 0 where there are none."""
        return patients.join(self.read(), "patient_id", "left").fillna(0, list(COUNTS))
