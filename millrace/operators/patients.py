"""Patient store: latest version per patient, lookup, and the patient-centred view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import hadoop

PATIENT_COLUMNS = ("patient_id", "name", "gender", "birth_date", "address")
SNAPSHOTS = "_snapshots"


def latest_by_key(versions: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Last row per key by the `order` columns; a NULL or empty key is not stored.

    The maximum is combined before the shuffle, so a key with very many versions costs no more
    than one row per map task.
    """
    rest = [c for c in versions.columns if c != key and c not in order]
    stored = versions.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    ordered = F.struct(*order, *rest)
    return (
        stored.groupBy(key)
        .agg(F.max(ordered).alias("_last"))
        .select(*[F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in versions.columns])
    )


def append_versions(batch: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Add patient versions to the store's change log; a replayed batch replaces itself."""
    batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={int(batch_id)}")


def current_patients(
    spark: SparkSession, path: str, order: Sequence[str] = ("batch_id", "sequence"), fmt: str = "parquet"
) -> DataFrame:
    """The store's state: later batches win, within a batch the later row.

    Reads the newest snapshot and the batches after it.
    """
    upto = max(_numbers(spark, f"{path}/{SNAPSHOTS}", "upto", done=True), default=None)
    if upto is None:
        return latest_by_key(spark.read.format(fmt).load(path), "patient_id", order)
    return _state(spark, path, upto, [n for n in _numbers(spark, path, "batch_id") if n > upto], order, fmt)


def _state(spark: SparkSession, path: str, upto: int | None, later: list[int], order: Sequence[str], fmt: str) -> DataFrame:
    """A snapshot, if there is one, and these batches."""
    tail = spark.read.format(fmt).option("basePath", path).load([f"{path}/batch_id={n}" for n in later]) if later else None
    if upto is None:
        return latest_by_key(tail, "patient_id", order)
    found = spark.read.parquet(f"{path}/{SNAPSHOTS}/upto={upto}")
    if tail is not None:
        found = found.unionByName(tail, allowMissingColumns=True)
    return latest_by_key(found, "patient_id", order)


def _numbers(spark: SparkSession, path: str, name: str, done: bool = False, mark: str = "_SUCCESS") -> list[int]:
    """n of the folders `<name>=<n>`; with `done`, of those that were written to the end."""
    fs, pattern = hadoop(spark, f"{path}/{name}=*" + (f"/{mark}" if done else ""))
    depth = mark.count("/") + 1 if done else 0
    out = set()
    for status in fs.globStatus(pattern) or ():
        folder = status.getPath()
        for _ in range(depth):
            folder = folder.getParent()
        out.add(int(folder.getName().split("=")[1]))
    return sorted(out)


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that the stream of this checkpoint will not run again; -1 if there is none."""
    fs, pattern = hadoop(spark, f"{checkpoint}/commits/*")
    names = [s.getPath().getName() for s in fs.globStatus(pattern) or ()]
    return max((int(n) for n in names if n.isdigit()), default=-1)


def compact_patients(
    spark: SparkSession, path: str, order: Sequence[str] = ("batch_id", "sequence"), fmt: str = "parquet", checkpoint: str | None = None
) -> int | None:
    """Write a snapshot of the batches so far, so that lookups need not regroup them; returns the last batch in it.

    It ends before the first batch whose write is in progress or was cut off. A finished batch can still be replayed
    until its stream has committed it: give the stream's `checkpoint`, and the snapshot ends with the last committed
    batch. Without it the caller says that no finished batch will change, as a batch that is written
    again after it went into a snapshot is not looked at. Batches and older snapshots stay for those who read them;
    `drop_compacted` deletes them.
    """
    last = max(_numbers(spark, f"{path}/{SNAPSHOTS}", "upto", done=True), default=None)
    done = set(_numbers(spark, path, "batch_id", done=True, mark="_delta_log/*.json" if fmt == "delta" else "_SUCCESS"))
    later = [n for n in _numbers(spark, path, "batch_id") if last is None or n > last]
    if checkpoint is not None:
        safe = _committed(spark, checkpoint)
        later = [n for n in later if n <= safe]
    later = later[: next((i for i, n in enumerate(later) if n not in done), len(later))]
    if not later:
        return last
    _state(spark, path, last, later, order, fmt).write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/upto={later[-1]}")
    return later[-1]


def drop_compacted(spark: SparkSession, path: str) -> None:
    """Delete the batches that the newest snapshot holds, and older snapshots."""
    kept = max(_numbers(spark, f"{path}/{SNAPSHOTS}", "upto", done=True), default=-1)
    old = [f"{path}/batch_id={n}" for n in _numbers(spark, path, "batch_id") if n <= kept]
    old += [f"{path}/{SNAPSHOTS}/upto={n}" for n in _numbers(spark, f"{path}/{SNAPSHOTS}", "upto") if n < kept]
    for folder in old:
        fs, where = hadoop(spark, folder)
        fs.delete(where, True)


def find_patient(patients: DataFrame, patient_id: str) -> DataFrame:
    """The five columns of one patient; no rows when unknown."""
    return patients.where(F.col("patient_id") == patient_id).select(*PATIENT_COLUMNS)


def find_patients(patients: DataFrame, ids: DataFrame) -> DataFrame:
    return patients.join(ids.select("patient_id").distinct(), "patient_id", "left_semi").select(*PATIENT_COLUMNS)


def unknown_patients(patients: DataFrame, ids: DataFrame) -> DataFrame:
    return ids.select("patient_id").distinct().join(patients.select("patient_id"), "patient_id", "left_anti")


def bare_id(reference: Column) -> Column:
    """`Patient/123` to `123`."""
    return F.regexp_replace(reference, "^Patient/", "")


def patient_view(
    patients: DataFrame, encounters: DataFrame, observations: DataFrame, conditions: DataFrame
) -> DataFrame:
    """One row per patient with the number of encounters, observations and conditions.

    Each fact table shrinks to one row per patient before it meets the patients.
    """
    view = patients
    for table, name in ((encounters, "n_encounters"), (observations, "n_observations"), (conditions, "n_conditions")):
        counts = table.groupBy(bare_id(F.col("patient_id")).alias("patient_id")).agg(F.count(F.lit(1)).alias(name))
        view = view.join(counts, "patient_id", "left")
    return view.fillna(0, ["n_encounters", "n_observations", "n_conditions"])


def patient_facts(patients: DataFrame, facts: DataFrame) -> DataFrame:
    """Every fact row with its patient's name, gender and birth date."""
    keyed = facts.withColumn("patient_id", bare_id(F.col("patient_id")))
    return keyed.join(patients.select("patient_id", "name", "gender", "birth_date"), "patient_id", "left")


def mask(df: DataFrame, hashed: Sequence[str] = (), shortened: Sequence[str] = (), dropped: Sequence[str] = (), keep: int = 1) -> DataFrame:
    """Minimise personal fields: hash, cut to the first characters, or drop."""
    out = []
    for c in df.columns:
        if c in dropped:
            continue
        if c in hashed:
            out.append(F.sha2(F.col(c).cast("string"), 256).alias(c))
        elif c in shortened:
            out.append(F.concat(F.substring(F.col(c).cast("string"), 1, keep), F.lit("***")).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)
