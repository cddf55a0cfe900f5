"""Row cleaning: incomplete rows, duplicates, text normalisation, audit column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.functions.columns import col, missing, string_columns, with_columns

AUDIT_COLUMN = "etl_timestamp"


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column, or in any of `subset`."""
    return df.dropna("any", subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Keep one of each set of equal rows; NULLs count as equal."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def normalise_text(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim spaces (only spaces) and upper-case every string column."""
    names = columns or string_columns(df)
    return with_columns(df, {n: F.upper(F.trim(col(n))) for n in names})


def stamp(df: DataFrame, at: Column | None = None, name: str = AUDIT_COLUMN) -> DataFrame:
    """Add the run timestamp: the query's own, or one given for reproducible output."""
    return with_columns(df, {name: F.current_timestamp() if at is None else at})


def clean(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Incomplete rows out, duplicates out, text normalised, audit column added.

    Incomplete rows go first: the result is the same and fewer rows are shuffled. Text is
    normalised after the duplicates are gone, so rows that only then become equal both stay.
    """
    return stamp(normalise_text(drop_duplicates(drop_incomplete(df))), at)


def clean_and_count(df: DataFrame, seen: Observation, at: Column | None = None, holes: Sequence[str] = ()) -> DataFrame:
    """`clean`, with the numbers of rows read ("extracted") and kept ("loaded") observed on the way, and for each column of
    `holes` the number of rows that lack it ("missing_0", "missing_1", ...).

    Incomplete rows are blanked instead of dropped, so they fold into one all-NULL group and the
    grouping that removes duplicates also counts every row. The numbers are taken after the
    shuffle, in the stage that writes: a map task that runs again cannot count twice.
    """
    incomplete = reduce(lambda a, b: a | b, [missing(df, c) for c in df.columns])
    blanked = df.select(*[F.when(~incomplete, col(c)).alias(c) for c in df.columns], *[missing(df, c).alias(f"_hole{i}") for i, c in enumerate(holes)])
    lacking = [F.count_if(f"_hole{i}").alias(f"_hole{i}") for i in range(len(holes))]
    groups = blanked.groupBy(*[col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_copies"), *lacking)
    kept = col(df.columns[0]).isNotNull()
    counted = groups.observe(
        seen,
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("extracted"),
        F.count_if(kept).alias("loaded"),
        *[F.coalesce(F.sum(f"_hole{i}"), F.lit(0)).alias(f"missing_{i}") for i in range(len(holes))],
    )
    return stamp(normalise_text(counted.where(kept).drop("_copies", *[f"_hole{i}" for i in range(len(holes))])), at)
