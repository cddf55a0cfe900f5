"""Small helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: [\x20\x09-\x0D]; bytes.split() splits at exactly these.
SPACES = " \t\n\x0b\x0c\r"
#: Lower-cases A-Z and turns every byte outside 0-9, a-z and non-ASCII into a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Arrow batches are cut at so many bytes, whatever the texts' lengths.
BATCH_BYTES = "16m"


def bounded_batches(spark: SparkSession) -> None:
    """Cut the batches that go to Python by bytes too, so that very long texts cannot fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """One output batch for each input batch."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield step(batch)

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8; null is empty."""
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def carried(docs: DataFrame, id: str, text: str, rest: bool = False) -> DataFrame:
    """Columns (doc_id, text) under fixed names, whatever else the table holds; with `rest`, all others in a struct."""
    others = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("rest")] if rest else []
    return docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), *others)


def restored(rows: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """The columns of `docs` from carried rows."""
    return rows.select(*[F.col("text").alias(c) if c == text else F.col(f"rest.`{c}`").alias(c) for c in docs.columns])


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns added or replaced; all others pass through."""
    kept = {n: batch.column(n) for n in batch.schema.names} | columns
    return pa.RecordBatch.from_arrays(list(kept.values()), list(kept))


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    return x * np.uint64(0x81DADEF4BC2DD44D)


class WordHashes(dict):
    """Word to 64-bit hash; emptied by `trim` when it has grown too large."""

    LIMIT = 300_000

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def without_spaces(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out
