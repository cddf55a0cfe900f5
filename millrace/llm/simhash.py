"""SimHash near-duplicates: pigeonhole blocks, join on blocks, Hamming check, connected components.

Two fingerprints that differ in at most 3 of 64 bits agree on at least 3 of 6 blocks. Every distinct fingerprint goes to
the 20 buckets named by three blocks (mask) and their bits. A bucket of more than `BUCKET` fingerprints is not
compared: its free bits are split into 6 blocks again, three of which must agree too, and so on, until at most 8
bits are free and no bucket can hold more than 256. So a large group of near copies costs no all-pairs work and no link
is lost. A bucket yields the links of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.common import carried, map_batches, restored, texts, with_columns
from millrace.llm.components import components, met
from millrace.plans.scratch import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCKS = 6
#: Fingerprints of a bucket that are compared in one task.
BUCKET = 1000
#: Hot buckets up to this number are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_BUCKETS = 100_000


def fingerprint(text: bytes) -> int:
    """Signed 64-bit SimHash of the 3-word shingles, repeats counted."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps)], [*gaps, len(joined)]
    digest = xxhash.xxh64_digest
    if len(starts) < SHINGLE:
        hashes = digest(joined, SEED)
    else:
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :])])
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(rows), 1 << 16):
        counts += np.unpackbits(rows[i : i + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(rows)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Adds `bits`, the fingerprint as a long, to (text, ...)."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return with_columns(batch, bits=pa.array([fingerprint(t) for t in texts(batch.column("text"))], pa.int64()))

    return map_batches(docs, step, StructType([*docs.schema, StructField("bits", LongType())]))


def _masks(free: int) -> list[int]:
    """Which of the free bits must agree: every choice of BLOCKS - DISTANCE of their BLOCKS blocks."""
    bits = [b for b in range(64) if free >> b & 1]
    edges = [len(bits) * k // BLOCKS for k in range(BLOCKS + 1)]
    blocks = [sum(1 << b for b in bits[i:j]) for i, j in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(blocks, BLOCKS - DISTANCE)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _refined(mask: int) -> list[int]:
    """The masks that follow a hot bucket's mask."""
    return sorted({mask | m for m in _masks(~mask & ((1 << 64) - 1))})


def _buckets(rows: DataFrame, masks: dict[int | None, list[int]]) -> DataFrame:
    """(mask, part, bits): each row under the masks that follow its own."""
    if None in masks:
        each = rows.withColumn("next", F.array(*[F.lit(_signed(m)) for m in masks[None]]))
    else:  # some hundred masks at most
        table = rows.sparkSession.createDataFrame([(_signed(k), [_signed(m) for m in v]) for k, v in masks.items()], "mask long, next array<long>")
        each = rows.join(F.broadcast(table), "mask")
    each = each.select(F.explode("next").alias("mask"), "bits")
    each = each.withColumn("part", F.col("bits").bitwiseAND(F.col("mask")))
    return each if None in masks else materialize(each.distinct(), "simhash-buckets")


def _forest(bits: np.ndarray) -> list[tuple[int, int]]:
    """Links of at most DISTANCE bits that span each group of a small bucket."""
    raw = bits.view(np.uint64)
    left, out = np.arange(len(raw)), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            at, front = front[0], front[1:]
            near = np.bitwise_count(raw[left] ^ raw[at]) <= DISTANCE
            if near.any():
                out.extend((int(bits[at]), int(bits[j])) for j in left[near])
                front, left = np.concatenate([front, left[near]]), left[~near]
    return out


def _compared(buckets: DataFrame) -> DataFrame:
    """Links within buckets of at most BUCKET rows each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in ("mask", "part", "bits")]).astype(np.int64)
            held = np.concatenate([held, rows])
            cuts = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1)) + 1
            if len(cuts):
                yield _links(held[: cuts[-1]])
                held = held[cuts[-1] :]
        yield _links(held)

    return buckets.repartition("mask", "part").sortWithinPartitions("mask", "part").select("mask", "part", "bits").mapInArrow(run, "a long, b long")


def _links(rows: np.ndarray) -> pa.RecordBatch:
    starts = np.flatnonzero(np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]) if len(rows) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(rows)] if len(rows) else starts
    several = ends - starts > 1
    bits = np.ascontiguousarray(rows[:, 2])
    pairs = [p for i, j in zip(starts[several].tolist(), ends[several].tolist()) for p in _forest(bits[i:j])]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def near_links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints (`bits`) that join all pairs of at most 3 differing bits."""
    masks: dict[int | None, list[int]] = {None: _masks((1 << 64) - 1)}
    rows, found = distinct.select("bits"), []
    while True:
        buckets = _buckets(rows, masks)
        following = sorted({m for v in masks.values() for m in v})
        if all(bin(~m & ((1 << 64) - 1)).count("1") <= 8 for m in following):
            return _union([*found, _compared(buckets)])
        hot = materialize(buckets.groupBy("mask", "part").count().where(F.col("count") > bucket).select("mask", "part"), "simhash-hot")
        number = hot.count()
        if not number:
            return _union([*found, _compared(buckets)])
        side = F.broadcast(hot) if number <= BROADCAST_BUCKETS else hot
        found.append(_compared(buckets.join(side, ["mask", "part"], "left_anti")))
        rows = materialize(buckets.join(side, ["mask", "part"], "left_semi").select("mask", "bits"), "simhash-rows")
        masks = {m: _refined(m) for m in following}


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _grouped(rows: DataFrame) -> DataFrame:
    """Adds component_id and root, a name for the component, to stored rows (doc_id, bits).

    A fingerprint of very many rows and a component of very many fingerprints are not shuffled to one task (`met`).
    """
    ids = materialize(rows.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-distinct")
    roots = components(near_links(ids)).select(F.col("node").alias("bits"), "root")
    placed = materialize(ids.join(roots, "bits", "left").withColumn("root", F.coalesce("root", "bits")), "simhash-placed")
    tops = materialize(placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "simhash-roots")
    named = materialize(met(placed, tops, "root").select("bits", "component_id", "root", F.col("copies").alias("n")), "simhash-named")
    return met(rows, named, "bits")


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    A null or empty text has fingerprint zero and is linked like any other. component_id is the smallest id
    among all that can be reached; null ids do not count, and a component of null ids only has null. Repeated rows
    and equal fingerprints belong together. An empty table gives no rows.
    """
    rows = materialize(fingerprints(carried(docs, id, text)).select("doc_id", "bits"), "simhash-bits")
    return _grouped(rows).select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each component, all columns: the row with the smallest id.

    Where rows repeat that id, the one whose columns have the least SHA-256 as JSON stays, so reruns agree. Null and empty
    texts are near copies of one another. A component of null ids only keeps one row too; an empty table gives no rows.
    """
    stored = materialize(fingerprints(carried(docs, id, text, rest=True)), "simhash-rows")
    groups = _grouped(stored.select("doc_id", "bits"))
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.struct("doc_id", "bits").alias("k"), "root").distinct()
    kept = stored.withColumn("k", F.struct("doc_id", "bits")).join(first, "k")
    if not stored.groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.withColumn("pick", F.sha2(F.to_json(F.struct("text", "rest"), {"ignoreNullFields": "false"}), 256))
        least = kept.groupBy("root").agg(F.min("pick").alias("pick"))
        kept = kept.join(least, ["root", "pick"]).dropDuplicates(["root"])  # those left are equal in all columns
    return restored(kept, docs, text)
