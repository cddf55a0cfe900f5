"""Exact deduplication: local, salted and global combining that compares whole contents at every stage.

Equal means identical after all white space is deleted; null is an empty text. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import without_spaces
from millrace.plans.scratch import materialize

Digest = Callable[[Column], Column]


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _signed(docs: DataFrame, id: str, text: str, digest: Digest) -> DataFrame:
    """(doc_id, n, content, digest, doc): n is the original's length in code points, doc the whole row."""
    raw = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"),
        F.coalesce(F.length(raw), F.lit(0)).cast("long").alias("n"),
        without_spaces(raw).alias("content"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
    )
    return rows.withColumn("digest", digest(F.col("content")))


#: Classes with more than one in so many rows are spread over several tasks.
HOT_PARTS = 1000
SPREAD = 64
#: Longer text first, then the smaller id, as one number; a missing id comes last.
_RANK = "cast(n as decimal(18,0)) * cast('100000000000000000000' as decimal(21,0)) + coalesce(cast('9223372036854775808' as decimal(20,0)) - doc_id, 0)"


def _winners(signed: DataFrame, salts: int) -> DataFrame:
    """A row for each content: (digest, content, rank, size)."""
    rows = signed.select("digest", "content", F.expr(_RANK).cast("decimal(38,0)").alias("rank"), (F.spark_partition_id() % salts).alias("salt"))
    # Map-side combining leaves one row per content and partition; salts spread them over the merging tasks.
    salted = rows.groupBy("digest", "salt", "content").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("size"))
    return salted.repartition("digest").groupBy("digest", "content").agg(F.max("rank").alias("rank"), F.sum("size").alias("size"))


def _unranked(rows: DataFrame) -> DataFrame:
    """keep_id and keep_n from the rank."""
    unit = F.expr("cast('100000000000000000000' as decimal(21,0))")
    left = F.col("rank") % unit
    return rows.withColumns(
        {
            "keep_id": F.when(left > 0, F.expr("cast('9223372036854775808' as decimal(20,0))") - left).cast("long"),
            "keep_n": ((F.col("rank") - left) / unit).cast("long"),
        }
    )


def _classes(signed: DataFrame, salts: int) -> tuple[DataFrame, DataFrame | None]:
    """Winners by digest, and by content for digests that several contents share (None: there are none)."""
    proven = _winners(signed, salts).groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.max("rank").alias("rank"), F.sum("size").alias("size"))
    by_digest = materialize(_unranked(proven).drop("rank"), "exact-classes")
    shared = by_digest.where("contents > 1").select("digest")
    alone = by_digest.where("contents = 1").drop("contents")
    if shared.isEmpty():
        return alone, None
    return alone, _unranked(_winners(signed.join(shared, "digest"), salts)).drop("rank")


def _labelled(rows: DataFrame, alone: DataFrame, shared: DataFrame | None) -> DataFrame:
    """Each row with keep_id, keep_n and size of its class. A digest known to have one content stands for it.

    Rows of a class with more than one in `HOT_PARTS` of all rows are dealt to `SPREAD` tasks by a salt; that
    fewer than `HOT_PARTS` classes can be so large bounds the broadcast list of their digests.
    """
    every = alone.agg(F.sum("size")).first()[0] or 0
    hot = F.col("size") * HOT_PARTS > every
    large = F.broadcast(alone.where(hot).select("digest", F.lit(SPREAD).alias("tasks")))
    drawn = F.pmod(F.xxhash64("doc_id", "n", F.spark_partition_id()), F.col("tasks"))
    salted = rows.drop("content").join(large, "digest", "left").withColumn("salt", F.coalesce(drawn, F.lit(0)).cast("int")).drop("tasks")
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    out = salted.join(alone.withColumn("salt", F.explode(salts)), ["digest", "salt"]).drop("salt")
    if shared is not None:
        out = out.unionByName(rows.join(shared, ["digest", "content"]).drop("content"))
    return out


def _won(rows: DataFrame, alone: DataFrame, shared: DataFrame | None) -> DataFrame:
    """`_labelled` for rows that win their class only: their ids are part of the key, so no class makes a hot one."""
    same = "digest = d and doc_id <=> keep_id and n = keep_n"
    out = rows.drop("content").join(alone.withColumnRenamed("digest", "d"), F.expr(same)).drop("d")
    if shared is not None:
        out = out.unionByName(rows.join(shared.withColumnsRenamed({"digest": "d", "content": "c"}), F.expr(f"{same} and content = c")).drop("content", "c", "d"))
    return out


def _first_of_repeats(labelled: DataFrame) -> DataFrame:
    """`kept`: one row of a class, also where rows repeat the winner's id."""
    wins = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n") == F.col("keep_n"))
    alike = Window.partitionBy("digest", "keep_id", "keep_n", "wins", F.when(~F.col("wins"), F.col("doc_id"))).orderBy("doc_id")
    return labelled.withColumn("wins", wins).withColumn("kept", F.col("wins") & (F.row_number().over(alike) == 1)).drop("wins")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", salts: int = 16, digest: Digest = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row.

    Of equal texts the longest original (code points), then the smallest id stays. A null text is empty, a
    null id comes last in ties and can win only where every id of that length is null. Of rows that repeat
    the winner's id and length one is kept. Empty tables give none; further columns are ignored.
    """
    signed = _signed(docs, id, text, digest)
    alone, shared = _classes(signed, salts)
    rows = signed.select("doc_id", "n", "digest", "content", sha256(F.col("content")).alias("text_sha256"))
    return _first_of_repeats(_labelled(rows, alone, shared)).select("doc_id", "keep_id", F.col("size").alias("group_size"), "kept", "text_sha256")


def drop_exact_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", salts: int = 16) -> DataFrame:
    """The rows of `docs` that stay, all columns; the rules are those of `exact_groups`."""
    signed = _signed(docs, id, text, sha256)
    alone, shared = _classes(signed, salts)
    won = _won(signed, alone, shared)
    repeated = docs.groupBy(F.col(f"`{id}`").cast("long").alias("doc_id")).count().where("count > 1")
    if not repeated.isEmpty():  # only then can two rows of a class win
        won = _first_of_repeats(won).where("kept")
    return won.select("doc.*")
