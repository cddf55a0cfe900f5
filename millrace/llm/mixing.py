"""Mix sources to target weights: hash-random order, distributed prefix sums, cut at each source's budget.

DataFrame functions only. Sizes are words, [^\\x20\\x09-\\x0D]+; a null text has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.plans.scratch import materialize

#: Times that a document can be taken at most.
EPOCHS = 3


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), epochs: int = EPOCHS) -> DataFrame:
    """(skey, source_size, target) from (skey, source_size), one row per source.

    Sources in order of skey weigh `weights`, repeating. They share the sum of all sizes by weight; a target
    stops at `epochs` times its source's size, and the excess goes to the others by weight until none is above.
    With sources in order of cap / weight the capped ones come first, so one pass of running sums finds the share
    per unit of weight. The table has a row per source only.
    """
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy("skey")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("long")).withColumn("cap", F.col("source_size") * epochs)
    by_cap = every.orderBy(F.col("cap").cast("double") / F.col("weight"), "skey")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "k": F.row_number().over(by_cap),
            "left": F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
            "free": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        }
    ).withColumn("share", F.col("left").cast("double") / F.col("free"))
    rows = rows.withColumn("first", F.min(F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.col("k"))).over(every))
    rows = rows.withColumn("unit", F.max(F.when(F.col("k") == F.col("first"), F.col("share"))).over(every))
    target = F.when(F.col("k") < F.col("first"), F.col("cap").cast("double")).otherwise(F.col("unit") * F.col("weight"))
    return rows.select("skey", "source_size", target.alias("target"))


def _measured(docs: DataFrame, id: str, text: str, source: str, seed: int, carry: bool) -> DataFrame:
    name = F.col(f"`{source}`").cast("string")
    doc_id = F.col(f"`{id}`").cast("long")
    words = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(r"[^ \t-\r]+"))
    return docs.select(
        doc_id.alias("doc_id"),
        words.cast("long").alias("size"),
        F.when(name.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), name)).alias("skey"),  # by code point, null last
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))).alias("draw"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []),
    )


def mix_sources(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), epochs: int = EPOCHS, seed: int = 0) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row.

    In each source rows stand in order of a hash of their id. The budget, the target's whole words, takes every
    row once for each whole epoch it holds; what is left goes to the first rows in that order, and the
    row at the cut gives a part. Rows with the same id stand by size. A null text has size 0, a null source is a
    source of its own (last), a null id hashes like the empty text. An empty table gives no rows.
    """
    rows = materialize(_measured(docs, id, text, source, seed, carry=False), "mix-sizes")
    goal = targets(rows.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, epochs)
    # Range slices split every source; each keeps its number.
    sliced = rows.repartitionByRange("skey", "draw", "doc_id", "size").withColumn("slice", F.spark_partition_id())
    sliced = materialize(sliced, "mix-slices")
    parts = sliced.groupBy("skey", "slice").agg(F.sum("size").alias("part"))
    earlier = Window.partitionBy("skey").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("offset", F.coalesce(F.sum("part").over(earlier), F.lit(0))).join(goal, "skey")
    inside = Window.partitionBy("skey", "slice").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(parts, ["skey", "slice"])
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("budget") - F.col("whole") * F.col("source_size") - F.col("offset") - F.col("inside")
    out = out.withColumn("budget", budget).withColumn("whole", whole)
    taken = F.col("whole") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    name = F.when(F.col("skey") != "2", F.substring("skey", 2, 2**31 - 1))
    return out.select("doc_id", name.alias("source"), "size", "source_size", "target", taken.alias("taken"))
