"""Connected components of a table of links, by alternating large and small stars.

Nothing is collected: each round is two groupings by node, and its links are written to the shared folder, which cuts
the lineage. Groups take a minimum and a count, combined before the shuffle; the links of a node with very many
neighbours then stay where they are and meet the node's minimum by broadcast (`met`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


#: Rows of a key that one task may take whatever the table's size; beyond it a key is hot when it holds over a thousandth of all.
HOT_ROWS = 10_000
SHARE = 1000


def met(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Stored rows with the columns of a stored table that has one row for each key and `n`, the key's number of rows.

    Keys of more than a thousandth of all rows are fewer than a thousand: their rows of `table` are broadcast, and
    the rows they meet are not shuffled. All other keys meet in a shuffle.
    """
    limit = F.greatest(F.lit(HOT_ROWS), F.floor(F.sum("n") / SHARE))
    most, limit = table.agg(F.max("n"), limit).first()
    if most is None or most <= limit:
        return rows.join(table.drop("n"), key)
    hot = F.broadcast(table.where(F.col("n") > limit).drop("n"))
    usual = rows.join(hot.select(key), key, "left_anti").join(table.where(F.col("n") <= limit).drop("n"), key)
    return rows.join(hot, key).unionByName(usual)


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links of a's neighbours (those above a, or those below and a itself) to the least of a and all of them."""
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"), F.count(F.lit(1)).alias("n"))
    least = materialize(least, "least")
    linked = met(pairs, least, "a")
    moved = linked.where("b > a") if large else linked.where("b != least").unionByName(least.select("a", F.col("a").alias("b"), "least"))
    return moved.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node that can be reached.

    `links` has two long columns a, b in any order; repeated links and links to oneself do no harm.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    now = materialize(now, "links")
    state = None
    while True:
        now = materialize(_star(_both_ways(now), large=True), "links")
        now = materialize(_star(now, large=False), "links")
        # Both sums stay when every node hangs on its root.
        seen = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % (1 << 31))).first()
        if seen == state:
            break
        state = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
