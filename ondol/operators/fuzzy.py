"""Fuzzy deduplication in blocks: greedy leaders in input order, without collecting a block.

A row leads if no earlier leader of its block is within ``days`` days and ``threshold`` of similarity; a row that doesn't lead
joins its earliest such leader. That is what a greedy pass over the block in input order gives. Here the similar pairs are found
first (rows with the same text and day are one node of the pairs), and the leaders are settled in rounds: a node whose earlier
neighbours all follow leads, one with an earlier neighbour that leads follows. Each round is a join of the pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import token_set_ratio
from ..session import materialize
from .relational import window_pairs

MAX_ROUNDS = 200
#: Nodes of a block and a range of days that one slice of its pairs has.
SLICE = 1000


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, r"(?U)\s+"), lambda x: x != ""))


def similar_pairs(nodes: DataFrame, days: int, threshold: float) -> DataFrame:
    """(a, b): nodes (node, block, day, text) of a block, a before b, within the bounds."""
    pairs = window_pairs(nodes, ["block"], "day", "node", days, ["text"], SLICE)
    # a bound without the exact similarity: a common token, or joined token sets whose lengths allow it
    x, y = _tokens(F.col("a_text")), _tokens(F.col("b_text"))
    n, m = F.length(F.array_join(x, " ")), F.length(F.array_join(y, " "))
    possible = F.arrays_overlap(x, y) | (2 * F.least(n, m) >= threshold * (n + m))
    return pairs.where(possible).withColumn("s", token_set_ratio("a_text", "b_text")).where(F.col("s") >= threshold).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def find_duplicates(rows: DataFrame, order: Column, posted: Column, block: Column, text: Column, days: int = 7, threshold: float = 0.90, id_column: str = "id") -> DataFrame:
    """(id, is_duplicate, canonical_id), one row for each input row.

    The canonical row of a group is the earliest posted one (NULL last, ties by input order). Rows without a day or without
    any token are alone.
    """
    base = rows.select(F.col(id_column).alias("id"), order.alias("ord"), posted.alias("posted"), F.lower(F.coalesce(block, F.lit(""))).alias("block"), F.coalesce(text, F.lit("")).alias("text")).withColumn("day", F.to_date("posted"))
    # a text without tokens is similar to nothing, not even to its like
    base = base.withColumn("alone", F.col("day").isNull() | (F.size(_tokens(F.col("text"))) == 0))
    # rows with the same block, day and text are one node: named by the first of them
    nodes = base.where("not alone").groupBy("block", "day", "text").agg(F.min("ord").alias("node"))
    nodes = materialize(nodes, "nodes")
    pairs = materialize(similar_pairs(nodes, days, threshold), "pairs")
    # a node is settled once all earlier neighbours are: it leads if none of them leads
    settled = nodes.select("node").join(pairs.select(F.col("b").alias("node")).distinct(), "node", "left_anti").withColumn("leads", F.lit(True))
    settled = materialize(settled, "settled")
    left = materialize(pairs.join(settled.select(F.col("node").alias("b")), "b", "left_anti"), "open")
    for _ in range(MAX_ROUNDS):
        if left.isEmpty():
            break
        known = left.join(settled.withColumnRenamed("node", "a"), "a", "left")
        now = known.groupBy("b").agg(F.bool_or(F.coalesce("leads", F.lit(False))).alias("hit"), F.bool_and(F.col("leads").isNotNull()).alias("all"))
        fresh = materialize(now.where("hit or all").select(F.col("b").alias("node"), (~F.col("hit")).alias("leads")), "fresh")
        settled = materialize(settled.unionByName(fresh), "settled")
        left = materialize(left.join(fresh.select(F.col("node").alias("b")), "b", "left_anti"), "open")
    else:
        raise RuntimeError("the leaders did not settle")
    leaders = settled.where("leads").select("node")
    follows = pairs.join(leaders.withColumnRenamed("node", "a"), "a").groupBy("b").agg(F.min("a").alias("leader")).join(leaders.withColumnRenamed("node", "b"), "b", "left_anti")
    group = nodes.join(follows.withColumnRenamed("b", "node"), "node", "left").select("block", "day", "text", F.coalesce("leader", "node").alias("leader"))
    members = base.where("not alone").join(group, ["block", "day", "text"])
    best = members.groupBy("leader").agg(F.min_by("id", F.struct("posted", "ord")).alias("canonical"), F.count(F.lit(1)).alias("n"))
    joined = members.join(best, "leader").select("id", ((F.col("n") > 1) & (F.col("id") != F.col("canonical"))).alias("is_duplicate"), F.when((F.col("n") > 1) & (F.col("id") != F.col("canonical")), F.col("canonical")).alias("canonical_id"))
    alone = base.where("alone").select("id", F.lit(False).alias("is_duplicate"), F.lit(None).cast(dict(base.dtypes)["id"]).alias("canonical_id"))
    return joined.unionByName(alone)
