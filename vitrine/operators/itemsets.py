"""Frequent itemsets of any length, by growing prefixes level by level.

A row is a prefix, the items of a basket that may still follow it (its tail) and how many
baskets are alike. One aggregate per level counts every extension of every prefix, combined
on the map side; an extension below the floor cannot be part of a longer frequent set, so
tails are cut to the frequent extensions of their prefix before the next level is formed.
Rows never leave their partition for that: only counts and frequent sets do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.operators.rules import LEAST_COUNT, MIN_SUPPORT
from vitrine.session import cut_counted, cut_lineage


def alike(baskets: DataFrame) -> DataFrame:
    """Baskets as rows of an empty prefix, their distinct items in text order as tail; equal baskets, those without items too, are one row of weight `w`."""
    items = F.array_sort(F.array_distinct(F.array_compact("items")))
    return (baskets.select(F.coalesce(items, F.array().cast("array<string>")).alias("tail")).groupBy("tail").agg(F.count(F.lit(1)).alias("w"))
            .select(F.array().cast("array<string>").alias("prefix"), "tail", "w"))


def extensions(rows: DataFrame, least: float, total: int) -> DataFrame:
    """(prefix, item, n) of the extensions whose support reaches the floor."""
    counted = rows.select("prefix", F.explode("tail").alias("item"), "w").groupBy("prefix", "item").agg(F.sum("w").alias("n"))
    return counted.filter(F.col("n") / F.lit(float(total)) >= F.lit(least))


def grown(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of the next level: each frequent extension of a row's prefix becomes a prefix of its own.

    The list joined to a prefix is at most the frequent items.
    """
    known = found.groupBy("prefix").agg(F.collect_list("item").alias("known"))
    cut = rows.join(known, "prefix").select("prefix", F.array_intersect("tail", "known").alias("tail"), "w").filter(F.size("tail") > 1)
    heads = cut.select("prefix", "w", "tail", F.posexplode("tail").alias("i", "item"))
    return heads.select(F.array_append("prefix", F.col("item")).alias("prefix"),
                        F.slice("tail", F.col("i") + 2, F.size("tail")).alias("tail"), "w").filter(F.size("tail") > 0)


def frequent_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT, max_length: int | None = None) -> DataFrame:
    """(items, length, n, support) of all itemsets whose support reaches the floor, items in text order.

    `baskets` holds (transaction_id, items); null and repeated items count once or not at all, and baskets
    without items still count in the support. `max_length` ends the search early; without it the longest frequent set does.
    """
    # What makes the baskets is run once: their number comes from the stored rows.
    rows, total = cut_counted(alike(baskets), F.sum("w"))
    total = max(total, 1)
    least = max(float(min_support), LEAST_COUNT / total)
    rows = rows.filter(F.size("tail") > 0)
    levels, length = [], 1
    while max_length is None or length <= max_length:
        found = cut_lineage(extensions(rows, least, total))
        if found.isEmpty():
            break
        levels.append(found.select(F.array_append("prefix", F.col("item")).alias("items"), F.lit(length).alias("length"), "n"))
        rows, length = grown(rows, found), length + 1
    out = baskets.sparkSession.createDataFrame([], "items array<string>, length int, n long")
    for level in levels:
        out = out.unionByName(level)
    return out.withColumn("support", F.col("n") / F.lit(float(total)))
