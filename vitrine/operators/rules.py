"""Association rules over baskets: frequent items and pairs, directed rules, metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.schema import CLUSTER_LABELS, available
from vitrine.session import cut_lineage, one_row

# Mining thresholds and the least count that supports an itemset.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_LIFT = 0.01, 0.5, 1.0
LEAST_COUNT = 5.0
MAX_LISTED_ITEMS = 20_000
RULE_METRICS = (
    "antecedent support", "consequent support", "support", "confidence", "lift",
    "representativity", "leverage", "conviction", "zhangs_metric", "jaccard",
    "certainty", "kulczynski",
)


def basket_key(df: DataFrame) -> Column:
    """`category_brand`, trimmed, missing parts as 'unknown'."""
    def part(c: str) -> Column:
        return F.trim(F.coalesce(F.col(c), F.lit("unknown"))) if c in df.columns else F.lit("unknown")

    return F.concat_ws("_", part("category"), part("brand"))


def transactions(df: DataFrame, id_column: str = "product_id") -> DataFrame:
    """One transaction per product: its basket and its label in each clustering."""
    labels = [F.concat(F.lit(c + "_"), F.coalesce(F.col(c).cast("int"), F.lit(-1)).cast("string"))
              for c in available(df, CLUSTER_LABELS)]
    return df.select(F.col(id_column).cast("string").alias("transaction_id"),
                     F.array(basket_key(df), *labels).alias("items"))


def to_long(wide: DataFrame) -> DataFrame:
    """(transaction_id, item) rows, nulls dropped, each pair once."""
    return (wide.select("transaction_id", F.explode("items").alias("item"))
            .dropna(subset=["item"]).dropDuplicates(["transaction_id", "item"]))


def frequent_items(counts: DataFrame, n: int, min_support: float) -> DataFrame:
    """Keep items of (item, n_item) whose support reaches the floor."""
    floor = max(float(min_support), LEAST_COUNT / max(n, 1))
    return counts.filter(F.col("n_item") / F.lit(float(max(n, 1))) >= F.lit(floor))


def known_items(singles: DataFrame) -> list[str] | None:
    """Names of the frequent items if they are few, else None.

    There are at most mean basket size / support of them; only a tiny support can
    make that a long list, so it is fetched only up to a fixed length.
    """
    names = [x["item"] for x in singles.select("item").limit(MAX_LISTED_ITEMS + 1).collect()]
    return names if len(names) <= MAX_LISTED_ITEMS else None


def gather(long: DataFrame) -> DataFrame:
    """One row per transaction with its distinct items."""
    return long.groupBy("transaction_id").agg(F.collect_set("item").alias("items"))


def prune(baskets: DataFrame, singles: DataFrame) -> DataFrame:
    """Baskets cut to frequent items, in text order; those under two items go."""
    names = known_items(singles)
    if names is not None:
        kept = baskets.select("transaction_id", F.filter("items", lambda x: x.isin(names)).alias("items"))
    else:
        long = baskets.select("transaction_id", F.explode("items").alias("item"))
        kept = gather(long.join(singles.select("item"), "item", "left_semi"))
    return kept.select("transaction_id", F.array_sort("items").alias("items")).filter(F.size("items") > 1)


def pair_counts(pruned: DataFrame) -> DataFrame:
    """(a, b, n_pair) with a < b, formed inside each row and combined on the map
    side, so neither a self-join nor one row per pair crosses the network."""
    heads = pruned.select(F.posexplode("items").alias("i", "a"), "items")
    pairs = heads.select("a", F.explode(F.slice("items", F.col("i") + 2, F.size("items"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_pair"))


def itemset_counts(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> tuple[DataFrame, DataFrame, int]:
    """Frequent items (item, n_item), frequent pairs (a, b, n_pair) and the number
    of transactions.

    `baskets` holds (transaction_id, items) with distinct items per row. Pruning to
    frequent items bounds every basket before pairs are formed.
    """
    n = baskets.count()
    counts = baskets.select(F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("n_item"))
    singles = cut_lineage(frequent_items(counts, n, min_support))
    floor = max(float(min_support), LEAST_COUNT / max(n, 1))
    pairs = pair_counts(prune(baskets, singles)).filter(
        F.col("n_pair") / F.lit(float(max(n, 1))) >= F.lit(floor))
    return singles, pairs, n


def baskets_from_long(long: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Baskets of a (transaction_id, item) table, cut to items that can be frequent.

    Repeats are combined on the map side and only frequent items are gathered, so a
    transaction with a third of all rows ends as one short array. Transactions left
    empty stay, as they count in the support.
    """
    distinct = long.dropna(subset=["item"]).dropDuplicates(["transaction_id", "item"])
    n = one_row(distinct.agg(F.count_distinct("transaction_id").alias("n")))["n"]
    counts = distinct.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    singles = cut_lineage(frequent_items(counts, n, min_support))
    names = known_items(singles)
    if names is not None:
        marked = long.withColumn("item", F.when(F.col("item").isin(names), F.col("item")))
    else:
        marks = singles.select("item", F.col("item").alias("kept"))
        marked = distinct.join(marks, "item", "left").select("transaction_id", F.col("kept").alias("item"))
    return gather(marked.dropDuplicates(["transaction_id", "item"]))


def rule_metrics(sa: Column, sc: Column, sac: Column) -> dict[str, Column]:
    """Interest measures of a -> c from the three supports."""
    confidence = F.try_divide(sac, sa)
    lift = F.try_divide(confidence, sc)
    leverage = sac - sa * sc
    spread = F.greatest(sac * (1 - sa), sa * (sc - sac))
    return {
        "antecedent support": sa, "consequent support": sc, "support": sac,
        "confidence": confidence, "lift": lift, "representativity": F.lit(1.0), "leverage": leverage,
        "conviction": F.when(confidence >= 1, F.lit(float("inf"))).otherwise(
            F.try_divide(1 - sc, 1 - confidence)),
        "zhangs_metric": F.when(spread == 0, F.lit(0.0)).otherwise(F.try_divide(leverage, spread)),
        "jaccard": F.try_divide(sac, sa + sc - sac),
        "certainty": F.try_divide(confidence - sc, 1 - sc),
        "kulczynski": (F.try_divide(sac, sa) + F.try_divide(sac, sc)) / 2,
    }


def pair_rules(baskets: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               min_lift: float = MIN_LIFT) -> DataFrame:
    """Directed rules in both directions above the thresholds, unordered."""
    singles, pairs, n_total = itemset_counts(baskets, min_support)
    both = F.array(F.struct(F.col("a").alias("antecedents"), F.col("b").alias("consequents")),
                   F.struct(F.col("b").alias("antecedents"), F.col("a").alias("consequents")))
    directed = pairs.select("n_pair", F.inline(both))
    left = singles.select(F.col("item").alias("antecedents"), F.col("n_item").alias("n_a"))
    right = singles.select(F.col("item").alias("consequents"), F.col("n_item").alias("n_c"))
    joined = directed.join(left, "antecedents").join(right, "consequents")
    n = F.lit(float(max(n_total, 1)))
    metrics = rule_metrics(F.col("n_a") / n, F.col("n_c") / n, F.col("n_pair") / n)
    rules = joined.select("antecedents", "consequents", *[metrics[m].alias(m) for m in RULE_METRICS])
    return rules.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))


def order_rules(rules: DataFrame, metric: str = "lift") -> DataFrame:
    """Best first, ties by antecedent and consequent."""
    return rules.orderBy(F.desc_nulls_last(metric), "antecedents", "consequents")


def top_rules(rules: DataFrame, metric: str = "lift", n: int = 10) -> DataFrame:
    """The n best rules; an unknown metric means lift."""
    return order_rules(rules, metric if metric in rules.columns else "lift").limit(n)


def filter_rules(rules: DataFrame, min_lift: float | None = None, limit: int = 50) -> DataFrame:
    """Rules at or above a lift, the best `limit` of them, with the count of all."""
    kept = rules if min_lift is None else rules.filter(F.col("lift") >= min_lift)
    total = kept.agg(F.count(F.lit(1))).scalar()
    return order_rules(kept).limit(limit).withColumn("total_rules", total)


def strength(lift: Column) -> Column:
    """Fixed thresholds: over 3 strong, over 1.5 moderate, over 1 weak."""
    return F.when(lift > 3, "strong").when(lift > 1.5, "moderate").when(lift > 1, "weak").otherwise("not significant")


def itemset_label(items: Column) -> Column:
    """An itemset as sorted, comma-joined text."""
    return F.concat_ws(", ", F.array_sort(items))

