"""Aggregates behind reports, dashboards and catalogue statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.functions.numeric import as_number, round_dec
from vitrine.functions.text import WHITESPACE
from vitrine.operators.features import COUNTRY_ISO3, mapped, source_country
from vitrine.operators.quantiles import quantiles
from vitrine.schema import PROFILE_COLUMNS, available
from vitrine.session import one_row

STAT_COLUMNS = ("price", "rating", "composite_score", "review_count", "stock_quantity")


def distribution(df: DataFrame, column: str = "composite_score") -> DataFrame:
    """One row: count, missing, min, max, mean, median, sample std, quartiles."""
    if column not in df.columns:
        raise KeyError(f"column '{column}' is missing")
    values = df.select(as_number(df, column).alias("v"))
    cuts = one_row(quantiles(values, "v", {"q25": 0.25, "median": 0.5, "q75": 0.75}))
    moments = values.agg(
        F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.count_if(F.col("v").isNull()).alias("missing"))
    return moments.withColumns({c: F.lit(cuts[c]).cast("double") for c in ("q25", "median", "q75")})


def quantile_set(df: DataFrame, column: str, probs: Sequence[float] = (0.5, 0.8, 0.9, 0.95, 0.99)) -> DataFrame:
    """(p, value) rows of exact quantiles."""
    names = {f"p{i}": p for i, p in enumerate(probs)}
    wide = quantiles(df.select(as_number(df, column).alias("v")), "v", names)
    pairs = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(n).alias("value")) for n, p in names.items()])
    return wide.select(F.inline(pairs))


def catalogue_stats(df: DataFrame, columns: Sequence[str] = STAT_COLUMNS, digits: int = 2) -> DataFrame:
    """Long statistics: one row per numeric column, with the table's row count."""
    present = available(df, columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), as_number(df, c).alias("v")) for c in present])
    long = df.select(F.inline(pairs))
    cuts = quantiles(long, "v", {"median": 0.5}, by=["column"], max_groups=len(present))
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("total"), F.avg("v").alias("mean"), F.min("v").alias("min"),
        F.max("v").alias("max"), F.stddev_samp("v").alias("std"))
    joined = moments.join(cuts.select("column", "median"), "column", "left")
    return joined.select("column", "total", *[
        round_dec(F.col(c), digits).alias(c) for c in ("mean", "min", "max", "median", "std")])


def value_counts(df: DataFrame, column: str, n: int | None = None, by_key: bool = False) -> DataFrame:
    """(value, n) of a column without nulls, most frequent first or in key order."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy("value") if by_key else counts.orderBy(F.desc("n"), "value")
    return ordered.limit(n) if n else ordered


def top_values_per(df: DataFrame, group: str, column: str, n: int = 3) -> DataFrame:
    """(group, entries): the n most frequent values per group as ordered
    (value, count) structs; at most n survive per group before collection."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(group, column).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group).orderBy(F.desc("n"), column)
    best = counts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    ordered = F.array_sort(F.collect_list(F.struct("_rn", F.col(column).alias("value"), "n")))
    return best.groupBy(group).agg(
        F.transform(ordered, lambda e: F.struct(e["value"].alias("value"), e["n"].alias("n"))).alias("entries"))


def cluster_report(df: DataFrame, cluster: str = "cluster_kmeans") -> DataFrame:
    """Per cluster: size, mean price, rating and score, three top categories."""
    known = df.filter(F.col(cluster).isNotNull())
    means = {"price": "avg_price", "rating": "avg_rating", "composite_score": "avg_score"}
    sizes = known.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("count"),
        *[(F.avg(c) if c in df.columns else F.lit(0.0)).alias(a) for c, a in means.items()])
    if "category" in df.columns:
        sizes = sizes.join(top_values_per(known, cluster, "category"), cluster, "left")
        sizes = sizes.withColumnRenamed("entries", "top_categories")
    return sizes.withColumnRenamed(cluster, "cluster_id")


def segment_profile(df: DataFrame, cluster: str = "cluster_kmeans", columns: Sequence[str] = PROFILE_COLUMNS
                    ) -> DataFrame:
    """Mean of every profile column per cluster, size and share of all rows."""
    grouped = df.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        *[round_dec(F.avg(c), 4).alias(c) for c in available(df, columns)], F.count(F.lit(1)).alias("count"))
    return with_share(grouped, df)


def with_share(counts: DataFrame, base: DataFrame, count: str = "count", digits: int = 1) -> DataFrame:
    """Add `pct`, each count's share of the base table's rows."""
    total = base.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", round_dec(F.col(count) / total * 100, digits))


def cluster_distribution(df: DataFrame, cluster: str = "cluster_kmeans") -> DataFrame:
    """(cluster, count, pct) in cluster order."""
    counts = df.filter(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))
    return with_share(counts, df)


def country_stats(df: DataFrame) -> DataFrame:
    """Products and mean score per estimated country, with its ISO code."""
    stats = df.groupBy(source_country(F.col("_source_file")).alias("country")).agg(
        F.count("product_id").alias("products"), F.avg("composite_score").alias("mean_score"))
    return stats.withColumn("iso", mapped(F.col("country"), COUNTRY_ISO3))


def category_context(df: DataFrame) -> DataFrame:
    """Per category: count, price range, mean and median, mean rating and score.

    Rows without price or rating are left out.
    """
    known = df.dropna(subset=["price", "rating"])
    means = known.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.min("price").alias("price_min"), F.max("price").alias("price_max"),
        F.avg("price").alias("price_mean"), F.avg("rating").alias("rating_mean"),
        F.avg("composite_score").alias("score_mean"))
    medians = quantiles(known, "price", {"price_median": 0.5}, by=["category"]).drop("n")
    return means.join(medians, "category", "left")


def category_clusters(df: DataFrame, cluster: str = "cluster_kmeans") -> DataFrame:
    """(category, cluster, n): cluster distribution inside every category."""
    return df.dropna(subset=["price", "rating"]).groupBy("category", cluster).agg(F.count(F.lit(1)).alias("n"))


def catalogue_summary(df: DataFrame) -> DataFrame:
    """One row: size, mean score, price and rating, currency, rating verdict."""
    currency = F.min_by("currency", "product_id") if "currency" in df.columns else F.lit("EUR")
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.avg("composite_score").alias("mean_score"),
        F.avg("price").alias("mean_price"), F.avg("rating").alias("mean_rating"), currency.alias("currency"))
    return row.withColumn("verdict", rating_verdict(F.col("mean_rating")))


def catalogue_report(df: DataFrame, top: DataFrame, cluster: str = "cluster_kmeans") -> DataFrame:
    """(section, position, key, value, pct): the whole summary of a catalogue and its top-k table.

    Means and cluster sizes are two grouping sets of one aggregate, so the catalogue is read once. Sections: overview (n, top_k, mean_score,
    mean_price, mean_rating), currency, top_categories (three of the top-k), clusters with their share of all rows, and trends
    (dominant category of the top-k and its products there, verdict on the mean rating).
    """
    has_cluster = cluster in df.columns
    sets = [[], [cluster]] if has_cluster else [[]]
    currency = F.min_by("currency", "product_id") if "currency" in df.columns else F.lit("EUR")
    grouped = df.groupingSets(sets, *([cluster] if has_cluster else [])).agg(
        (F.grouping_id() if has_cluster else F.lit(1)).alias("_all"), F.count(F.lit(1)).alias("n"), F.avg("composite_score").alias("mean_score"),
        F.avg("price").alias("mean_price"), F.avg("rating").alias("mean_rating"), currency.alias("currency"))
    total = F.max(F.when(F.col("_all") == 1, F.col("n"))).over(Window.partitionBy())
    # One row per cluster and one for all.
    shares = grouped.withColumn("pct", round_dec(F.col("n") / total * 100, 1))
    categories = value_counts(top, "category", 3).select(
        F.row_number().over(Window.orderBy(F.desc("n"), "value")).alias("position"), F.col("value").alias("key"), F.col("n").cast("double").alias("value"))
    size = one_row(top.agg(F.count(F.lit(1)).alias("n")))["n"]

    def line(section: str, position: int, key: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(position).alias("position"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    nothing = F.lit(None)
    overview = shares.filter("_all = 1").withColumn("top_k", F.lit(size)).select(F.inline(F.array(
        *[line("overview", i, F.lit(c), F.col(c)) for i, c in enumerate(("n", "top_k", "mean_score", "mean_price", "mean_rating"), 1)],
        line("currency", 1, F.col("currency"), nothing), line("trends", 2, rating_verdict(F.col("mean_rating")), F.col("mean_rating")))))
    parts = [overview.withColumn("pct", nothing.cast("double")),
             categories.select(F.lit("top_categories").alias("section"), "position", "key", "value", nothing.cast("double").alias("pct")),
             categories.filter("position = 1").select(F.lit("trends").alias("section"), "position", "key", "value", nothing.cast("double").alias("pct"))]
    if has_cluster:
        known = shares.filter((F.col("_all") == 0) & F.col(cluster).isNotNull())
        parts.append(known.select(F.lit("clusters").alias("section"), F.row_number().over(Window.orderBy(cluster)).alias("position"),
                                  F.col(cluster).cast("string").alias("key"), F.col("n").cast("double").alias("value"), "pct"))
    return reduce(DataFrame.unionByName, parts)


# Columns of a category's best products, and the length of their titles.
BEST_COLUMNS = ("price", "rating", "review_count", "composite_score", "cluster_kmeans")
TITLE_CHARS = 60


def category_report(df: DataFrame, best: int = 10, cluster: str = "cluster_kmeans") -> DataFrame:
    """One row per category with all of its context: size, price range, mean and median, mean rating and score, `clusters` as
    (cluster, n) by cluster, and `best` as its first products by score. Rows without price or rating are left out.

    Figures by category and by category and cluster are two grouping sets of one aggregate; the best products are cut to `best` per category
    before they are gathered.
    """
    known = df.dropna(subset=["price", "rating"])
    grouped = known.groupingSets([["category"], ["category", cluster]], "category", cluster).agg(
        F.grouping(cluster).alias("_all"), F.count(F.lit(1)).alias("n"), F.min("price").alias("price_min"), F.max("price").alias("price_max"),
        F.avg("price").alias("price_mean"), F.avg("rating").alias("rating_mean"), F.avg("composite_score").alias("score_mean"))
    whole = F.col("_all") == 1
    figures = grouped.groupBy("category").agg(
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in ("n", "price_min", "price_max", "price_mean", "rating_mean", "score_mean")],
        F.array_sort(F.collect_list(F.when(~whole & F.col(cluster).isNotNull(), F.struct(F.col(cluster).alias("cluster"), "n")))).alias("clusters"))
    medians = quantiles(known, "price", {"price_median": 0.5}, by=["category"]).drop("n")
    w = Window.partitionBy("category").orderBy(F.desc_nulls_last("composite_score"), "product_id")
    first = known.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= best).groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("rank", F.substring("title", 1, TITLE_CHARS).alias("title"), *available(df, BEST_COLUMNS)))).alias("best"))
    keyed = [x.withColumnRenamed("category", f"_{i}") for i, x in enumerate((medians, first))]
    return (figures.join(keyed[0], F.col("category").eqNullSafe(F.col("_0")), "left")
            .join(keyed[1], F.col("category").eqNullSafe(F.col("_1")), "left").drop("_0", "_1"))


def rating_verdict(mean_rating):
    """Fixed thresholds: 4 and above is excellent, 3 and above fair, else weak."""
    return F.when(mean_rating >= 4.0, "excellent").when(mean_rating >= 3.0, "fair").otherwise("weak")


def marketing_context(df: DataFrame, top: DataFrame) -> DataFrame:
    """(section, key, value) facts: means, cluster split, top categories, top five."""
    means = df.agg(F.count(F.lit(1)).cast("double").alias("n"), *[
        F.avg(c).alias(c) for c in ("price", "rating", "composite_score")])
    overview = means.select(F.inline(F.array(*[
        F.struct(F.lit("overview").alias("section"), F.lit(c).alias("key"), F.col(c).alias("value"))
        for c in ("n", "price", "rating", "composite_score")])))
    parts = [overview]
    if "cluster_kmeans" in df.columns:
        parts.append(cluster_distribution(df).select(
            F.lit("clusters").alias("section"), F.col("cluster_kmeans").cast("string").alias("key"),
            F.col("count").cast("double").alias("value")))
    if "category" in top.columns:
        parts.append(value_counts(top, "category", 3).select(
            F.lit("top_categories").alias("section"), F.col("value").alias("key"),
            F.col("n").cast("double").alias("value")))
    best = top.orderBy(F.desc_nulls_last("composite_score"), "product_id").limit(5)
    parts.append(best.select(
        F.lit("top_products").alias("section"), F.substring("title", 1, 60).alias("key"),
        F.col("composite_score").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def box_stats(df: DataFrame, value: str = "composite_score", group: str = "cluster_kmeans") -> DataFrame:
    """Five-number summary of `value` per group."""
    known = df.dropna(subset=[value, group])
    cuts = quantiles(known, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[group])
    ends = known.groupBy(group).agg(F.min(value).alias("min"), F.max(value).alias("max"))
    return ends.join(cuts, group)


def histogram(df: DataFrame, column: str = "composite_score", bins: int = 20) -> DataFrame:
    """(bin, n) over equal-width bins between the column's extremes; the maximum
    falls in the last bin."""
    ends = one_row(df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")))
    lo, hi = F.lit(ends["lo"]), F.lit(ends["hi"])
    slot = F.floor(F.try_divide((F.col(column) - lo) * F.lit(float(bins)), hi - lo))
    bin_ = F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1)) + 1
    return df.filter(F.col(column).isNotNull()).groupBy(bin_.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def keyword_counts(df: DataFrame, columns: Sequence[str], min_length: int = 5) -> DataFrame:
    """(word, n) of lowercased whitespace-separated words of at least `min_length`."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    words = df.select(F.explode(F.split(F.lower(text), WHITESPACE)).alias("word"))
    return words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def trend_facts(df: DataFrame, text_columns: Sequence[str] = ("title", "description")) -> DataFrame:
    """(position, kind, value): the two most common categories and the most common
    word of more than four letters; ties go to the smaller text."""
    cats = value_counts(df, "category", 2)
    place = F.row_number().over(Window.orderBy(F.desc("n"), "value"))
    cats = cats.withColumn("position", place).select(
        "position", F.when(F.col("position") == 1, "dominant_category").otherwise("emerging_category").alias("kind"),
        "value")
    word = keyword_counts(df, text_columns).orderBy(F.desc("n"), "word").limit(1).select(
        F.lit(3).alias("position"), F.lit("recurring_keyword").alias("kind"), F.col("word").alias("value"))
    return cats.unionByName(word)


def report_facts(top: DataFrame, name: str = "title", score: str = "composite_score",
                 order: str = "rank") -> DataFrame:
    """One row: size, mean price (an unusable price counts as 0), best name and score;
    among equal scores the first in `order` wins."""
    price = F.coalesce(as_number(top, "price"), F.lit(0.0))
    first = F.struct(F.col(score), -F.col(order).cast("double"))
    best = F.max_by(F.struct(name, score), F.when(F.col(score).isNotNull() & (F.col(score) != 0), first))
    return top.agg(F.count(F.lit(1)).alias("n"), (F.sum(price) / F.count(F.lit(1))).alias("mean_price"),
                   best.alias("_b")).select("n", "mean_price", F.col(f"_b.{name}").alias("best_name"),
                                            F.col(f"_b.{score}").alias("best_score"))
