"""Product search, BI filters and validity predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.numeric import text_to_double
from vitrine.schema import available

# Words that mark a product as not physical, the length of the
# description lead they are looked for in, and the price ceiling.
NON_PHYSICAL_WORDS = (
    "plugin", "extension", "software", "license", "licence", "theme", "download",
    "téléchargement", "module", "abonnement", "subscription", "addon", "add-on", "api",
    "support", "maintenance", "digital", "virtual", "pdf", "ebook", "course",
    "formation", "app", "integration",
)
DESCRIPTION_LEAD = 500
PRICE_CEILING = 1500
ALL = "Toutes"
SEARCH_COLUMNS = ("title", "category", "price", "rating", "composite_score")


def has_non_physical_word(text: Column) -> Column:
    """Whether a marker word occurs between word boundaries, in any case."""
    return F.lower(text).rlike(r"(?U)\b(" + "|".join(NON_PHYSICAL_WORDS) + r")\b")


def drop_non_physical(df: DataFrame, lead: int | None = None) -> DataFrame:
    """Drop software, services and prices over the ceiling.

    An unparseable price is kept. All of the description is judged; a caller that
    holds a late mention for meaningless gives the `lead` that counts.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("")) if c in df.columns else F.lit("")

    description = text("description") if lead is None else F.substring(text("description"), 1, lead)
    judged = F.concat_ws(" ", text("title"), text("category"), text("tags"), description)
    price_ok = F.coalesce(text_to_double(F.col("price")) <= PRICE_CEILING, F.lit(True)) \
        if "price" in df.columns else F.lit(True)
    return df.filter(~has_non_physical_word(judged) & price_ok)


def bi_filter(df: DataFrame, category: str = ALL, clusters: Sequence[int] = (), platform: str = ALL,
              price: tuple[float, float] | None = None,
              score: tuple[float, float] | None = None) -> DataFrame:
    """Dashboard filter; a condition on an absent column is skipped."""
    has = set(df.columns)
    tests: list[Column] = []
    if category != ALL:
        tests.append(F.col("category") == category)
    if clusters and "cluster_kmeans" in has:
        tests.append(F.col("cluster_kmeans").isin(*clusters))
    if platform != ALL and "platform" in has:
        tests.append(F.col("platform") == platform)
    if price is not None and "price" in has:
        tests.append(F.col("price").between(*price))
    if score is not None and "composite_score" in has:
        tests.append(F.col("composite_score").between(*score))
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def filter_options(df: DataFrame) -> DataFrame:
    """Choices and ranges offered by the filter bar as (option, value, lo, hi)."""
    none = F.lit(None).cast("double")
    parts = [
        df.filter(F.col(c).isNotNull()).select(F.lit(c).alias("option"), F.col(c).cast("string").alias("value"))
        .distinct().select("option", "value", none.alias("lo"), none.alias("hi"))
        for c in available(df, ("category", "cluster_kmeans", "platform"))]
    ranged = available(df, ("price", "composite_score"))
    if ranged:
        extremes = df.agg(*[f(c).cast("double").alias(f"{c}_{f.__name__}") for c in ranged for f in (F.min, F.max)])
        ends = F.array(*[
            F.struct(F.lit(c).alias("option"), F.lit(None).cast("string").alias("value"),
                     F.col(f"{c}_min").alias("lo"), F.col(f"{c}_max").alias("hi")) for c in ranged])
        parts.append(extremes.select(F.inline(ends)))
    return reduce(DataFrame.unionByName, parts)


def search(df: DataFrame, query: str = "", category: str = "", price_min: float | None = None,
           price_max: float | None = None) -> DataFrame:
    """All matching products: `query` is a regular expression looked for in every
    text column, without case; NULL never matches."""
    tests: list[Column] = []
    needle = query.lower().strip()
    if needle:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        hits = [F.coalesce(F.lower(c).rlike(needle), F.lit(False)) for c in texts]
        tests.append(reduce(Column.__or__, hits, F.lit(False)))
    if category.strip():
        tests.append(F.lower("category") == category.strip().lower())
    if "price" in df.columns:
        if price_min is not None:
            tests.append(F.col("price") >= price_min)
        if price_max is not None:
            tests.append(F.col("price") <= price_max)
    return df.filter(reduce(Column.__and__, tests)) if tests else df


def search_page(df: DataFrame, limit: int = 50, order: Sequence[str] = ("product_id",), **terms) -> DataFrame:
    """First `limit` hits in a total order, with the count of all hits as `total`."""
    hits = search(df, **terms)
    total = hits.agg(F.count(F.lit(1))).scalar()
    page = hits.orderBy(*order).limit(limit)
    return page.select(*available(df, SEARCH_COLUMNS), *[c for c in order if c not in SEARCH_COLUMNS],
                       total.alias("total"))
