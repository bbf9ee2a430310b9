"""Canonical product schema, column aliases and fixed domain constants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The 32 raw product fields, all text, in file order.
RAW_FIELDS = (
    "product_id", "title", "description", "category", "subcategory", "brand",
    "image_url", "tags", "url", "platform", "price", "price_promo", "price_old",
    "discount_pct", "currency", "rating", "review_count", "category_rank",
    "availability", "stock_quantity", "delivery_days", "variant_count", "colors",
    "sizes", "shop_name", "shop_country", "shop_product_count", "vendor",
    "related_products", "published_at", "scraped_at", "customer_reviews",
)

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])

# Accepted spellings per canonical column, first match wins,
# compared without case.
COLUMN_ALIASES = {
    "price": ("price", "prix", "unit_price"),
    "rating": ("rating", "note", "score", "average_rating"),
    "review_count": ("review_count", "reviews", "nb_reviews", "customer_reviews"),
    "stock_quantity": ("stock_quantity", "stock", "inventory", "quantity", "inventory_quantity"),
    "availability": ("availability", "disponibilite", "stock_status", "disponible"),
    "title": ("title", "nom", "name", "titre", "product_name", "product_title"),
    "category": ("category", "categorie", "catégorie"),
    "product_id": ("product_id", "id", "productid"),
    "traffic": ("traffic", "ventes", "sales", "visits"),
    "shop_country": ("shop_country", "geographie", "country", "pays"),
    "url": ("url", "link"),
}

# Text tokens a CSV reader must treat as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

NUMERIC_CORE = ("price", "rating", "review_count", "stock_quantity")
NORM_COLUMNS = tuple(f"{c}_norm" for c in NUMERIC_CORE)

# Columns of the clustering matrix and of the segment profile.
CLUSTER_FEATURES = NORM_COLUMNS + ("engagement", "prix_par_rating", "log_reviews", "disponible")
PROFILE_COLUMNS = CLUSTER_FEATURES + ("composite_score",)

# Classifier inputs.
BASE_FEATURES = ("engagement", "prix_par_rating", "log_reviews", "disponible")
OPTIONAL_FEATURES = ("discount_pct", "delivery_days", "variant_count")

CLUSTER_LABELS = ("cluster_kmeans", "cluster_hierarchical", "cluster_dbscan")


def find_column(df: DataFrame, canonical: str) -> str | None:
    """Name under which `canonical` appears in `df`, or None."""
    by_lower = {c.lower(): c for c in df.columns}
    names = COLUMN_ALIASES.get(canonical, (canonical,))
    return next((by_lower[n] for n in names if n in by_lower), None)


def canonicalize(df: DataFrame) -> DataFrame:
    """Rename aliased columns to canonical names.

    A column is claimed by at most one canonical name, and a column that already
    carries a canonical name is never taken as an alias of another one, so `score`
    becomes `rating` only when no `rating` exists.
    """
    renames: dict[str, str] = {}
    taken = {c for c in df.columns if c in COLUMN_ALIASES or c in RAW_FIELDS}
    for canonical in COLUMN_ALIASES:
        if canonical in df.columns:
            continue
        free = [c for c in df.columns if c not in taken and c not in renames]
        by_lower = {c.lower(): c for c in free}
        hit = next((by_lower[a] for a in COLUMN_ALIASES[canonical] if a in by_lower), None)
        if hit:
            renames[hit] = canonical
    return df.withColumnsRenamed(renames) if renames else df


def available(df: DataFrame, wanted) -> list[str]:
    """The wanted columns that `df` has, in the wanted order."""
    return [c for c in wanted if c in df.columns]
