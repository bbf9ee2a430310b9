"""Product, basket and audit views derived from the TPC-H-like test tables, each as
a DataFrame and as the equal DuckDB SQL used by the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.features import derive, normalize
from vitrine.operators.score import composite_score


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per sold part. Integer sums keep it independent of order."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("disc"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))).alias("qty"),
    )
    third = F.col("p_size") % 3
    parts = table(spark, sf_dir, "part")
    return parts.join(lines, parts.p_partkey == lines.l_partkey).select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_name", F.lit("of size"), "p_size", F.lit("made by"), "p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(third == 0, "shopify").when(third == 1, "woocommerce").otherwise("generic").alias("platform"),
        F.when(F.col("p_size") % 2 == 0, "EUR").otherwise("USD").alias("currency"),
        F.when(third == 0, "shopify_20260101_000000.csv").when(third == 1, "woocommerce_20260102_000000.csv")
        .otherwise("manual.csv").alias("_source_file"),
        F.col("p_retailprice").alias("price"),
        (F.lit(5) - F.lit(0.2) * (F.col("disc") / F.col("n").cast("double"))).alias("rating"),
        F.col("n").alias("review_count"),
        F.col("qty").alias("stock_quantity"),
    )


PRODUCTS_SQL = """products AS (
  SELECT CAST(p.p_partkey AS VARCHAR) AS product_id, p.p_name AS title,
         concat_ws(' ', p.p_name, 'of size', p.p_size, 'made by', p.p_brand) AS description,
         p.p_type AS category, p.p_brand AS brand,
         CASE p.p_size % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'woocommerce' ELSE 'generic' END AS platform,
         CASE WHEN p.p_size % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE p.p_size % 3 WHEN 0 THEN 'shopify_20260101_000000.csv'
              WHEN 1 THEN 'woocommerce_20260102_000000.csv' ELSE 'manual.csv' END AS _source_file,
         p.p_retailprice AS price, 5 - 0.2e0 * (l.disc / CAST(l.n AS DOUBLE)) AS rating,
         l.n AS review_count, l.qty AS stock_quantity
  FROM part p JOIN (
    SELECT l_partkey, COUNT(*) AS n, SUM(CAST(ROUND(l_discount * 100) AS BIGINT))::BIGINT AS disc,
           SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS qty
    FROM lineitem GROUP BY l_partkey) l ON p.p_partkey = l.l_partkey)"""


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with normalised and derived features."""
    return derive(normalize(products(spark, sf_dir)))


FEATURED_SQL = PRODUCTS_SQL + """, extremes AS (
  SELECT min(price) p0, max(price) p1, min(rating) r0, max(rating) r1, min(review_count) v0,
         max(review_count) v1, min(stock_quantity) s0, max(stock_quantity) s1 FROM products
), featured AS (
  SELECT products.*,
         CASE WHEN p1 = p0 THEN 0 ELSE (price - p0) / (p1 - p0) END AS price_norm,
         CASE WHEN r1 = r0 THEN 0 ELSE (rating - r0) / (r1 - r0) END AS rating_norm,
         CASE WHEN v1 = v0 THEN 0 ELSE (review_count - v0) / CAST(v1 - v0 AS DOUBLE) END AS review_count_norm,
         CASE WHEN s1 = s0 THEN 0 ELSE (stock_quantity - s0) / (s1 - s0) END AS stock_quantity_norm,
         CASE WHEN rating <> 0 THEN price / rating ELSE price END AS prix_par_rating,
         review_count * rating AS engagement,
         CASE WHEN stock_quantity > 0 THEN 1 ELSE 0 END AS disponible,
         ln(1 + review_count) AS log_reviews
  FROM products CROSS JOIN extremes)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Featured products with the composite score rounded to 6 digits."""
    return composite_score(featured(spark, sf_dir), digits=6)


SCORED_SQL = FEATURED_SQL + """, scored AS (
  SELECT *, round(-0.2e0 * price_norm + 0.4e0 * rating_norm + 0.3e0 * review_count_norm
                  + 0.1e0 * stock_quantity_norm, 6) AS composite_score
  FROM featured)"""

# Centroids in (price_norm, rating_norm) that give the BI queries a
# cluster label every engine can recompute.
DEMO_CENTROIDS = {0: (0.2, 0.5), 1: (0.8, 0.7), 2: (0.5, 0.2)}


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored products with `cluster_kmeans` by nearest fixed centroid."""
    from vitrine.operators.cluster import assign_to_centroids

    return assign_to_centroids(scored(spark, sf_dir), ("price_norm", "rating_norm"), DEMO_CENTROIDS)


CLUSTERED_SQL = SCORED_SQL + """, distances AS (
  SELECT *, (price_norm - 0.2e0) * (price_norm - 0.2e0) + (rating_norm - 0.5e0) * (rating_norm - 0.5e0) AS d0,
         (price_norm - 0.8e0) * (price_norm - 0.8e0) + (rating_norm - 0.7e0) * (rating_norm - 0.7e0) AS d1,
         (price_norm - 0.5e0) * (price_norm - 0.5e0) + (rating_norm - 0.2e0) * (rating_norm - 0.2e0) AS d2
  FROM scored
), clustered AS (
  SELECT * EXCLUDE (d0, d1, d2),
         CASE WHEN d0 <= d1 AND d0 <= d2 THEN 0 WHEN d1 <= d2 THEN 1 ELSE 2 END AS cluster_kmeans
  FROM distances)"""
