"""Queries: cleaning, features, scoring, ranking, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.numeric import text_to_double
from vitrine.operators import clean as C
from vitrine.operators import features as X
from vitrine.operators import filters as L
from vitrine.operators import score as K
from vitrine.plans.registry import Registry
from vitrine.sources import demo
from vitrine.sources.demo import CLUSTERED_SQL, FEATURED_SQL, PRODUCTS_SQL, SCORED_SQL, clustered, scored, table

REG = Registry()

# --- dirty view: the product facts as badly typed text with repeats ---------------


def dirty(spark, sf_dir):
    """Parts as raw text rows: commas, "None", blanks, junk numbers, and every
    third part repeated in a later file with a changed price."""
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    first = part.select(
        F.when(k % 50 == 7, F.lit(None)).otherwise(k.cast("string")).alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.when(k % 11 == 0, "None").when(k % 11 == 1, "").when(k % 11 == 2, "1,234.56").when(k % 11 == 3, "nan")
        .when(k % 11 == 4, F.replace(price, F.lit("."), F.lit(","))).when(k % 11 == 5, F.concat(F.lit(" "), price))
        .when(k % 97 == 50, "inf").when(k % 97 == 51, "20000").when(k % 97 == 52, "-3").otherwise(price)
        .alias("price"),
        F.when(k % 5 == 0, "None").when(k % 5 == 1, F.concat(F.lit("4,"), (k % 10).cast("string")))
        .otherwise(F.concat(F.lit("3."), (k % 7).cast("string"))).alias("rating"),
        F.when(k % 4 == 0, F.lit(None)).otherwise((F.col("p_size") * 3).cast("string")).alias("review_count"),
        F.when(k % 6 == 0, "").otherwise(F.col("p_size").cast("string")).alias("stock_quantity"),
        F.when(k % 3 == 0, "None").when(k % 3 == 1, "in stock").otherwise(F.lit(None)).alias("availability"),
        F.lit("None").alias("shop_country"),
        F.concat(F.lit("https://"), F.when(k % 8 == 0, "GymShark").when(k % 8 == 1, "culturekings").otherwise("shop"),
                 F.lit(".example.com/p/"), k.cast("string")).alias("url"),
        F.lit("a.csv").alias("_source_file"), k.alias("_pos"))
    again = first.filter(F.col("_pos") % 3 == 0).withColumns({
        "price": F.concat(F.col("price"), F.lit("1")), "_source_file": F.lit("b.csv")})
    return first.unionByName(again)


DIRTY_SQL = """first AS (
  SELECT CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
         p_name AS title, p_type AS category, p_brand AS brand,
         CASE WHEN p_partkey % 11 = 0 THEN 'None' WHEN p_partkey % 11 = 1 THEN ''
              WHEN p_partkey % 11 = 2 THEN '1,234.56' WHEN p_partkey % 11 = 3 THEN 'nan'
              WHEN p_partkey % 11 = 4 THEN replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',')
              WHEN p_partkey % 11 = 5 THEN ' ' || CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)
              WHEN p_partkey % 97 = 50 THEN 'inf' WHEN p_partkey % 97 = 51 THEN '20000'
              WHEN p_partkey % 97 = 52 THEN '-3'
              ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
         CASE WHEN p_partkey % 5 = 0 THEN 'None' WHEN p_partkey % 5 = 1 THEN '4,' || (p_partkey % 10)
              ELSE '3.' || (p_partkey % 7) END AS rating,
         CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size * 3 AS VARCHAR) END AS review_count,
         CASE WHEN p_partkey % 6 = 0 THEN '' ELSE CAST(p_size AS VARCHAR) END AS stock_quantity,
         CASE p_partkey % 3 WHEN 0 THEN 'None' WHEN 1 THEN 'in stock' ELSE NULL END AS availability,
         'None' AS shop_country,
         'https://' || CASE p_partkey % 8 WHEN 0 THEN 'GymShark' WHEN 1 THEN 'culturekings' ELSE 'shop' END
           || '.example.com/p/' || p_partkey AS url,
         'a.csv' AS _source_file, p_partkey AS _pos
  FROM part
), dirty AS (
  SELECT * FROM first
  UNION ALL BY NAME
  SELECT * REPLACE (price || '1' AS price, 'b.csv' AS _source_file) FROM first WHERE _pos % 3 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY product_id, title ORDER BY _source_file DESC, _pos DESC) AS rn FROM dirty
), kept AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1)"""


def sql_number(c: str) -> str:
    t = f"trim(replace({c}, ',', '.'), ' ')"
    return (f"CASE WHEN regexp_full_match({t}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
            f"THEN TRY_CAST({t} AS DOUBLE) END")


TYPED_SQL = DIRTY_SQL + f""", typed AS (
  SELECT * REPLACE ({sql_number('price')} AS price, {sql_number('rating')} AS rating,
                    {sql_number('review_count')} AS review_count, {sql_number('stock_quantity')} AS stock_quantity)
  FROM kept
)"""

SQL_UNIT = "(('0x' || substr(md5('{salt}|' || {key}), 1, 8))::BIGINT + 0.5e0) / 4294967296e0"
KEY = "(coalesce(product_id, '') || '|' || coalesce(title, ''))"


def unit(salt: str, key: str = KEY) -> str:
    return SQL_UNIT.format(salt=salt, key=key)


def gauss(salt: str, key: str = KEY) -> str:
    return f"sqrt(-2e0 * ln({unit(salt + '-r', key)})) * cos(6.283185307179586e0 * {unit(salt + '-a', key)})"


IMPUTED_SQL = TYPED_SQL + f""", med AS (
  SELECT median(price) AS mp, median(rating) AS mr FROM typed
), imputed AS (
  SELECT product_id, title, category, brand, coalesce(price, mp, 0) AS price, coalesce(rating, mr, 4) AS rating,
         coalesce(review_count, 0) AS review_count, coalesce(stock_quantity, 0) AS stock_quantity,
         CASE WHEN availability IS NULL OR availability = 'None' THEN 'unknown' ELSE availability END AS availability,
         CASE WHEN contains(lower(url), 'gymshark') THEN 'UK' WHEN contains(lower(url), 'culturekings') THEN 'AU'
              ELSE 'US' END AS shop_country,
         coalesce(review_count, 0) * (10 + floor({unit('traffic')} * 90)) AS traffic, url
  FROM typed CROSS JOIN med
)"""

CLEAN_COLUMNS = ("product_id", "title", "price", "rating", "review_count", "stock_quantity", "availability",
                 "shop_country", "traffic")


def kept_dirty(spark, sf_dir):
    return C.keep_last(dirty(spark, sf_dir), ["product_id", "title"], ["_source_file", "_pos"])


@REG.query("dedupe_keep_last", f"WITH {DIRTY_SQL} SELECT product_id, title, price, _source_file FROM kept")
def _(spark, sf_dir):
    return kept_dirty(spark, sf_dir).select("product_id", "title", "price", "_source_file")


@REG.query("dedupe_keep_first", f"""WITH {DIRTY_SQL}, keyed AS (
  SELECT *, coalesce(nullif(product_id, ''), CASE WHEN _pos % 2 = 0 THEN nullif(url, '') END) AS key FROM dirty
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY _source_file, _pos) AS rn FROM keyed
) SELECT product_id, title, price, _source_file FROM numbered WHERE rn = 1 OR key IS NULL""")
def _(spark, sf_dir):
    df = dirty(spark, sf_dir).withColumn("url", F.when(F.col("_pos") % 2 == 0, F.col("url")))
    return C.dedupe_first(df, ["_source_file", "_pos"], ["product_id", "url"]).select(
        "product_id", "title", "price", "_source_file")


@REG.query("parse_numbers", f"WITH {TYPED_SQL} SELECT product_id, title, price, rating, review_count, "
                            "stock_quantity FROM typed")
def _(spark, sf_dir):
    df = kept_dirty(spark, sf_dir)
    return df.select("product_id", "title", *[
        text_to_double(F.col(c)).alias(c) for c in ("price", "rating", "review_count", "stock_quantity")])


@REG.query("column_flags", f"""WITH {TYPED_SQL} SELECT count(*) AS n,
  coalesce(bool_and(rating IS NULL), true) OR bool_and(coalesce(rating = 0, false)) AS rating_synthetic,
  coalesce(bool_and(review_count IS NULL), true) OR bool_and(coalesce(review_count <= 1, false)) AS reviews_synthetic,
  bool_and(shop_country IS NULL OR shop_country IN ('', 'None')) AS country_missing,
  true AS traffic_missing FROM typed""")
def _(spark, sf_dir):
    return C.column_flags(C.typed(kept_dirty(spark, sf_dir)))


@REG.query("impute_missing", f"""WITH {IMPUTED_SQL} SELECT coalesce(product_id, '') AS product_id, title, price,
  rating, review_count, stock_quantity, availability, shop_country, traffic FROM imputed""")
def _(spark, sf_dir):
    return C.impute(C.typed(kept_dirty(spark, sf_dir))).select(*CLEAN_COLUMNS)


@REG.query("clean_products", f"""WITH {IMPUTED_SQL} SELECT coalesce(product_id, '') AS product_id, title, price, rating,
  review_count, stock_quantity, availability, shop_country, traffic
  FROM imputed WHERE price > 0 AND price < 10000 AND rating > 0""")
def _(spark, sf_dir):
    return C.clean(kept_dirty(spark, sf_dir)).select(*CLEAN_COLUMNS)


@REG.query("impute_synthetic", f"""WITH {PRODUCTS_SQL}, t AS (
  SELECT product_id, title, floor(exp(4e0 + 1.5e0 * {gauss('reviews')})) AS review_count,
         round(least(greatest(4.3e0 + 0.5e0 * {gauss('rating')}, 2.5e0), 5e0), 1) AS rating,
         10 + floor({unit('traffic')} * 90) AS spread FROM products
) SELECT product_id, rating, review_count, review_count * spread AS traffic FROM t""")
def _(spark, sf_dir):
    bare = demo.products(spark, sf_dir).select(
        "product_id", "title", F.lit(None).cast("double").alias("rating"), F.lit(0.0).alias("review_count"))
    return C.impute(bare).select("product_id", "rating", "review_count", "traffic")


@REG.query("union_by_name", """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS title, p_retailprice AS price,
  CAST(NULL AS DOUBLE) AS stock_quantity FROM part
  UNION ALL SELECT 's' || s_suppkey, s_name, NULL, s_acctbal FROM supplier""")
def _(spark, sf_dir):
    from vitrine.sources.raw import union_sources

    a = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"))
    b = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), "s_suppkey").alias("product_id"), F.col("s_name").alias("title"),
        F.col("s_acctbal").alias("stock_quantity"))
    return union_sources([a, b])


@REG.query("resolve_aliases", """SELECT p_partkey AS product_id, p_name AS title, p_retailprice AS price, p_size AS rating,
  p_type AS category, p_brand AS brand FROM part""")
def _(spark, sf_dir):
    from vitrine.schema import canonicalize

    return canonicalize(table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ID"), F.col("p_name").alias("Nom"), F.col("p_retailprice").alias("PRIX"),
        F.col("p_size").alias("score"), F.col("p_type").alias("Categorie"), F.col("p_brand").alias("brand")))


# --- features and scores ----------------------------------------------------------

@REG.query("normalize_features", f"""WITH {FEATURED_SQL} SELECT product_id, round(price_norm, 9) AS price_norm,
  round(rating_norm, 9) AS rating_norm, round(review_count_norm, 9) AS review_count_norm,
  round(stock_quantity_norm, 9) AS stock_quantity_norm, 0e0 AS constant_norm FROM featured""")
def _(spark, sf_dir):
    df = demo.products(spark, sf_dir).withColumn("constant", F.lit(7))
    out = X.normalize(df, ("price", "rating", "review_count", "stock_quantity", "constant"))
    return out.select("product_id", *[F.round(c, 9).alias(c) for c in out.columns if c.endswith("_norm")])


@REG.query("derive_features", f"""WITH {PRODUCTS_SQL}, p AS (
  SELECT *, CASE length(title) % 4 WHEN 0 THEN 'In Stock' WHEN 1 THEN 'instock' WHEN 2 THEN 'indisponible' END AS a,
         CASE WHEN length(title) % 3 = 0 THEN 0 ELSE stock_quantity END AS s FROM products)
  SELECT product_id, round(price / rating, 9) AS prix_par_rating, round(review_count * rating, 9) AS engagement,
    round(ln(1 + review_count), 9) AS log_reviews,
    CASE WHEN s > 0 OR coalesce(regexp_matches(lower(a), 'in.stock|true|yes|disponible'), false) THEN 1 ELSE 0 END
      AS disponible,
    CASE WHEN s > 0 OR coalesce(a IN ('In Stock', 'instock'), false) THEN 1 ELSE 0 END AS disponible_strict
  FROM p""")
def _(spark, sf_dir):
    n = F.length("title")
    df = demo.products(spark, sf_dir).withColumns({
        "availability": F.when(n % 4 == 0, "In Stock").when(n % 4 == 1, "instock").when(n % 4 == 2, "indisponible"),
        "stock_quantity": F.when(n % 3 == 0, F.lit(0.0)).otherwise(F.col("stock_quantity"))})
    loose = X.derive(df)
    strict = X.derive(loose.withColumnRenamed("disponible", "_loose"), strict=True)
    return strict.select("product_id", *[
        F.round(c, 9).alias(c) for c in ("prix_par_rating", "engagement", "log_reviews")],
        F.col("_loose").alias("disponible"), F.col("disponible").alias("disponible_strict"))


@REG.query("composite_score", f"WITH {SCORED_SQL} SELECT product_id, composite_score FROM scored")
def _(spark, sf_dir):
    return scored(spark, sf_dir).select("product_id", "composite_score")


@REG.query("composite_score_contributions", f"""WITH {FEATURED_SQL} SELECT product_id,
  round(0.5e0 * rating_norm - 0.125e0 * price_norm + 0.375e0 * review_count_norm, 6) AS composite_score,
  round(-0.125e0 * price_norm, 6) AS price_contrib, round(0.5e0 * rating_norm, 6) AS rating_contrib,
  round(0.375e0 * review_count_norm, 6) AS review_count_contrib, 0e0 AS stock_quantity_contrib FROM featured""")
def _(spark, sf_dir):
    weights = {"price": -0.1, "rating": 0.4, "review_count": 0.3, "stock_quantity": 0.0}
    out = K.composite_score(demo.featured(spark, sf_dir), weights, contributions=True)
    names = [f"{c}_contrib" for c in K.DEFAULT_WEIGHTS]
    return out.select("product_id", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ["composite_score", *names]])


FLAGSHIP = f"""WITH {SCORED_SQL} SELECT product_id, title, category, brand, composite_score,
  row_number() OVER (ORDER BY composite_score DESC, product_id) AS rank
  FROM scored QUALIFY rank <= 100"""


@REG.query("flagship_top_100", FLAGSHIP)
def _(spark, sf_dir):
    return K.top_k(scored(spark, sf_dir), 100).select(
        "product_id", "title", "category", "brand", "composite_score", "rank")


@REG.query("ranked_head", f"""WITH {SCORED_SQL} SELECT row_number() OVER (ORDER BY composite_score DESC, product_id) AS rank,
  title, category, platform, price, round(rating, 9) AS rating, review_count, composite_score
  FROM scored QUALIFY rank <= 10""")
def _(spark, sf_dir):
    top = K.top_k(scored(spark, sf_dir).withColumn("rating", F.round("rating", 9)), 100)
    return K.ranked_head(top, 10)


@REG.query("top_n_per_category", f"""WITH {SCORED_SQL} SELECT category, product_id, composite_score,
  row_number() OVER (PARTITION BY category ORDER BY composite_score DESC, product_id) AS rank_in_group
  FROM scored QUALIFY rank_in_group <= 10""")
def _(spark, sf_dir):
    return K.top_n_per(scored(spark, sf_dir), "category", 10).select(
        "category", "product_id", "composite_score", "rank_in_group")


# --- filters ----------------------------------------------------------------------

@REG.query("bi_filter", f"""WITH {CLUSTERED_SQL} SELECT product_id, category, platform, cluster_kmeans, price, composite_score
  FROM clustered WHERE category = 'PROMO' AND cluster_kmeans IN (0, 2) AND platform = 'shopify'
  AND price BETWEEN 910 AND 1800 AND composite_score BETWEEN 0.05 AND 0.45""")
def _(spark, sf_dir):
    return L.bi_filter(clustered(spark, sf_dir), "PROMO", [0, 2], "shopify", (910, 1800), (0.05, 0.45)).select(
        "product_id", "category", "platform", "cluster_kmeans", "price", "composite_score")


@REG.query("filter_options", f"""WITH {CLUSTERED_SQL}
  SELECT DISTINCT 'category' AS option, category AS value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi FROM clustered
  UNION ALL SELECT DISTINCT 'cluster_kmeans', CAST(cluster_kmeans AS VARCHAR), NULL, NULL FROM clustered
  UNION ALL SELECT DISTINCT 'platform', platform, NULL, NULL FROM clustered
  UNION ALL SELECT 'price', NULL, min(price), max(price) FROM clustered
  UNION ALL SELECT 'composite_score', NULL, min(composite_score), max(composite_score) FROM clustered""")
def _(spark, sf_dir):
    return L.filter_options(clustered(spark, sf_dir))


@REG.query("search_products", f"""WITH {SCORED_SQL}, hits AS (
  SELECT * FROM scored WHERE (regexp_matches(lower(title), 'ring|b.lt') OR regexp_matches(lower(description), 'ring|b.lt')
    OR regexp_matches(lower(category), 'ring|b.lt') OR regexp_matches(lower(brand), 'ring|b.lt')
    OR regexp_matches(lower(platform), 'ring|b.lt') OR regexp_matches(lower(currency), 'ring|b.lt')
    OR regexp_matches(lower(_source_file), 'ring|b.lt') OR regexp_matches(product_id, 'ring|b.lt'))
    AND lower(category) = 'promo' AND price >= 905 AND price <= 1900)
  SELECT title, category, price, round(rating, 9) AS rating, composite_score, product_id,
    (SELECT count(*) FROM hits) AS total FROM hits ORDER BY product_id LIMIT 50""")
def _(spark, sf_dir):
    page = L.search_page(scored(spark, sf_dir), 50, query=" Ring|b.lt ", category="Promo", price_min=905,
                         price_max=1900)
    return page.withColumn("rating", F.round("rating", 9))


WORDS = "|".join(L.NON_PHYSICAL_WORDS)


@REG.query("non_physical_words", f"""SELECT doc_id,
  regexp_matches(lower(text), '(^|[^\\pL\\pN\\pM_])({WORDS})($|[^\\pL\\pN\\pM_])') AS anywhere,
  regexp_matches(lower(substr(text, 1, 500)), '(^|[^\\pL\\pN\\pM_])({WORDS})($|[^\\pL\\pN\\pM_])') AS in_lead
  FROM documents""")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", L.has_non_physical_word(F.col("text")).alias("anywhere"),
        L.has_non_physical_word(F.substring("text", 1, L.DESCRIPTION_LEAD)).alias("in_lead"))


@REG.query("drop_non_physical", f"""SELECT doc_id, price FROM (
  SELECT doc_id, text, CASE doc_id % 4 WHEN 0 THEN '1500,01' WHEN 1 THEN '1500' WHEN 2 THEN 'call us' ELSE '12.5' END
    AS price FROM documents)
  WHERE NOT regexp_matches(lower(text), '(^|[^\\pL\\pN\\pM_])({WORDS})($|[^\\pL\\pN\\pM_])') AND price <> '1500,01'""")
def _(spark, sf_dir):
    k = F.col("doc_id") % 4
    priced = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("description"),
        F.when(k == 0, "1500,01").when(k == 1, "1500").when(k == 2, "call us").otherwise("12.5").alias("price"))
    return L.drop_non_physical(priced, lead=None).select("doc_id", "price")


@REG.query("on_sale", """SELECT p_partkey, p_size % 3 <> 0 AND p_size % 3 <> 1 AS is_on_sale FROM part""")
def _(spark, sf_dir):
    from vitrine.sources.payloads import is_on_sale

    k = F.col("p_size") % 3
    price = F.col("p_retailprice").cast("string")
    promo = F.when(k == 0, "").when(k == 1, price).otherwise(F.concat(price, F.lit("0")))
    return table(spark, sf_dir, "part").select("p_partkey", is_on_sale(promo, price).alias("is_on_sale"))


@REG.query("drop_null_rows", f"""SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id)
  WHERE quality IS NOT NULL AND nullif(lang, 'en') IS NOT NULL""")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"))
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left").dropna(
        subset=["quality", "lang"]).select("doc_id", "quality")
