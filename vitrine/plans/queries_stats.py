"""Queries: statistics, reports and dashboard data."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.functions.numeric import round_dec
from vitrine.operators import features as X
from vitrine.operators import score as K
from vitrine.operators import sketches as H
from vitrine.operators import stats as S
from vitrine.plans.registry import Registry, r
from vitrine.session import fresh_path, one_row
from vitrine.sources import demo
from vitrine.sources.demo import CLUSTERED_SQL, PRODUCTS_SQL, SCORED_SQL, clustered, scored, table

REG = Registry()


def rounded(df, columns, digits=6):
    return df.withColumns({c: round_dec(F.col(c), digits) for c in columns})


@REG.query("score_distribution", f"""WITH {SCORED_SQL} SELECT count(composite_score) AS count,
  count(*) - count(composite_score) AS missing, min(composite_score) AS min, max(composite_score) AS max,
  {r('avg(composite_score)', 7)} AS mean, {r('stddev_samp(composite_score)', 7)} AS std,
  {r('quantile_cont(composite_score, 0.25)', 7)} AS q25, {r('median(composite_score)', 7)} AS median,
  {r('quantile_cont(composite_score, 0.75)', 7)} AS q75 FROM scored""")
def _(spark, sf_dir):
    return rounded(S.distribution(scored(spark, sf_dir)), ("mean", "std", "q25", "median", "q75"), 7)


@REG.query("quantile_set", f"""WITH {SCORED_SQL} SELECT p,
  {r('quantile_cont(composite_score, p)', 7)} AS value FROM scored,
  (SELECT unnest([0.5e0, 0.8e0, 0.9e0, 0.95e0, 0.99e0]) AS p) GROUP BY p""".replace(
    "quantile_cont(composite_score, p)",
    "CASE p WHEN 0.5e0 THEN quantile_cont(composite_score, 0.5) WHEN 0.8e0 THEN quantile_cont(composite_score, 0.8) "
    "WHEN 0.9e0 THEN quantile_cont(composite_score, 0.9) WHEN 0.95e0 THEN quantile_cont(composite_score, 0.95) "
    "ELSE quantile_cont(composite_score, 0.99) END"))
def _(spark, sf_dir):
    return rounded(S.quantile_set(scored(spark, sf_dir), "composite_score"), ["value"], 7)


def _stat(c):
    return (f"SELECT '{c}' AS \"column\", count(*) AS total, {r(f'avg({c})', 2)} AS mean, {r(f'min({c})', 2)} AS min, "
            f"{r(f'max({c})', 2)} AS max, {r(f'median({c})', 2)} AS median, {r(f'stddev_samp({c})', 2)} AS std "
            "FROM scored")


@REG.query("catalogue_stats", f"WITH {SCORED_SQL} " + " UNION ALL ".join(_stat(c) for c in S.STAT_COLUMNS))
def _(spark, sf_dir):
    return S.catalogue_stats(scored(spark, sf_dir))


@REG.query("lineitem_quantiles", f"""SELECT l_returnflag, count(l_extendedprice) AS n,
  {r('quantile_cont(l_extendedprice, 0.1)', 6)} AS p10, {r('median(l_extendedprice)', 6)} AS p50,
  {r('quantile_cont(l_extendedprice, 0.999)', 6)} AS p999 FROM lineitem GROUP BY l_returnflag""")
def _(spark, sf_dir):
    cuts = S.quantiles(table(spark, sf_dir, "lineitem"), "l_extendedprice",
                       {"p10": 0.1, "p50": 0.5, "p999": 0.999}, by=["l_returnflag"])
    return rounded(cuts, ("p10", "p50", "p999"))


@REG.query("top_categories", """SELECT p_type AS value, count(*) AS n FROM part GROUP BY p_type
  ORDER BY n DESC, value LIMIT 10""")
def _(spark, sf_dir):
    return S.value_counts(table(spark, sf_dir, "part"), "p_type", 10)


@REG.query("platform_counts", f"""WITH {PRODUCTS_SQL} SELECT CASE platform WHEN 'shopify' THEN 'Shopify'
  WHEN 'woocommerce' THEN 'WooCommerce' END AS name, platform AS value, count(*) AS n FROM products GROUP BY platform""")
def _(spark, sf_dir):
    counts = S.value_counts(demo.products(spark, sf_dir), "platform")
    return counts.withColumn("name", X.mapped(F.col("value"), X.PLATFORM_NAMES))


@REG.query("cluster_counts", f"""WITH {CLUSTERED_SQL} SELECT cluster_kmeans AS value, count(*) AS n
  FROM clustered GROUP BY cluster_kmeans""")
def _(spark, sf_dir):
    return S.value_counts(clustered(spark, sf_dir), "cluster_kmeans", by_key=True)


@REG.query("top_k_category_counts", f"""WITH {SCORED_SQL}, top AS (
  SELECT * FROM scored ORDER BY composite_score DESC, product_id LIMIT 100)
  SELECT category AS value, count(*) AS n FROM top GROUP BY category ORDER BY n DESC, value LIMIT 15""")
def _(spark, sf_dir):
    return S.value_counts(K.top_k(scored(spark, sf_dir)), "category", 15)


@REG.query("cluster_report", f"""WITH {CLUSTERED_SQL}, cats AS (
  SELECT cluster_kmeans, category, count(*) AS n,
         row_number() OVER (PARTITION BY cluster_kmeans ORDER BY count(*) DESC, category) AS rn
  FROM clustered GROUP BY cluster_kmeans, category
), tops AS (
  SELECT cluster_kmeans, string_agg(category || '=' || n, ',' ORDER BY rn) AS top_categories FROM cats
  WHERE rn <= 3 GROUP BY cluster_kmeans
) SELECT cluster_kmeans AS cluster_id, count(*) AS count, {r('avg(price)', 6)} AS avg_price,
  {r('avg(rating)', 6)} AS avg_rating, {r('avg(composite_score)', 6)} AS avg_score,
  any_value(top_categories) AS top_categories FROM clustered JOIN tops USING (cluster_kmeans) GROUP BY cluster_kmeans""")
def _(spark, sf_dir):
    out = rounded(S.cluster_report(clustered(spark, sf_dir)), ("avg_price", "avg_rating", "avg_score"))
    pairs = F.transform("top_categories", lambda e: F.concat(e["value"], F.lit("="), e["n"].cast("string")))
    return out.withColumn("top_categories", F.array_join(pairs, ","))


@REG.query("segment_profile", f"""WITH {CLUSTERED_SQL} SELECT cluster_kmeans, """ + ", ".join(
    f"{r(f'avg({c})', 4)} AS {c}" for c in S.PROFILE_COLUMNS) + f""", count(*) AS count,
  {r('count(*) * 100e0 / (SELECT count(*) FROM clustered)', 1)} AS pct FROM clustered GROUP BY cluster_kmeans""")
def _(spark, sf_dir):
    return S.segment_profile(clustered(spark, sf_dir))


@REG.query("cluster_distribution", f"""WITH {CLUSTERED_SQL} SELECT cluster_kmeans, count(*) AS count,
  {r('count(*) * 100e0 / (SELECT count(*) FROM clustered)', 1)} AS pct FROM clustered GROUP BY cluster_kmeans""")
def _(spark, sf_dir):
    return S.cluster_distribution(clustered(spark, sf_dir))


@REG.query("country_stats", f"""WITH {SCORED_SQL}, c AS (
  SELECT *, CASE WHEN contains(_source_file, 'shopify') OR contains(_source_file, 'aggregated') THEN 'United States'
    WHEN contains(_source_file, 'woocommerce') THEN 'United Kingdom' ELSE 'Unknown' END AS country FROM scored)
  SELECT country, count(product_id) AS products, {r('avg(composite_score)', 6)} AS mean_score,
  CASE country WHEN 'United States' THEN 'USA' WHEN 'United Kingdom' THEN 'GBR' END AS iso FROM c GROUP BY country""")
def _(spark, sf_dir):
    return rounded(S.country_stats(scored(spark, sf_dir)), ["mean_score"])


@REG.query("source_country", """SELECT page_id, CASE WHEN contains(lower(url), 'shopify') OR contains(lower(url), 'aggregated')
  THEN 'United States' WHEN contains(lower(url), 'woocommerce') THEN 'United Kingdom' ELSE 'Unknown' END AS country
  FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'SHOPIFY-' WHEN 1 THEN 'woocommerce_' ELSE '' END || url AS url
        FROM pages)""")
def _(spark, sf_dir):
    k = F.col("page_id") % 3
    name = F.concat(F.when(k == 0, "SHOPIFY-").when(k == 1, "woocommerce_").otherwise(""), F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", X.source_country(name).alias("country"))


@REG.query("category_context", f"""WITH {SCORED_SQL} SELECT category, count(*) AS n, min(price) AS price_min,
  max(price) AS price_max, {r('avg(price)', 6)} AS price_mean, {r('avg(rating)', 6)} AS rating_mean,
  {r('avg(composite_score)', 6)} AS score_mean, {r('median(price)', 6)} AS price_median FROM scored GROUP BY category""")
def _(spark, sf_dir):
    out = S.category_context(scored(spark, sf_dir))
    return rounded(out, ("price_mean", "rating_mean", "score_mean", "price_median"))


@REG.query("category_clusters", f"""WITH {CLUSTERED_SQL} SELECT category, cluster_kmeans, count(*) AS n
  FROM clustered GROUP BY ALL""")
def _(spark, sf_dir):
    return S.category_clusters(clustered(spark, sf_dir))


@REG.query("catalogue_summary", f"""WITH {SCORED_SQL} SELECT count(*) AS n, {r('avg(composite_score)', 6)} AS mean_score,
  {r('avg(price)', 6)} AS mean_price, {r('avg(rating)', 6)} AS mean_rating, arg_min(currency, product_id) AS currency,
  CASE WHEN avg(rating) >= 4 THEN 'excellent' WHEN avg(rating) >= 3 THEN 'fair' ELSE 'weak' END AS verdict FROM scored""")
def _(spark, sf_dir):
    return rounded(S.catalogue_summary(scored(spark, sf_dir)), ("mean_score", "mean_price", "mean_rating"))


REPORT_SQL = f"""WITH {CLUSTERED_SQL}, top AS (SELECT * FROM clustered ORDER BY composite_score DESC, product_id LIMIT 100
), cats AS (SELECT category AS key, count(*)::DOUBLE AS value, row_number() OVER (ORDER BY count(*) DESC, category) AS position
  FROM top GROUP BY category QUALIFY position <= 3
), facts AS (SELECT count(*) AS n, avg(composite_score) AS s, avg(price) AS p, avg(rating) AS r, arg_min(currency, product_id) AS c FROM clustered
), lines AS (
  SELECT 'overview' AS section, 1 AS position, 'n' AS key, n::DOUBLE AS value, NULL::DOUBLE AS pct FROM facts
  UNION ALL SELECT 'overview', 2, 'top_k', (SELECT count(*) FROM top), NULL FROM facts
  UNION ALL SELECT 'overview', 3, 'mean_score', s, NULL FROM facts
  UNION ALL SELECT 'overview', 4, 'mean_price', p, NULL FROM facts
  UNION ALL SELECT 'overview', 5, 'mean_rating', r, NULL FROM facts
  UNION ALL SELECT 'currency', 1, c, NULL, NULL FROM facts
  UNION ALL SELECT 'trends', 2, CASE WHEN r >= 4 THEN 'excellent' WHEN r >= 3 THEN 'fair' ELSE 'weak' END, r, NULL FROM facts
  UNION ALL SELECT 'top_categories', position, key, value, NULL FROM cats
  UNION ALL SELECT 'trends', 1, key, value, NULL FROM cats WHERE position = 1
  UNION ALL SELECT 'clusters', row_number() OVER (ORDER BY cluster_kmeans), CAST(cluster_kmeans AS VARCHAR), count(*),
    {r('count(*) * 100e0 / any_value(n)', 1)} FROM clustered, facts GROUP BY cluster_kmeans)
SELECT section, position, key, {r('value', 6)} AS value, pct FROM lines"""


@REG.query("catalogue_report", REPORT_SQL)
def _(spark, sf_dir):
    df = clustered(spark, sf_dir)
    return rounded(S.catalogue_report(df, K.top_k(df, 100)), ("value",))


@REG.query("category_report", f"""WITH {CLUSTERED_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY composite_score DESC, product_id) AS rank FROM clustered
), best AS (SELECT category, string_agg(rank || ':' || title[:60] || ':' || review_count || ':' || cluster_kmeans, '; ' ORDER BY rank) AS best
  FROM ranked WHERE rank <= 10 GROUP BY category
), parts AS (SELECT category, string_agg(cluster_kmeans || '=' || n, ' ' ORDER BY cluster_kmeans) AS clusters
  FROM (SELECT category, cluster_kmeans, count(*) AS n FROM clustered GROUP BY ALL) GROUP BY category)
SELECT category, count(*) AS n, min(price) AS price_min, max(price) AS price_max, {r('avg(price)', 6)} AS price_mean,
  {r('median(price)', 6)} AS price_median, {r('avg(rating)', 6)} AS rating_mean, {r('avg(composite_score)', 6)} AS score_mean,
  any_value(clusters) AS clusters, any_value(best) AS best FROM clustered JOIN best USING (category) JOIN parts USING (category) GROUP BY category""")
def _(spark, sf_dir):
    out = S.category_report(clustered(spark, sf_dir))

    def joined(column, sep, *fields):
        text = F.transform(column, lambda e: F.concat_ws(sep, *[e[f].cast("string") for f in fields]))
        return F.array_join(text, "; " if sep == ":" else " ")

    out = out.withColumns({"clusters": joined("clusters", "=", "cluster", "n"), "best": joined("best", ":", "rank", "title", "review_count", "cluster_kmeans")})
    return rounded(out, ("price_mean", "price_median", "rating_mean", "score_mean"))


def stored_batches(spark, sf_dir):
    """Sketches of the scored products, one stored batch per source file, the first one stored twice."""
    df, table_path = scored(spark, sf_dir), fresh_path(spark, "sketches")
    for name in ("shopify_20260101_000000.csv", "woocommerce_20260102_000000.csv", "manual.csv", "manual.csv"):
        batch = df.filter(F.col("_source_file") == name)
        H.store(H.summed_up(batch, "composite_score", F.concat_ws("_", "category", "brand")), table_path, name)
    return df, H.merged(spark, table_path)


@REG.query("score_distribution_approx", f"""WITH {SCORED_SQL} SELECT count(*) AS n, min(composite_score) AS low, max(composite_score) AS high,
  {r('avg(composite_score)', 6)} AS mean, true AS q25_within, true AS median_within, true AS q75_within FROM scored""")
def _(spark, sf_dir):
    """Exact figures, and whether the rank of each quantile of the merged sketches is within the stated error."""
    df, sketch = stored_batches(spark, sf_dir)
    probs = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    found = H.distribution(sketch, probs)
    score, cuts = F.col("composite_score"), one_row(found)
    ranks = one_row(df.agg(*[f.alias(f"{name}_{end}") for name in probs for end, f in (
        ("below", F.count_if(score < F.lit(cuts[name]))), ("upto", F.count_if(score <= F.lit(cuts[name]))))]))
    within = {f"{name}_within": ranks[f"{name}_below"] <= (p + H.RANK_ERROR) * cuts["n"] and ranks[f"{name}_upto"] >= (p - H.RANK_ERROR) * cuts["n"]
              for name, p in probs.items()}
    return rounded(found.select("n", "low", "high", "mean", *[F.lit(v).alias(k) for k, v in within.items()]), ("mean",))


@REG.query("distinct_baskets_approx", f"""WITH {SCORED_SQL} SELECT count(*) AS n, true AS within FROM scored""")
def _(spark, sf_dir):
    """Whether the merged sketches' number of distinct baskets is within the stated error of the exact one."""
    df, sketch = stored_batches(spark, sf_dir)
    exact = one_row(df.agg(F.count_distinct(F.concat_ws("_", "category", "brand")).alias("n")))["n"]
    return H.distinct(sketch).select("n", (F.abs(F.col("distinct") - exact) <= H.COUNT_ERROR * exact).alias("within"))


@REG.query("rating_verdict", f"""WITH {PRODUCTS_SQL} SELECT brand, CASE WHEN avg(rating) >= 4 THEN 'excellent'
  WHEN avg(rating) >= 3 THEN 'fair' ELSE 'weak' END AS verdict,
  any_value(dom) AS dominant_category FROM products JOIN (
    SELECT brand, category AS dom, row_number() OVER (PARTITION BY brand ORDER BY count(*) DESC, category) AS rn
    FROM products GROUP BY brand, category QUALIFY rn = 1) USING (brand) GROUP BY brand""")
def _(spark, sf_dir):
    df = demo.products(spark, sf_dir)
    top = S.top_values_per(df, "brand", "category", 1).select(
        "brand", F.col("entries")[0]["value"].alias("dominant_category"))
    return df.groupBy("brand").agg(S.rating_verdict(F.avg("rating")).alias("verdict")).join(top, "brand")


@REG.query("marketing_context", f"""WITH {CLUSTERED_SQL}, top AS (
  SELECT * FROM clustered ORDER BY composite_score DESC, product_id LIMIT 100
), facts AS (
  SELECT 'overview' AS section, 'n' AS key, CAST(count(*) AS DOUBLE) AS value FROM clustered
  UNION ALL SELECT 'overview', 'price', avg(price) FROM clustered
  UNION ALL SELECT 'overview', 'rating', avg(rating) FROM clustered
  UNION ALL SELECT 'overview', 'composite_score', avg(composite_score) FROM clustered
  UNION ALL SELECT 'clusters', CAST(cluster_kmeans AS VARCHAR), count(*) FROM clustered GROUP BY cluster_kmeans
  UNION ALL (SELECT 'top_categories', category, count(*) AS n FROM top GROUP BY category ORDER BY n DESC, category LIMIT 3)
  UNION ALL (SELECT 'top_products', substr(title, 1, 60), composite_score FROM top
             ORDER BY composite_score DESC, product_id LIMIT 5)
) SELECT section, key, {r('value', 6)} AS value FROM facts""")
def _(spark, sf_dir):
    df = clustered(spark, sf_dir)
    return rounded(S.marketing_context(df, K.top_k(df)), ["value"])


@REG.query("box_stats", f"""WITH {CLUSTERED_SQL} SELECT cluster_kmeans, count(*) AS n, min(composite_score) AS min,
  max(composite_score) AS max, {r('quantile_cont(composite_score, 0.25)', 7)} AS q1,
  {r('median(composite_score)', 7)} AS median, {r('quantile_cont(composite_score, 0.75)', 7)} AS q3
  FROM clustered GROUP BY cluster_kmeans""")
def _(spark, sf_dir):
    return rounded(S.box_stats(clustered(spark, sf_dir)), ("q1", "median", "q3"), 7)


@REG.query("score_histogram", f"""WITH {SCORED_SQL}, e AS (
  SELECT min(composite_score) AS lo, max(composite_score) AS hi FROM scored)
  SELECT CAST(least(floor((composite_score - lo) * 20e0 / (hi - lo)), 19) + 1 AS INTEGER) AS bin, count(*) AS n
  FROM scored, e GROUP BY bin""")
def _(spark, sf_dir):
    return S.histogram(scored(spark, sf_dir))


# Fixed value: characters that separate words.
SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@REG.query("keyword_counts", f"""SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(lower(text), '{SPACES}')) AS word FROM documents)
  WHERE length(word) > 4 GROUP BY word""")
def _(spark, sf_dir):
    return S.keyword_counts(table(spark, sf_dir, "documents"), ["text"])


@REG.query("trend_facts", f"""WITH cats AS (
  SELECT source AS value, row_number() OVER (ORDER BY count(*) DESC, source) AS position FROM documents GROUP BY source
), words AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '{SPACES}')) AS word FROM documents)
  WHERE length(word) > 4 GROUP BY word ORDER BY n DESC, word LIMIT 1
) SELECT position, CASE position WHEN 1 THEN 'dominant_category' ELSE 'emerging_category' END AS kind, value
  FROM cats WHERE position <= 2 UNION ALL SELECT 3, 'recurring_keyword', word FROM words""")
def _(spark, sf_dir):
    return S.trend_facts(table(spark, sf_dir, "documents").withColumnRenamed("source", "category"), ["text"])


@REG.query("report_facts", f"""WITH {SCORED_SQL}, top AS (
  SELECT *, row_number() OVER (ORDER BY composite_score DESC, product_id) AS rank,
         CASE WHEN length(title) % 5 = 0 THEN NULL ELSE price END AS p FROM scored QUALIFY rank <= 10)
  SELECT count(*) AS n, {r('sum(coalesce(p, 0)) / count(*)', 6)} AS mean_price,
  arg_min(title, rank) AS best_name, arg_min(composite_score, rank) AS best_score FROM top""")
def _(spark, sf_dir):
    top = K.top_k(scored(spark, sf_dir), 10)
    bad = F.when(F.length("title") % 5 == 0, "n/a").otherwise(F.col("price").cast("string"))
    return rounded(S.report_facts(top.withColumn("price", bad)), ["mean_price"])


@REG.query("basket_counts", """SELECT count(DISTINCT p_type || '_' || p_brand) AS baskets, count(*) AS transactions
  FROM part""")
def _(spark, sf_dir):
    from vitrine.operators.rules import basket_key

    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    return part.agg(F.count_distinct(basket_key(part)).alias("baskets"), F.count(F.lit(1)).alias("transactions"))


@REG.query("bi_typed_load", f"""WITH {PRODUCTS_SQL} SELECT product_id, price,
  CASE WHEN review_count % 3 = 0 THEN 0 ELSE review_count END AS review_count FROM products""")
def _(spark, sf_dir):
    from vitrine.sources.stage import bi_typed

    raw = demo.products(spark, sf_dir).select(
        "product_id", F.col("price").cast("string").alias("price"),
        F.when(F.col("review_count") % 3 == 0, "None").otherwise(F.col("review_count").cast("string"))
        .alias("review_count"))
    return bi_typed(raw)
