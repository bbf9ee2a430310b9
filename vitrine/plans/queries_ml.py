"""Queries: supervised learning, clustering and end-to-end runs."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.functions.numeric import round_dec
from vitrine.operators import cluster as C
from vitrine.operators import evaluate as E
from vitrine.operators import silhouette as H
from vitrine.operators import stats as S
from vitrine.operators import supervised as M
from vitrine.operators import ward as W
from vitrine.operators.dbscan import dbscan
from vitrine.plans import full_run
from vitrine.plans.registry import Registry, r
from vitrine.schema import CLUSTER_FEATURES, NORM_COLUMNS
from vitrine.session import fresh_path
from vitrine.sources.demo import (CLUSTERED_SQL, FEATURED_SQL, PRODUCTS_SQL, SCORED_SQL, clustered, featured, products, scored,
                                  table)

REG = Registry()

# --- supervised ------------------------------------------------------------------------

TARGET_SQL = SCORED_SQL + """, cut AS (SELECT quantile_cont(composite_score, 0.8) AS c FROM scored), target AS (
  SELECT *, CASE WHEN composite_score >= c THEN 1 ELSE 0 END AS is_top_product FROM scored, cut)"""
HASH = "('0x' || substr(md5('split-42|' || product_id), 1, 13))::BIGINT"
SPLIT_SQL = TARGET_SQL + f""", counted AS (
  SELECT *, count(*) OVER (PARTITION BY is_top_product) AS n,
         row_number() OVER (PARTITION BY is_top_product ORDER BY {HASH}, product_id) AS rn FROM target
), marked AS (SELECT *, rn <= ceil(n * 0.3e0) AS is_test FROM counted)"""


def stage_of(df, label):
    """The query's input as a table of its own, as a run reads its stages."""
    from vitrine.sources.stage import write_stage

    return write_stage(df, fresh_path(df.sparkSession, label))


@REG.query("make_target", f"WITH {TARGET_SQL} SELECT product_id, is_top_product FROM target")
def _(spark, sf_dir):
    return M.make_target(scored(spark, sf_dir)).select("product_id", M.TARGET)


@REG.query("make_target_price", f"""WITH {PRODUCTS_SQL}, cut AS (SELECT quantile_cont(price, 0.95) AS c FROM products)
  SELECT product_id, CASE WHEN price >= c THEN 1 ELSE 0 END AS is_top_product FROM products, cut""")
def _(spark, sf_dir):
    return M.make_target(products(spark, sf_dir), 5, "price").select("product_id", M.TARGET)


@REG.query("feature_table", f"""WITH {FEATURED_SQL} SELECT product_id, round(engagement, 9) AS engagement,
  round(prix_par_rating, 9) AS prix_par_rating, round(log_reviews, 9) AS log_reviews,
  CAST(disponible AS DOUBLE) AS disponible, CASE WHEN length(title) % 2 = 0 THEN 12.5e0 ELSE 0 END AS discount_pct
  FROM featured""")
def _(spark, sf_dir):
    df = featured(spark, sf_dir).withColumn(
        "discount_pct", F.when(F.length("title") % 2 == 0, "12,5").otherwise("n/a"))
    out, names = M.feature_table(df)
    return out.select("product_id", *[F.round(c, 9).alias(c) for c in names])


@REG.query("stratified_split", f"WITH {SPLIT_SQL} SELECT product_id, is_top_product, is_test FROM marked")
def _(spark, sf_dir):
    out = M.split(M.make_target(scored(spark, sf_dir)))
    return out.select("product_id", M.TARGET, "is_test")


@REG.query("split_sizes", f"""WITH {SPLIT_SQL} SELECT is_top_product, is_test, count(*) AS n FROM marked GROUP BY ALL""")
def _(spark, sf_dir):
    out = M.split(M.make_target(scored(spark, sf_dir)))
    return out.groupBy(M.TARGET, "is_test").agg(F.count(F.lit(1)).alias("n"))


@REG.query("positive_rate", f"WITH {TARGET_SQL} SELECT {r('avg(is_top_product) * 100', 6)} AS positive_pct FROM target")
def _(spark, sf_dir):
    out = E.positive_rate(M.make_target(scored(spark, sf_dir)), M.TARGET)
    return out.select(round_dec(F.col("positive_pct"), 6).alias("positive_pct"))


COUNTS = """c AS (SELECT CAST(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp FROM labels)"""


def safe(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0e0 ELSE ({a}) / CAST(({b}) AS DOUBLE) END)"


@REG.query("binary_metrics", f"""WITH {COUNTS} SELECT tn, fp, fn, tp, round({safe('tp + tn', 'tp + tn + fp + fn')}, 9) AS accuracy,
  round({safe('tp', 'tp + fp')}, 9) AS precision, round({safe('tp', 'tp + fn')}, 9) AS recall,
  round({safe('2 * tp', '2 * tp + fp + fn')}, 9) AS f1 FROM c""")
def _(spark, sf_dir):
    out = E.binary_metrics(table(spark, sf_dir, "labels"), "quality", "toxic")
    return out.withColumns({c: F.round(c, 9) for c in ("accuracy", "precision", "recall", "f1")})


@REG.query("class_report", f"""WITH {COUNTS}, each AS (
  SELECT '0' AS class, {safe('tn', 'tn + fn')} AS precision, {safe('tn', 'tn + fp')} AS recall,
         {safe('2 * tn', '2 * tn + fn + fp')} AS f1, tn + fp AS support FROM c
  UNION ALL SELECT '1', {safe('tp', 'tp + fp')}, {safe('tp', 'tp + fn')}, {safe('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM c
), report AS (
  SELECT * FROM each
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM each
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support)::BIGINT FROM each
) SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM report""")
def _(spark, sf_dir):
    out = E.class_report(table(spark, sf_dir, "labels"), "quality", "toxic")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@REG.query("confusion_counts", """SELECT quality AS actual, toxic AS predicted, count(*) AS n FROM labels GROUP BY ALL""")
def _(spark, sf_dir):
    return E.confusion(table(spark, sf_dir, "labels"), "quality", "toxic")


def training(spark, sf_dir):
    """Split feature table, stored once, with its feature names."""
    rows, names = M.feature_table(M.make_target(scored(spark, sf_dir)))
    return stage_of(M.sized(M.assembled(M.split(rows), names)), "train")


def model_metrics(estimator, marked, balanced):
    train = M.with_weights(marked.filter("not is_test"), balanced)
    model = M.fitted(estimator, M.sized(train, work=M.FOREST_WORK if balanced else 1).persist())
    return E.binary_metrics(M.predict(model, marked.filter("is_test")), M.TARGET, "prediction")


@REG.query("forest_metrics")
def _(spark, sf_dir):
    return model_metrics(M.forest(), training(spark, sf_dir), True)


@REG.query("boosted_metrics")
def _(spark, sf_dir):
    return model_metrics(M.boosted(), training(spark, sf_dir), False)


def cross_validated(spark, sf_dir, estimator, balanced):
    train = M.sized(M.with_weights(training(spark, sf_dir).filter("not is_test"), balanced), work=M.FOREST_WORK if balanced else 1).persist()
    mean, std = M.cross_validate(estimator, train)
    train.unpersist()
    return spark.createDataFrame([(mean, std)], "f1_mean double, f1_std double")


@REG.query("forest_cross_validation")
def _(spark, sf_dir):
    return cross_validated(spark, sf_dir, M.forest(), True)


@REG.query("boosted_cross_validation")
def _(spark, sf_dir):
    return cross_validated(spark, sf_dir, M.boosted(), False)


@REG.query("model_save_load", f"WITH {SPLIT_SQL} SELECT count(*) AS n, true AS same FROM marked WHERE is_test")
def _(spark, sf_dir):
    from pyspark.ml.classification import RandomForestClassificationModel

    marked = training(spark, sf_dir)
    model = M.forest(trees=20, depth=8).fit(M.with_weights(marked.filter("not is_test"), True))
    path = M.save_models({"rf": model}, fresh_path(spark, "models"))["rf"]
    test = marked.filter("is_test")
    again = M.predict(RandomForestClassificationModel.load(path), test).select(
        "product_id", F.col("prediction").alias("again"))
    both = M.predict(model, test).join(again, "product_id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("prediction") == F.col("again")).alias("same"))


@REG.query("supervised_run")
def _(spark, sf_dir):
    return M.run(stage_of(scored(spark, sf_dir), "scored"))["comparison"]


# --- clustering --------------------------------------------------------------------------

@REG.query("assign_to_centroids", f"WITH {CLUSTERED_SQL} SELECT product_id, cluster_kmeans FROM clustered")
def _(spark, sf_dir):
    return clustered(spark, sf_dir).select("product_id", "cluster_kmeans")


@REG.query("kmeans_labels")
def _(spark, sf_dir):
    return C.kmeans(stage_of(scored(spark, sf_dir), "scored"), 3).select("product_id", "cluster_kmeans")


@REG.query("kmeans_sweep")
def _(spark, sf_dir):
    _, by_k = C.sweep_k(stage_of(scored(spark, sf_dir), "scored"))
    return spark.createDataFrame(list(by_k.items()), "k int, silhouette double")


def embedding_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    names = [f"e{i}" for i in range(64)]
    return rows.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]), names


@REG.query("embedding_kmeans")
def _(spark, sf_dir):
    df, names = embedding_columns(spark, sf_dir)
    return C.kmeans(df, 10, names).select("vec_id", "label", "cluster_kmeans")


@REG.query("hierarchical_labels")
def _(spark, sf_dir):
    return C.hierarchical(stage_of(scored(spark, sf_dir), "scored")).select("product_id", "cluster_hierarchical")


@REG.query("hierarchical_bisecting")
def _(spark, sf_dir):
    return C.hierarchical(stage_of(scored(spark, sf_dir), "scored"), bisecting=True).select("product_id", "cluster_hierarchical")


SPREAD = " + ".join(f"var_pop({c})" for c in CLUSTER_FEATURES)


@REG.query("ward_merges", f"""WITH {FEATURED_SQL}, whole AS (SELECT count(*) AS n, count(*) * ({SPREAD}) AS error FROM featured)
  SELECT n AS top_size, CAST(round(error, 0) AS BIGINT) AS error, true AS rising FROM whole""")
def _(spark, sf_dir):
    """The rises of all merges add up to the squared error of the table, and none is below the one before."""
    steps = W.merge_table(stage_of(featured(spark, sf_dir).select(*CLUSTER_FEATURES), "featured"), CLUSTER_FEATURES)
    last = F.lag("rise").over(Window.orderBy("step"))
    return steps.select("n", "rise", "step", ((F.col("step") < 2) | (F.col("rise") >= last - 1e-9)).alias("up")).agg(
        F.max("n").alias("top_size"), F.round(F.sum("rise"), 0).cast("long").alias("error"), F.bool_and("up").alias("rising"))


@REG.query("pca_projection")
def _(spark, sf_dir):
    return C.pca2(clustered(spark, sf_dir))[0]


@REG.query("feature_covariance", f"WITH {FEATURED_SQL} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {r(f'covar_samp({a}, {b})', 6)} AS cov FROM featured"
    for i, a in enumerate(CLUSTER_FEATURES) for b in CLUSTER_FEATURES[i:]))
def _(spark, sf_dir):
    return C.covariance(featured(spark, sf_dir)).withColumn("cov", round_dec(F.col("cov"), 6))


def silhouette_sql(base: str, rows: str, distance: str) -> str:
    """Brute force over all pairs of `rows` (id, label, ...)."""
    return f"""WITH {base}, pts AS MATERIALIZED ({rows}), sizes AS (SELECT label, count(*) AS n FROM pts GROUP BY label
), sums AS (
  SELECT p.id, p.label AS own, o.label AS other, sum({distance}) AS total FROM pts p, pts o GROUP BY p.id, p.label, o.label
), sides AS (
  SELECT id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
         min(CASE WHEN own <> other THEN total / n END) AS b FROM sums JOIN sizes ON sizes.label = other GROUP BY id
) SELECT (SELECT count(*) FROM sizes) AS clusters, count(*) AS n,
  round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 7) AS silhouette FROM sides"""


NORM_ROWS = "SELECT product_id AS id, cluster_kmeans AS label, " + ", ".join(NORM_COLUMNS) + " FROM clustered"
NORM_SQUARE = " + ".join(f"(p.{c} - o.{c}) * (p.{c} - o.{c})" for c in NORM_COLUMNS)


def shown(df):
    return df.select("clusters", "n", F.round("silhouette", 7).alias("silhouette"))


@REG.query("silhouette_squared", silhouette_sql(CLUSTERED_SQL, NORM_ROWS, NORM_SQUARE))
def _(spark, sf_dir):
    return shown(H.silhouette(clustered(spark, sf_dir), NORM_COLUMNS, squared=True))


@REG.query("silhouette_euclidean", silhouette_sql(CLUSTERED_SQL, NORM_ROWS, f"sqrt({NORM_SQUARE})"))
def _(spark, sf_dir):
    return shown(H.silhouette(clustered(spark, sf_dir), NORM_COLUMNS))


CERTIFIED_SQL = silhouette_sql(CLUSTERED_SQL, NORM_ROWS, f"sqrt({NORM_SQUARE})")


@REG.query("silhouette_certified", f"SELECT clusters, n, true AS within_bound, true AS narrow FROM ({CERTIFIED_SQL})")
def _(spark, sf_dir):
    """The bound of a coarse enclosure against the exact value."""
    df = stage_of(clustered(spark, sf_dir).select("cluster_kmeans", *NORM_COLUMNS), "clustered")
    exact = H.silhouette(df, NORM_COLUMNS).first()["silhouette"]
    coarse = H.silhouette(df, NORM_COLUMNS, tolerance=0.01, leaves=1_024)
    return coarse.select("clusters", "n", (F.abs(F.col("silhouette") - exact) <= F.col("error_bound") + 1e-9).alias("within_bound"),
                         F.col("error_bound").between(1e-6, 0.05).alias("narrow"))


@REG.query("silhouette_embeddings", silhouette_sql(
    "e AS (SELECT vec_id, label, embedding::DOUBLE[64] AS v FROM embeddings)", "SELECT vec_id AS id, label, v FROM e",
    "array_distance(p.v, o.v)"))
def _(spark, sf_dir):
    df, names = embedding_columns(spark, sf_dir)
    return shown(H.silhouette(df, names, "label"))


def dbscan_sql(eps: float, min_samples: int, features=NORM_COLUMNS) -> str:
    e2 = repr(eps * eps)
    square = " + ".join(f"(p.{c} - o.{c}) * (p.{c} - o.{c})" for c in features)
    return f"""WITH RECURSIVE {FEATURED_SQL}, pts AS MATERIALIZED (
  SELECT product_id AS id, {', '.join(features)} FROM featured
), near AS MATERIALIZED (SELECT p.id AS a, o.id AS b FROM pts p, pts o WHERE {square} <= {e2}
), core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= {min_samples}
), links AS MATERIALIZED (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core) AND a <> b
), cc(id, root) USING KEY (id) AS (
  SELECT id, id FROM core
  UNION
  SELECT l.b, min(cc.root) FROM cc JOIN links l ON l.a = cc.id JOIN recurring.cc AS seen ON seen.id = l.b
  WHERE cc.root < seen.root GROUP BY l.b
), border AS (
  SELECT a AS id, min(root) AS root FROM near JOIN cc ON cc.id = b WHERE a NOT IN (FROM core) GROUP BY a
), rooted AS (SELECT id, root FROM cc UNION ALL SELECT id, root FROM border
), numbered AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS c FROM (SELECT DISTINCT root FROM cc)
) SELECT pts.id AS product_id, CAST(coalesce(c, -1) AS INTEGER) AS cluster_dbscan
  FROM pts LEFT JOIN rooted ON rooted.id = pts.id LEFT JOIN numbered USING (root)"""


@REG.query("dbscan_fine", dbscan_sql(0.08, 5))
def _(spark, sf_dir):
    return dbscan(stage_of(featured(spark, sf_dir), "featured"), NORM_COLUMNS, 0.08).select("product_id", "cluster_dbscan")


@REG.query("dbscan_coarse", dbscan_sql(0.1, 5))
def _(spark, sf_dir):
    return dbscan(stage_of(featured(spark, sf_dir), "featured"), NORM_COLUMNS, 0.1).select("product_id", "cluster_dbscan")


@REG.query("dbscan_all_features", dbscan_sql(1.0, 5, CLUSTER_FEATURES))
def _(spark, sf_dir):
    return dbscan(stage_of(featured(spark, sf_dir), "featured"), CLUSTER_FEATURES, 1.0).select("product_id", "cluster_dbscan")


@REG.query("interpret_segments", f"""WITH {CLUSTERED_SQL}, profile AS (
  SELECT category, {r('avg(price_norm)', 4)} AS p, {r('avg(rating_norm)', 4)} AS rt, {r('avg(stock_quantity_norm)', 4)} AS s
  FROM clustered GROUP BY category)
  SELECT category, concat_ws(', ', CASE WHEN p > 0.7 THEN 'premium' WHEN p < 0.3 THEN 'discount' ELSE 'mid-range' END,
    CASE WHEN rt > 0.7 THEN 'top-rated' END, CASE WHEN s > 0.7 THEN 'high-stock' END) AS tags FROM profile""")
def _(spark, sf_dir):
    return C.interpret(S.segment_profile(clustered(spark, sf_dir), "category"), "category")


@REG.query("silhouette_by_method")
def _(spark, sf_dir):
    df = stage_of(scored(spark, sf_dir), "scored")
    out, scores = full_run.segment(df, full_run.Settings())
    return spark.createDataFrame(list(scores.items()), "method string, silhouette double")


RUNS = {}


def whole_run(spark, sf_dir):
    """One run per session and input, which its report shares."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in RUNS:
        RUNS[key] = new_run(spark, sf_dir)
    return RUNS[key]


def new_run(spark, sf_dir):
    raw = products(spark, sf_dir).select(
        "product_id", "title", "description", "category", "brand", "platform", "currency", "_source_file",
        *[F.col(c).cast("string").alias(c) for c in ("price", "rating", "review_count", "stock_quantity")])
    return full_run.run(spark, raw, fresh_path(spark, "run"))


@REG.query("run_all_steps")
def _(spark, sf_dir):
    return whole_run(spark, sf_dir)["metrics"]
