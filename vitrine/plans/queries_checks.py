"""Queries: what has no SQL form of its own, by the properties that SQL can state of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import cluster as C
from vitrine.operators import score as K
from vitrine.operators import silhouette as H
from vitrine.operators import supervised as M
from vitrine.plans.queries_ml import SPLIT_SQL, stage_of, whole_run
from vitrine.plans.registry import Registry, r
from vitrine.schema import CLUSTER_FEATURES
from vitrine.session import fresh_path, one_row
from vitrine.sources import audit, raw
from vitrine.sources.demo import FEATURED_SQL, SCORED_SQL, featured, scored, table

REG = Registry()


@REG.query("raw_without_match", "SELECT count(*) AS n, true AS refused FROM part")
def _(spark, sf_dir):
    """A batch under another name than the pattern's is an error, not an empty table."""
    root = fresh_path(spark, "raw")
    part = table(spark, sf_dir, "part")
    part.select(F.col("p_partkey").cast("string").alias("product_id")).write.options(**raw.CSV_WRITE).csv(f"{root}/other.csv")
    try:
        raw.read_raw(spark, f"{root}/shop*.csv/*.csv")
        refused = False
    except FileNotFoundError:
        refused = True
    return part.agg(F.count(F.lit(1)).alias("n"), F.lit(refused).alias("refused"))


@REG.query("role_file", """SELECT r_name AS role, 'tools of ' || r_name AS description, n_name AS tool
  FROM region JOIN nation ON n_regionkey = r_regionkey""")
def _(spark, sf_dir):
    """A nested configuration file, a role per region and its nations as tools."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    roles = region.join(nation, region.r_regionkey == nation.n_regionkey).groupBy("r_name").agg(F.collect_list("n_name").alias("tools"))
    entry = F.struct(F.col("r_name").alias("key"), F.struct(F.concat(F.lit("tools of "), "r_name").alias("description"), "tools").alias("value"))
    whole = roles.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(entry)).alias("roles"))).alias("value"))  # one row per region
    path = fresh_path(spark, "roles")
    whole.write.text(path)
    return audit.read_roles(spark, path)


@REG.query("score_from_raw_columns", f"""WITH {FEATURED_SQL} SELECT product_id,
  round(-0.2e0 * price_norm + 0.4e0 * rating + 0.3e0 * review_count_norm + 0.1e0 * stock_quantity, 6) AS composite_score FROM featured""")
def _(spark, sf_dir):
    """A weight whose normalised column is missing reads the raw one."""
    df = featured(spark, sf_dir).drop("rating_norm", "stock_quantity_norm")
    return K.composite_score(df, digits=6).select("product_id", "composite_score")


@REG.query("target_by_first_score", f"""WITH {FEATURED_SQL}, s AS (SELECT product_id, price * 2 AS score FROM featured
  ), cut AS (SELECT quantile_cont(score, 0.8) AS c FROM s)
  SELECT product_id, 'score' AS score_column, CASE WHEN score >= c THEN 1 ELSE 0 END AS is_top_product FROM s, cut""")
def _(spark, sf_dir):
    """Without a composite score the next score column makes the target, before the normalised rating."""
    df = featured(spark, sf_dir).withColumn("score", F.col("price") * 2)
    return M.make_target(df).select("product_id", F.lit(M.score_column(df)).alias("score_column"), M.TARGET)


@REG.query("kmeans_properties", f"WITH {SCORED_SQL} SELECT count(*) AS n, 3 AS clusters, true AS nearest, true AS by_norm FROM scored")
def _(spark, sf_dir):
    """Rows are with the nearest mean (but for one in a thousand, as the search stops at a tolerance), numbered by its norm."""
    labelled = stage_of(C.kmeans(stage_of(scored(spark, sf_dir), "scored"), 3), "labelled")
    means = {x["cluster_kmeans"]: [x[f] for f in CLUSTER_FEATURES] for x in labelled.groupBy("cluster_kmeans").agg(
        *[F.avg(f).alias(f) for f in CLUSTER_FEATURES]).collect()}
    again = C.assign_to_centroids(labelled.withColumnRenamed("cluster_kmeans", "own"), CLUSTER_FEATURES, means, "near")
    norms = [sum(x * x for x in means[k]) for k in sorted(means)]
    return again.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("own").cast("int").alias("clusters"),
                     (F.count_if(F.col("own") == F.col("near")) >= 0.999 * F.count(F.lit(1))).alias("nearest"), F.lit(norms == sorted(norms)).alias("by_norm"))


@REG.query("kmeans_sweep_winner", f"""WITH {SCORED_SQL} SELECT count(*) AS n, 3 AS tried, true AS kept_best, true AS score_holds FROM scored""")
def _(spark, sf_dir):
    """The labels kept are those of the best k, and its score is within the tolerance of the exact one."""
    df = stage_of(scored(spark, sf_dir), "scored")
    out, by_k = C.sweep_k(df)
    exact = one_row(H.silhouette(stage_of(out, "labelled"), CLUSTER_FEATURES))
    best = max(by_k, key=by_k.get)
    holds = abs(exact["silhouette"] - by_k[best]) <= 0.02
    return out.agg(F.count(F.lit(1)).alias("n"), F.lit(len(by_k)).alias("tried"), F.lit(exact["clusters"] == best).alias("kept_best"),
                   F.lit(holds).alias("score_holds"))


TRACE = " + ".join(f"var_samp({c})" for c in CLUSTER_FEATURES)


@REG.query("pca_properties", f"""WITH {FEATURED_SQL} SELECT count(*) AS n, {r(TRACE, 4)} AS variance, true AS centred, true AS uncorrelated,
  true AS ordered FROM featured""")
def _(spark, sf_dir):
    """The variance of the projections over their shares is that of all features."""
    out, shares = C.pca2(stage_of(featured(spark, sf_dir), "featured"), keep=("product_id",))
    row = out.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("pca_1", "pca_2") for f in (F.avg, F.var_samp)],
                  F.covar_samp("pca_1", "pca_2").alias("together"))
    one, two = F.col("var_samp_pca_1"), F.col("var_samp_pca_2")
    total = ((one + two) / sum(shares)).cast("decimal(28,8)")
    return row.select("n", F.round(total, 4).cast("double").alias("variance"), ((F.abs("avg_pca_1") < 1e-6) & (F.abs("avg_pca_2") < 1e-6)).alias("centred"),
                      (F.abs("together") < 1e-6 * one).alias("uncorrelated"), (one >= two).alias("ordered"))


REPORT_SQL = f"""{SPLIT_SQL}, raw AS (SELECT -0.2e0 * price_norm + 0.4e0 * rating_norm + 0.3e0 * review_count_norm + 0.1e0 * stock_quantity_norm AS s
  FROM featured), facts AS (
  SELECT 'prepare' AS step, 'rows' AS metric, count(*)::DOUBLE AS value FROM scored
  UNION ALL SELECT 'score', 'count', count(s) FROM raw UNION ALL SELECT 'score', 'missing', count(*) - count(s) FROM raw
  UNION ALL SELECT 'score', 'min', min(s) FROM raw UNION ALL SELECT 'score', 'max', max(s) FROM raw
  UNION ALL SELECT 'score', 'mean', avg(s) FROM raw UNION ALL SELECT 'score', 'std', stddev_samp(s) FROM raw
  UNION ALL SELECT 'score', 'q25', quantile_cont(s, 0.25) FROM raw UNION ALL SELECT 'score', 'median', median(s) FROM raw
  UNION ALL SELECT 'score', 'q75', quantile_cont(s, 0.75) FROM raw UNION ALL SELECT 'score', 'top_k', least(count(*), 100) FROM raw
  UNION ALL SELECT 'classify', 'n_train', count(*) FROM marked WHERE NOT is_test UNION ALL SELECT 'classify', 'n_test', count(*) FROM marked WHERE is_test
  UNION ALL SELECT 'check', unnest(['models_compare', 'models_learn', 'folds_agree', 'labels_kept', 'silhouettes_hold', 'rules_exported', 'best_rules']), 1)
SELECT step, metric, {r('value', 5)} AS value FROM facts"""


@REG.query("run_report", f"WITH {REPORT_SQL}")
def _(spark, sf_dir):
    """The figures of a whole run that SQL can compute, and properties of the others."""
    run = whole_run(spark, sf_dir)
    shown = [(x["step"], x["metric"], x["value"]) for x in run["metrics"].collect()]
    value = {f"{step} {name}": v for step, name, v in shown}
    models = run["supervised"]["models"]
    by_metric = {x["metric"]: x for x in run["supervised"]["comparison"].collect()}
    f1 = {m: value[f"classify {m}_f1"] for m in models}
    harmonic = {m: 2 * by_metric["precision"][m] * by_metric["recall"][m] / (by_metric["precision"][m] + by_metric["recall"][m]) for m in models}
    kept = one_row(run["clustered"].agg(*[F.count_if(F.col(f"cluster_{m}").isNotNull()).alias(m) for m in run["silhouettes"]]))
    exact = {m: one_row(H.silhouette(run["clustered"], CLUSTER_FEATURES, f"cluster_{m}", noise=-1 if m == "dbscan" else None))["silhouette"]
             for m in run["silhouettes"]}
    exported = spark.read.option("header", True).csv(run["exports"]["rules"])
    lifts = [x["lift"] for x in run["best_rules"].collect()]
    every = run["rules"].count()
    checks = {
        "models_compare": all(abs(f1[m] - harmonic[m]) < 1e-9 for m in models) and set(models) == {"rf", "gbt"},
        "models_learn": all(value[f"classify {m}_accuracy"] >= 0.85 for m in models),
        "folds_agree": all(abs(value[f"classify {m}_cv_f1"] - f1[m]) < 0.25 for m in models),
        "labels_kept": all(kept[m] == value["prepare rows"] for m in run["silhouettes"]),
        "silhouettes_hold": all(abs(exact[m] - v) <= 0.02 for m, v in run["silhouettes"].items()),
        "rules_exported": exported.count() == every == value["associate rules"],
        "best_rules": len(lifts) == min(every, 10) and lifts == sorted(lifts, reverse=True) and (not lifts or lifts[0] == value["associate best_lift"]),
    }
    sql = [(step, name, v) for step, name, v in shown if (step == "score" or name in ("rows", "n_train", "n_test"))]
    rows = spark.createDataFrame(sql + [("check", name, float(ok)) for name, ok in checks.items()], "step string, metric string, value double")
    return rows.withColumn("value", F.round(F.col("value").cast("decimal(28,8)"), 5).cast("double"))
