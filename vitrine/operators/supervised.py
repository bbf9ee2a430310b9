"""High-potential product classifiers: target, split, training, cross-validation.

The target is a threshold on a score that is itself computed from rating, reviews,
price and stock, as most features are: a near-perfect F1 shows that leak, not skill.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial
from statistics import fmean, pstdev

from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.hashing import hash32, hash52
from vitrine.functions.numeric import as_number
from vitrine.operators.evaluate import binary_metrics
from vitrine.operators.quantiles import order_statistics, quantiles
from vitrine.schema import BASE_FEATURES, OPTIONAL_FEATURES, available
from vitrine.session import one_row, together

SEED = 42
ROW_KEY = ("product_id", "title")
TARGET = "is_top_product"
# Score columns in order of preference, and the training parameters.
SCORE_COLUMNS = ("composite_score", "score", "rating_norm")
TOP_PERCENT, TEST_SHARE, FOLDS, TREES = 20, 0.3, 5, 100
FOREST_DEPTH, BOOST_DEPTH, BOOST_STEP = 10, 6, 0.3
ROWS_PER_PART, SMALL_PART, FOREST_WORK = 200_000, 5_000, 10


def score_column(df: DataFrame) -> str:
    """The first score column the table has."""
    found = available(df, SCORE_COLUMNS)
    if not found:
        raise KeyError("no score column among " + ", ".join(SCORE_COLUMNS))
    return found[0]


def make_target(df: DataFrame, top_percent: float = TOP_PERCENT, score: str | None = None) -> DataFrame:
    """Add the label: score at or above its (100 - top_percent) percentile."""
    score = score or score_column(df)
    cut = one_row(quantiles(df.select(as_number(df, score).alias("s")), "s", {"cut": 1 - top_percent / 100.0}))["cut"]
    return df.withColumn(TARGET, F.coalesce(as_number(df, score) >= F.lit(cut), F.lit(False)).cast("int"))


def feature_table(df: DataFrame, keep: Sequence[str] = (*ROW_KEY, TARGET)) -> tuple[DataFrame, list[str]]:
    """Available features as numbers, bad or missing values as 0."""
    names = available(df, BASE_FEATURES + OPTIONAL_FEATURES)
    out = df.select(*available(df, keep), *[F.coalesce(as_number(df, c), F.lit(0.0)).alias(c) for c in names])
    return out, names


def split(df: DataFrame, label: str = TARGET, key: Sequence[str] = ("product_id",), test_share: float = TEST_SHARE,
          seed: int = SEED) -> DataFrame:
    """Add `is_test`, marking ceil(share * n) rows of each class.

    The rows with the smallest key hashes of a class are its test rows: the hash of
    that rank is found by counting, so no class is sorted or gathered.
    """
    hashed = df.withColumn("_h", hash52(F.concat_ws("|", *key), f"split-{seed}"))
    edges = order_statistics(
        hashed, "_h", [("edge", test_share, lambda n: F.ceil(n * F.lit(float(test_share))) - 1)], by=[label], max_groups=2)
    limits = {r[label]: r["edge"] for r in edges.limit(3).collect()}
    if len(limits) > 2:
        raise ValueError("the label must have two classes")
    edge = F.lit(None).cast("double")
    for value, limit in limits.items():
        edge = F.when(F.col(label) == value, F.lit(limit)).otherwise(edge)
    return hashed.withColumn("is_test", F.coalesce(F.col("_h") <= edge, F.lit(False))).drop("_h")


def with_weights(df: DataFrame, balanced: bool, label: str = TARGET) -> DataFrame:
    """Add `_weight`: n / (2 n_class) when balanced, else neg / pos on positives."""
    n = one_row(df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("pos")))
    pos, neg = max(n["pos"], 1), max(n["n"] - n["pos"], 1)
    if balanced:
        up, down = n["n"] / (2.0 * pos), n["n"] / (2.0 * neg)
    else:
        up, down = (n["n"] - n["pos"]) / pos, 1.0
    return df.withColumn("_weight", F.when(F.col(label) == 1, F.lit(float(up))).otherwise(F.lit(float(down))))


def assembled(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(names), outputCol="_features").transform(df)


def sized(table: DataFrame, partitions: int | None = None, work: int = 1) -> DataFrame:
    """The narrow training table in parts of about ROWS_PER_PART rows, or more parts, up
    to the cores, while each still has work: the table is read once per tree level, and
    parts that are too small cost more than the work in them."""
    n = table.count()
    cores = table.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, -(-n // ROWS_PER_PART), min(-(-n * work // SMALL_PART), cores))
    return table.repartition(partitions or wanted)


def forest(trees: int = TREES, depth: int = FOREST_DEPTH, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="_features", labelCol=TARGET, weightCol="_weight", numTrees=trees,
                                  maxDepth=depth, seed=seed, maxBins=32, maxMemoryInMB=512, cacheNodeIds=True)


def boosted(trees: int = TREES, depth: int = BOOST_DEPTH, seed: int = SEED) -> GBTClassifier:
    return GBTClassifier(featuresCol="_features", labelCol=TARGET, weightCol="_weight", maxIter=trees, maxDepth=depth,
                         stepSize=BOOST_STEP, seed=seed, maxBins=32, maxMemoryInMB=512)


def fold_of(df: DataFrame, folds: int, key: Sequence[str] = ("product_id",)) -> DataFrame:
    """Add `_fold` from the key's hash."""
    return df.withColumn("_fold", (hash32(F.concat_ws("|", *key), "fold") % folds).cast("int"))


def fitted(estimator, rows: DataFrame):
    """The model of the weighted rows. Boosting sees equal rows of a class only through the sum of their weights, so these are one row;
    a forest draws every row for itself, and gets them all."""
    if not isinstance(estimator, GBTClassifier):
        return estimator.fit(rows)
    alike = sized(rows.groupBy("_features", TARGET).agg(F.sum("_weight").alias("_weight"))).persist()
    try:
        return estimator.fit(alike)
    finally:
        alike.unpersist()


def fold_f1(estimator, folded: DataFrame, fold: int) -> float:
    """F1 of class 1 on one fold, trained on the others."""
    model = fitted(estimator, folded.filter(F.col("_fold") != fold))
    held_out = predict(model, folded.filter(F.col("_fold") == fold))
    return float(one_row(binary_metrics(held_out, TARGET, "prediction"))["f1"])


def cross_validate(estimator, train: DataFrame, folds: int = FOLDS, key: Sequence[str] = ("product_id",)) -> tuple[float, float]:
    """Mean and standard deviation of the positive-class F1 over hash folds."""
    folded = fold_of(train, folds, key)
    return mean_std(together([partial(fold_f1, estimator, folded, i) for i in range(folds)]))


def mean_std(scores: Sequence[float]) -> tuple[float, float]:
    return fmean(scores), pstdev(scores)


def predict(model, rows: DataFrame) -> DataFrame:
    """Rows with their prediction as an integer."""
    out = model.transform(rows).withColumn("prediction", F.col("prediction").cast("int"))
    return out.drop("_features", "rawPrediction", "probability", "_weight")


def comparison(results: dict[str, DataFrame]) -> DataFrame:
    """(metric, one column per model) of accuracy, precision, recall and f1."""
    names = ("accuracy", "precision", "recall", "f1")
    rows = {m: one_row(r) for m, r in results.items()}
    spark = next(iter(results.values())).sparkSession
    table = [(n, *[float(rows[m][n]) for m in results]) for n in names]
    return spark.createDataFrame(table, "metric string, " + ", ".join(f"{m} double" for m in results))


def run(df: DataFrame, folds: int = FOLDS, top_percent: float = TOP_PERCENT, test_share: float = TEST_SHARE,
        trees: int = TREES, forest_depth: int = FOREST_DEPTH, partitions: int | None = None) -> dict:
    """Target, split, both models, their metrics and cross-validation scores.

    All fits and folds are independent and run side by side. `partitions` overrides
    how many parts the cached training table has.
    """
    table, names = feature_table(make_target(df, top_percent))
    key = available(table, ROW_KEY)
    marked = assembled(split(table, key=key, test_share=test_share), names)
    marked = sized(marked, partitions).persist()
    train, test = marked.filter("not is_test"), marked.filter("is_test")
    estimators = {"rf": forest(trees, forest_depth), "gbt": boosted(trees)}
    weighted = {m: fold_of(with_weights(train, balanced=m == "rf"), max(folds, 1), key) for m in estimators}
    scored_folds = range(folds if folds > 1 else 0)
    weighted["rf"] = sized(weighted["rf"], partitions, FOREST_WORK).persist()
    tasks = [partial(fitted, e, weighted[m]) for m, e in reversed(estimators.items())]
    tasks += [partial(fold_f1, e, weighted[m], i) for m, e in reversed(estimators.items()) for i in scored_folds]
    done = together(tasks)
    models = dict(zip(reversed(estimators), done))
    scores = {m: done[2 + j * folds:2 + (j + 1) * folds] for j, m in enumerate(reversed(estimators))} if scored_folds else {}
    metrics = {m: binary_metrics(predict(models[m], test), TARGET, "prediction") for m in estimators}
    out = {
        "feature_cols": names, "n_train": train.count(), "n_test": test.count(), "models": models, "metrics": metrics,
        "cv": {m: mean_std(s) for m, s in scores.items()}, "comparison": comparison(metrics),
    }
    weighted["rf"].unpersist()
    marked.unpersist()
    return out


def save_models(models: dict, root: str) -> dict[str, str]:
    """Store every model under its name."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in models}
    for name, model in models.items():
        model.write().overwrite().save(paths[name])
    return paths


