"""Partitional clustering, projection and segment naming."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.silhouette import TOLERANCE, silhouette
from vitrine.operators.ward import ENTRIES, ward_fit
from vitrine.schema import CLUSTER_FEATURES, available
from vitrine.session import together

# Candidate numbers of clusters, and the limits of the segment tags.
CANDIDATE_K = (3, 4, 5)
HIERARCHICAL_K = 3
HIGH, LOW = 0.7, 0.3


def assign_to_centroids(df: DataFrame, features: Sequence[str], centroids: Mapping[int, Sequence[float]],
                        label: str = "cluster_kmeans") -> DataFrame:
    """Label of the nearest given centroid; equal distances go to the smaller label."""
    def squared(center: Sequence[float]) -> Column:
        total = F.lit(0.0)
        for name, x in zip(features, center):
            gap = F.col(name) - F.lit(float(x))
            total = total + gap * gap
        return total

    options = [F.struct(squared(c).alias("d"), F.lit(i).alias("i")) for i, c in sorted(centroids.items())]
    nearest = F.least(*options) if len(options) > 1 else options[0]
    return df.withColumn(label, nearest["i"])


def assembled(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Add the feature vector `_features`."""
    names = list(features or available(df, CLUSTER_FEATURES))
    return VectorAssembler(inputCols=names, outputCol="_features").transform(df)


def norm_order(centers) -> list[int]:
    """New number per centre, by distance from the origin, so labels do not depend on
    the order the algorithm found them in."""
    rows = [tuple(float(x) for x in c) for c in centers]
    ranked = sorted(range(len(rows)), key=lambda i: (sum(x * x for x in rows[i]), rows[i]))
    return [ranked.index(i) for i in range(len(rows))]


def renumbered(predicted: DataFrame, order: Sequence[int], label: str) -> DataFrame:
    """Replace the model's prediction by the stable label."""
    table = F.array(*[F.lit(i) for i in order])
    return predicted.withColumn(label, table[F.col("_p")]).drop("_p", "_features")


Labeller = Callable[[DataFrame], DataFrame]


def kmeans_fit(df: DataFrame, k: int = 3, features: Sequence[str] | None = None, seed: int = 42, label: str = "cluster_kmeans") -> Labeller:
    """K-means as a function that adds labels to a table; numbered by the norm of their centres."""
    names = list(features or available(df, CLUSTER_FEATURES))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_p", maxIter=100, tol=1e-4).fit(
        assembled(df.select(*names), names))
    order = norm_order(model.clusterCenters())
    return lambda rows: renumbered(model.transform(assembled(rows.drop(label), names)), order, label)


def kmeans(df: DataFrame, k: int = 3, features: Sequence[str] | None = None, seed: int = 42,
           label: str = "cluster_kmeans") -> DataFrame:
    """K-means labels, numbered by the norm of their centres."""
    return kmeans_fit(df, k, features, seed, label)(df)


def sweep_fit(df: DataFrame, ks: Sequence[int] = CANDIDATE_K, features: Sequence[str] | None = None,
              seed: int = 42, squared: bool = False, tolerance: float = TOLERANCE) -> tuple[Labeller, dict[int, float]]:
    """K-means for every k, keeping the one of the best silhouette; scores by k, Euclidean ones within the tolerance."""
    names = list(features or available(df, CLUSTER_FEATURES))

    def attempt(k: int) -> tuple[Labeller, float]:
        labeller = kmeans_fit(df, k, names, seed)
        return labeller, silhouette(labeller(df), names, squared=squared, tolerance=tolerance).first()["silhouette"]

    done = dict(zip(ks, together([partial(attempt, k) for k in ks])))
    scores = {k: value for k, (_, value) in done.items()}
    return done[max(scores, key=scores.get)][0], scores


def sweep_k(df: DataFrame, ks: Sequence[int] = CANDIDATE_K, features: Sequence[str] | None = None,
            seed: int = 42, squared: bool = False, tolerance: float = TOLERANCE) -> tuple[DataFrame, dict[int, float]]:
    """The rows with the labels of the best k, and the scores by k."""
    labeller, scores = sweep_fit(df, ks, features, seed, squared, tolerance)
    return labeller(df), scores


def hierarchical_fit(df: DataFrame, k: int = HIERARCHICAL_K, features: Sequence[str] | None = None, seed: int = 42,
                     label: str = "cluster_hierarchical", bisecting: bool = False, entries: int = ENTRIES) -> Labeller:
    """Ward's hierarchy over clustering features, cut at k clusters; or, with `bisecting`, divisive clustering by k-means.
    A function that adds labels to a table; clusters are numbered by centre norm."""
    names = list(features or available(df, CLUSTER_FEATURES))
    if not bisecting:
        return ward_fit(df, k, names, label, entries)
    model = BisectingKMeans(k=k, seed=seed, featuresCol="_features", predictionCol="_p").fit(
        assembled(df.select(*names), names))
    order = norm_order(model.clusterCenters())
    return lambda rows: renumbered(model.transform(assembled(rows.drop(label), names)), order, label)


def hierarchical(df: DataFrame, k: int = HIERARCHICAL_K, features: Sequence[str] | None = None, seed: int = 42,
                 label: str = "cluster_hierarchical", bisecting: bool = False, entries: int = ENTRIES) -> DataFrame:
    """The rows with their cluster in the hierarchy."""
    return hierarchical_fit(df, k, features, seed, label, bisecting, entries)(df)


def covariance(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """(a, b, cov) for every pair of features, a at or before b, from one aggregate."""
    names = list(features or available(df, CLUSTER_FEATURES))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    row = df.agg(*[F.covar_samp(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("cov")) for i, (a, b) in enumerate(pairs)])))


def pca2(df: DataFrame, features: Sequence[str] | None = None, keep: Sequence[str] = ("product_id", "cluster_kmeans")
         ) -> tuple[DataFrame, list[float]]:
    """Two principal components of the centred features per row, and the share of
    variance of each. The largest loading of a component is made positive."""
    names = list(features or available(df, CLUSTER_FEATURES))
    vectors = assembled(df, names)
    centred = StandardScaler(inputCol="_features", outputCol="_centred", withMean=True, withStd=False).fit(vectors)
    model = PCA(k=2, inputCol="_centred", outputCol="_pca").fit(centred.transform(vectors))
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(2)]
    parts = vector_to_array("_pca")
    out = model.transform(centred.transform(vectors)).select(*available(df, keep), *[
        (parts[j] * F.lit(s)).alias(f"pca_{j + 1}") for j, s in enumerate(signs)])
    return out, [float(v) for v in model.explainedVariance.toArray()]


def interpret(profile: DataFrame, cluster: str = "cluster_kmeans") -> DataFrame:
    """(cluster, tags) from a segment profile: price level, rating, stock."""
    has = set(profile.columns)
    tags = []
    if "price_norm" in has:
        tags.append(F.when(F.col("price_norm") > HIGH, "premium").when(F.col("price_norm") < LOW, "discount")
                    .otherwise("mid-range"))
    if "rating_norm" in has:
        tags.append(F.when(F.col("rating_norm") > HIGH, "top-rated"))
    if "stock_quantity_norm" in has:
        tags.append(F.when(F.col("stock_quantity_norm") > HIGH, "high-stock"))
    named = F.nullif(F.concat_ws(", ", *tags), F.lit("")) if tags else F.lit(None).cast("string")
    return profile.select(cluster, F.coalesce(named, F.lit("standard")).alias("tags"))
