import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vitrine.operators import cluster as C
from vitrine.operators import components as P
from vitrine.operators import near_boxes as N
from vitrine.operators import silhouette as H
from vitrine.operators.components import components, number_in_order
from vitrine.operators.dbscan import dbscan


def brute_dbscan(points, eps, min_samples):
    near = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= min_samples
    labels = np.full(len(points), -1)
    current = 0
    for i in range(len(points)):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = current
        while stack:
            j = stack.pop()
            if core[j]:
                for m in np.flatnonzero(near[j] & (labels == -1)):
                    labels[m] = current
                    stack.append(m)
        current += 1
    return labels


def cloud(seed, dims):
    rng = np.random.default_rng(seed)
    blobs = [rng.normal(rng.uniform(-2, 2, dims), 0.15, (70, dims)) for _ in range(4)]
    hot = np.repeat(rng.uniform(-2, 2, (1, dims)), 120, axis=0)
    return np.round(np.vstack([*blobs, rng.uniform(-3, 3, (60, dims)), hot]), 3)


@pytest.mark.parametrize("dims,eps", [(2, 0.12), (3, 0.3), (6, 0.6)])
def test_dbscan_equals_brute_force(spark, dims, eps):
    points = cloud(dims, dims)
    names = [f"f{i}" for i in range(dims)]
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)],
                               "product_id int, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {r.product_id: r.cluster_dbscan for r in dbscan(df, names, eps).collect()}
    assert [got[i] for i in range(len(points))] == list(brute_dbscan(points, eps, 5))


def test_components(spark):
    pairs = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (20, 11), (11, 30), (30, 12), (12, 4)]
    nodes = spark.createDataFrame([(n,) for n in {n for p in pairs for n in p} | {99}], "node int")
    got = {r.node: r.root for r in components(nodes, spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {**{n: 1 for n in (1, 2, 3, 4, 11, 12, 20, 30)}, **{n: 7 for n in (7, 8, 9)}, 5: 5, 99: 99}


def test_long_path_is_one_component(spark):
    n = 300
    nodes = spark.range(n).select(F.col("id").alias("node"))
    edges = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(nodes, edges).collect()} == {0}


@pytest.mark.parametrize("dims,radius,boxes_per_region", [(2, 0.1, 20), (8, 0.6, 30), (5, 0.0, 8), (3, 50.0, 4)])
def test_near_boxes_by_brute_force(spark, monkeypatch, dims, radius, boxes_per_region):
    monkeypatch.setattr(N, "REGION_BOXES", boxes_per_region)
    monkeypatch.setattr(N, "STEP", 500)
    rng = np.random.default_rng(dims)
    lo = np.round(rng.normal(size=(300, dims)), 1)
    hi = lo + rng.integers(0, 2, (300, dims)) * 0.1
    names = [f"{e}{i}" for e in ("lo", "hi") for i in range(dims)]
    df = spark.createDataFrame([(i, *a, *b, i * 2) for i, (a, b) in enumerate(zip(lo.tolist(), hi.tolist()))],
                               "id int, " + ", ".join(f"{n} double" for n in names) + ", n int").repartition(4)
    got = N.near_boxes(df, "id", names[:dims], names[dims:], radius, ["n", "lo0"]).collect()
    want = {(a, b) for a, b in zip(*np.nonzero(N.gap(lo[:, None], hi[:, None], lo, hi) <= radius * radius)) if a != b}
    assert len(got) == len(want) and {(r.a_id, r.b_id) for r in got} == want
    assert all(r.b_n == 2 * r.b_id and r.b_lo0 == lo[r.b_id, 0] for r in got)


@pytest.mark.parametrize("depth", [1, 10])
def test_dbscan_where_boxes_leave_pairs_open(spark, monkeypatch, depth):
    """Rings whose cells are full, at distances just under and just over the radius: sub-cells must be split again and again."""
    from vitrine.operators import dbscan as module

    monkeypatch.setattr(module, "DEPTH", depth)
    turn = np.linspace(0, 2 * np.pi, 600, endpoint=False)
    points = np.concatenate([np.stack([r * np.cos(turn), r * np.sin(turn)], 1) + [x, 0] for r, x in ((1.0, 0), (2.0999, 0), (3.2001, 0))])
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "product_id int, x double, y double")
    got = {r.product_id: r.cluster_dbscan for r in dbscan(df, ["x", "y"], 1.1, 3).collect()}
    assert [got[i] for i in range(len(points))] == list(brute_dbscan(points, 1.1, 3))


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 1000, 7).withColumnRenamed("id", "v").repartition(6)
    got = sorted(tuple(r) for r in number_in_order(df, "v", "i").collect())
    assert [i for _, i in got] == list(range(len(got)))


def brute_silhouette(points, labels, squared):
    d = ((points[:, None] - points[None]) ** 2).sum(-1)
    d = d if squared else np.sqrt(d)
    out = []
    for i, own in enumerate(labels):
        same = (labels == own)
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == o].mean() for o in set(labels) if o != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


@pytest.mark.parametrize("squared", [True, False])
def test_silhouette_equals_brute_force(spark, squared):
    points = cloud(1, 3)
    labels = np.append(np.arange(len(points) - 1) % 3, 7)
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(points, labels)], "x double, y double, z double, c int")
    got = H.silhouette(df, ["x", "y", "z"], "c", squared=squared).first()
    assert got["clusters"] == 4 and got["error_bound"] == 0.0
    assert got["silhouette"] == pytest.approx(brute_silhouette(points, labels, squared), abs=1e-9)


@pytest.mark.parametrize("tolerance,leaves,most", [(0.02, 300, 0.05), (0.0, 64, 0.2), (0.5, 1, 1.0), (1e-9, 5_000, 1e-6)])
def test_silhouette_lies_within_its_bound(spark, tolerance, leaves, most):
    rng = np.random.default_rng(6)
    # Clusters of very different sizes and widths, copies, a single row and a far one.
    points = np.concatenate([rng.normal(c, w, (n, 3)) for c, w, n in ((0, 1, 900), (3, 0.2, 500), (-8, 3, 60), (2, 1, 40), (500, 0, 1))])
    points[:100] = points[100]
    labels = np.repeat([4, 1, 2, 9, 7], [900, 500, 60, 40, 1])
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(points, labels)], "x double, y double, z double, c int").repartition(5)
    got = H.silhouette(df, ["x", "y", "z"], "c", tolerance=tolerance, leaves=leaves).first()
    assert (got["clusters"], got["n"]) == (5, len(points))
    assert abs(got["silhouette"] - brute_silhouette(points, labels, False)) <= got["error_bound"] + 1e-9
    assert got["error_bound"] <= most


def test_silhouette_opens_no_more_nodes_for_more_rows():
    """Nodes visited per row at one tolerance, for 4 times the rows."""
    visited = []
    for n in (2_000, 8_000):
        rng = np.random.default_rng(n)
        points, own = rng.normal(size=(n, 2)) + np.repeat([0, 4], n // 2)[:, None], np.repeat([0, 1], n // 2)
        forest = H.Forest.shaped(points, own, 2)
        forest.fill(pd.DataFrame({"leaf": forest.leaf(points, own), "n": 1, "q": 0.0, "a": 0.0, "b": 0.0}), ["a", "b"])
        seen, forest.mean = [], forest.mean.view(Counted)
        Counted.seen = seen
        forest.opened(points[::n // 50], own[::n // 50], 0.02)
        visited.append(sum(seen))
    assert visited[1] < 1.5 * visited[0]


class Counted(np.ndarray):
    """Counts the nodes whose first coordinate is looked up."""

    def __getitem__(self, key):
        if isinstance(key, tuple) and key[1] == 0:
            Counted.seen.append(len(key[0]))
        return np.asarray(super().__getitem__(key))


def test_silhouette_is_exact_over_many_vectors(spark):
    points = np.random.default_rng(3).normal(size=(8_300, 1))
    points[-50:] = points[:50]
    labels = np.append(np.arange(len(points) - 1) % 3, 7)
    df = spark.createDataFrame([(float(p), int(c)) for (p,), c in zip(points, labels)], "x double, c int")
    got = H.silhouette(df, ["x"], "c").first()
    assert (got["clusters"], got["n"], got["error_bound"]) == (4, len(points), 0.0)
    assert got["silhouette"] == pytest.approx(brute_silhouette(points, labels, False), abs=1e-9)


def test_silhouette_without_tolerance_is_exact_beyond_the_leaves(spark):
    """Several passes of several blocks; a cluster of one row, which most blocks do not have, and copies."""
    rng = np.random.default_rng(12)
    points = np.concatenate([rng.normal(c, w, (n, 2)) for c, w, n in ((0, 1, 500), (3, 0.2, 300), (500, 0, 1))])
    points[:40] = points[40]
    labels = np.repeat([4, 1, 7], [500, 300, 1])
    df = spark.createDataFrame([(*map(float, p), int(c)) for p, c in zip(points, labels)], "x double, y double, c int").repartition(5)
    got = H.silhouette(df, ["x", "y"], "c", leaves=64).first()
    assert (got["clusters"], got["n"], got["error_bound"]) == (3, len(points), 0.0)
    assert got["silhouette"] == pytest.approx(brute_silhouette(points, labels, False), abs=1e-9)


def test_silhouette_scores_copies_once(spark):
    points, rows = np.random.default_rng(8).normal(size=(300, 3)), []
    labels = np.arange(300) % 3
    for p, c in zip(points, labels):
        rows += [(*map(float, p), int(c))] * (c + 2)
    df = spark.createDataFrame(rows, "x double, y double, z double, c int")
    kept = H.labelled(df, ["x", "y", "z"], "c", None)
    assert kept.count() == 300 and kept.agg({"_w": "sum"}).first()[0] == len(rows)
    every = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows])
    for squared in (False, True):
        got = H.silhouette(df, ["x", "y", "z"], "c", squared=squared).first()
        assert got["n"] == len(rows) and got["silhouette"] == pytest.approx(brute_silhouette(*every, squared), abs=1e-9)


def test_sums_over_leaves_keep_their_digits():
    """Close points far from the origin, in more leaves than one step holds."""
    rng = np.random.default_rng(9)
    points, own = 1e4 + rng.normal(size=(6_000, 2)) * np.repeat([[1e-3], [50]], 3_000, 0), np.repeat([0, 1], 3_000)
    forest = H.Forest.shaped(points, own, 2)
    forest.fill(pd.DataFrame({"leaf": forest.leaf(points, own), "n": 1, "q": 0.0, "a": 0.0, "b": 0.0}), ["a", "b"])
    lo, _ = forest.totals(points[::500])
    want = [[np.sqrt(((p - points[own == c]) ** 2).sum(1)).sum() for c in (0, 1)] for p in points[::500]]
    assert np.allclose(lo, want, rtol=1e-9)


def test_silhouette_of_one_cluster(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0), (9.0, -1)], "x double, c int")
    assert H.silhouette(df, ["x"], "c", noise=-1).first()["silhouette"] == -1.0


def test_kmeans_labels_follow_the_norm(spark):
    rows = [(i, c + (i % 5) / 100) for i, c in enumerate([1.0, 50.0, 9.0] * 20)]
    df = spark.createDataFrame(rows, "product_id int, x double")
    got = {round(r.x): r.cluster_kmeans for r in C.kmeans(df, 3, ["x"]).collect()}
    assert got == {1: 0, 9: 1, 50: 2}
    best, scores = C.sweep_k(df, (2, 3), ["x"])
    assert max(scores, key=scores.get) == 3 and best.select("cluster_kmeans").distinct().count() == 3


def test_pca_equals_eigenvectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3)) @ np.array([[3, 1, 0], [0, 1, 0.5], [0, 0, 0.2]]) + 100
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "product_id int, a double, b double, c double")
    out, ratio = C.pca2(df, ["a", "b", "c"])
    got = np.array([[r.pca_1, r.pca_2] for r in out.orderBy("product_id").collect()])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    order = np.argsort(values)[::-1][:2]
    want = (x - x.mean(0)) @ vectors[:, order]
    for j in range(2):
        assert np.allclose(np.abs(got[:, j]), np.abs(want[:, j]), atol=1e-6)
    assert ratio == pytest.approx(values[order] / values.sum(), rel=1e-9)
    assert abs(got.mean()) < 1e-9


@pytest.mark.parametrize("task_edges", [500_000, 40, 3])
@pytest.mark.parametrize("kind", ["long", "string"])
def test_components_by_brute_force(spark, monkeypatch, task_edges, kind):
    """Chains, a star, repeated edges, loops and lone nodes, whole in one task or spread over many."""
    monkeypatch.setattr(P, "TASK_EDGES", task_edges)
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(70, 99)] + [(7, 7), (100, 99), (99, 100)]
    edges += [tuple(map(int, e)) for e in rng.integers(200, 400, (90, 2))]
    name = (lambda i: i) if kind == "long" else (lambda i: f"n{i:04d}é")
    parent = list(range(420))
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    nodes = spark.createDataFrame([(name(i),) for i in range(420)], f"node {kind}")
    linked = spark.createDataFrame([(name(a), name(b)) for a, b in edges], f"a {kind}, b {kind}").repartition(5)
    assert {r.node: r.root for r in P.components(nodes, linked).collect()} == {name(i): name(parent[i]) for i in range(420)}
    assert {(r.node, r.root) for r in P.components(nodes, linked.limit(0)).collect()} == {(name(i), name(i)) for i in range(420)}


def test_dbscan_broadcasts_nothing(spark, monkeypatch):
    """Every join names the side that is dealt out, so a small one is not held by the driver."""
    from vitrine.operators import components, dbscan as D
    sides = []
    for module in (components, D):
        monkeypatch.setattr(module, "met", lambda df: sides.append(1) or df.hint("merge"))
    df = spark.createDataFrame([(i, float(i % 20), float(i // 20)) for i in range(400)], "product_id int, x double, y double")
    out = D.dbscan(df, ["x", "y"], 1.5)
    assert out.count() == 400 and len(sides) >= 10
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The numbers of the partitions alone are broadcast, on purpose.
    assert plan.split("Initial Plan")[0].count("BroadcastHashJoin") <= 1
