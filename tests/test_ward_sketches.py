import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.operators import cluster as C
from vitrine.operators import sketches as K
from vitrine.operators import stats as S
from vitrine.operators import ward as W


def brute_ward(points, k):
    """All pairs of sets at every step: rises, and the sets left at k."""
    sets, rises, left = [[i] for i in range(len(points))], [], None
    while True:
        if len(sets) == k:
            left = sorted(sorted(s) for s in sets)
        if len(sets) == 1:
            return rises, left
        means = np.array([points[s].mean(0) for s in sets])
        n = np.array([len(s) for s in sets])
        rise = n[:, None] * n / (n[:, None] + n) * ((means[:, None] - means) ** 2).sum(-1)
        rise[np.arange(len(sets)), np.arange(len(sets))] = np.inf
        i, j = np.unravel_index(rise.argmin(), rise.shape)
        rises.append(rise[i, j])
        sets = [s for x, s in enumerate(sets) if x not in (i, j)] + [sets[i] + sets[j]]


def frame(spark, points):
    names = [f"x{i}" for i in range(points.shape[1])]
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "product_id int, " + ", ".join(f"{n} double" for n in names)).repartition(4), names


@pytest.mark.parametrize("k", [1, 3, 7])
def test_ward_equals_brute_force(spark, k):
    rng = np.random.default_rng(k)
    points = np.concatenate([rng.normal(c, 1, (n, 3)) for c, n in ((0, 40), (4, 25), (-6, 5))])
    points[:6] = points[6]  # copies are one entry of more rows
    rises, want = brute_ward(points, k)
    df, names = frame(spark, points)
    got = W.merge_table(df, names).orderBy("step").collect()
    # Copies merge at no rise; from there on the hierarchies are the same.
    assert np.allclose([r.rise for r in got[1:]], rises[6:]) and got[0].rise == pytest.approx(0) and got[-1].n == len(points)
    labels = {}
    for r in C.hierarchical(df, k, names).collect():
        labels.setdefault(r.cluster_hierarchical, []).append(r.product_id)
    assert sorted(sorted(s) for s in labels.values()) == want and set(labels) == set(range(k))
    norms = [np.linalg.norm(points[labels[c]].mean(0)) for c in range(k)]
    assert norms == sorted(norms)


def test_ward_over_fewer_entries(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(c, 0.3, (400, 2)) for c in (0, 5, 12)])
    df, names = frame(spark, points)
    labels = {r.product_id: r.cluster_hierarchical for r in C.hierarchical(df, 3, names, entries=40).collect()}
    assert [len({labels[i] for i in range(a, a + 400)}) for a in (0, 400, 800)] == [1, 1, 1] and len(set(labels.values())) == 3
    steps = W.merge_table(df, names, entries=40).collect()
    assert len(steps) == 40 and sum(r.rise for r in steps) == pytest.approx(((points - points.mean(0)) ** 2).sum())
    assert C.hierarchical(df, 3, names, bisecting=True).select("cluster_hierarchical").distinct().count() == 3


def test_ward_of_few_rows(spark):
    df, names = frame(spark, np.array([[1.0], [1.0], [1.0]]))
    assert {r.cluster_hierarchical for r in C.hierarchical(df, 3, names).collect()} == {0}
    assert C.hierarchical(df.limit(0), 3, names).count() == 0


def test_sketches_merge_over_batches(spark, tmp_path):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=30_000), np.full(10_000, 7.5)])
    rows = [(i, float(v), f"m{i % 9_000}", "ab"[i % 2]) for i, v in enumerate(values)] + [(-1, None, None, "a"), (-2, None, None, "empty")]
    df = spark.createDataFrame(rows, "i int, v double, m string, g string")
    table = str(tmp_path / "sketches")
    for batch in range(4):
        for _ in range(2):  # stored again: replaced, not added
            K.store(K.summed_up(df.filter(F.pmod("i", F.lit(4)) == batch), "v", F.col("m"), ["g"]), table, str(batch))
    probs = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    got = {r.g: r for r in K.distribution(K.merged(spark, table, ["g"]), probs, ["g"]).collect()}
    for at, g in enumerate("ab"):
        own = np.sort(values[at::2])
        r = got[g]
        assert (r.known, r.low, r.high) == (len(own), own[0], own[-1]) and r.mean == pytest.approx(own.mean()) and r.n == len(own) + (g == "a")
        for name, p in probs.items():
            lo, hi = np.searchsorted(own, r[name]) / len(own), np.searchsorted(own, r[name], "right") / len(own)
            assert lo <= p + K.RANK_ERROR and hi >= p - K.RANK_ERROR
    assert (got["empty"].n, got["empty"].known, got["empty"].p50, got["empty"].mean) == (1, 0, None, None)
    distinct = K.distinct(K.merged(spark, table)).first()
    assert distinct.n == len(rows) and abs(distinct.distinct - 9_000) <= K.COUNT_ERROR * 9_000


def test_reports_with_gaps(spark):
    """Null categories, clusters and prices; a top-k without rows."""
    rows = [("1", "t" * 80, None, 5.0, 4.0, 1, 0.5, None, "EUR"), ("2", "b", "c", None, 4.0, 1, 0.9, 1, "USD"), ("3", "c", "c", 2.0, 2.0, 3, None, 1, None),
            ("4", "d", "c", 4.0, 3.0, 3, 0.1, None, "EUR")]
    df = spark.createDataFrame(rows, "product_id string, title string, category string, price double, rating double, review_count int, "
                                     "composite_score double, cluster_kmeans int, currency string")
    lines = {(r.section, r.key): (r.value, r.pct) for r in S.catalogue_report(df, df.limit(0)).collect()}
    assert lines["overview", "n"] == (4.0, None) and lines["overview", "top_k"] == (0.0, None) and lines["clusters", "1"] == (2.0, 50.0)
    assert ("trends", "fair") in lines and not [k for k in lines if k[0] == "top_categories"]
    plain = S.catalogue_report(df.drop("cluster_kmeans"), df).collect()
    assert {(r.section, r.key) for r in plain if r.section in ("top_categories", "clusters")} == {("top_categories", "c")}
    got = {r.category: r for r in S.category_report(df).collect()}
    assert got["c"].n == 2 and got["c"].price_median == 3.0 and [b.title for b in got["c"].best] == ["d", "c"] and got["c"].clusters == [(1, 1)]
    assert got[None].n == 1 and len(got[None].best[0].title) == 60 and got[None].clusters == [] and got[None].price_median == 5.0
