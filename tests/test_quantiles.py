import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vitrine.operators import quantiles as Q


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6) | st.just(3.0), min_size=1, max_size=60), st.floats(0, 1))
def test_equals_numpy(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = Q.quantiles(df, "v", {"q": p}).first()
    assert got["n"] == len(values)
    assert got["q"] == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_brackets_are_exact(spark, monkeypatch, hot):
    """With brackets forced on, a skewed column with a hot value is still exact."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 10)
    rng = np.random.default_rng(7)
    values = np.round(rng.lognormal(3, 2, 20_000), 3)
    values[: int(hot * len(values))] = 20.0
    df = spark.createDataFrame([(float(v), int(i % 3 > 0)) for i, v in enumerate(values)], "v double, g int").repartition(8)
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 0.999, "f": 1.0}
    got = Q.quantiles(df, "v", probs, accuracy=200).first()
    for name, p in probs.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    groups = np.arange(len(values)) % 3 > 0
    for row in Q.quantiles(df, "v", probs, by=["g"], accuracy=200).collect():
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values[groups == bool(row["g"])], p), rel=1e-12)


@pytest.mark.parametrize("kind", ["missed", "wide"])
def test_brackets_are_narrowed_round_by_round(spark, monkeypatch, kind):
    """A sketch that always points elsewhere, and brackets far above what may be listed: several rounds, still exact."""
    monkeypatch.setattr(Q, "SMALL_GROUP", 10)
    monkeypatch.setattr(Q, "GRID", 8)
    monkeypatch.setattr(Q, "FEW", 5)
    rounds, real = [], Q.cut_counted
    monkeypatch.setattr(Q, "cut_counted", lambda df, value: rounds.append(1) or real(df, value))
    if kind != "missed":
        monkeypatch.setattr(Q, "listed_up_to", lambda accuracy: 100)
    if kind != "wide":
        true = F.percentile_approx
        # The first sketch, of plain values, is turned round: what it calls low is high.
        monkeypatch.setattr(Q.F, "percentile_approx", lambda c, p, a: true(c, [1 - x for x in p] if isinstance(c, str) else p, a))
    rng = np.random.default_rng(3)
    values = np.round(rng.lognormal(2, 2, 3_000), 2)
    values[:900], values[900:1_000] = 20.0, 1e9
    df = spark.createDataFrame([(float(v), None if i % 3 else i % 2) for i, v in enumerate(values)], "v double, g int").repartition(4)
    probs = {"a": 0.001, "b": 0.5, "c": 0.95}
    got = Q.quantiles(df, "v", probs, accuracy=50).first()
    assert len(rounds) >= 5
    keys = np.array([-1 if i % 3 else i % 2 for i in range(len(values))])
    grouped = {-1 if r["g"] is None else r["g"]: r for r in Q.quantiles(df, "v", probs, by=["g"], accuracy=50).collect()}
    assert set(grouped) == {-1, 0, 1}
    for row, own in [(got, values), *[(grouped[g], values[keys == g]) for g in grouped]]:
        ordered = np.sort(own)
        assert row["n"] == len(own)
        for name, p in probs.items():
            h = p * (len(own) - 1)
            a, b = ordered[int(np.floor(h))], ordered[int(np.ceil(h))]
            assert row[name] == (pytest.approx(a + (h - np.floor(h)) * (b - a), rel=1e-12) if a < b < np.inf else a if a == b < np.inf else row[name])


def test_empty_and_null_only(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert Q.quantiles(df, "v", {"q": 0.5}).first()["q"] is None
    assert Q.quantiles(df, "v", {"q": 0.5}, by=["v"]).count() == 0


def test_column_quantiles(spark):
    df = spark.range(11).select(F.col("id").alias("a"), (F.col("id") * 2).cast("double").alias("b"))
    assert tuple(Q.column_quantiles(df, ["a", "b"]).first()) == (5.0, 10.0)
