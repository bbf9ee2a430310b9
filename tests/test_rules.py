import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.operators import itemsets as I
from vitrine.operators import rules as R

# Supports of published rules and the metrics that follow from them.
GOLDEN = [
    # sA, sC, sAC, confidence, lift, leverage, conviction, zhang, jaccard, certainty, kulczynski
    (0.024960726130214696, 0.9841159015534997, 0.024960726130214696, 1.0, 1.0161404753458674, 0.0003964786311484621,
     math.inf, 0.01629072681704262, 0.025363604114934372, 1.0, 0.5126818020574672),
    (0.9909233723162856, 0.9841159015534997, 0.9841159015534997, 0.9931301743878809, 1.0091597674828254,
     0.008932453636024018, 2.3121545354046535, 0.999999999999994, 0.9931301743878809, 0.5675029567930724,
     0.9965650871939404),
    (0.011345784604643043, 0.9841159015534997, 0.011171234072263921, 0.9846153846153848, 1.000507544955931,
     5.667027233815028e-06, 1.0324663990225302, 0.0005131091101696382, 0.011349530058521014, 0.031445477599336163,
     0.4979834638578875),
]
NAMES = ("confidence", "lift", "leverage", "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski")


@pytest.mark.parametrize("row", GOLDEN)
def test_metrics(spark, row):
    df = spark.createDataFrame([row[:3]], "sa double, sc double, sac double")
    metrics = R.rule_metrics(F.col("sa"), F.col("sc"), F.col("sac"))
    got = df.select(*[metrics[n].alias(n) for n in NAMES]).first()
    assert tuple(got) == pytest.approx(row[3:], rel=1e-6)


def baskets(spark, sets):
    return spark.createDataFrame([(str(i), list(s)) for i, s in enumerate(sets)], "transaction_id string, items array<string>")


def test_both_directions_and_thresholds(spark):
    df = baskets(spark, [("a", "b")] * 6 + [("a",)] * 4 + [("c",)] * 10)
    got = {(r.antecedents, r.consequents): r for r in R.pair_rules(df).collect()}
    assert set(got) == {("a", "b"), ("b", "a")}
    assert got["b", "a"].confidence == 1.0 and got["b", "a"].conviction == math.inf
    assert got["a", "b"].confidence == pytest.approx(0.6)
    assert all(r.confidence >= 0.5 and r.lift >= 1 for r in got.values())


def test_small_data_raises_the_support_floor(spark):
    df = baskets(spark, [("a", "b")] * 4 + [("a",)] * 4)
    assert R.pair_rules(df).count() == 0


def test_unlisted_items_take_the_join_path(spark, monkeypatch):
    rows = [(str(i % 40), f"i{(i * i) % 11}") for i in range(400)]
    long = spark.createDataFrame(rows, "transaction_id string, item string")
    listed = sorted(R.pair_rules(R.baskets_from_long(long, 0.1), 0.1, 0.1, 0.0).collect())
    monkeypatch.setattr(R, "MAX_LISTED_ITEMS", 2)
    joined = sorted(R.pair_rules(R.baskets_from_long(long, 0.1), 0.1, 0.1, 0.0).collect())
    assert listed and listed == joined


def test_hot_transaction_counts_once(spark):
    rows = [("hot", f"i{i % 5}") for i in range(3000)] + [(f"t{i}", f"i{i % 5}") for i in range(50)]
    long = spark.createDataFrame(rows, "transaction_id string, item string")
    found = R.baskets_from_long(long, 0.01).filter("transaction_id = 'hot'").first()
    assert sorted(found["items"]) == ["i0", "i1", "i2", "i3", "i4"]


def test_strength_and_labels(spark):
    df = spark.createDataFrame([(3.1,), (3.0,), (1.2,), (1.0,)], "lift double")
    assert [r[0] for r in df.select(R.strength(F.col("lift"))).collect()] == ["strong", "moderate", "weak", "not significant"]
    assert spark.range(1).select(R.itemset_label(F.array(F.lit("b"), F.lit("a")))).first()[0] == "a, b"


def test_unknown_metric_means_lift(spark):
    rules = R.pair_rules(baskets(spark, [("a", "b")] * 6 + [("c", "d")] * 9 + [("e",)] * 9))
    assert R.top_rules(rules, "nope", 1).first()["antecedents"] == "a"


def brute_itemsets(baskets, least, longest):
    counts = Counter(s for b in baskets for k in range(1, longest + 1) for s in itertools.combinations(sorted({x for x in b if x is not None}), k))
    return {s: n for s, n in counts.items() if n / len(baskets) >= max(least, 5 / len(baskets))}


@pytest.mark.parametrize("least,longest", [(0.02, None), (0.1, 3), (0.9, None), (0.02, 1)])
def test_itemsets_by_brute_force(spark, least, longest):
    rng = random.Random(5)
    # A third of all baskets are alike, some are empty or hold nulls and repeats.
    baskets = [["a", "b", "c", "d", "e"]] * 100 + [[], None, [None], ["a", "a", None, "b"]]
    baskets += [rng.sample("abcdefgh", rng.randrange(1, 7)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(baskets)), "transaction_id int, items array<string>").repartition(3)
    got = {tuple(r["items"]): (r["n"], r["length"], r["support"]) for r in I.frequent_itemsets(df, least, longest).collect()}
    want = brute_itemsets([b or [] for b in baskets], least, longest or 8)
    assert got == {s: (n, len(s), n / len(baskets)) for s, n in want.items()}
    pairs = {(r["a"], r["b"]): r["n_pair"] for r in R.itemset_counts(R.baskets_from_long(R.to_long(df), least), least)[1].collect()}
    if longest != 1 and least > 0.05:
        assert pairs == {s: n for s, (n, k, _) in got.items() if k == 2}


def test_itemsets_of_nothing(spark):
    assert I.frequent_itemsets(spark.createDataFrame([], "transaction_id int, items array<string>")).count() == 0


def test_itemsets_run_their_source_once(spark):
    from vitrine.operators import itemsets as I
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = [(i, ["a", "b"] if i % 2 else []) for i in range(40)]
    baskets = spark.createDataFrame(rows, "transaction_id int, items array<string>").mapInPandas(counted, "transaction_id int, items array<string>")
    got = {tuple(r["items"]): r["support"] for r in I.frequent_itemsets(baskets, 0.1).collect()}
    assert got == {("a",): 0.5, ("b",): 0.5, ("a", "b"): 0.5} and made.value == 40
