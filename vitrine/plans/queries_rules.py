"""Queries: association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine.operators import itemsets as I
from vitrine.operators import rules as R
from vitrine.plans.registry import Registry
from vitrine.sources.demo import CLUSTERED_SQL, clustered, table

REG = Registry()

BRANDS_SQL = """long AS (
  SELECT DISTINCT l_orderkey AS tid, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey)"""
PRODUCT_SQL = CLUSTERED_SQL + """, long AS (
  SELECT product_id AS tid, trim(category) || '_' || trim(brand) AS item FROM clustered
  UNION ALL SELECT product_id, 'cluster_kmeans_' || cluster_kmeans FROM clustered)"""


def rules_sql(base: str, support: float, confidence: float, lift: float) -> str:
    """CTEs up to `rules`, from a distinct long table `long`."""
    return f"""WITH {base}, total AS (
  SELECT CAST(count(DISTINCT tid) AS DOUBLE) AS n FROM long
), fl AS (SELECT n, greatest({support}, 5e0 / greatest(n, 1)) AS floor FROM total
), single AS (SELECT item, count(*) AS c FROM long GROUP BY item
), freq AS (SELECT item, c FROM single, fl WHERE c / n >= floor
), pair AS (
  SELECT a.item AS a, b.item AS b, count(*) AS c FROM long a JOIN long b ON a.tid = b.tid AND a.item < b.item
  GROUP BY a.item, b.item
), freqpair AS (SELECT a, b, c FROM pair, fl WHERE c / n >= floor
), directed AS (
  SELECT a AS antecedents, b AS consequents, c FROM freqpair UNION ALL SELECT b, a, c FROM freqpair
), s AS (
  SELECT antecedents, consequents, x.c / n AS sa, y.c / n AS sc, d.c / n AS sac
  FROM directed d JOIN freq x ON x.item = antecedents JOIN freq y ON y.item = consequents, fl
), rules AS (
  SELECT *, sac / sa AS conf, sac / sa / sc AS lift FROM s
  WHERE sac / sa >= {confidence} AND sac / sa / sc >= {lift})"""


ROUND = 9
METRICS_SQL = f"""round(sa, {ROUND}) AS antecedent_support, round(sc, {ROUND}) AS consequent_support,
  round(sac, {ROUND}) AS support, round(conf, {ROUND}) AS confidence, round(lift, {ROUND}) AS lift,
  1e0 AS representativity, round(sac - sa * sc, {ROUND}) AS leverage,
  CASE WHEN conf >= 1 THEN 'Infinity'::DOUBLE ELSE round((1 - sc) / (1 - conf), {ROUND}) END AS conviction,
  round((sac - sa * sc) / greatest(sac * (1 - sa), sa * (sc - sac)), {ROUND}) AS zhangs_metric,
  round(sac / (sa + sc - sac), {ROUND}) AS jaccard, round((conf - sc) / (1 - sc), {ROUND}) AS certainty,
  round((sac / sa + sac / sc) / 2, {ROUND}) AS kulczynski"""


def order_baskets(spark, sf_dir):
    """(transaction_id, item): the brands in every order."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("l_orderkey").alias("transaction_id"), F.col("p_brand").alias("item"))


def brand_rules(spark, sf_dir, confidence=0.1):
    baskets = R.baskets_from_long(order_baskets(spark, sf_dir), 0.01)
    return R.pair_rules(baskets, 0.01, confidence, 1.0)


def shown(rules):
    out = rules.select("antecedents", "consequents", *[
        F.col(c).alias(c.replace(" ", "_")) for c in R.RULE_METRICS])
    digits = [c for c in out.columns if c not in ("antecedents", "consequents", "conviction")]
    return out.withColumns({c: F.round(c, ROUND) for c in digits}).withColumn(
        "conviction", F.when(F.col("conviction") == float("inf"), F.col("conviction"))
        .otherwise(F.round("conviction", ROUND)))


@REG.query("product_transactions", f"WITH {PRODUCT_SQL} SELECT tid AS transaction_id, item FROM long")
def _(spark, sf_dir):
    return R.to_long(R.transactions(clustered(spark, sf_dir)))


@REG.query("order_brand_pairs", f"""WITH {BRANDS_SQL} SELECT a.item AS a, b.item AS b, count(*) AS n_pair
  FROM long a JOIN long b ON a.tid = b.tid AND a.item < b.item GROUP BY a.item, b.item
  HAVING count(*) >= 0.01 * (SELECT count(DISTINCT tid) FROM long)""")
def _(spark, sf_dir):
    baskets = R.baskets_from_long(order_baskets(spark, sf_dir), 0.01)
    return R.itemset_counts(baskets, 0.01)[1]


@REG.query("frequent_items", f"""{rules_sql(PRODUCT_SQL, 0.003, 0, 0)} SELECT item, c AS n_item FROM freq""")
def _(spark, sf_dir):
    return R.itemset_counts(R.transactions(clustered(spark, sf_dir)), 0.003)[0]


def itemsets_sql(support: float) -> str:
    """Sets of one to four brands, by self-joins of the long table."""
    joins = {k: " ".join(f"JOIN long t{i} ON t{i}.tid = t1.tid AND t{i - 1}.item < t{i}.item" for i in range(2, k + 1)) for k in range(1, 5)}
    names = {k: " || ', ' || ".join(f"t{i}.item" for i in range(1, k + 1)) for k in range(1, 5)}
    levels = " UNION ALL ".join(f"SELECT {names[k]} AS items, {k} AS length, count(*) AS n FROM long t1 {joins[k]} GROUP BY 1" for k in joins)
    return f"""WITH {BRANDS_SQL}, total AS (SELECT count(DISTINCT tid)::DOUBLE AS baskets FROM long), sets AS ({levels})
  SELECT items, length, n, round(n / baskets, {ROUND}) AS support FROM sets, total
  WHERE n / baskets >= greatest({support}, 5e0 / greatest(baskets, 1))"""


@REG.query("frequent_itemsets", itemsets_sql(0.0003))
def _(spark, sf_dir):
    baskets = R.gather(order_baskets(spark, sf_dir).dropDuplicates())
    return I.frequent_itemsets(baskets, 0.0003, 4).select(
        F.array_join("items", ", ").alias("items"), "length", "n", F.round("support", ROUND).alias("support"))


@REG.query("brand_rules", f"{rules_sql(BRANDS_SQL, 0.01, 0.1, 1.0)} SELECT antecedents, consequents, {METRICS_SQL} FROM rules")
def _(spark, sf_dir):
    return shown(brand_rules(spark, sf_dir))


@REG.query("brand_rules_any_confidence", f"""{rules_sql(BRANDS_SQL, 0.01, 0, 1.0)}
  SELECT antecedents, consequents, {METRICS_SQL} FROM rules""")
def _(spark, sf_dir):
    return shown(brand_rules(spark, sf_dir, 0.0))


@REG.query("product_rules", f"{rules_sql(PRODUCT_SQL, 0.003, 0.4, 1.0)} SELECT antecedents, consequents, {METRICS_SQL} FROM rules")
def _(spark, sf_dir):
    return shown(R.pair_rules(R.transactions(clustered(spark, sf_dir)), 0.003, 0.4, 1.0))


@REG.query("top_rules_by_confidence", f"""{rules_sql(BRANDS_SQL, 0.01, 0.1, 1.0)}
  SELECT antecedents, consequents, round(conf, {ROUND}) AS confidence FROM rules
  ORDER BY conf DESC, antecedents, consequents LIMIT 10""")
def _(spark, sf_dir):
    return R.top_rules(brand_rules(spark, sf_dir), "confidence", 10).select(
        "antecedents", "consequents", F.round("confidence", ROUND).alias("confidence"))


@REG.query("filter_rules", f"""{rules_sql(BRANDS_SQL, 0.01, 0, 1.0)}, kept AS (SELECT * FROM rules WHERE lift >= 1.01)
  SELECT antecedents, consequents, round(lift, {ROUND}) AS lift, (SELECT count(*) FROM kept) AS total_rules
  FROM kept ORDER BY kept.lift DESC, antecedents, consequents LIMIT 50""")
def _(spark, sf_dir):
    return R.filter_rules(brand_rules(spark, sf_dir, 0.0), 1.01).select(
        "antecedents", "consequents", F.round("lift", ROUND).alias("lift"), "total_rules")


@REG.query("rule_strength", f"""{rules_sql(BRANDS_SQL, 0.01, 0, 0)} SELECT antecedents, consequents,
  CASE WHEN lift > 1.5 THEN 'moderate' WHEN lift > 1 THEN 'weak' ELSE 'not significant' END AS strength FROM rules""")
def _(spark, sf_dir):
    baskets = R.baskets_from_long(order_baskets(spark, sf_dir), 0.01)
    rules = R.pair_rules(baskets, 0.01, 0.0, 0.0)
    return rules.select("antecedents", "consequents", R.strength(F.col("lift")).alias("strength"))


@REG.query("itemset_labels", f"""WITH {BRANDS_SQL} SELECT tid AS transaction_id, string_agg(item, ', ' ORDER BY item) AS items
  FROM long GROUP BY tid""")
def _(spark, sf_dir):
    baskets = R.gather(order_baskets(spark, sf_dir).dropDuplicates())
    return baskets.select("transaction_id", R.itemset_label(F.col("items")).alias("items"))


@REG.query("too_few_itemsets", "SELECT count(*) AS rules FROM part WHERE false")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    lonely = part.select(F.col("p_partkey").cast("string").alias("transaction_id"),
                         F.array(F.concat(F.lit("only-"), F.col("p_partkey").cast("string"))).alias("items"))
    return R.pair_rules(lonely).agg(F.count(F.lit(1)).alias("rules"))
