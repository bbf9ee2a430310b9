"""Weighted composite score, ranking and top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vitrine.functions.numeric import as_number
from vitrine.schema import available

# Default score weights.
DEFAULT_WEIGHTS = {"price": -0.2, "rating": 0.4, "review_count": 0.3, "stock_quantity": 0.1}
TOP_K_COLUMNS = ("rank", "title", "category", "platform", "price", "rating", "review_count", "composite_score")


def effective_weights(weights: Mapping[str, float] | None = None) -> dict[str, float]:
    """Defaults overridden by `weights`, scaled so absolute values sum to 1."""
    merged = {**DEFAULT_WEIGHTS, **(weights or {})}
    total = sum(abs(v) for v in merged.values())
    return {k: (v / total if total else 0.0) for k, v in merged.items()}


def score_columns(df: DataFrame, weights: Mapping[str, float] | None = None) -> dict[str, tuple[str, float]]:
    """Per base name the column it reads (`*_norm` if there, else raw) and its weight."""
    out = {}
    for base, weight in effective_weights(weights).items():
        column = next((c for c in (f"{base}_norm", base) if c in df.columns), None)
        if column:
            out[base] = (column, weight)
    return out


def composite_score(df: DataFrame, weights: Mapping[str, float] | None = None,
                    contributions: bool = False, digits: int | None = None) -> DataFrame:
    """Add `composite_score`, and on request one `{base}_contrib` per term.

    Terms are added in a fixed order, so the sum is the same on every run. `digits`
    rounds the score, to rank by a value that is equal across engines.
    """
    terms = {
        f"{base}_contrib": F.coalesce(as_number(df, c), F.lit(0.0)) * F.lit(w)
        for base, (c, w) in score_columns(df, weights).items()}
    total: Column = F.lit(0.0)
    for term in terms.values():
        total = total + term
    if digits is not None:
        total = F.round(total, digits)
    return df.withColumns({"composite_score": total, **(terms if contributions else {})})


def top_k(df: DataFrame, k: int = 100, score: str = "composite_score",
          tie: Sequence[str] = ("product_id",)) -> DataFrame:
    """The k best rows with `rank` 1..k, ties broken by `tie`.

    `orderBy.limit` keeps a k-row heap per task; the window numbers only k rows.
    """
    if score not in df.columns:
        raise KeyError(f"column '{score}' is missing")
    order = [F.col(score).desc_nulls_last(), *[F.col(c).asc() for c in tie]]
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def ranked_head(top: DataFrame, k: int = 100, columns: Sequence[str] = TOP_K_COLUMNS) -> DataFrame:
    """First k rows of an already ranked table, display columns only."""
    return top.select(*available(top, columns)).orderBy("rank").limit(k)


def top_n_per(df: DataFrame, group: str, n: int = 10, score: str = "composite_score",
              tie: Sequence[str] = ("product_id",)) -> DataFrame:
    """The n best rows of every group, with `rank_in_group`.

    Spark prunes to n rows per group and task before the shuffle, so one huge
    group costs no more than a small one.
    """
    w = Window.partitionBy(group).orderBy(F.col(score).desc_nulls_last(), *[F.col(c).asc() for c in tie])
    return df.withColumn("rank_in_group", F.row_number().over(w)).filter(F.col("rank_in_group") <= n)
