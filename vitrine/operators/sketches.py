"""Mergeable sketches as stored state: distributions and distinct counts over batches that are never read again.

A batch is summed up once in a small row of sketches. Rows of many batches merge into the
sketch of all their rows, so a figure over the whole history costs one row per batch and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Quantile sketch: a rank is off by less than RANK_ERROR with a probability above 0.9999 (about 1.3 times 400 ** -0.9 at 0.99).
KLL_SIZE, RANK_ERROR = 400, 0.015
# Distinct sketch: 2 ** 14 registers, a standard error of 0.8%; COUNT_ERROR is five of them.
HLL_BITS, COUNT_ERROR = 14, 0.04


def summed_up(batch: DataFrame, value: str | None = None, member: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per group: rows `n`, the values' `low`, `high`, `total` and quantile sketch, and the distinct sketch of `member`. Nulls count in n only."""
    parts = [F.count(F.lit(1)).alias("n")]
    if value is not None:
        v = F.col(value).cast("double")
        parts += [F.count(v).alias("known"), F.min(v).alias("low"), F.max(v).alias("high"), F.sum(v).alias("total"),
                  F.kll_sketch_agg_double(v, KLL_SIZE).alias("ranks")]
    if member is not None:
        parts.append(F.hll_sketch_agg(member.cast("string"), HLL_BITS).alias("members"))
    return batch.groupBy(*by).agg(*parts)


def store(sketches: DataFrame, table: str, batch: str) -> str:
    """Keep a batch's sketches; storing the batch again replaces them."""
    path = f"{table.rstrip('/')}/batch={batch}"
    sketches.write.mode("overwrite").parquet(path)
    return path


def merged(spark: SparkSession, table: str, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of all stored batches as one row per group."""
    found = spark.read.parquet(table)
    has = set(found.columns)
    parts = [F.sum("n").alias("n")]
    if "ranks" in has:
        parts += [F.sum("known").alias("known"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"),
                  F.kll_merge_agg_double("ranks", KLL_SIZE).alias("ranks")]
    if "members" in has:
        parts.append(F.hll_union_agg("members").alias("members"))
    return found.groupBy(*by).agg(*parts)


def distribution(sketch: DataFrame, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Count, extremes, mean (all exact) and approximate quantiles per group."""
    cuts = [F.when(F.col("known") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(p))).alias(name) for name, p in probs.items()]
    return sketch.select(*by, "n", "known", "low", "high", F.try_divide("total", "known").alias("mean"), *cuts)


def distinct(sketch: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and the approximate number of distinct members per group."""
    return sketch.select(*by, "n", F.hll_sketch_estimate("members").alias("distinct"))
