"""Stage tables between steps, with reuse, fallbacks and exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.numeric import as_number
from vitrine.operators.score import top_k
from vitrine.schema import available
from vitrine.sources.raw import CSV_WRITE


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a finished stage table (one with a success marker) is at `path`."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage as Parquet and read it back: a durable cut of the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Reuse a finished stage, else build and write it."""
    return spark.read.parquet(path) if exists(spark, path) else write_stage(build(), path)


def read_first(spark: SparkSession, *paths: str) -> DataFrame:
    """The first finished stage among `paths`."""
    for path in paths:
        if exists(spark, path):
            return spark.read.parquet(path)
    raise FileNotFoundError("no processed data in " + ", ".join(paths))


def read_top_k(spark: SparkSession, top_path: str, *stage_paths: str, k: int = 100) -> DataFrame:
    """The stored top-k, else the k best of the first stage, else its first k rows
    by product id."""
    if exists(spark, top_path):
        return spark.read.parquet(top_path)
    df = read_first(spark, *stage_paths)
    if "composite_score" in df.columns:
        return top_k(df, k)
    return df.orderBy("product_id").limit(k)


def export(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> str:
    """Write rows with a header line; only CSV is offered. One file is meant for
    results of known small size, such as a top-k or a rule table."""
    if fmt != "csv":
        raise ValueError(f"format '{fmt}' is not supported")
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_WRITE).csv(path)
    return path


def bi_typed(df: DataFrame) -> DataFrame:
    """Numeric columns parsed; a missing review count is 0."""
    numeric = available(df, ("composite_score", "price", "rating", "review_count", "stock_quantity"))
    out = df.withColumns({c: as_number(df, c) for c in numeric})
    if "review_count" in numeric:
        out = out.withColumn("review_count", F.coalesce(F.col("review_count").cast("bigint"), F.lit(0)))
    return out
