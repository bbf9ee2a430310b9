"""Incremental ingest of raw CSV batches into a table of the current products.

The stream finds new files; their rows are read by header name, as the batch reader reads
them, and merged into the table bucket by bucket. A bucket holds the products whose key
hashes to it, and every micro-batch writes a new version of the buckets it touches and of
no others:

    table/buckets=64/version=<batch id>/bucket=<b>/part-*.parquet

The newest finished version of each bucket is the current table. A replayed micro-batch
starts from the versions before it and replaces its own, so it repeats nothing, and
readers see a version only once all of it is written.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine.operators.clean import keep_last
from vitrine.schema import RAW_FIELDS, RAW_SCHEMA
from vitrine.sources.raw import POSITION, read_files, union_sources

KEYS = ("product_id", "title")
BUCKETS = 64
FOUND_FILES = "path string, modificationTime timestamp, length long, content binary"


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob: names of folders and markers, no data."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    return [s.getPath().toString() for s in found]


def buckets_of(spark: SparkSession, table: str, default: int) -> int:
    """Number of buckets a table was begun with."""
    known = [int(p.rsplit("=", 1)[1]) for p in listed(spark, f"{table}/buckets=*")]
    return known[0] if known else default


def newest(spark: SparkSession, table: str, before: int | None = None) -> dict[int, tuple[int, str]]:
    """Version and folder of every bucket's newest finished version, or of the newest one before `before`.

    Finished versions are listed, at most one folder per bucket and version that `vacuum` has left.
    """
    finished = {int(re.search(r"version=(\d+)", p)[1]) for p in listed(spark, f"{table}/buckets=*/version=*/_SUCCESS")}
    out: dict[int, tuple[int, str]] = {}
    for path in listed(spark, f"{table}/buckets=*/version=*/bucket=*"):
        version, bucket = map(int, re.search(r"version=(\d+)/bucket=(\d+)", path).groups())
        if version in finished and (before is None or version < before) and version > out.get(bucket, (-1, ""))[0]:
            out[bucket] = (version, path)
    return out


def read_paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Bucket folders as one table; a column that only some versions have is NULL elsewhere."""
    empty = spark.createDataFrame([], RAW_SCHEMA)
    return union_sources([empty, spark.read.option("mergeSchema", True).parquet(*paths)]) if paths else empty


def upsert(rows: DataFrame, table: str, version: int, buckets: int = BUCKETS) -> list[int]:
    """Merge rows (with POSITION) into the table as `version`; returns the buckets rewritten.

    Per key the last row in POSITION order stays, whichever version brought it, so late files
    change nothing they should not. Only folders of touched buckets are read. A table belongs to one
    stream: versions later than this one mean another stream wrote it, which is refused.
    """
    spark = rows.sparkSession
    later = [v for v, _ in newest(spark, table).values() if v > version]
    if later:
        raise ValueError(f"{table} already has version {max(later)}: it belongs to a stream with another checkpoint")
    n = buckets_of(spark, table, buckets)
    fresh = keep_last(rows, KEYS, POSITION).withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(n)).cast("int")).persist()
    try:
        # One row per bucket at most.
        touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
        held = {b: path for b, (_, path) in newest(spark, table, version).items()}
        merged = fresh
        if any(b in held for b in touched):
            old = spark.read.option("mergeSchema", True).parquet(*[held[b] for b in touched if b in held])
            keyed = old.withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(n)).cast("int"))
            merged = keep_last(keyed.unionByName(fresh, allowMissingColumns=True), KEYS, POSITION)
        path = f"{table}/buckets={n}/version={version}"
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    finally:
        fresh.unpersist()
    return touched


def start_ingest(spark: SparkSession, pattern: str, table: str, checkpoint: str,
                 max_files: int = 1000, multiline: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """Read every new batch file once and merge its rows into the table.

    Files may have their columns in any order and may lack some. The stream itself carries only paths, at most `max_files` of
    them a micro-batch; contents are read by the batch reader.
    """
    files = (spark.readStream.format("binaryFile").schema(FOUND_FILES).option("maxFilesPerTrigger", max_files).load(pattern)
             .select("path"))

    def store(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.filter(F.col("path").endswith(".csv")).collect()]
        if paths:
            rows = read_files(spark, paths, multiline)
            upsert(rows.select("*", *[F.lit(None).cast("string").alias(c) for c in RAW_FIELDS if c not in rows.columns]), table, batch_id, buckets)

    return files.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, table: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """The current row per product, of all buckets or of those named."""
    found = newest(spark, table)
    return read_paths(spark, [found[b][1] for b in sorted(found) if buckets is None or b in buckets]).drop(*POSITION)


def vacuum(spark: SparkSession, table: str) -> int:
    """Delete bucket folders which a newer finished version replaces; returns how many. The stream must not be
    running. The newest batch may still be replayed, so what it was merged into stays."""
    now = newest(spark, table)
    last = max((v for v, _ in now.values()), default=0)
    base = newest(spark, table, last)
    keep = {path for _, path in now.values()} | {path for _, path in base.values()}
    finished = {p.rsplit("/", 1)[0] for p in listed(spark, f"{table}/buckets=*/version=*/_SUCCESS")}
    old = [p for p in listed(spark, f"{table}/buckets=*/version=*/bucket=*") if p not in keep and p.rsplit("/", 1)[0] in finished]
    for path in old:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(old)
