"""Helpers the corpus operators share: reading, written stages, words, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import fresh_path

# Distinct words a worker remembers; the memory of a task is bounded, results never depend on it.
MEMO_WORDS = 1_000_000
SLICE_BYTES = 8 << 20
# Spark's setting to delete the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
M64 = (1 << 64) - 1
# ASCII letters fold to lower case, other ASCII than letters and digits separates words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a stage to the shared folder and read it back: lineage ends here, and a lost executor costs no rerun. What was
    shuffled for it is read no more, and Spark deletes it as soon as the stage is written."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    stage = spark.read.schema(df.schema).parquet(path)
    stage._written_at = path
    return stage


def removed(*stages: DataFrame) -> None:
    """Delete tables that `written` returned and nothing reads any more."""
    for stage in stages:
        spark = stage.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(stage._written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and the text as UTF-8 bytes; other columns of the input never enter an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with a bounded amount of text, so that a run of long texts does not fill the worker."""
    if not batch.num_rows:
        return
    data = batch.column(column)
    sizes = np.diff(np.frombuffer(data.buffers()[1], np.int32)[data.offset:data.offset + len(data) + 1])
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        total += size
        if total >= SLICE_BYTES:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def folded_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


class WordHashes(dict):
    """64-bit hash of a word, remembered while the worker lives."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective finalisation of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache
def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, M64, n, dtype=np.uint64, endpoint=True) | np.uint64(1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit value for each run of `size` words."""
    factors = odd_numbers(size, 7)
    n = len(hashes) - size + 1
    total = np.zeros(max(n, 0), np.uint64)
    for i in range(size if n > 0 else 0):
        total += hashes[i:i + n] * factors[i]
    return mixed(total)


def chi2_quantile(p: int, z: float) -> float:
    """Quantile of chi-square with p degrees of freedom at the normal quantile z (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3
