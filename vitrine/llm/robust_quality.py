"""Quality rules: minimum-covariance-determinant estimates per language and source.

Each document becomes a vector of transformed text statistics. For every group the
half-sample with the smallest Mahalanobis distances is found by concentration steps;
a document far from the centre of its group is rejected.

A step is one aggregate. Squared distances fall into narrow logarithmic bins, and
each (group, bin) keeps its count and moment sums, so a group with a third of all
rows is summed on the map side and only its bins meet in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, chi2_quantile, slices, texts, windows, word_hashes, written

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COVERAGE, STEPS, MIN_GROUP = 0.75, 4, 60
COVERAGE_Z, OUTLIER_Z = 0.6744898, 4.2648908  # normal quantiles of 0.75 and 0.99999
BINS_PER_OCTAVE, LOWEST_BIN, HIGHEST_BIN = 16, -160, 400
GRID = 64
SYMBOLS = list(b"#*$%&|<>")
SPACES = [9, 10, 11, 12, 13, 32]
MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]

# Transformed statistics and the spread below which a difference never counts: a
# statistic that is constant in a group would otherwise make its covariance singular.
VECTOR = (
    ("ln(1 + n_words)", 2.0),
    ("ln(1 + word_chars / greatest(n_words, 1))", 0.12),
    ("ln(1 + 100 * n_symbols / greatest(n_words, 1))", 0.5),
    ("n_dup_lines / greatest(n_lines, 1)", 0.35),
    ("n_repeat_words / greatest(n_words, 1)", 0.25),
    ("n_upper / greatest(word_chars, 1)", 0.06),
    ("ln(1 + 100 * n_marks / greatest(n_words, 1))", 0.7),
)
P = len(VECTOR)
NAMES = [f"x{i}" for i in range(P)]
CROSS = [(i, j) for i in range(P) for j in range(i, P)]
STATS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *(
    (c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"))])
PARAMS = "key string, mean array<double>, inv array<double>"


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """Counts of one text; words are runs without ASCII white space."""
    text = text or b""
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(counts.sum() - counts[0x80:0xC0].sum() - counts[SPACES].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 4:
        _, back, seen = np.unique(windows(word_hashes(words), 3), return_inverse=True, return_counts=True)
        twice = seen[back] > 1
        if twice.any():
            covered = np.zeros(len(words), bool)
            for i in range(3):
                covered[i:i + len(twice)] |= twice
            repeated = int(covered.sum())
    return (len(words), chars, int(counts[SYMBOLS].sum()), len(lines) - len(set(lines)), repeated, len(lines),
            int(counts[65:91].sum()), int(counts[MARKS].sum()))


def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = list(zip(*(text_stats(t) for t in part.column("text").to_pylist())))
            yield batch_of(STATS, **{c: part.column(c) for c in ("doc_id", "lang", "source")},
                           **dict(zip(STATS.names[3:], found)))


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, the base verdict and the vector x0, x1, ..."""
    schema = "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in STATS.names[3:])
    found = texts(docs, F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")).mapInArrow(measure, schema)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    keys = {"k0": F.lit("{}"), "k1": F.to_json(F.struct("lang")), "k2": F.to_json(F.struct("lang", "source"))}
    return written(found.withColumns({"base_failed": failed, **keys, **{n: F.expr(e) for n, (e, _) in zip(NAMES, VECTOR)}}), "stats")


def distance() -> F.Column:
    """Squared Mahalanobis distance of the vector from `mean` under the inverse covariance `inv`."""
    diff = [F.col(n) - F.col("mean")[i] for i, n in enumerate(NAMES)]
    return sum((1 if i == j else 2) * F.col("inv")[i * P + j] * diff[i] * diff[j] for i, j in CROSS)


def parameters(mean: np.ndarray, cov: np.ndarray) -> dict:
    return {"mean": mean.tolist(), "inv": np.linalg.inv(cov + np.diag([f * f for _, f in VECTOR])).ravel().tolist()}


def first_guess(df: pd.DataFrame) -> pd.DataFrame:
    """Medians and quartile ranges of each statistic."""
    out = []
    for row in df.to_dict("records"):
        q = np.array([row[n] for n in NAMES])
        out.append({"key": row["key"], **parameters(q[:, 1], np.diag(((q[:, 2] - q[:, 0]) / 1.349) ** 2))})
    return pd.DataFrame(out, columns=["key", "mean", "inv"])


def concentrate(df: pd.DataFrame) -> pd.DataFrame:
    """Mean and covariance of the rows in the lowest bins that hold the coverage share of a group."""
    df = df.sort_values("bin")
    count = df["n"].to_numpy().cumsum()
    last = int(np.searchsorted(count, math.ceil(COVERAGE * count[-1])))
    n, sums = count[last], df.iloc[:last + 1].sum(numeric_only=True)
    mean = np.array([sums[c] for c in NAMES]) / n
    cov = np.zeros((P, P))
    for i, j in CROSS:
        cov[i, j] = cov[j, i] = sums[f"s{i}_{j}"] / n - mean[i] * mean[j]
    edge = 2 ** ((df["bin"].iloc[last] + 1) / BINS_PER_OCTAVE)
    # The kept share of a normal sample has its own largest distance; scaling to it makes the estimate consistent.
    scale = max(1.0, edge / chi2_quantile(P, COVERAGE_Z))
    return pd.DataFrame([{"key": df["key"].iloc[0], **parameters(mean, cov * scale)}])


def estimates(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes, parameters) per group key; groups under MIN_GROUP rows have neither."""
    keyed = judged.select(F.explode(F.array("k0", "k1", "k2")).alias("key"), *NAMES)
    sizes = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") >= MIN_GROUP), "sizes")
    keyed = keyed.join(sizes.select("key"), "key", "left_semi")
    # Statistics on a grid: the state of an exact percentile is then bounded.
    grid = keyed.groupBy("key").agg(*[F.percentile(F.round(F.col(n) * GRID) / GRID, [0.25, 0.5, 0.75]).alias(n) for n in NAMES])
    params = written(grid.mapInPandas(lambda parts: map(first_guess, parts), PARAMS), "mcd")
    for _ in range(STEPS):
        d2 = F.greatest(distance(), F.lit(1e-12))
        placed = keyed.join(params, "key").withColumn("bin", F.least(F.greatest(
            F.floor(F.log2(d2) * BINS_PER_OCTAVE), F.lit(LOWEST_BIN)), F.lit(HIGHEST_BIN)).cast("int"))
        summed = placed.groupBy("key", "bin").agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in NAMES],
            *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in CROSS])
        params = written(summed.groupBy("key").applyInPandas(concentrate, PARAMS), "mcd")
    return sizes, params


def judge_documents(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept, distance and limit for every row.

    The group of a document is its language and source; under MIN_GROUP judged rows
    the language, under that all documents. Fewer rows than that in all: no verdict
    beyond the base rules, distance null. A null language or source is a group of its
    own. No text: no words, so the base rules reject it. Repeated rows are judged alike.
    """
    stats = statistics(docs)
    sizes, params = estimates(stats.filter(~F.col("base_failed")))
    for k in ("k1", "k2"):
        stats = stats.join(sizes.select(F.col("key").alias(k), F.col("size").alias(f"n_{k}")), k, "left")
    chosen = F.when(F.col("n_k2").isNotNull(), F.col("k2")).when(F.col("n_k1").isNotNull(), F.col("k1")).otherwise(F.col("k0"))
    placed = stats.withColumn("key", chosen).join(params, "key", "left").withColumn("distance", distance())
    limit = chi2_quantile(P, OUTLIER_Z)
    return placed.select(
        *[c for c in STATS.names if c not in ("lang", "source", "n_lines", "n_upper", "n_marks")], "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"), "distance", F.lit(limit).alias("limit"))
