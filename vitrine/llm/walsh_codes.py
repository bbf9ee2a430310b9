"""Product codes of vectors, nearest entries found exactly in the Walsh-Hadamard domain.

Parts and codebook entries are whole numbers, padded with zeros to a power of two and
transformed without scaling, so d times their squared distance is the sum of the squared
differences of d coefficients. These are added in sequency order: the mean first, then
ever finer detail. The entry nearest by the first coefficient gives a bound, and an entry
whose running sum passes it is out before the rest is looked at. All of it is integer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
STEPS = 256
# Components of one block of rows: bounds the memory of a task.
BLOCK_VALUES = 1 << 18
LONG = (1 << 63) - 1
# Sums of components travel in limbs, so that they are exact at every size.
LIMB = 40
LIMBS = 5

CODED = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("code", pa.string()), ("error", pa.int64())])
SUMMED = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("n", pa.int64())]
                   + [(f"limb{i}", pa.int64()) for i in range(LIMBS)])


@lru_cache
def sequency(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix by their number of sign changes."""
    i = np.arange(size)
    signs = np.bitwise_count(i[:, None] & i[None, :]) & 1
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1))


def transform(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows, padded with zeros to a power of two, in sequency order."""
    n, width = rows.shape
    size = 1 << max(width - 1, 0).bit_length()
    out = np.zeros((n, size), rows.dtype)
    out[:, :width] = rows
    step = 1
    while step < size:
        halves = out.reshape(n, size // (2 * step), 2, step)
        out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], 2).reshape(n, size)
        step *= 2
    return out[:, sequency(size)]


def fits(*arrays: np.ndarray) -> bool:
    """Whether every sum of the search stays below 2**63."""
    width = arrays[0].shape[-1]
    size = 1 << max(width - 1, 0).bit_length()
    top = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    return size * (2 * size * top) ** 2 <= LONG


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lower one of equals, and the squared distance."""
    n = len(parts)
    if not parts.shape[1]:
        return np.zeros(n, np.int64), np.zeros(n, parts.dtype)
    if parts.dtype != object and not fits(parts, entries):
        parts, entries = parts.astype(object), entries.astype(object)
    x, e = transform(parts), transform(entries)
    first = (x[:, :1] - e[None, :, 0]) ** 2
    bound = ((x - e[first.argmin(1)]) ** 2).sum(1)
    rows, cols = np.nonzero(first <= bound[:, None])
    total = first[rows, cols]
    for k in range(1, x.shape[1]):
        total = total + (x[rows, k] - e[cols, k]) ** 2
        left = np.asarray(total <= bound[rows], bool)
        rows, cols, total = rows[left], cols[left], total[left]
    # Every row still has the entry of its bound, and rows and entries are in ascending order.
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    least = np.minimum.reduceat(total, starts)
    hits = np.flatnonzero(np.asarray(total == least[rows], bool))
    _, at = np.unique(rows[hits], return_index=True)
    return cols[hits[at]], least // x.shape[1]


def blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Row ranges of a batch and their whole-numbered parts: rows x PARTS x width."""
    vectors = batch.column("vector")
    step = max(1, BLOCK_VALUES // max(1, PARTS * width))
    for start in range(0, batch.num_rows, step):
        piece = vectors.slice(start, step)
        lengths = np.diff(piece.offsets.to_numpy())
        values = np.floor(piece.flatten().to_numpy(zero_copy_only=False) * float(STEPS))
        exact = values.astype(np.int64) if not values.size or np.abs(values).max() < 2**62 else np.array([int(v) for v in values.tolist()], object)
        out = np.zeros((len(piece), PARTS * width), exact.dtype)
        out[np.arange(PARTS * width)[None, :] < lengths[:, None]] = exact
        yield slice(start, start + len(piece)), out.reshape(len(piece), PARTS, width)


def assign(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance for each row and part."""
    found = [nearest(parts[:, p], books[p]) for p in range(PARTS)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1].astype(object) for f in found], 1)


def summing(books: np.ndarray):
    """Per task, the parts of each entry: how many and the sums of their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = books.shape[1:]
        n, sums = np.zeros((PARTS, k), np.int64), np.zeros((PARTS, k, width), object)
        for batch in batches:
            for _, parts in blocks(batch, width):
                for p in range(PARTS):
                    entry, _ = nearest(parts[:, p], books[p])
                    order = np.argsort(entry, kind="stable")
                    used, starts = np.unique(entry[order], return_index=True)
                    n[p, used] += np.diff(np.r_[starts, len(entry)])
                    if width:
                        safe = parts[:, p] if fits(parts[:, p]) else parts[:, p].astype(object)
                        sums[p, used] += np.add.reduceat(safe[order], starts, 0).astype(object)
        part, entry, at = (i.ravel() for i in np.indices(sums.shape))
        kept = n[part, entry] > 0
        part, entry, at = part[kept], entry[kept], at[kept]
        left, limbs = sums[part, entry, at], {}
        for i in range(LIMBS - 1):
            limbs[f"limb{i}"] = [int(v) & ((1 << LIMB) - 1) for v in left]
            left = [int(v) >> LIMB for v in left]
        limbs[f"limb{LIMBS - 1}"] = [int(v) for v in left]
        yield batch_of(SUMMED, part=part.astype(np.int32), entry=entry.astype(np.int32), at=at.astype(np.int32), n=n[part, entry], **limbs)
    return run


def coding(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, errors = [], []
            for _, parts in blocks(batch, books.shape[2]):
                entry, distance = assign(parts, books)
                codes += [bytes(row).hex() for row in entry.astype(np.uint8)]
                errors += [min(int(v), LONG) for v in distance.sum(1)]
            yield batch_of(CODED, vec_id=batch.column("vec_id"), label=batch.column("label"), code=codes, error=errors)
    return run


def first_books(kept: DataFrame, width: int) -> np.ndarray:
    """The parts of the ENTRIES smallest vectors by id: PARTS x entries x width."""
    rows = kept.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).select("vec_id", "label", "vector").toArrow().combine_chunks()
    found = [parts for batch in rows.to_batches() for _, parts in blocks(batch, width)]
    return np.concatenate(found).transpose(1, 0, 2) if found else np.zeros((PARTS, 0, width), np.int64)


def moved(books: np.ndarray, rows) -> np.ndarray:
    """Each used entry becomes the floor of the mean of its parts."""
    out = books.astype(object)
    for r in rows:
        out[r["part"], r["entry"], r["at"]] = sum(r[f"limb{i}"] << (LIMB * i) for i in range(LIMBS)) // r["n"]
    return out.astype(np.int64) if not out.size or np.abs(out).max() < 2**62 else out


def encode(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row whose vector is whole and finite.

    Components become floor(256 * x). A vector has 16 parts of equal width; the longest kept vector sets the width, and what
    shorter ones, or a length that 16 does not divide, leave open is zeros. The codebook of a part starts from the 64
    smallest ids (nulls last, repeated ids by their vectors; fewer rows make fewer entries), moves twice and stays.
    Repeated rows are coded and counted each. Sums are exact at every size; an error beyond 2**63 - 1 is given as
    that. No row kept means no row out. Other columns are not read.
    """
    whole = F.forall("vector", lambda x: F.abs(x) < F.lit(float("inf")))
    kept = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vector")).filter(whole)
    width = -(-(kept.agg(F.max(F.size("vector"))).first()[0] or 0) // PARTS)
    books = first_books(kept, width)
    schema = "part int, entry int, at int, n long, " + ", ".join(f"limb{i} long" for i in range(LIMBS))
    for _ in range(ROUNDS):
        sums = kept.mapInArrow(summing(books), schema).groupBy("part", "entry", "at").agg(
            *[F.sum(c).alias(c) for c in ["n", *[f"limb{i}" for i in range(LIMBS)]]])
        # At most PARTS x ENTRIES x width rows, whatever the number of vectors.
        books = moved(books, sums.collect())
    digest = hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()
    coded = written(kept.mapInArrow(coding(books), "vec_id long, label long, code string, error long"), "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(
        F.least(F.sum(F.col("error").cast("decimal(30,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
