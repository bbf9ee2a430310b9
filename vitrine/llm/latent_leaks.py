"""Benchmark decontamination by latent semantic retrieval.

Corpus passages and pieces of benchmark items are TF-IDF vectors over the benchmark's
words. A randomised singular value decomposition of them, computed in one pass over the
corpus, gives a latent space; passages with a high cosine to a piece are candidates.
A longest common subsequence and a check of the item's ending confirm them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, folded_words, slices, texts

PASSAGE_WORDS, STRIDE = 64, 32
PIECE_WORDS = 20
RANK, EXTRA = 64, 16
ITEM_BLOCK = 2_000
BLOCKS_A_PASS = 16  # blocks sketched side by side; bounds the memory of a task, changes no result
MIN_COSINE = 0.4
# An item is found at the first share of its words in order, or at the second with its ending.
FULL_SHARE, PARTIAL_SHARE, ANSWER_SHARE = 0.7, 0.6, 0.6
SLACK = 1.5  # words of text per word of the item
SEED = 5
FOUND = pa.schema([("doc_id", pa.int64()), ("contaminated", pa.bool_()), ("n_items", pa.int64()), ("item_ids", pa.list_(pa.int64())),
                   ("cosine", pa.float64()), ("lcs_share", pa.float64())])
FOUND_SCHEMA = "doc_id long, contaminated boolean, n_items long, item_ids array<long>, cosine double, lcs_share double"


def pieces(n: int) -> list[tuple[int, int]]:
    """Even cuts of n words into runs of at most PIECE_WORDS."""
    k = -(-n // PIECE_WORDS)
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


@dataclass
class Index:
    """A block of items: their words as term numbers, pieces, and after fitting the latent space."""

    items: list[tuple[int, list[int]]]
    terms: dict[bytes, int]
    spans: list[tuple[int, int, int]]  # item, first and last word
    idf: np.ndarray | None = None
    basis: np.ndarray | None = None
    queries: np.ndarray | None = None
    probe: np.ndarray | None = None
    padded: np.ndarray | None = None
    needed: np.ndarray | None = None

    @classmethod
    def of(cls, items: list[tuple[int, bytes]]) -> Index:
        terms: dict[bytes, int] = {}
        listed = [(i, [terms.setdefault(w, len(terms)) for w in folded_words(t)]) for i, t in items]
        listed = [x for x in listed if x[1]]
        return cls(listed, terms, [(k, lo, hi) for k, (_, words) in enumerate(listed) for lo, hi in pieces(len(words))])

    def sketch_matrix(self) -> np.ndarray:
        return np.random.default_rng(SEED).standard_normal((len(self.terms), RANK + EXTRA))

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.terms.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def piece_counts(self) -> np.ndarray:
        out = np.zeros((len(self.spans), len(self.terms)), np.float32)
        for row, (k, lo, hi) in enumerate(self.spans):
            np.add.at(out[row], self.items[k][1][lo:hi], 1)
        return out

    def fit(self, passages: int, df: np.ndarray, sketch: np.ndarray) -> None:
        """Latent space from S = T'T W, where T has the raw counts of all passages.

        With D the idf weights, squared so that rare words carry a passage, the weighted matrix A = T D has A'A (D^-1 W) = D S,
        so a single pass gives a Nystroem approximation of A'A with test matrix
        D^-1 W, although the weights are known only after it. The pieces join the
        passages as further rows, with as much weight in all.
        """
        self.idf = (np.log((1 + passages) / (1 + df)) + 0.1) ** 2
        test = self.sketch_matrix() / self.idf[:, None]
        image = sketch * self.idf[:, None]
        own = self.piece_counts().astype(float) * self.idf
        extra = own.T @ (own @ test)
        image = image / max(1e-12, np.linalg.norm(image)) + extra / max(1e-12, np.linalg.norm(extra))
        core = test.T @ image
        values, vectors = np.linalg.eigh((core + core.T) / 2)
        good = values > values.max() * 1e-9
        half = image @ (vectors[:, good] / np.sqrt(values[good]))
        left, _, _ = np.linalg.svd(half, full_matrices=False)
        self.basis = (left[:, :RANK] * self.idf[:, None]).astype(np.float32)
        self.queries = unit(own.astype(np.float32) / self.idf.astype(np.float32) @ self.basis)
        # Of a piece found at PARTIAL_SHARE at most the rest is missing, so two of its rarest words beyond that many are there.
        self.probe = np.zeros(len(self.terms) + 1, np.int64)
        for k, lo, hi in self.spans:
            words = self.items[k][1][lo:hi]
            rare = sorted(words, key=lambda t: (-self.idf[t], t))
            self.probe[rare[:int((1 - PARTIAL_SHARE) * len(words)) + 2]] = 1
        self.padded = np.full((len(self.spans), PIECE_WORDS), len(self.terms))
        for row, (k, lo, hi) in enumerate(self.spans):
            self.padded[row, :hi - lo] = self.items[k][1][lo:hi]
        self.needed = PARTIAL_SHARE * (self.padded < len(self.terms)).sum(axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def starts(n: int) -> np.ndarray:
    """First words of the passages of a text: every STRIDE words, up to the one that reaches its end."""
    return np.arange(0, max(1, n - PASSAGE_WORDS + STRIDE), STRIDE)


class Sketch:
    """What a task sums for one block of items: passages with each term, and each term's row of T'T W."""

    def __init__(self, index: Index):
        self.index = index
        self.w = index.sketch_matrix().astype(np.float32)
        self.df, self.total = np.zeros(len(self.w), np.int64), np.zeros(self.w.shape)
        self.clear()

    def clear(self) -> None:
        self.ids, self.owner, self.rows = [], [], 0

    def text(self, words: list[bytes]) -> None:
        own = self.index.ids(words)
        known = np.flatnonzero(own >= 0)
        self.ids.append(own[known])
        self.owner.append(known // PASSAGE_WORDS + self.rows)
        self.rows += -(-len(own) // PASSAGE_WORDS)
        if self.rows >= 1000:
            self.add()

    def add(self) -> None:
        if self.rows:
            term, row = np.concatenate(self.ids), np.concatenate(self.owner)
            seen, short = np.unique(term, return_inverse=True)
            counts = np.bincount(row * len(seen) + short, minlength=self.rows * len(seen)).reshape(self.rows, len(seen)).astype(np.float32)
            self.df[seen] += (counts > 0).sum(axis=0)
            self.total[seen] += counts.T @ (counts @ self.w[seen])
        self.clear()


def sketcher(indexes: list[Index]):
    """Per task and block one row per term, and one of term -1 with the number of separate passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches, passages = [Sketch(x) for x in indexes], 0
        for batch in batches:
            for part in slices(batch):
                for text in part.column("text").to_pylist():
                    words = folded_words(text)
                    passages += -(-len(words) // PASSAGE_WORDS)
                    for sketch in sketches:
                        sketch.text(words)
        for number, sketch in enumerate(sketches):
            sketch.add()
            n = len(sketch.w)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n + 1, number, np.int32)), pa.array(np.append(np.arange(n), -1)), pa.array(np.append(sketch.df, passages)),
                 *(pa.array(np.append(sketch.total[:, i], 0.0)) for i in range(sketch.w.shape[1]))],
                names=["block", "term", "df", *(f"s{i}" for i in range(sketch.w.shape[1]))])
    return run


def fitted(indexes: list[Index], source: DataFrame) -> list[Index]:
    """Statistics of all passages, for BLOCKS_A_PASS blocks in each pass over them; only one row per benchmark word and block
    comes to the driver."""
    columns = [f"s{i}" for i in range(RANK + EXTRA)]
    for i in range(0, len(indexes), BLOCKS_A_PASS):
        some = indexes[i:i + BLOCKS_A_PASS]
        rows = source.mapInArrow(sketcher(some), "block int, term long, df long, " + ", ".join(f"{c} double" for c in columns)).groupBy(
            "block", "term").agg(F.sum("df").alias("df"), *[F.sum(c).alias(c) for c in columns]).orderBy("block", "term").toPandas()
        for number, index in enumerate(some):
            own = rows[rows["block"] == number]
            if len(own):
                index.fit(int(own["df"].iloc[0]), own["df"].to_numpy()[1:], own[columns].to_numpy()[1:])
            else:
                index.fit(0, np.zeros(len(index.terms)), np.zeros((len(index.terms), len(columns))))
    return indexes


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one machine word operation per word of b."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def confirm(item: list[int], own: np.ndarray, at: int, span: tuple[int, int]) -> float:
    """Best share of the item's words found in order near the passage at word `at`, or 0 if that does not confirm it."""
    n, width = len(item), int(SLACK * len(item)) + 1
    lo, hi = max(0, at - int(SLACK * span[0]) - width), min(len(own), at + PASSAGE_WORDS + int(SLACK * (n - span[1])) + width)
    near = own[lo:hi]
    inside = np.concatenate([[0], np.cumsum(np.isin(near, item))])
    gain = inside[np.minimum(np.arange(len(near)) + width, len(near))] - inside[:-1]
    if not len(gain) or gain.max() < PARTIAL_SHARE * n:
        return 0.0
    best = 0.0
    step = max(1, n // 4)  # less than the slack, so some window holds all that one in between would
    for s in range(0, len(near), step):
        if gain[s] < PARTIAL_SHARE * n:
            continue
        text = near[s:s + width].tolist()
        share = common_subsequence(item, text) / n
        if share > best:
            ending = item[-max(3, n // 5):]
            if share >= FULL_SHARE or share >= PARTIAL_SHARE and common_subsequence(ending, text) >= ANSWER_SHARE * len(ending):
                best = share
    return best


def search(indexes: list[Index], words: list[bytes]) -> tuple[dict[int, float], float]:
    """Items found in a text with their shares, and the best cosine of a candidate."""
    found: dict[int, float] = {}
    top = 0.0
    for index in indexes:
        own = index.ids(words)
        probes = np.concatenate([[0], np.cumsum(index.probe[own])])
        begin = starts(len(own))
        begin = begin[probes[np.minimum(begin + PASSAGE_WORDS, len(own))] - probes[begin] >= 2]
        if not len(begin):
            continue
        spots = begin[:, None] + np.arange(PASSAGE_WORDS)
        ids = np.where(spots < len(own), own[np.minimum(spots, len(own) - 1)], -1)
        row, col = np.nonzero(ids >= 0)
        term = ids[row, col]
        vectors = unit(np.add.reduceat(index.basis[term], np.flatnonzero(np.diff(row, prepend=-1)), axis=0))
        cosine = vectors @ index.queries.T
        r, q = np.nonzero(cosine >= MIN_COSINE)
        # One piece of a found item has its share of words in the passage, in any order.
        present = np.zeros((len(begin), len(index.terms) + 1), bool)
        present[row, term] = True
        enough = present[r[:, None], index.padded[q]].sum(axis=1) >= index.needed[q]
        for r, q in zip(r[enough].tolist(), q[enough].tolist()):
            k, lo, hi = index.spans[q]
            item_id, item = index.items[k]
            if found.get(item_id, 0.0) < 1.0:
                share = confirm(item, own, int(begin[r]), (lo, hi))
                if share > 0:
                    found[item_id] = max(found.get(item_id, 0.0), share)
                    top = max(top, float(cosine[r, q]))
    return found, top


def searcher(indexes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hits = [search(indexes.value, folded_words(t)) for t in part.column("text").to_pylist()]
                yield batch_of(FOUND, doc_id=part.column("doc_id"), contaminated=[bool(f) for f, _ in hits], n_items=[len(f) for f, _ in hits],
                               item_ids=[sorted(f) for f, _ in hits], cosine=[c for _, c in hits],
                               lcs_share=[max(f.values(), default=0.0) for f, _ in hits])
    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids, cosine, lcs_share for every row.

    The benchmark is the stated query set: its items go to every task, in blocks of
    ITEM_BLOCK with a latent space each. Items without words and null item ids are
    left out; equal items count each. Null and empty texts hold nothing.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).filter("item_id is not null and text is not null").distinct()
    listed = sorted((i, bytes(t)) for i, t in items.collect())
    source = texts(docs)
    indexes = [Index.of(listed[i:i + ITEM_BLOCK]) for i in range(0, len(listed), ITEM_BLOCK)]
    indexes = fitted([x for x in indexes if x.terms], source)
    return source.mapInArrow(searcher(spark.sparkContext.broadcast(indexes)), FOUND_SCHEMA)
