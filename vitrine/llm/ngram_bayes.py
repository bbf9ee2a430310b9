"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Runs of one to four characters, none across two words, are hashed into a fixed number of
buckets. Learning is one aggregate: buckets counted by language in every task and summed.
The matrix of log-probabilities (buckets x languages) goes to all tasks, where a batch
of texts is one sparse matrix of bucket ids, multiplied by it in one gather. Weights
are whole numbers, so a score does not depend on batches or their order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, odd_numbers, slices

ORDERS = (1, 2, 3, 4)
MAX_BITS = 15
# Weights of the matrix that every task gets: languages x buckets stay below this, so many languages share fewer buckets.
MAX_WEIGHTS = 1 << 23
SMOOTHING = 0.5
UNIT = 1 << 16
FOLDS, TEST_FOLD = 4, 2
UNKNOWN = "und"
# Characters hashed at a time, a bound of memory.
CHUNK = 1 << 20
SPACE = 32
# What is no letter in ASCII separates words.
BREAKS = np.array([not chr(c).isalpha() for c in range(128)])

COUNTED = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
JUDGED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
DOCS = -1


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, each word after one space, a space at the end; and where each text starts."""
    joined = [np.frombuffer((" " + t.lower()).encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    starts = np.cumsum([0] + [len(j) for j in joined])
    codes = np.concatenate([*joined, np.array([SPACE], np.uint32)])
    gap = (codes == SPACE) | BREAKS[np.minimum(codes, 127)] & (codes < 128)
    codes = np.where(gap, np.uint32(SPACE), codes)
    # The last space of a run stays, so that a text begins with the space before its first word.
    keep = ~gap
    keep[:-1] |= ~gap[1:]
    keep[-1] = True
    place = np.r_[0, np.cumsum(keep)]
    return codes[keep], place[starts]


def buckets(codes: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First positions and buckets of all n-grams, by chunk and order. One space may stand at either end, none inside."""
    factors = odd_numbers(max(ORDERS) + 1, 13).astype(np.uint32)
    space = codes == SPACE
    for start in range(0, len(codes), CHUNK):
        for size in ORDERS:
            end = min(start + CHUNK, len(codes) - size + 1)
            if end <= start:
                continue
            value = np.full(end - start, factors[-1] * np.uint32(size), np.uint32)
            whole = np.ones(end - start, bool)
            for i in range(size):
                value += codes[start + i:end + i] * factors[i]
                if 0 < i < size - 1 or size == 1:
                    whole &= ~space[start + i:end + i]
            if size == 2:
                whole &= ~(space[start:end] & space[start + 1:end + 1])
            at = np.flatnonzero(whole)
            value = value[at]
            value ^= value >> np.uint32(16)
            value *= np.uint32(0x7FEB352D)
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x846CA68B)
            yield at + start, (value >> np.uint32(32 - bits)).astype(np.int64)


def counter(bits: int):
    """Per task, n-grams by language and bucket, and training texts by language in the row DOCS."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch):
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    by_lang.setdefault(lang, []).append(text.decode("utf-8", "replace"))
                for lang, some in by_lang.items():
                    docs[lang] = docs.get(lang, 0) + len(some)
                    found = counts.setdefault(lang, np.zeros(1 << bits, np.int64))
                    for _, ids in buckets(letters(some)[0], bits):
                        found += np.bincount(ids, minlength=1 << bits)
        for lang, found in counts.items():
            used = np.flatnonzero(found)
            yield batch_of(COUNTED, lang=[lang] * (len(used) + 1), bucket=np.r_[DOCS, used].astype(np.int32), n=np.r_[docs[lang], found[used]])
    return run


@dataclass
class Model:
    langs: list[str]
    bits: int
    prior: np.ndarray
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-probability of each text and language, in units of 1 / UNIT."""
        codes, starts = letters(texts)
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        for at, ids in buckets(codes, self.bits):
            sums = np.zeros((len(ids) + 1, len(self.langs)), np.int64)
            np.cumsum(self.weights[ids], 0, out=sums[1:])
            ends = np.searchsorted(at, starts)
            total += sums[ends[1:]] - sums[ends[:-1]]
        return total + self.prior

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [has_letter(t) and bool(self.langs) for t in texts]
        points = self.scores([t if k else "" for t, k in zip(texts, known)]) if self.langs else np.zeros((len(texts), 1), np.int64)
        best = points.argmax(1)
        spread = np.exp((points - points.max(1, keepdims=True)) / UNIT).sum(1)
        return ([self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), known)],
                [float(1 / s) if k else 0.0 for s, k in zip(spread.tolist(), known)])


def fit(training: DataFrame, n_langs: int) -> Model:
    """From lang and text (as bytes) of all training rows, of at most n_langs languages."""
    bits = min(MAX_BITS, (MAX_WEIGHTS // max(n_langs, 1)).bit_length() - 1)
    if bits < 1:
        raise ValueError(f"{n_langs} languages are more than {MAX_WEIGHTS // 2}")
    rows = (training.mapInArrow(counter(bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(rows.column("lang").to_pylist()), key=str.encode)
    number = {lang: i for i, lang in enumerate(langs)}
    counts, docs = np.zeros((1 << bits, len(langs))), np.zeros(len(langs))
    lang = np.array([number[v] for v in rows.column("lang").to_pylist()], np.int64)
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    grams = bucket != DOCS
    counts[bucket[grams], lang[grams]] = n[grams]
    docs[lang[~grams]] = n[~grams]
    chance = (counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * len(counts))
    prior = np.log(docs / docs.sum()) if len(langs) else docs
    return Model(langs, bits, np.rint(prior * UNIT).astype(np.int64), np.rint(np.log(chance) * UNIT).astype(np.int32))


def judging(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                some = [None if t is None else t.decode("utf-8", "replace") for t in part.column("text").to_pylist()]
                lang, score = model.judge(some)
                yield batch_of(JUDGED, doc_id=part.column("doc_id"), held_out=part.column("held_out"), lang_pred=lang, score=score)
    return run


def predict(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior probability of lang_pred) for every row.

    Learned from all rows with text and lang whose fold (crc32 of the id as text, modulo 4) is not 2. Texts that are null or have
    no letter are `und` with score 0, and so is everything where nothing can be learned. Letters of scripts
    without spaces are words as long as the run. Ties go to the language whose bytes are smaller. Repeated rows are learned from
    and judged each; a null id counts as empty text. Columns other than these four are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                         F.col("lang").cast("string").alias("lang"))
    held_out = fold_of(F.col("doc_id")) == TEST_FOLD
    training = source.filter(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    model = fit(training, source.select("lang").distinct().count())
    return source.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        judging(model), "doc_id long, held_out boolean, lang_pred string, score double")
