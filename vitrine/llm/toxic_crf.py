"""Toxic spans by a two-state linear-chain conditional random field.

Token labels come from document labels: a token of a toxic training document is
positive if its word form or word stem is far commoner in toxic than in clean
training documents. The field is trained on these sequences; its forward-backward
marginals give document scores and offending spans.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import FOLD, MEMO_WORDS, batch_of, folded_words, slices, texts

FOLDS = 5
# Bounds of the training sample: documents per label, and bytes of one training document.
SAMPLE_DOCS, SAMPLE_BYTES = 1_200, 20_000
# Of these, the sequences per label that the field itself is fitted on; the rest give word counts only.
FITTED_DOCS = 400
# Word features that may be toxic; documents and odds a toxic one needs, and the likelihood ratio of a strong one.
STEMS, MIN_DOCS, MIN_ODDS, STRONG = 7, 3, 20.0, 40.0
ITERATIONS, RATE, PENALTY = 30, 0.4, 1e-4
SPAN_LEVEL = 0.5
SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()),
                    ("n_toxic", pa.int64()), ("span_starts", pa.list_(pa.int64())), ("span_ends", pa.list_(pa.int64()))])
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_toxic long, span_starts array<long>, span_ends array<long>"


def features(word: bytes) -> list[bytes]:
    """The form itself, its beginnings and its end; beginnings stand for the stems of suffixing languages."""
    return [b"=" + word, b"4" + word[:4], b"5" + word[:5], b"6" + word[:6], b"7" + word[:7], b"8" + word[:8], b"9" + word[:9], b"$" + word[-3:], b"1"]


def chain(steps: tuple[np.ndarray, ...], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row vectors after each 2x2 step (m00, m01, m10, m11), scaled to sum 1; at `starts` the vector is reset to
    the step's first row.

    The steps are cut into blocks. Products inside all blocks grow side by side,
    the blocks are linked, and the vectors are then filled in, again side by side.
    """
    n = len(steps[0])
    width = max(1, int(n ** 0.5) // 2)
    rows = -(-n // width)
    m = []
    for k, values in enumerate(steps):
        padded = np.full(rows * width, float(k in (0, 3)))
        padded[:n] = values
        m.append(padded)
    m[2][starts], m[3][starts] = m[0][starts], m[1][starts]  # both rows alike: what came before no longer matters
    m = [np.ascontiguousarray(x.reshape(rows, width).T) for x in m]
    p00, p01, p10, p11 = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for a, b, c, d in zip(*m):
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    u, v, entry = 0.5, 0.5, np.empty((2, rows))
    for r, (a, b, c, d) in enumerate(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist())):
        entry[0, r], entry[1, r] = u, v
        u, v = u * a + v * c, u * b + v * d
        u, v = u / (u + v), v / (u + v)
    x, y = entry
    out = np.empty((2, width, rows))
    for i, (a, b, c, d) in enumerate(zip(*m)):
        x, y = x * a + y * c, x * b + y * d
        scale = 1 / (x + y)
        x, y = x * scale, y * scale
        out[0, i], out[1, i] = x, y
    return out[0].T.ravel()[:n], out[1].T.ravel()[:n]


def marginals(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple:
    """P(token is toxic) and, if asked for, the expected transitions summed over all sequences laid end to end."""
    n = len(emission)
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    tails = heads + lengths - 1
    e = np.exp(np.clip(emission, -30, 30))
    (a, b), (c, d) = np.exp(trans)
    steps = [np.full(n, a), b * e, np.full(n, c), d * e]
    steps[0][heads], steps[1][heads] = 1.0, e[heads]
    f0, f1 = chain(tuple(steps), heads)
    # Backwards, b[t] = A @ (e[t+1] * b[t+1]); the last token of a sequence starts from ones.
    after = np.append(e[1:], 1.0)
    steps = [np.full(n, a), np.full(n, c), b * after, d * after]
    steps[0][tails] = steps[1][tails] = 1.0
    b0, b1 = chain(tuple(x[::-1] for x in steps), n - 1 - tails[::-1])
    b0, b1 = b0[::-1], b1[::-1]
    p = f1 * b1 / (f0 * b0 + f1 * b1)
    if not pairs:
        return p, None
    inner = np.ones(n, bool)
    inner[heads] = False
    t = np.flatnonzero(inner)
    joint = [f0[t - 1] * a * b0[t], f0[t - 1] * b * e[t] * b1[t], f1[t - 1] * c * b0[t], f1[t - 1] * d * e[t] * b1[t]]
    whole = sum(joint)
    return p, np.array([(x / whole).sum() for x in joint]).reshape(2, 2)


@dataclass
class Field:
    """Feature weights, transition scores, and the logistic that turns marginals into a document score."""

    weights: dict[bytes, float]
    trans: np.ndarray
    calibration: np.ndarray

    def emission(self, word: bytes) -> float:
        return sum(self.weights.get(f, 0.0) for f in features(word))


def evidence(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per sequence: log odds of its most toxic token, and the expected number of toxic tokens; empty ones get the floor."""
    out = np.zeros((len(lengths), 3))
    out[:, 0], out[:, 1] = 1, -12.0
    full = np.flatnonzero(lengths)
    heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])[full]
    if len(full):
        top = np.clip(np.maximum.reduceat(p, heads), 6e-6, 1 - 6e-6)
        out[full, 1] = np.log(top / (1 - top))
        out[full, 2] = np.log1p(np.add.reduceat(np.where(p >= 0.05, p, 0), heads))
    return out


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-x @ w))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + ridge, x.T @ (y - q) - ridge @ w)
        w = w + np.clip(step, -2, 2)
    return w


def toxic_forms(sequences: list[list[bytes]], labels: np.ndarray) -> set[bytes]:
    """Forms and stems far commoner in toxic than in clean documents.

    A strong one is taken at once. Of the others, the one found in most toxic
    documents without any so far comes next, as long as it explains MIN_DOCS - 1 of them.
    """
    seen, holders = Counter(), {}
    n0, n1 = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
    for i, (words, y) in enumerate(zip(sequences, labels)):
        if y:
            for before, w, after in zip([b"", *words], words, [*words[1:], b""]):
                for f in features(w)[:STEMS]:
                    holders.setdefault(f, {}).setdefault(i, (before, after))
        else:
            seen.update({f for w in set(words) for f in features(w)[:STEMS]})

    def support(f: bytes, docs) -> int:
        """Documents with a word, where those that have it between the same words count once: a copied passage
        repeats all its words."""
        return len({holders[f][i] for i in docs})

    odds = {f: support(f, d) for f, d in holders.items() if len(d) >= MIN_DOCS and len(d) / n1 >= MIN_ODDS * (seen[f] + 0.1) / n0}
    odds = {f: k for f, k in odds.items() if k >= MIN_DOCS}
    chosen = {f for f, k in odds.items() if 2 * k * np.log((n0 + n1) / n1) >= STRONG}
    left = {f: set(holders[f]) for f in sorted(odds.keys() - chosen)}
    covered = {i for f in chosen for i in holders[f]}
    while left:
        left = {f: d - covered for f, d in left.items() if support(f, d - covered) >= MIN_DOCS - 1}
        if left:
            best = max(left, key=lambda f: (len(left[f]), -len(f)))
            covered |= left[best]
            chosen |= {best}
            del left[best]
    return chosen


def train(sample: list[tuple[bytes, int]]) -> Field:
    """Fit on (text, label) rows; without both labels the field finds nothing toxic."""
    sequences = [folded_words(t) for t, _ in sample]
    labels = np.array([y for _, y in sample], dtype=float)
    keep = [i for i, s in enumerate(sequences) if s]
    sequences, labels = [sequences[i] for i in keep], labels[keep]
    if len(set(labels.tolist())) < 2:
        return Field({b"1": -12.0}, np.zeros((2, 2)), np.array([-6.0, 0.0, 0.0]))
    toxic = toxic_forms(sequences, labels)
    fitted = np.sort(np.concatenate([np.flatnonzero(labels == y)[:FITTED_DOCS] for y in (0, 1)]))
    sequences, labels = [sequences[i] for i in fitted], labels[fitted]
    types = {w: i for i, w in enumerate(dict.fromkeys(w for s in sequences for w in s))}
    names: dict[bytes, int] = {}
    rows = np.array([[names.setdefault(f, len(names)) for f in features(w)] for w in types])
    tox_type = np.array([any(f in toxic for f in features(w)[:STEMS]) for w in types])
    token = np.fromiter((types[w] for s in sequences for w in s), np.int64)
    lengths = np.array([len(s) for s in sequences])
    gold = tox_type[token] & np.repeat(labels > 0, lengths)
    inner = np.ones(len(token), bool)
    inner[np.cumsum(lengths)[:-1]] = False
    inner[0] = False
    t = np.flatnonzero(inner)
    gold_pairs = np.bincount(2 * gold[t - 1].astype(int) + gold[t], minlength=4).reshape(2, 2)
    gold_types = np.bincount(token, weights=gold, minlength=len(types))
    w, g2 = np.zeros(len(names)), np.full(len(names), 1e-6)
    trans, h2, total = np.zeros((2, 2)), np.full((2, 2), 1e-6), len(token)
    w[names[b"1"]] = -3.0
    for _ in range(ITERATIONS):
        p, pairs = marginals(w[rows].sum(axis=1)[token], lengths, trans, pairs=True)
        diff = gold_types - np.bincount(token, weights=p, minlength=len(types))
        grad = np.bincount(rows.ravel(), weights=np.repeat(diff, rows.shape[1]), minlength=len(names)) / total - PENALTY * w / len(names)
        grad_t = (gold_pairs - pairs) / total
        g2, h2 = g2 + grad ** 2, h2 + grad_t ** 2
        w = w + RATE * grad / np.sqrt(g2)
        trans = trans + RATE * grad_t / np.sqrt(h2)
    p, _ = marginals(w[rows].sum(axis=1)[token], lengths, trans)
    return Field({f: float(w[i]) for f, i in names.items() if abs(w[i]) > 1e-3 and (f[:1] != b"=" or f in toxic)},
                 trans, logistic(evidence(p, lengths), labels))


class Emissions(dict):
    """Emission score of a word, remembered while the worker lives."""

    def __init__(self, field: Field):
        super().__init__()
        self.field = field

    def __missing__(self, word: bytes) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = self.field.emission(word)
        return value


def spans(p: np.ndarray) -> tuple[list[int], list[int]]:
    """First and one-past-last token of each maximal run at SPAN_LEVEL or above."""
    edge = np.diff(np.concatenate([[0], (p >= SPAN_LEVEL).astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()


def byte_offsets(text: bytes, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """Offsets of token runs in the UTF-8 text."""
    folded = np.frombuffer(text.translate(FOLD), np.uint8)
    word = np.concatenate([[0], (~np.isin(folded, [9, 10, 11, 12, 13, 32])).astype(np.int8), [0]])
    edge = np.diff(word)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return first[starts].tolist(), last[np.array(ends) - 1].tolist()


def scorer(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Emissions(field)
        for batch in batches:
            for part in slices(batch):
                raw = part.column("text").to_pylist()
                sequences = [folded_words(t) for t in raw]
                lengths = np.array([len(s) for s in sequences], np.int64)
                emission = np.fromiter((memo[w] for s in sequences for w in s), np.float64, int(lengths.sum()))
                p = np.zeros(0)
                if len(emission):
                    p = marginals(emission, lengths[lengths > 0], field.trans)[0]
                score = 1 / (1 + np.exp(-evidence(p, lengths) @ field.calibration))
                toxic, begin, end = [], [], []
                for text, at, n in zip(raw, np.cumsum(lengths) - lengths, lengths):
                    own = p[at:at + n]
                    starts, ends = spans(own) if n and own.max() >= SPAN_LEVEL else ([], [])
                    toxic.append(int((own >= SPAN_LEVEL).sum()))
                    starts, ends = byte_offsets(text, starts, ends) if starts else ([], [])
                    begin.append(starts)
                    end.append(ends)
                yield batch_of(SCORED, doc_id=part.column("doc_id"), held_out=part.column("held_out"), score=score.tolist(),
                               predicted=(score >= 0.5).astype(int).tolist(), n_toxic=toxic, span_starts=begin, span_ends=end)
    return run


def training_sample(docs: DataFrame, labels: DataFrame) -> list[tuple[bytes, int]]:
    """At most SAMPLE_DOCS documents of each label outside the held-out fold, by key hash."""
    rows = texts(docs, fold().alias("held_out")).filter("not held_out and length(text) <= %d" % SAMPLE_BYTES)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1)").distinct()
    out = []
    for y in (0, 1):
        chosen = marks.filter(F.col("toxic") == y).join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(
            F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
        found = rows.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi").select("doc_id", "text").distinct()
        out += [(bytes(r["text"]), y) for r in sorted(found.collect(), key=lambda r: (r["doc_id"], r["text"]))]
    return out


def fold() -> F.Column:
    """True for the held-out fifth of the documents; a null doc_id is in no fold."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic and byte offsets of toxic spans for every row.

    Only the text enters a score. Null and empty texts have no tokens and get the
    score of the evidence floor. Without labels of both kinds nothing is toxic.
    """
    field = train(training_sample(docs, labels))
    return texts(docs, fold().alias("held_out")).mapInArrow(scorer(field), SCHEMA)
