"""Source divergence, vector codes and language identification against brute force and held-out labels."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vitrine.llm import count_bitmaps, ngram_bayes, walsh_codes

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def divergence_by_hand(rows, min_docs):
    groups, docs = {}, {}
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate(FOLD))
        groups.setdefault((lang or "", source or ""), Counter()).update(terms)
        docs.setdefault(lang or "", Counter()).update(set(terms))
    kept = {lang: [t for t, n in found.items() if n >= min_docs] for lang, found in docs.items()}

    def shares(counts, lang):
        total, v = sum(counts[t] for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * v) for t in kept[lang]}

    p = {g: shares(c, g[0]) for g, c in groups.items()}
    q = {lang: shares(sum((c for g, c in groups.items() if g[0] == lang), Counter()), lang) for lang in docs}
    out = []
    for g in groups:
        pairs = [(h[1], sum(abs(p[g][t] - p[h][t]) for t in kept[g[0]])) for h in groups if h[0] == g[0] and h != g]
        terms = [(t, p[g][t] - q[g[0]][t]) for t in kept[g[0]] if groups[g][t] and p[g][t] > q[g[0]][t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, 50)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit]
            out += [(*g, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize("min_docs,block", [(30, 1024), (2, 7), (10**6, 1024)])
def test_divergence_by_brute_force(documents, odd, monkeypatch, min_docs, block):
    monkeypatch.setattr(count_bitmaps, "MIN_DOCS", min_docs)
    monkeypatch.setattr(count_bitmaps, "PIECE", 100)
    docs = documents.select("text", "lang", "source").unionByName(odd.select("text", "lang", "source"))
    want = divergence_by_hand([tuple(r) for r in docs.collect()], min_docs)
    got = sorted(tuple(r) for r in count_bitmaps.divergence(docs).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == want
    # The task's own combination, in blocks that cut groups and words apart.
    words = _bitmap_batches(documents)
    whole = _summed(count_bitmaps.joint_cells(iter(words)))
    monkeypatch.setattr(count_bitmaps, "BLOCK", block)
    assert _summed(count_bitmaps.joint_cells(b.slice(i, 5) for b in words for i in range(0, b.num_rows, 5))) == whole


def _bitmap_batches(documents):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = sorted((lang, int(word), g) for lang in "ab" for word in range(3) for g in rng.integers(0, 9, 40).tolist())
    p, bits = rng.integers(1, 1000, len(rows)), rng.integers(0, 2**63, len(rows))
    return [pa.RecordBatch.from_pydict({"lang": [r[0] for r in rows], "word": [r[1] for r in rows], "g": [r[2] for r in rows],
                                        "p": p, "zero": [r[2] for r in rows], "bits": bits})]


def _summed(batches):
    total = Counter()
    for b in batches:
        for g, h, n in zip(*(b.column(c).to_pylist() for c in ("g", "h", "joint"))):
            total[g, h] += n
    return dict(total)


def test_divergence_of_nothing(empty):
    assert count_bitmaps.divergence(empty).count() == 0


def codes_by_hand(rows):
    """Plain search over whole numbers of any size."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16)
    whole = [([math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in v] + [0] * (16 * width))[:16 * width] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda j: (kept[j][0] is None, kept[j][0] or 0, kept[j][1]))[:64]
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(whole[j], p) for j in order] for p in range(16)]

    def near(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(book))

    for _ in range(2):
        for p in range(16):
            found = [near(part(v, p), books[p])[1] for v in whole]
            for e in range(len(books[p])):
                mine = [part(v, p) for v, f in zip(whole, found) if f == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out = []
    for (i, _, label), v in zip(kept, whole):
        found = [near(part(v, p), books[p]) for p in range(16)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), min(sum(d for d, _ in found), 2**63 - 1)))
    by_label = Counter()
    for _, label, _, error in out:
        by_label[label] += error
    return sorted(((i, code, error, min(by_label[label], 2**63 - 1), digest) for i, label, code, error in out), key=repr)


def vectors(kind):
    rng = np.random.default_rng(7)
    if kind == "odd":
        rows = [(i, rng.normal(size=32).tolist(), i % 3) for i in range(150)]
        return [*rows, rows[3], (None, rows[5][1], None), (7, [0.0] * 32, 1), (-4, None, 1), (900, [None] + [0.5] * 31, 1), (901, [float("nan")] * 32, 1),
                (902, [float("-inf")] * 32, None), (903, [], 2), (904, [1.0] * 7, None), (905, [0.25] * 32, None)]
    if kind == "few":
        return [(i, (rng.normal(size=49) * 3).tolist(), None) for i in range(5)] * 3
    if kind == "huge":
        return [(i, (rng.normal(size=32) * 10.0 ** (i % 30)).tolist(), i % 2) for i in range(120)]
    return []


@pytest.mark.parametrize("kind", ["odd", "few", "huge", "none"])
def test_codes_by_brute_force(spark, kind):
    rows = vectors(kind)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, of int")
    got = walsh_codes.encode(df.repartition(3))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == codes_by_hand(rows)


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 8, 20])
def test_nearest_by_plain_distance(width):
    rng = np.random.default_rng(width)
    parts, entries = rng.integers(-9, 9, (300, width)), rng.integers(-9, 9, (64, width))
    distance = ((parts[:, None] - entries[None]) ** 2).sum(2)
    index, least = walsh_codes.nearest(parts, entries)
    assert (index == distance.argmin(1)).all() and (least == distance.min(1)).all()
    assert ((walsh_codes.transform(parts) ** 2).sum(1) == (1 << (width - 1).bit_length()) * (parts**2).sum(1)).all()


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = ngram_bayes.predict(docs).collect()
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_languages_by_brute_force(odd, odd_rows, documents, monkeypatch):
    """Counts, weights and sums one n-gram at a time; small chunks change nothing."""
    rows = [tuple(r) for r in documents.select("doc_id", "text", "lang").collect()] + [
        (r[0] and r[0] + 10_000, r[1], r[2]) for r in odd_rows if r[0] != 0]
    more = odd.filter("doc_id is null or doc_id != 0").selectExpr("doc_id + 10000 AS doc_id", "text", "lang", "kept", "row")
    docs = documents.select("doc_id", "text", "lang").unionByName(more, allowMissingColumns=True)
    got = ngram_bayes.predict(docs.repartition(5)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    text_of = {i: t for i, t, _ in rows}
    for r in got:
        assert r["doc_id"] is None or (r["lang_pred"] == "und") == (not ngram_bayes.has_letter(text_of[r["doc_id"]]))
    train = [(lang, t) for i, t, lang in rows if lang is not None and t is not None
             and zlib.crc32(str("" if i is None else i).encode()) % 4 != 2]
    counts, bits = {}, ngram_bayes.MAX_BITS
    for lang, text in train:
        for gram in grams_by_hand(text):
            counts.setdefault(lang, Counter())[bucket(gram, bits)] += 1
    langs, n_docs = sorted(counts), Counter(lang for lang, _ in train)
    assert sorted(n_docs) == langs
    total = {lang: sum(c.values()) + 0.5 * 2**bits for lang, c in counts.items()}
    for r in [x for x in got if x["doc_id"] is not None][::7]:
        text = text_of[r["doc_id"]]
        if not ngram_bayes.has_letter(text):
            continue
        points = [round(math.log(n_docs[lang] / len(train)) * 65536) + sum(
            round(math.log((counts[lang][b] + 0.5) / total[lang]) * 65536) for b in (bucket(g, bits) for g in grams_by_hand(text))) for lang in langs]
        assert r["lang_pred"] == langs[int(np.argmax(points))]
    monkeypatch.setattr(ngram_bayes, "CHUNK", 37)
    model = ngram_bayes.Model(["a"], 10, np.zeros(1, np.int64), np.arange(1024, dtype=np.int32)[:, None])
    some = [t for _, t, _ in rows[:20] if t]
    want = [sum(bucket(g, 10) for g in grams_by_hand(t)) for t in some]
    assert model.scores(some)[:, 0].tolist() == want


def grams_by_hand(text):
    words = "".join(" " if ord(c) < 128 and not c.isalpha() else c for c in text.lower()).split(" ")
    for word in filter(None, words):
        padded = f" {word} "
        for size in ngram_bayes.ORDERS:
            for i in range(len(padded) - size + 1):
                gram = padded[i:i + size]
                if gram.strip(" "):
                    yield gram


_BUCKETS = {}


def bucket(gram, bits):
    """Of a text that is the n-gram alone, the last order gives the n-gram itself."""
    if (gram, bits) not in _BUCKETS:
        codes = np.array([ord(c) for c in gram], np.uint32)
        _BUCKETS[gram, bits] = int(list(ngram_bayes.buckets(codes, bits))[-1][1][0])
    return _BUCKETS[gram, bits]


def test_no_languages(empty, spark):
    assert ngram_bayes.predict(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r)[2:] for r in ngram_bayes.predict(unlabelled).collect()} == {("und", 0.0)}
