"""Quality, near duplicates, lines, repeated bytes, packing and id files against brute force."""

import collections
import hashlib
import itertools
import pathlib
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vitrine.llm import fuzzy_lines, minhash_forest, repair_ids, robust_quality, suffix_dedup, sum_squares_packing, tokens
from vitrine.session import work_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def folded(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    runs = collections.Counter(zip(words, words[1:], words[2:]))
    inside = {i + j for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(inside)


def test_base_counts(spark, documents, corpus):
    got = {r["doc_id"]: r for r in robust_quality.judge_documents(documents).collect()}
    assert len(got) == len(corpus)
    for doc_id, text in corpus:
        want, r = base_counts(text), got[doc_id]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_concentration_finds_the_clean_centre():
    """One step over exact bins equals the mean and covariance of the nearest share of the rows."""
    import pandas as pd

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, robust_quality.P))
    x[:60] += 40
    d2 = (x ** 2).sum(axis=1)
    bins = np.floor(np.log2(d2) * robust_quality.BINS_PER_OCTAVE).astype(int)
    rows = []
    for b in np.unique(bins):
        own = x[bins == b]
        row = {"key": "k", "bin": b, "n": len(own), **dict(zip(robust_quality.NAMES, own.sum(axis=0)))}
        rows.append(row | {f"s{i}_{j}": (own[:, i] * own[:, j]).sum() for i, j in robust_quality.CROSS})
    got = robust_quality.concentrate(pd.DataFrame(rows)).iloc[0]
    last = np.sort(bins)[299]
    kept = x[bins <= last]
    assert np.allclose(got["mean"], kept.mean(axis=0))
    scale = max(1.0, 2 ** ((last + 1) / robust_quality.BINS_PER_OCTAVE) / robust_quality.chi2_quantile(robust_quality.P, robust_quality.COVERAGE_Z))
    cov = np.cov(kept.T, bias=True) * scale + np.diag([f * f for _, f in robust_quality.VECTOR])
    assert np.allclose(np.linalg.inv(np.array(got["inv"]).reshape(robust_quality.P, -1)), cov)


def test_junk_goes_and_prose_stays(spark):
    rows = [(i, prose(i, 120), "en", "a") for i in range(100)]
    rows += [(1000 + i, " ".join(w + "$$$" for w in prose(i, 120).split()), "en", "a") for i in range(5)]
    got = {r["doc_id"]: r["kept"] for r in robust_quality.judge_documents(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(100)) and not any(got[1000 + i] for i in range(5))


def components_of(texts, percent):
    sets, parent = {}, {}
    for doc_id, text in texts:
        w = WORD.findall(folded(text))
        sets[doc_id] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        parent[doc_id] = doc_id

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(list)
    for doc_id, own in sets.items():
        shared = collections.Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                a, b = find(doc_id), find(j)
                parent[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(doc_id)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("region_rows", [48, 1])
def test_near_duplicates(spark, documents, corpus, monkeypatch, region_rows):
    monkeypatch.setattr(minhash_forest, "REGION_ROWS", region_rows)
    want = components_of(corpus, 85)
    got = {r["doc_id"]: r for r in minhash_forest.near_duplicates(documents, 85).collect()}
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_crowd_of_near_copies(spark):
    """Variants of one text, some linked only through others."""
    base = prose(5, 200).split()
    texts = [(i, " ".join(base[:i] + [f"edit{j}" for j in range(2)] + base[i:])) for i in range(0, 120)]
    texts += [(500 + i, " ".join(base[:40 + i] + [f"other{i}x{j}" for j in range(30)] + base[40 + i:])) for i in range(40)]
    want = components_of(texts, 85)
    got = minhash_forest.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_crowd_of_texts_that_are_apart(spark, monkeypatch):
    """Texts with much in common and too many shingles of their own give no square of pairs; the few alike ones are linked."""
    head = [f"c{i}" for i in range(150)]
    texts = [(i, " ".join([*head, *[f"own{i}x{j}" for j in range(40)]])) for i in range(200)]
    texts += [(1000 + i, " ".join([*head, *[f"own{i}x{j}" for j in range(40)], "more"])) for i in range(0, 200, 20)]
    tested, verify = [], minhash_forest.verified
    monkeypatch.setattr(minhash_forest, "verified", lambda pairs, *rest: tested.append(pairs.count()) or verify(pairs, *rest))
    got = minhash_forest.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i % 1000 for i, _ in texts}
    assert sum(tested) < 8 * len(texts)


@pytest.mark.parametrize("percent, core, own_pair, own", [(80, 159, 1, 20), (85, 169, 1, 15)])
def test_crowd_of_many_components(spark, percent, core, own_pair, own):
    """Pairs exactly at the threshold, all of them in regions that their likeness to the other pairs crowds."""
    head = [f"c{i}" for i in range(core + 4)]
    texts = [(2 * p + d, " ".join([*head, *[f"p{p}x{i}" for i in range(own_pair)], *[f"d{p}x{d}x{i}" for i in range(own)]]))
             for p in range(200) for d in range(2)]
    assert 100 * (core + own_pair) == percent * (core + own_pair + 2 * own)
    got = minhash_forest.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - i % 2 for i, _ in texts}


def test_near_duplicates_of_odd_rows(spark, odd, empty):
    got = collections.defaultdict(list)
    for r in minhash_forest.near_duplicates(odd).collect():
        got[r["doc_id"]].append(r)
    assert len(got[None]) == 2 and all(r["component_id"] is None and r["kept"] for r in got[None])
    assert [got[i][0]["component_id"] for i in range(11)] == [0, 1, 2, 3, 4, 5, 5, 7, 8, 9, 10]
    assert len(got[5]) == 2 and len(got[10]) == 2
    assert minhash_forest.near_duplicates(empty).count() == 0


def test_lines_by_brute_force(spark, documents, corpus):
    import regex

    norm = {}
    for doc_id, text in corpus:
        for at, line in enumerate((text or "").split("\n")):
            plain = regex.sub(r"[^\p{L}0]+", " ", line.lower().translate(str.maketrans("123456789", "0" * 9))).strip(" ")
            if len(plain) >= fuzzy_lines.MIN_CHARS:
                norm[doc_id, at] = plain
    lines = sorted(set(norm.values()))
    parent = list(range(len(lines)))
    # An edit removes and adds at most three runs of three characters each: counts of hashed runs that differ by more rule a pair out.
    runs = np.zeros((len(lines), 4096), np.int16)
    for i, line in enumerate(lines):
        codes = np.array([ord(c) for c in f"  {line} "], np.int64)
        np.add.at(runs[i], (codes[2:] * 131 + codes[1:-1] * 7919 + codes[:-2] * 104729) % 4096, 1)
    sizes = np.array([len(line) for line in lines])

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            left, row[0], corner = row[0], i, row[0]
            for j, y in enumerate(b, 1):
                corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
        return row[-1]

    for i in range(len(lines)):
        most = (100 - fuzzy_lines.EDIT_PERCENT) * np.maximum(sizes[i + 1:], sizes[i]) // 100
        alike = np.flatnonzero(np.abs(sizes[i + 1:] - sizes[i]) <= most)
        for j in alike[np.abs(runs[i + 1 + alike] - runs[i]).sum(1, dtype=np.int64) <= 6 * most[alike]].tolist():
            if distance(lines[i], lines[i + 1 + j]) <= most[j]:
                parent[find(i)] = find(i + 1 + j)
    number, first = {t: i for i, t in enumerate(lines)}, {}
    for place in sorted(norm):
        first.setdefault(find(number[norm[place]]), place)
    want = {p: first[find(number[t])] == p for p, t in norm.items()}
    assert {(r["doc_id"], r["at"]): r["kept"] for r in fuzzy_lines.line_decisions(documents).collect()} == want


def test_line_votes_of_every_width(spark):
    import xxhash

    lines = [" ".join(["same"] * (n - n // 3) + [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(n // 3)]) for n in (5, 127, 128, 32_767, 32_768, 40_001)]
    docs = spark.createDataFrame([(0, "\n".join(lines))], "doc_id long, text string")
    got = {r["at"]: r["simhash"] & (1 << 64) - 1 for r in fuzzy_lines.hashed_lines(docs).collect()}
    want = {}
    for at, line in enumerate(lines):
        votes = [xxhash.xxh64_intdigest(w, 42) for w in line.split()]
        want[at] = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in votes) > len(votes))
    assert got == {at: v for at, v in want.items() if len(lines[at]) >= fuzzy_lines.MIN_CHARS}


def test_line_stage_keeps_columns(spark, odd, empty):
    out = fuzzy_lines.without_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[6] == "" and texts[5] == prose(1, 60) and texts[0] is None
    assert fuzzy_lines.dedup_lines(odd).count() == odd.count()
    assert fuzzy_lines.dedup_lines(empty).count() == 0


def test_every_block_scheme_finds_the_same():
    for lines in (10, 10**6, 10**9, 10**12):
        masks = fuzzy_lines.block_masks(lines)
        rng = np.random.default_rng(2)
        for _ in range(50):
            bits = rng.choice(64, fuzzy_lines.HAMMING, replace=False)
            flipped = sum(1 << int(b) for b in bits)
            assert any((m & (1 << 64) - 1) & flipped == 0 for m in masks)


@pytest.mark.parametrize("crowd", [4096, 2])
def test_repeated_bytes(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    shared, other = prose(20, 60), prose(21, 40)
    texts = [(0, prose(22, 30) + shared + prose(23, 10)), (1, shared + prose(24, 60)), (2, prose(25, 30) + shared[100:450] + prose(26, 9)),
             (3, "ab" * 300), (4, other + " é " + other), (5, shared[:199]), (6, None), (7, ""), (8, "x" * 199), (9, "y" * 200), (10, prose(24, 60))]
    texts += [(20 + i, prose(40 + i, 10) + shared[:220] + prose(60 + i, 10)) for i in range(12)]
    raw = [(i, (t or "").encode()) for i, t in texts]
    count = collections.Counter(b[k:k + 200] for _, b in raw for k in range(len(b) - 199))
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for doc_id, b in raw:
        mark = np.zeros(len(b), bool)
        for k in range(len(b) - 199):
            if count[b[k:k + 200]] > 1:
                mark[k:k + 200] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~mark])
        r = got[doc_id]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), int(mark.sum()), len(suffix_dedup.runs(mark)), hashlib.sha256(kept).hexdigest())


def test_repeated_bytes_of_odd_rows(spark, odd, empty):
    rows = suffix_dedup.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert all(r["n_removed"] == r["n_bytes"] > 200 for r in by[10] + by[5] + by[6])
    assert by[8][0]["n_removed"] == by[8][0]["n_bytes"] == 100_000
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(0)
    for letters in (2, 5, 200):
        text = rng.integers(1, letters + 1, 1500).astype(np.uint8)
        text[300:500] = text[900:1100]
        text[-1] = 0
        order = suffix_dedup.suffix_array(text, np.array([1499]), np.array([0]))
        padded = text.tobytes() + bytes(suffix_dedup.SPAN)
        keys = [padded[i:i + suffix_dedup.SPAN] for i in order]
        assert sorted(order.tolist()) == list(range(1500)) and keys == sorted(keys)


def reference_ids(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.vocabulary_path())
    tokenizer.encode_special_tokens = True
    return [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for t in texts]


def test_parts_give_the_library_ids(odd_rows):
    odd = ["a  b", " a", "a ", "a\n\nb c", "a\tb", "don't, 's . , x.", "é. ñ, “q” a b", "\0 a \0b", "1.2, 3.", "<|endoftext|> x", "a \n b", "x.\ny,\nz"]
    texts = odd + [r[1] for r in odd_rows]
    assert [b for b in tokens.encoder().documents([None if t is None else t.encode() for t in texts])] == [x.tobytes() for x in reference_ids(texts)]


def check_pieces(pieces, texts):
    ids = dict(zip((i for i, _ in texts), reference_ids([t for _, t in texts])))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in pieces:
        own = ids[r["doc_id"]]
        assert zlib.crc32(own[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(own)
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))

    def whole(spans):
        end = 0
        for start, n in sorted(spans):
            assert start == end and n > 0
            end += n
        return end

    assert all(whole(by_doc[i]) == len(own) for i, own in ids.items())
    sizes = [whole(s) for s in by_sequence.values()]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in sizes)


@pytest.mark.parametrize("most_open", [4096, 3])
def test_packing(spark, documents, corpus, monkeypatch, most_open):
    monkeypatch.setattr(sum_squares_packing, "MAX_OPEN", most_open)
    check_pieces(sum_squares_packing.pack_documents(documents).collect(), corpus)
    packer = sum_squares_packing.Packer(0)
    for i, n in enumerate([5, 1024, 700, 300, 24, 1000, 2049, 1, 1, 1] * 20):
        packer.add(i, np.arange(n, dtype="<u4").tobytes())
    packer.pour(last=True)
    assert sum(r[2] for r in packer.rows) == 20 * 5105 and not packer.open


def test_level_choice_is_least_squares():
    rng = np.random.default_rng(4)
    packer = sum_squares_packing.Packer(0)
    packer.levels[1:1024] = rng.integers(0, 3, 1023)
    for size in (1, 10, 500, 1023):
        def after(level):
            n = packer.levels.copy()
            if level:
                n[level] -= 1
            n[level + size] += 1
            return int((n[1:1024] ** 2).sum())

        able = [h for h in range(0, 1025 - size) if h == 0 or packer.levels[h]]
        assert after(packer.level_for(size)) == min(map(after, able))


def test_id_files(spark, documents, corpus):
    got = {r["doc_id"]: r for r in repair_ids.round_trip(documents).collect()}
    start = 0
    for (doc_id, _), own in zip(sorted(corpus), reference_ids([t for _, t in sorted(corpus)])):
        r = got[doc_id]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(own), zlib.crc32(own.tobytes()))
        start += len(own)


def test_random_access_and_grammar():
    rng = np.random.default_rng(6)
    ids = [np.append(rng.choice([5, 6, 7, 50_256], n), 0).astype("<u4") for n in (3000, 0, 1, 500, 2000)]
    segment = repair_ids.Segment.load(repair_ids.Segment.build([4, None, 6, 7, 8], [x.tobytes() for x in ids]).dump())
    assert len(segment.rules) and len(segment.symbols) < 0.7 * sum(map(len, ids))
    assert segment.valid.tolist() == [1, 0, 1, 1, 1]
    assert (segment.ids() == np.concatenate(ids)).all()
    assert all((segment.ids(i) == x).all() for i, x in enumerate(ids))
    assert (segment.lengths == repair_ids.expansion_lengths(segment.rules)).all()


def test_grammar_is_complete():
    """Runs of one symbol are replaced, and no pair that could have a rule is left; ids beyond the format are refused."""
    rng = np.random.default_rng(9)
    phrase = rng.integers(1, 50_000, 300)
    ids = [np.append(x, 0).astype("<u4") for x in (np.full(4097, 7), np.tile(phrase, 40), np.full(3, 7), rng.integers(1, 40, 20_000), [])]
    segment = repair_ids.Segment.build(list(range(len(ids))), [x.tobytes() for x in ids])
    assert all((segment.ids(i) == x).all() for i, x in enumerate(ids)) and segment.lengths.max() >= 300
    left = collections.Counter()
    for a, b in itertools.pairwise(np.append(segment.first, len(segment.symbols)).tolist()):
        left.update(itertools.pairwise(segment.symbols[a:b].tolist()))
    assert max(left.values()) < repair_ids.MIN_COUNT and segment.first[1] - segment.first[0] < 40
    with pytest.raises(ValueError):
        repair_ids.Segment.build([1], [np.array([repair_ids.TERMINALS, 0], "<u4").tobytes()])


def test_ids_of_odd_rows(spark, odd, odd_rows, empty):
    rows = repair_ids.round_trip(odd).collect()
    assert len(rows) == len(odd_rows)
    spans = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert sum_squares_packing.pack_documents(odd).filter("offset = 0").count() > 0
    assert repair_ids.round_trip(empty).count() == 0 and sum_squares_packing.pack_documents(empty).count() == 0


def test_lines_by_edit_similarity_alone(spark, documents):
    """Every pair at the edit similarity is in one group, whatever its hashes are."""
    lines = fuzzy_lines.written(fuzzy_lines.lines_of(documents).filter("norm <> ''").select("norm").distinct().repartition(16), "norms")
    x, y = lines.selectExpr("norm as x"), lines.selectExpr("norm as y")
    allowed = "cast(greatest(length(x), length(y)) div 10 as int)"
    pairs = x.join(y, (x["x"] < y["y"])).filter(f"abs(length(x) - length(y)) <= {allowed}").filter(f"levenshtein(x, y, {allowed}) >= 0").collect()
    hashed = fuzzy_lines.written(fuzzy_lines.hashed_lines(documents), "lines")
    roots = {bytes(r["node"]): bytes(r["root"]) for r in fuzzy_lines.line_groups(hashed, documents).collect()}
    keys = [[hashlib.md5(t.encode()).digest() for t in pair] for pair in pairs]
    assert len(keys) > 20 and all(a in roots and roots[a] == roots.get(b) for a, b in keys)


def test_a_word_replaced_and_short_repeats(spark):
    texts = []
    for n in (5, 8, 12, 15, 20, 40, 200):
        words = prose(300 + n, n).translate(str.maketrans("0123456789", "abcdefghij")).split()
        for at in {0, n // 2, n - 1}:
            texts += [" ".join(words), " ".join([*words[:at], words[at][:-1] + "z", *words[at + 1:]])]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "Les.", "les", "...", "..."])], "doc_id long, text string")
    kept = {r["doc_id"] for r in fuzzy_lines.line_decisions(docs).filter("kept").collect()}
    assert len(kept) == 8  # one of each length, and one short line
    assert {r["doc_id"]: r["n_removed"] for r in fuzzy_lines.dedup_lines(docs).filter(f"doc_id >= {len(texts)}").collect()} == {
        len(texts): 0, len(texts) + 1: 1, len(texts) + 2: 0, len(texts) + 3: 0}


def test_counts_of_letters_rule_out_no_pair(spark):
    """Lines within the edits allowed always pass, also where counts are cut at 255."""
    rng, pairs = np.random.default_rng(5), []
    for n in (10, 30, 100, 900, 4000):
        for _ in range(20):
            a = "".join(rng.choice(list("eeeetaonis xyz0"), n))
            b = list(a)
            for _ in range(n // 10):
                at = int(rng.integers(len(b)))
                b[at:at + 1] = [["q"], [], [b[at], "e"]][rng.integers(3)]
            pairs.append((a, "".join(b)))
    pairs += [("e" * 200, "e" * 100 + "t" * 100), ("the same length of a line", "xyz wqvb kpfgj qq zz wxy")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for end in "ab":
        df = df.withColumn(f"size_{end}", F.length(end))
        for i in range(2):
            df = df.withColumn(f"c{i}_{end}", fuzzy_lines.counts(F.col(end), fuzzy_lines.COUNTED[8 * i:8 * i + 8]))
    near = F.expr("levenshtein(a, b) <= floor(greatest(length(a), length(b)) / 10)")
    rows = df.select(near.alias("near"), (fuzzy_lines.long_as("size_a", "size_b") & fuzzy_lines.lettered_as("a", "b")).alias("passes")).collect()
    assert all(r["passes"] for r in rows if r["near"]) and sum(r["near"] for r in rows) > 50
    assert not rows[-1]["passes"] and not rows[-2]["passes"]


def test_lines_that_cannot_be_alike_are_not_read(spark, monkeypatch):
    """Lines with runs in common, of which lengths and letters tell that they are not alike, never reach the edit distance."""
    words = prose(41, 30).translate(str.maketrans("0123456789", "abcdefghij")).split()
    texts = [" ".join([*words[:20 + k], *["zzz"] * (k % 2)]) for k in range(0, 10, 3)] + [" ".join([*words[:-1], "other"])]
    read, confirm = [], fuzzy_lines.confirmed
    monkeypatch.setattr(fuzzy_lines, "confirmed", lambda pairs, lines: read.append(pairs.count()) or confirm(pairs, lines))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, " ".join(words)])], "doc_id long, text string")
    kept = [r["doc_id"] for r in fuzzy_lines.line_decisions(docs).filter("kept").orderBy("doc_id").collect()]
    longest = [len(t) for t in [*texts, " ".join(words)]]
    able = sum(abs(a - b) <= max(a, b) // 10 for i, a in enumerate(longest) for b in longest[:i])
    assert 0 < sum(read) <= able < 15 and len(kept) < len(texts) + 1


def test_written_stages_leave_no_shuffle_files(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before = shuffled()
    stage = fuzzy_lines.written(spark.range(1000).repartition(7), "kept")
    for _ in range(50):
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.2)
    assert not left and stage.count() == 1000


def test_line_stages_are_removed_when_read(spark, documents, monkeypatch):
    """Of the line stages only the places, distinct lines, links and groups are left; the number of passes changes nothing."""
    def found():
        return {(r["doc_id"], r["at"], r["kept"]) for r in fuzzy_lines.line_decisions(documents).collect()}

    root = pathlib.Path(work_dir(spark).removeprefix("file:"))
    before = {p.name for p in root.iterdir()}
    want = found()
    left = {p.name.rpartition("-")[0] for p in root.iterdir() if p.name not in before}
    assert not left & {"lines", "blocks", "line-pairs", "spots", "line-texts", "apart"} and {"line-places", "distinct-lines"} <= left
    monkeypatch.setattr(fuzzy_lines, "PASSES", 5)
    assert found() == want
