"""Toxicity, leaks, licences and pages against brute force, planted cases and held-out accuracy."""

import html
import itertools
import random
import tracemalloc
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from vitrine.llm import block_lstm, latent_leaks, license_index, toxic_crf
from vitrine.llm.common import folded_words


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    lengths, trans = np.array([3, 1, 5, 2, 7]), rng.normal(size=(2, 2))
    emission = rng.normal(size=lengths.sum())
    p, pairs = toxic_crf.marginals(emission, lengths, trans, pairs=True)
    at, total = 0, np.zeros((2, 2))
    for n in lengths.tolist():
        e = emission[at:at + n]
        z, want, joint = 0.0, np.zeros(n), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(e[i] * y[i] for i in range(n)) + sum(trans[y[i - 1], y[i]] for i in range(1, n)))
            z, want = z + w, want + w * np.array(y)
            for i in range(1, n):
                joint[y[i - 1], y[i]] += w
        assert np.allclose(p[at:at + n], want / z)
        total, at = total + joint / z, at + n
    assert np.allclose(pairs, total)


@pytest.fixture(scope="module")
def toxic_tables(spark):
    """Documents of which a third hold one of four words, in three of them with a suffix of its own."""
    rng, rows, labels = random.Random(2), [], []
    for i in range(600):
        words = prose(100 + i, 60).split()
        if i % 3 == 0:
            words.insert(rng.randrange(60), rng.choice(["zorgmux", "blatt" + "abcdefg"[i % 7] * 2, "kripl" + "uvwxyz"[i % 6], "snurfo"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 3 == 0)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(toxic_tables):
    docs, labels = toxic_tables
    rows = toxic_crf.score_documents(docs, labels).collect()
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == int(r["doc_id"] % 3 == 0) for r in held) >= 0.95 * len(held)
    hit = next(r for r in held if r["predicted"])
    found = texts[hit["doc_id"]][hit["span_starts"][0]:hit["span_ends"][0]]
    assert found.startswith((b"zorgmux", b"blatt", b"kripl", b"snurfo"))


def test_toxicity_of_odd_rows(toxic_tables, odd, odd_rows, empty, spark):
    _, labels = toxic_tables
    rows = toxic_crf.score_documents(odd, labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema))).collect()
    assert len(rows) == len(odd_rows) and all(r["score"] is not None and r["predicted"] == 0 for r in rows)
    assert all(r["held_out"] is False for r in rows if r["doc_id"] is None)
    assert toxic_crf.score_documents(empty, labels).count() == 0
    assert toxic_crf.score_documents(odd, labels.limit(0)).count() == len(odd_rows)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(i, prose(900 + i, 12 + 3 * i)) for i in range(14)] + [(50, ""), (51, None), (None, prose(3, 30)), (52, prose(900, 12))]
    return spark.createDataFrame(items, "item_id long, text string")


def test_planted_leaks(spark, benchmark):
    rng, items = random.Random(4), {i: prose(900 + i, 12 + 3 * i) for i in range(14)}
    rows, want = [], {}
    for n in range(120):
        words, i = prose(2000 + n, 250).split(), n % 14
        text = items[i].split()
        if n < 56:  # whole
            want[n] = i
        elif n < 84:  # every eighth word missing or another one
            text = [rng.choice(words) if k % 16 == 0 else w for k, w in enumerate(text) if k % 16 != 8]
            want[n] = i
        else:
            text = []
        at = rng.randrange(250)
        rows.append((n, " ".join(words[:at] + text + words[at:]).upper()))
    got = {r["doc_id"]: r for r in latent_leaks.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), benchmark).collect()}
    assert all(want[n] in got[n]["item_ids"] for n in want)
    assert not any(got[n]["contaminated"] for n in range(84, 120))
    assert 52 in got[0]["item_ids"] and got[0]["lcs_share"] == 1.0 and got[0]["cosine"] >= latent_leaks.MIN_COSINE


def test_leaks_of_odd_rows(spark, odd, odd_rows, empty, benchmark):
    rows = latent_leaks.find_leaks(odd, benchmark).collect()
    assert len(rows) == len(odd_rows) and not any(r["contaminated"] for r in rows)
    assert latent_leaks.find_leaks(empty, benchmark).count() == 0
    assert latent_leaks.find_leaks(odd, benchmark.limit(0)).filter("contaminated").count() == 0


def test_leaks_in_many_blocks(spark, benchmark, monkeypatch):
    """Items in blocks of three, two blocks a pass, are found as those of one block are."""
    monkeypatch.setattr(latent_leaks, "ITEM_BLOCK", 3)
    monkeypatch.setattr(latent_leaks, "BLOCKS_A_PASS", 2)
    test_planted_leaks(spark, benchmark)
    source = latent_leaks.texts(spark.createDataFrame([(n, prose(2000 + n, 250)) for n in range(40)] + [(50, None)], "doc_id long, text string"))
    blocks = [latent_leaks.Index.of([(i, prose(2000 + i, 40).encode()) for i in range(k, k + 2)]) for k in range(0, 6, 2)]
    alone = [latent_leaks.fitted([latent_leaks.Index(x.items, x.terms, x.spans)], source)[0] for x in blocks]
    for x, y in zip(latent_leaks.fitted(blocks, source), alone):
        assert np.allclose(x.idf, y.idf) and np.allclose(np.abs(x.queries @ x.queries.T), np.abs(y.queries @ y.queries.T), atol=1e-2)


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert latent_leaks.common_subsequence(a, b) == table[-1][-1]


def test_sketch_recovers_the_leading_space():
    """The one-pass approximation spans the leading right singular vectors of a low-rank matrix."""
    rng = np.random.default_rng(7)
    index = latent_leaks.Index.of([(i, prose(i, 20).encode()) for i in range(8)])
    counts = rng.poisson(1, (300, 6)) @ rng.poisson(0.3, (6, len(index.terms))).astype(float)
    df = (counts > 0).sum(axis=0)
    index.fit(300, df, counts.T @ (counts @ index.sketch_matrix()))
    basis = index.basis / index.idf[:, None]
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-3)
    weighted = counts * index.idf
    assert np.linalg.norm(weighted - weighted @ basis @ basis.T) < 0.05 * np.linalg.norm(weighted)


LICENCES = (
    ("Licensed under the Apache License, Version 2.0.", "", "apache-2.0"), ("Released under the MIT License.", "", "mit"),
    ("Licensed under CC BY-NC 4.0.", "cc-by", "cc-by,cc-by-nc"), ("All rights reserved.", "reserved", "reserved"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl", "gpl,gpl-3.0"), ("No such thing here.", "", ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the", "", "mit"),
    ("apache license trail, a version of a walk licensed by nobody", "", ""),
)


def test_licences(spark):
    rows = [(i, f"{prose(i, 40)}\n{text}\n{prose(90 + i, 40)}") for i, (text, _, _) in enumerate(LICENCES)]
    got = {r["doc_id"]: r for r in license_index.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (_, base, labels) in enumerate(LICENCES):
        assert (got[i]["base_labels"], got[i]["labels"]) == (base, labels)
        assert (got[i]["score"] > 0) == bool(labels) and got[i]["score"] <= 1


def test_notices_without_their_rarest_words():
    """Any words may be missing, as many as the share allows; the index finds what a search of every place does."""
    rng = np.random.default_rng(5)
    index = license_index.Index.build({b"license": 900, b"the": 5000, b"software": 70})
    whole = license_index.Index(index.templates, {}, index.base)
    whole.candidates = lambda words: {(n, s) for n in range(len(index.templates)) for s in range(-30, len(words) + 2)}
    for label, template, phrase in index.templates:
        probes = {at for p in index.postings.values() for n, at in p if index.templates[n][1] is template}
        at = next(i for i in range(len(template)) if template[i:i + len(phrase)] == phrase)
        able = [i for i in range(len(template)) if not at <= i < at + len(phrase)]
        for k in range(20):
            order = sorted(able, key=lambda i: (i not in probes, rng.random())) if k else able
            gone = set(order[:int(0.3 * len(template) + 1e-9)])
            words = [b"x"] * 40 + [b"missing" if i in gone else w for i, w in enumerate(template)] + [b"y"] * 40
            found = index.verified(words)
            assert found == whole.verified(words) and label in found
    text = ("You may not use this work unless in accordance with the License. You may obtain a copy of the License at "
            "http www apache org licenses LICENSE-2.0")
    assert "apache-2.0" in license_index.Index.build({}).verified(license_index.split(text))


def test_base_places(documents, corpus):
    got = {r["doc_id"]: r for r in license_index.scan_licences(documents).collect()}
    phrases = [p.split() for p, _ in license_index.PHRASES]
    for doc_id, text in corpus:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places = [i for i in range(len(words)) for p in phrases if words[i:i + len(p)] == p]
        r = got[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None))


def test_licences_of_odd_rows(odd, odd_rows, empty):
    rows = license_index.scan_licences(odd).collect()
    assert len(rows) == len(odd_rows) and all(r["labels"] == "" and r["score"] == 0 and r["first_word"] is None for r in rows)
    assert license_index.scan_licences(empty).count() == 0


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def test_articles_of_the_table(pages):
    want = {}
    for r in pages.collect():
        body = r["html"][r["html"].index("<article>") + 9:r["html"].index("</article>")]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x.replace("<br>", " ")))).strip() for x in re.split(r"</?(?:p|h1)[^>]*>", body))
        want[r["page_id"]] = "\n".join(x for x in parts if x)
    got = block_lstm.extract(pages).collect()
    assert len(got) == len(want) and all(r["text"] == want[r["page_id"]] and r["n_chars"] == len(r["text"]) for r in got)


OTHER_TEMPLATE = """<html><head><title>T</title></head><body><header><div class="logo">My Site</div><ul class="menu"><li><a href="/a">Home</a></li>
<li><a>About us</a></li></ul></header><div class="cookie-notice"><p>We use cookies to improve this site.</p></div>OPEN<h1>A title here</h1>
<p>First paragraph, with a <a href="x">link</a> inside it.</p><div class="ad">Buy now things</div><p>Second   goes on &amp; &lt;here&gt;.</p>CLOSE
<aside class="sidebar"><p>Some other article teaser that is long enough to look real.</p></aside><section class="comments"><div class="comment"><p>I liked
this article very much.</p></div></section><form action="/s"><button>Send</button></form><footer><p>Imprint and terms.</p></footer>
<script>var a = "<p>no</p>";</script></body></html>"""


def test_other_templates(pages):
    network = block_lstm.train([r["html"] for r in pages.orderBy("page_id").limit(100).collect()])
    want = "A title here\nFirst paragraph, with a link inside it.\nSecond goes on & <here>."
    for tag, close in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>")):
        page = OTHER_TEMPLATE.replace("OPEN", tag).replace("CLOSE", close)
        assert block_lstm.main_texts(network, [page, None, ""]) == [want, "", ""]


def test_gradients_by_differences():
    rng = np.random.default_rng(8)
    network = block_lstm.Network(rng)
    x, mask = block_lstm.padded([rng.normal(size=(n, block_lstm.WIDTH)) for n in (3, 1, 4)])
    y = rng.integers(0, 2, mask.shape)

    def loss():
        p = network.forward(x, mask)[0]
        return -(np.where(y, np.log(p), np.log(1 - p)) * mask).sum() / mask.sum()

    x = x.astype(float)
    found = network.gradients(x, mask, y)
    for name, w in network.w.items():
        for at in [tuple(int(rng.integers(n)) for n in w.shape) for _ in range(4)]:
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - found[name][at]) < 1e-6


def test_scripts_are_read_to_their_end_tag():
    script = "for(i=0;i<n;i++){f('<p>', \"it's\")} if (a<b && c) x = '<!-- '"
    page = f"<body><SCRIPT type=a>{script}</Script ><article><p>One.</p><svg><style>a<b{{}}</style><path d='x'/></svg><p>Two.</p></article>" \
           f"<style>p<q {{}} </styles></style><p>Three.</p><script src=x></script><p>Four.</p><script>{script}</script><p>Five.</p><script>a<b"
    assert [x.text for x in block_lstm.leaves(page)] == ["One.", "Two.", "Three.", "Four.", "Five."]


def test_quotes_and_hidden_parts():
    def texts(page):
        return [x.text for x in block_lstm.leaves(page)]

    assert texts("<article><p class=it's>Hello don't you</p><p>second para isn't lost</p></article>") == ["Hello don't you", "second para isn't lost"]
    assert texts('<article><p><a title="x>link</a> and more</p></article>') == ["link and more"]
    assert texts("<p title='a > b' data-x = \"c > d\">kept</p><p>Sum <math><mi>x</mi><mo>=</mo><mn>2</mn></math></p><object data=x><p>in its place</p></object>") \
        == ["kept", "Sum x=2", "in its place"]
    for tag in ("<div hidden>", "<div aria-hidden=true>", "<div style='display: none'>"):
        assert "hidden" in next(block_lstm.leaves(tag + "x</div>")).path[-1]
    assert "hidden" not in next(block_lstm.leaves("<div title='hidden class=nav' data-class=nav>x</div>")).path[-1]


def test_every_word_of_a_block_counts():
    words = [f"w{i}" for i in range(200)]
    one = block_lstm.vectors([block_lstm.Leaf(" ".join(words), (), 0)])
    words[100] = "other"
    assert (one != block_lstm.vectors([block_lstm.Leaf(" ".join(words), (), 0)])).any()


def test_prediction_equals_the_trained_network():
    network = block_lstm.Network(np.random.default_rng(4))
    pages = [OTHER_TEMPLATE, "<p>a</p>", "<ul>" + "<li>item of a list" * 50 + "</ul>"]
    blocks = [list(block_lstm.leaves(p)) for p in pages]
    xs = [block_lstm.vectors(b) for b in blocks]
    for x in xs:
        x[:, block_lstm.PLACE] = block_lstm.places(len(x))
    want = network.forward(*block_lstm.padded(xs))[0]
    got = network.predict([network.inputs(iter(b))[1] for b in blocks])
    for i, p in enumerate(got):
        assert np.allclose(p, want[:len(p), i], atol=1e-4)


def test_memory_of_a_page_of_many_blocks():
    network = block_lstm.Network(np.random.default_rng(4))
    page = "<article>" + "<p class=a>one block</p>" * 30_000 + "</article>"
    tracemalloc.start()
    try:
        found = block_lstm.main_texts(network, [page, page, None])
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == 3 and found[0] == found[1] and peak < 150e6


def test_odd_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (2, "u", "", "x", "y"), (None, "u", "<p>no end", "x", "y"), (4, "u", "<" * 500 + "&#x;&bad;" + "<p " * 50, "x", "y"),
            (5, "u", "<div>" * 2000 + "deep " * 50_000, "x", "y"), (5, "u", "<div>" * 2000 + "deep " * 50_000, "x", "y")]
    got = block_lstm.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 6 and all(r["text"] is not None for r in got)
    assert [r["text"] for r in got if r["page_id"] in (1, 2)] == ["", ""]
    assert block_lstm.extract(spark.createDataFrame([], schema)).count() == 0
