"""Main text of web pages by a bidirectional LSTM over the blocks of a page.

A page is read into its sequence of leaf blocks. Each has a vector of its tag path,
hashed words and layout; the network reads the whole sequence in both directions and
labels every block. It is trained here on pages of the table whose markup says what is
article and what is not, with their templates varied at random.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import batch_of, slices

# Fixed values of HTML: elements without content, elements that end a block, elements whose content is no text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                  "h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr "
                  "ul".split())
HIDDEN = frozenset("script style noscript template iframe svg textarea canvas".split())
# Elements whose content is read as characters up to their end tag, whatever looks like a tag in it.
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in ("script", "style", "noscript", "iframe", "textarea")}
CLOSES_P = BLOCK - {"html", "head", "body", "title"}
INNER = frozenset("a abbr b bdi bdo cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup tt u var time label".split())

# What markup calls the parts of a page; the training labels follow from these words.
CONTENT_WORDS = "article main content post entry story body text prose page".split()
BOILERPLATE = {
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager links topbar tabs",
    "header": "header masthead banner logo branding top hero",
    "footer": "footer copyright legal bottom credits colophon imprint",
    "aside": "aside sidebar side widget related recommended popular trending tags share sharing social author bio rail",
    "div": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion notice cookie consent gdpr alert popup modal "
           "overlay newsletter subscribe signup login paywall toolbar skip hidden",
    "form": "form search contact feedback poll",
    "section": "comments comment reply replies discussion disqus respond reviews",
}
BAD_WORDS = frozenset(w for v in BOILERPLATE.values() for w in v.split()) | {"button", "select", "option", "fieldset", "legend", "input", "title", "head"}
ARTICLE_PARTS = ("ul li", "ol li", "h2", "h3", "h4", "blockquote", "blockquote p", "pre", "table tr td", "table tr th", "dl dd", "figure figcaption",
                 "div", "div p", "section p", "p", "details summary")
TAGS = sorted((BLOCK | INNER) - BAD_WORDS - set(CONTENT_WORDS))
KNOWN = {w: i for i, w in enumerate([*CONTENT_WORDS, *sorted(BAD_WORDS), *TAGS])}
CAPITALS = bytes(range(65, 91))
HASHED, LAYOUT = 32, 13
WIDTH = 2 * len(KNOWN) + HASHED + LAYOUT
PLACE = slice(2 * len(KNOWN) + HASHED + 6, 2 * len(KNOWN) + HASHED + 9)
HIDDEN_UNITS, EPOCHS, BATCH, RATE, SEED = 16, 14, 32, 0.01, 3
SAMPLE_PAGES, SAMPLE_CHARS, VARIANTS = 150, 100_000, 3
# Blocks made into vectors at once, and blocks of the pages that are labelled together; a longer page is labelled alone.
CHUNK, BLOCKS_AT_ONCE = 2048, 65_536

# A quote opens a value only after "=", and only where it is closed later; otherwise it is a character like any other.
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"</?[a-zA-Z](?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+(?:>|\Z)|[^<]+|<", re.S)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"([^\s/>=\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
EXTRACTED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


@dataclass(slots=True)
class Leaf:
    """Text of a block, the words of each element from the root to it, and its characters inside links."""

    text: str
    path: tuple[frozenset, ...]
    linked: int


@lru_cache(8192)
def element_words(tag: str) -> frozenset:
    """Name of an element, the words of its class, id and role, and "hidden" where an attribute says that it is not shown."""
    m = NAME.match(tag)
    found = {m[1].lower()}
    for a in ATTRIBUTE.finditer(tag, m.end()):
        key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
        if key in ("class", "id", "role"):
            found.update(WORDS.findall(value.lower()))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and UNSEEN.search(value):
            found.add("hidden")
    return frozenset(found)


def leaves(page: str) -> Iterator[Leaf]:
    """Blocks of a page in order: text between the tags that end a block, with references decoded and white space joined."""
    stack: list[tuple[str, frozenset]] = []
    pieces: list[str] = []
    linked, hidden = 0, ""

    def block() -> Iterator[Leaf]:
        text = SPACE.sub(" ", "".join(pieces)).strip()
        if text:
            yield Leaf(text, tuple(w for _, w in stack), linked)

    def pop(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return
            if name in INNER and stack[i][0] in BLOCK:
                return

    tokens = TOKEN.finditer(page)
    while m := next(tokens, None):
        token = m[0]
        if token[0] != "<" or token == "<":
            if not hidden:
                text = html.unescape(token)
                pieces.append(text)
                if any(n == "a" for n, _ in stack):
                    linked += len(text.strip())
            continue
        found = NAME.match(token)
        if not found:
            continue
        name = found[1].lower()
        closing = token[1] == "/"
        if name in RAW_END and not closing and not token.endswith("/>"):
            end = RAW_END[name].search(page, m.end())
            tokens = TOKEN.finditer(page, end.start() if end else len(page))
        if hidden:
            if closing and name == hidden:
                hidden = ""
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK and pieces:
            yield from block()
            pieces.clear()
            linked = 0
        if closing:
            pop(name)
        elif name in HIDDEN:
            hidden = "" if token.endswith("/>") else name
        elif name not in VOID:
            if name in CLOSES_P and any(n == "p" for n, _ in stack):
                pop("p")
            elif name in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
                stack.pop()
            stack.append((name, element_words(token)))
    yield from block()


def vector(leaf: Leaf, out: np.ndarray) -> None:
    """Everything of a block but its place in the page, from all its words."""
    n = len(KNOWN)
    for depth, words in enumerate(reversed(leaf.path)):
        for w in words:
            i = KNOWN.get(w)
            if i is not None:
                out[i] = 1
                if depth < 2:
                    out[n + i] = 1
    base = 2 * n
    words = leaf.text.lower().encode("utf-8", "replace").split(b" ")
    out[base:base + HASHED] = np.bincount([crc32(w) % HASHED for w in words], minlength=HASHED) * (4 / max(16, len(words)))
    chars, raw = len(leaf.text), leaf.text.encode("utf-8", "replace")
    base += HASHED
    out[base:base + LAYOUT] = (np.log1p(chars) / 5, np.log1p(len(words)) / 4, min(1.0, leaf.linked / chars), leaf.text[-1] in ".!?:;\"'",
                               (len(raw) - len(raw.translate(None, b"0123456789"))) / chars, (len(raw) - len(raw.translate(None, CAPITALS))) / chars, 0, 0, 0, len(leaf.path) / 10,
                               any(w & BAD_WORDS for w in leaf.path), any(w & BAD_WORDS for w in leaf.path[-2:]),
                               any(not w.isdisjoint(CONTENT_WORDS) for w in leaf.path))


def places(count: int) -> np.ndarray:
    """The three columns of PLACE for the blocks of a page: share of the page before it, first, last."""
    at = np.arange(count)
    return np.stack([at / max(count, 1), at == 0, at == count - 1], axis=1).astype(np.float32)


def vectors(page: list[Leaf]) -> np.ndarray:
    out = np.zeros((len(page), WIDTH), np.float32)
    for i, leaf in enumerate(page):
        vector(leaf, out[i])
    return out


def marked(leaf: Leaf) -> float | None:
    """Training label: what the path says, None where it says nothing."""
    if any(words & BAD_WORDS for words in leaf.path):
        return 0.0
    return 1.0 if any(words & {"article", "main"} for words in leaf.path) else None


def varied(page: list[Leaf], rng: np.random.Generator, strange: list[Leaf]) -> tuple[list[Leaf], np.ndarray]:
    """A copy of a labelled page in another template: article and other parts are renamed, and parts of other pages' text put in."""
    labels = [marked(x) for x in page]
    page, labels = [x for x, y in zip(page, labels) if y is not None], [y for y in labels if y is not None]
    kind = rng.integers(6)
    wrap = (frozenset({"article"}), frozenset({"main"}), frozenset({"div", rng.choice(CONTENT_WORDS)}),
            frozenset({"div", rng.choice(CONTENT_WORDS), rng.choice(CONTENT_WORDS)}), frozenset({"div"}), frozenset({"section"}))[kind]
    out = []
    for leaf, y in zip(page, labels):
        path = leaf.path
        if y:
            path = tuple(wrap if p & {"article", "main"} else p for p in path)
            if rng.random() < 0.3:  # the sample's articles may know only some of the elements that articles use
                path = (*(p for p in path if not p & {"p", "h1"}), *(frozenset({w}) for w in ARTICLE_PARTS[rng.integers(len(ARTICLE_PARTS))].split()))
        elif rng.random() < 0.5:
            path = tuple(part(rng) if p & BAD_WORDS else p for p in path)
        out.append((Leaf(leaf.text, path, leaf.linked), y))
    body = tuple(p for p in (page[0].path if page else ()) if p & {"html", "body"})
    for _ in range(rng.integers(1, 6) if strange else 0):
        own = part(rng)
        extra = [strange[i] for i in rng.integers(0, len(strange), rng.integers(1, 4))]
        inner = (frozenset({str(rng.choice(["p", "li", "div", "span", "h3"]))}),) if rng.random() < 0.6 else ()
        inside = rng.random() < 0.5
        made = [(Leaf(x.text[:int(rng.integers(10, 400))] or "x", (*body, *((wrap,) if inside else ()), own, *inner),
                      len(x.text) if rng.random() < 0.3 else 0), 0.0) for x in extra]
        at = int(rng.integers(0, len(out) + 1))
        out[at:at] = made
    return [x for x, _ in out], np.array([y for _, y in out], np.float32)


def part(rng: np.random.Generator) -> frozenset:
    """Markup of something that is not the article."""
    tag = str(rng.choice(list(BOILERPLATE)))
    word = str(rng.choice(BOILERPLATE[tag].split()))
    return frozenset({tag}) if rng.random() < 0.3 and tag not in ("div", "section") else frozenset({"div" if rng.random() < 0.6 else tag, word})


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Bidirectional LSTM with a logistic output per block; batches are (time, page, feature) with a mask."""

    def __init__(self, rng: np.random.Generator):
        h = HIDDEN_UNITS
        self.w = {}
        for d in "fb":
            self.w[d + "x"] = rng.normal(0, 0.1, (WIDTH, 4 * h))
            self.w[d + "h"] = rng.normal(0, 0.2, (h, 4 * h))
            self.w[d + "b"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        self.w["o"], self.w["ob"] = rng.normal(0, 0.2, (2 * h, 1)), np.zeros(1)

    def scan(self, x: np.ndarray, mask: np.ndarray, d: str):
        """Hidden states in reading order, and what the way back needs; masked steps keep the state."""
        h = HIDDEN_UNITS
        state, cell = np.zeros((x.shape[1], h)), np.zeros((x.shape[1], h))
        inputs = x @ self.w[d + "x"] + self.w[d + "b"]
        out, kept = np.zeros((*x.shape[:2], h)), []
        for t in range(len(x)):
            z = inputs[t] + state @ self.w[d + "h"]
            i, f, o, g = sigmoid(z[:, :h]), sigmoid(z[:, h:2 * h]), sigmoid(z[:, 2 * h:3 * h]), np.tanh(z[:, 3 * h:])
            m = mask[t][:, None]
            new = np.where(m, f * cell + i * g, cell)
            squashed = np.tanh(new)
            kept.append((i, f, o, g, cell, squashed, state))
            state, cell = np.where(m, o * squashed, state), new
            out[t] = state
        return out, kept

    def inputs(self, page: Iterator[Leaf]) -> tuple[list[str], np.ndarray]:
        """Texts of a page's blocks and what both directions read of them, made a chunk at a time so that paths and vectors do not pile up."""
        both = np.concatenate([self.w["fx"], self.w["bx"]], axis=1).astype(np.float32)
        bias = np.concatenate([self.w["fb"], self.w["bb"]]).astype(np.float32)
        texts, parts = [], []
        while chunk := list(islice(page, CHUNK)):
            texts += [x.text for x in chunk]
            parts.append(vectors(chunk) @ both + bias)
        z = np.concatenate(parts) if parts else np.zeros((0, len(bias)), np.float32)
        z += places(len(texts)) @ both[PLACE]
        return texts, z

    def run(self, z: np.ndarray, mask: np.ndarray, d: str) -> np.ndarray:
        """Contribution of one direction to the output, keeping only the current state."""
        h = HIDDEN_UNITS
        side = 0 if d == "f" else 1
        wh, wo = self.w[d + "h"].astype(np.float32), self.w["o"][side * h:side * h + h, 0].astype(np.float32)
        state, cell = np.zeros((z.shape[1], h), np.float32), np.zeros((z.shape[1], h), np.float32)
        out = np.zeros(z.shape[:2], np.float32)
        for t in range(len(z)) if d == "f" else range(len(z) - 1, -1, -1):
            a = z[t, :, side * 4 * h:side * 4 * h + 4 * h] + state @ wh
            gates, g = sigmoid(a[:, :3 * h]), np.tanh(a[:, 3 * h:])
            m = mask[t][:, None]
            cell = np.where(m, gates[:, h:2 * h] * cell + gates[:, :h] * g, cell)
            state = np.where(m, gates[:, 2 * h:] * np.tanh(cell), state)
            out[t] = state @ wo
        return out

    def predict(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each block of some pages, given their `inputs`."""
        z, mask = padded(pages)
        p = sigmoid(self.run(z, mask, "f") + self.run(z, mask, "b") + self.w["ob"][0])
        return [p[:len(x), i] for i, x in enumerate(pages)]

    def unscan(self, x: np.ndarray, mask: np.ndarray, d: str, kept: list, above: np.ndarray) -> dict:
        h = HIDDEN_UNITS
        ds, dc = np.zeros((x.shape[1], h)), np.zeros((x.shape[1], h))
        dz = np.zeros((*x.shape[:2], 4 * h))
        grad_h = np.zeros((h, 4 * h))
        for t in range(len(x) - 1, -1, -1):
            i, f, o, g, cell, squashed, state = kept[t]
            m = mask[t][:, None]
            ds = ds + above[t]
            own = np.where(m, ds, 0)
            into = np.where(m, dc, 0) + own * o * (1 - squashed ** 2)
            z = np.concatenate([into * g * i * (1 - i), into * cell * f * (1 - f), own * squashed * o * (1 - o), into * i * (1 - g ** 2)], axis=1)
            dz[t] = z
            grad_h += state.T @ z
            ds = np.where(m, 0, ds) + z @ self.w[d + "h"].T
            dc = np.where(m, into * f, dc)
        flat = dz.reshape(-1, 4 * h)
        return {d + "x": x.reshape(-1, x.shape[2]).T @ flat, d + "h": grad_h, d + "b": flat.sum(axis=0)}

    def forward(self, x: np.ndarray, mask: np.ndarray):
        front, kept_f = self.scan(x, mask, "f")
        back, kept_b = self.scan(x[::-1], mask[::-1], "b")
        both = np.concatenate([front, back[::-1]], axis=2)
        return sigmoid(both @ self.w["o"] + self.w["ob"])[..., 0], both, kept_f, kept_b

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        p, both, kept_f, kept_b = self.forward(x, mask)
        error = np.where(mask, p - y, 0)[..., None] / mask.sum()
        above = error @ self.w["o"].T
        h = HIDDEN_UNITS
        return {"o": both.reshape(-1, 2 * h).T @ error.reshape(-1, 1), "ob": error.sum(axis=(0, 1)),
                **self.unscan(x, mask, "f", kept_f, above[..., :h]), **self.unscan(x[::-1], mask[::-1], "b", kept_b, above[::-1][..., h:])}


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(len(p) for p in pages), len(pages), pages[0].shape[1]), np.float32)
    mask = np.zeros(x.shape[:2], bool)
    for i, p in enumerate(pages):
        x[:len(p), i], mask[:len(p), i] = p, True
    return x, mask


def train(pages: list[str]) -> Network:
    """Fit on the blocks that the markup labels; pages without any give a network that follows chance, as does no page."""
    rng = np.random.default_rng(SEED)
    network = Network(rng)
    read = [list(leaves(p)) for p in pages]
    strange = [x for page in read for x in page if len(x.text) > 20]
    data = []
    for page in read:
        for _ in range(VARIANTS):
            blocks, y = varied(page, rng, strange)
            if blocks:
                x = vectors(blocks)
                x[:, PLACE] = places(len(blocks))
                data.append((x, y))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.w.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for i in range(0, len(data), BATCH):
            some = [data[j] for j in order[i:i + BATCH]]
            x, mask = padded([v for v, _ in some])
            y = np.zeros(mask.shape)
            for j, (_, labels) in enumerate(some):
                y[:len(labels), j] = labels
            step += 1
            for k, g in network.gradients(x, mask, y).items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                network.w[k] -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return network


def labelled(network: Network, read: list[tuple[list[str], np.ndarray]]) -> list[str]:
    """Main text of pages that were read; pages of like length run together as long as their blocks, padded, keep to BLOCKS_AT_ONCE."""
    found = [""] * len(read)
    order = sorted((j for j in range(len(read)) if read[j][0]), key=lambda j: len(read[j][0]), reverse=True)
    while order:
        width = max(1, min(32, BLOCKS_AT_ONCE // len(read[order[0]][0])))
        group, order = order[:width], order[width:]
        for j, p in zip(group, network.predict([read[j][1] for j in group])):
            found[j] = "\n".join(x for x, q in zip(read[j][0], p) if q >= 0.5)
    return found


def main_texts(network: Network, pages: list[str | None]) -> list[str]:
    """Main text of each page: its blocks with a probability of one half or more, a line each."""
    out, read, blocks = [], [], 0
    for page in pages:
        read.append(network.inputs(leaves(page or "")))
        blocks += len(read[-1][0])
        if blocks >= BLOCKS_AT_ONCE:
            out += labelled(network, read)
            read, blocks = [], 0
    return out + labelled(network, read)


def extractor(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "html"):
                found = main_texts(network, [None if x is None else x.decode("utf-8", "replace") for x in piece.column("html").to_pylist()])
                yield batch_of(EXTRACTED, page_id=piece.column("page_id"), url=piece.column("url"), text=found, n_chars=[len(x) for x in found])
    return run


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page; null and empty html give an empty text.

    The network is fitted on at most SAMPLE_PAGES pages of up to SAMPLE_CHARS
    characters, taken by key hash; a table without pages that long or short enough
    trains on none. Repeated rows are extracted alike; a null page_id stays null. The
memory of a task grows with the text of a page and by about 600 bytes a block.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    small = source.filter(f"length(html) <= {SAMPLE_CHARS}")
    chosen = small.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE_PAGES)  # keys first: pages move once
    rows = small.join(F.broadcast(chosen), "page_id", "left_semi").select("page_id", "html").distinct().limit(2 * SAMPLE_PAGES).collect()
    network = train([h.decode("utf-8", "replace") for _, h in sorted((r["page_id"], bytes(r["html"])) for r in rows)])
    return source.mapInArrow(extractor(network), "page_id long, url string, text string, n_chars long")
