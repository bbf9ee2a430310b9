"""Products out of shop pages: JSON scripts first, product cards where there are none."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.web import absolute, host
from vitrine.sources.payloads import canonical, embedded_fields, is_json, json_ld_fields

# Fixed value: a JSON script element and its body.
SCRIPT_PATTERN = r"""(?is)<script\b[^>]*\btype\s*=\s*["']application/(?:ld\+)?json["'][^>]*>(.*?)</script>"""
CARD_SCHEMA = "page_id bigint, page_url string, position int, id string, title string, price string, image string, href string"
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def script_products(html: Column) -> Column:
    """All product objects in a page's JSON scripts, as an array of
    (kind, payload): kind 'ld' for JSON-LD, 'embedded' for a shop's own object."""
    scripts = F.regexp_extract_all(html, F.lit(SCRIPT_PATTERN), F.lit(1))

    def is_ld(x: Column) -> Column:
        return F.coalesce(F.get_json_object(x, "$['@type']") == "Product", F.lit(False))

    def products_in(body: Column) -> Column:
        items = F.coalesce(F.from_json(F.when(is_json(body, "["), body), "ARRAY<STRING>"), F.array())
        from_list = F.transform(F.filter(items, is_ld), lambda x: F.struct(F.lit("ld").alias("kind"), x.alias("payload")))
        inner = F.get_json_object(body, "$.product")
        single = F.when(is_ld(body), F.array(F.struct(F.lit("ld").alias("kind"), body.alias("payload")))).when(
            is_json(inner, "{"), F.array(F.struct(F.lit("embedded").alias("kind"), inner.alias("payload"))))
        return F.coalesce(F.when(is_json(body, "["), from_list), F.when(is_json(body, "{"), single),
                          F.array().cast("array<struct<kind:string,payload:string>>"))

    return F.flatten(F.transform(scripts, products_in))


class CardParser(HTMLParser):
    """Collects product cards: every element whose class mentions a product or that
    carries data-product, with its first link, image, price and title."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cards: list[dict[str, str]] = []
        self.stack: list[tuple[str, list[tuple[dict, str]]]] = []
        self.open_cards: list[dict] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        classes, kind = a.get("class", ""), set(a.get("class", "").split())
        opened: list[tuple[dict, str]] = []
        for card in self.open_cards:
            if tag == "a" and "href" in a:
                card.setdefault("href", a["href"])
            if tag == "img":
                card.setdefault("image", a.get("src") or a.get("data-src", ""))
            if "price" not in card and ("price" in classes or "amount" in kind):
                card["price"] = ""
                opened.append((card, "price"))
            if "title" not in card and (tag in ("h2", "h3", "h4") or "name" in kind or "title" in classes):
                card["title"] = ""
                opened.append((card, "title"))
        if "product" in classes or "data-product" in a:
            card = {"id": a.get("id", "").replace("product-", "").replace("ProductJson-", "")}
            self.cards.append(card)
            if tag not in VOID:
                self.open_cards.append(card)
                opened.append((card, "card"))
        if tag not in VOID:
            self.stack.append((tag, opened))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not any(t == tag for t, _ in self.stack):
            return
        while self.stack:
            name, opened = self.stack.pop()
            self.open_cards = [c for c in self.open_cards if not any(k == "card" and o is c for o, k in opened)]
            if name == tag:
                return

    def handle_data(self, data):
        text = data.strip()
        if text:
            for _, opened in self.stack:
                for card, part in opened:
                    if part != "card":
                        card[part] += text


def parse_cards(html: str) -> list[dict[str, str]]:
    parser = CardParser()
    parser.feed(html)
    parser.close()
    return parser.cards


def cards_in(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Arrow batches of (page_id, page_url, html) to card rows, one page at a time."""
    names = ["page_id", "page_url", "position", "id", "title", "price", "image", "href"]
    for batch in batches:
        rows = [
            (page, url, i, *[card.get(k, "") for k in names[3:]])
            for page, url, html in zip(batch["page_id"], batch["page_url"], batch["html"]) if html
            for i, card in enumerate(parse_cards(html))]
        yield pd.DataFrame(rows, columns=names)


def page_products(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) to canonical product rows with their page and position.

    Whether a page has JSON products is decided in its own row, so the two paths
    split without a join.
    """
    base = F.concat(F.lit("https://"), F.coalesce(host(F.col("page_url")), F.lit("")))
    found = pages.select("page_id", F.col("url").alias("page_url"), "html",
                         script_products(F.col("html")).alias("found"))
    each = found.select("page_id", "page_url", F.posexplode("found").alias("position", "f")).select(
        "page_id", "page_url", "position", "f.kind", "f.payload")
    keep = ("page_id", "position")
    ld = canonical(each.filter("kind = 'ld'"), json_ld_fields("payload"), keep)
    embedded = canonical(each.filter("kind = 'embedded'"), embedded_fields("payload", base), keep)
    bare = found.filter(F.size("found") == 0)
    cards = bare.select("page_id", "page_url", "html").mapInPandas(cards_in, CARD_SCHEMA)
    shown = canonical(cards, {
        "product_id": F.col("id"), "title": F.col("title"), "image_url": F.col("image"),
        "price": F.regexp_replace("price", r"[^\d.,]", ""),
        "url": absolute(F.col("href"), base), "platform": F.lit("shopify"),
    }, keep)
    return ld.unionByName(embedded).unionByName(shown)
