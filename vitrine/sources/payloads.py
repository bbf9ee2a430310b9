"""Shop API payloads (JSON text) to canonical product rows.

A field that is absent or JSON null becomes empty text. Where the source takes the
first non-empty of several fields, empty text is skipped too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.text import strip_html, strip_space
from vitrine.functions.web import absolute
from vitrine.schema import RAW_FIELDS

# Keys under which an envelope may hold its list of products.
ENVELOPE_KEYS = ("products", "data", "items", "results")

VARIANTS = "ARRAY<STRUCT<price STRING, compare_at_price STRING, inventory_quantity STRING>>"
GENERIC = ", ".join(f"`{f}` STRING" for f in (
    "id", "name", "title", "description", "body_html", "brand", "url", "link", "currency", "review_count",
    "reviews_count", "vendor", "seller", "published_at", "date_created", "price", "sale_price", "regular_price",
    "original_price", "discount", "discount_percent", "rating", "average_rating", "availability", "stock_status",
    "stock_quantity", "stock", "categories", "product_type", "image", "thumbnail", "shop_name", "store_name",
)) + f", variants {VARIANTS}, images ARRAY<STRING>"

STORE_API = """id STRING, name STRING, description STRING,
    prices STRUCT<price STRING, regular_price STRING, sale_price STRING, currency_code STRING,
                  currency_minor_unit INT>,
    images ARRAY<STRING>, categories STRING, average_rating STRING, stock_status STRING, quantity STRING,
    permalink STRING, url STRING, review_count STRING, vendor STRING"""

RENDERED = "STRUCT<rendered STRING>"
WP_V2 = f"""id STRING, title {RENDERED}, content {RENDERED}, excerpt {RENDERED}, meta MAP<STRING, STRING>,
    featured_media_url STRING, link STRING, _embedded STRUCT<`wp:term` STRING>"""

JSON_LD = """sku STRING, name STRING, description STRING, image STRING, url STRING, brand STRING, offers STRING"""
OFFER = "price STRING, priceCurrency STRING, availability STRING"
EMBEDDED = f"""id STRING, title STRING, description STRING, url STRING, vendor STRING, published_at STRING,
    image STRING, images ARRAY<STRING>, variants {VARIANTS}"""


def first_present(*columns: Column) -> Column:
    """First that is not missing, else empty text."""
    return F.coalesce(*columns, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """First that is neither missing nor empty, else empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def is_json(c: Column, opener: str) -> Column:
    return F.coalesce(F.ltrim(c).startswith(opener), F.lit(False))


def names_of(c: Column) -> Column:
    """A JSON list of objects as their names, joined by ', '; other text as it is."""
    names = F.transform(F.from_json(c, "ARRAY<STRUCT<name STRING>>"), lambda x: F.coalesce(x["name"], F.lit("")))
    return F.when(is_json(c, "["), F.array_join(names, ", ")).otherwise(c)


def image_url(images: Column, *fallback: Column) -> Column:
    """Address of the first image, given as an object or as plain text."""
    head = F.try_element_at(images, F.lit(1))
    from_object = first_present(F.get_json_object(head, "$.src"), F.get_json_object(head, "$.url"))
    return F.when(head.isNotNull(), F.when(is_json(head, "{"), from_object).otherwise(head)).otherwise(
        first_present(*fallback))


def variant_field(variants: Column, field: str, *fallback: Column) -> Column:
    """Field of the first variant if there is one, else the top-level field."""
    head = F.try_element_at(variants, F.lit(1))
    return F.when(F.coalesce(F.size(variants), F.lit(0)) > 0, first_present(head[field])).otherwise(
        first_present(*fallback))


def canonical(df: DataFrame, fields: dict[str, Column], keep: tuple[str, ...] = ()) -> DataFrame:
    """All 32 fields in order, those not given as empty text."""
    return df.select(*keep, *[
        F.coalesce(fields.get(f, F.lit("")), F.lit("")).cast("string").alias(f) for f in RAW_FIELDS])


def is_on_sale(promo: Column, price: Column) -> Column:
    """A promo price is present and differs, as text, from the price."""
    return F.coalesce((promo != "") & (promo != F.coalesce(price, F.lit(""))), F.lit(False))


def unwrap(df: DataFrame, body: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per product of a response body: a bare list, or the first list found
    under the known keys. Result: `keep`, `position`, `payload` (JSON text)."""
    text = F.col(body)
    listed = F.when(is_json(text, "["), F.from_json(text, "ARRAY<STRING>"))
    for key in ENVELOPE_KEYS:
        inner = F.get_json_object(text, f"$.{key}")
        listed = F.coalesce(listed, F.when(is_json(text, "{") & is_json(inner, "["),
                                           F.from_json(inner, "ARRAY<STRING>")))
    return df.select(*keep, F.posexplode(listed).alias("position", "payload"))


def normalize_generic(df: DataFrame, payload: str, platform: str, scraped_at: Column | None = None,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Generic and Shopify product JSON to canonical rows."""
    parsed = df.select(*keep, F.from_json(payload, GENERIC).alias("p"))
    p = {f.name: F.col(f"p.{f.name}") for f in parsed.schema["p"].dataType.fields}
    return canonical(parsed, {
        "product_id": p["id"],
        "title": first_filled(p["name"], p["title"]),
        "description": strip_space(first_filled(p["description"], p["body_html"])),
        "category": first_filled(names_of(F.nullif(p["categories"], F.lit("[]"))), names_of(p["product_type"])),
        "brand": p["brand"],
        "image_url": image_url(p["images"], p["image"], p["thumbnail"]),
        "url": first_present(p["url"], p["link"]),
        "platform": F.lit(platform),
        "price": variant_field(p["variants"], "price", p["price"]),
        "price_promo": variant_field(p["variants"], "compare_at_price", p["sale_price"]),
        "price_old": first_present(p["regular_price"], p["original_price"]),
        "discount_pct": first_present(p["discount"], p["discount_percent"]),
        "currency": p["currency"],
        "rating": first_present(p["rating"], p["average_rating"]),
        "review_count": first_present(p["review_count"], p["reviews_count"]),
        "availability": first_present(p["availability"], p["stock_status"]),
        "stock_quantity": variant_field(p["variants"], "inventory_quantity", p["stock_quantity"], p["stock"]),
        "vendor": first_present(p["vendor"], p["seller"]),
        "shop_name": first_present(p["shop_name"], p["store_name"], p["vendor"]),
        "published_at": first_present(p["published_at"], p["date_created"]),
        "scraped_at": scraped_at if scraped_at is not None else F.lit(""),
    }, keep)


def normalize_store_api(df: DataFrame, payload: str, scraped_at: Column | None = None,
                        minor_units: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """WooCommerce Store API JSON to canonical rows.

    Prices are copied as sent; `minor_units` divides them by the power of ten the
    payload names.
    """
    parsed = df.select(*keep, F.from_json(payload, STORE_API).alias("p"))
    scale = F.pow(F.lit(10.0), F.coalesce("p.prices.currency_minor_unit", F.lit(0)))

    def price(field: str) -> Column:
        sent = F.col(f"p.prices.{field}")
        return F.coalesce((sent.try_cast("double") / scale).cast("string"), sent) if minor_units else sent

    return canonical(parsed, {
        "product_id": F.col("p.id"),
        "title": F.col("p.name"),
        "description": strip_html(F.col("p.description"), all_entities=True),
        "category": names_of(F.col("p.categories")),
        "image_url": image_url(F.col("p.images")),
        "url": first_present(F.col("p.permalink"), F.col("p.url")),
        "platform": F.lit("woocommerce"),
        "price": price("price"),
        "price_promo": price("sale_price"),
        "price_old": price("regular_price"),
        "currency": F.col("p.prices.currency_code"),
        "rating": F.col("p.average_rating"),
        "availability": F.col("p.stock_status"),
        "stock_quantity": first_filled(F.nullif(F.col("p.quantity"), F.lit("0")), F.col("p.stock_status")),
        "scraped_at": scraped_at if scraped_at is not None else F.lit(""),
    }, keep)


def normalize_wp_v2(df: DataFrame, payload: str, scraped_at: Column | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """WordPress v2 product JSON to canonical rows; shop fields sit in `meta`."""
    parsed = df.select(*keep, F.from_json(payload, WP_V2).alias("p"))

    def meta(key: str) -> Column:
        return F.try_element_at(F.col("p.meta"), F.lit(key))

    return canonical(parsed, {
        "product_id": F.col("p.id"),
        "title": F.col("p.title.rendered"),
        "description": first_filled(strip_html(F.col("p.content.rendered"), all_entities=True),
                                    strip_html(F.col("p.excerpt.rendered"), all_entities=True)),
        "category": names_of(F.col("p._embedded.`wp:term`")),
        "image_url": F.col("p.featured_media_url"),
        "url": F.col("p.link"),
        "platform": F.lit("woocommerce"),
        "price": first_present(meta("_price"), meta("_regular_price")),
        "price_promo": meta("_sale_price"),
        "price_old": meta("_regular_price"),
        "availability": meta("_stock_status"),
        "stock_quantity": first_filled(meta("_stock"), meta("_stock_status")),
        "scraped_at": scraped_at if scraped_at is not None else F.lit(""),
    }, keep)


def json_ld_fields(p: str) -> dict[str, Column]:
    """Canonical fields of a JSON-LD product held as text in column `p`."""
    ld = F.from_json(F.col(p), JSON_LD)
    offers = ld["offers"]
    offer_text = F.when(is_json(offers, "["), F.get_json_object(offers, "$[0]")).otherwise(offers)
    offer = F.from_json(offer_text, OFFER)
    brand = ld["brand"]
    return {
        "product_id": ld["sku"],
        "title": ld["name"],
        "description": strip_space(ld["description"]),
        "brand": F.when(is_json(brand, "{"), first_present(F.get_json_object(brand, "$.name"))).otherwise(brand),
        "image_url": ld["image"],
        "url": ld["url"],
        "platform": F.lit("shopify"),
        "price": offer["price"],
        "currency": offer["priceCurrency"],
        "availability": F.when(offer["availability"].contains("InStock"), "in stock").otherwise(""),
    }


def embedded_fields(p: str, base: Column) -> dict[str, Column]:
    """Canonical fields of a product JSON embedded in a shop page."""
    e = F.from_json(F.col(p), EMBEDDED)
    return {
        "product_id": e["id"],
        "title": e["title"],
        "description": strip_space(e["description"]),
        "image_url": image_url(e["images"], e["image"]),
        "url": absolute(e["url"], base),
        "platform": F.lit("shopify"),
        "price": variant_field(e["variants"], "price"),
        "price_promo": variant_field(e["variants"], "compare_at_price"),
        "vendor": e["vendor"],
        "shop_name": e["vendor"],
        "published_at": e["published_at"],
    }
