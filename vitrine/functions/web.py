"""URL expressions: platform, host and API base of a shop."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL patterns of the two shop platforms.
SHOPIFY_HOST = r"(?i)[^.]+\.myshopify\.com"
WOO_API = r"(?i)wp-json/wc/(store/v1|v[23])/products"
SHOPIFY_SUFFIX = ".myshopify.com"


def host(url: Column) -> Column:
    """Lower-cased host name, or NULL."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def platform_of(url: Column) -> Column:
    """shopify, woocommerce or generic, from the URL alone."""
    name = F.coalesce(host(url), F.lit(""))
    return (F.when(name.rlike(SHOPIFY_HOST), "shopify")
            .when(url.rlike(WOO_API), "woocommerce")
            .when(name.endswith("myshopify.com") | url.contains("/products.json"), "shopify")
            .otherwise("generic"))


def shop_base(url: Column) -> Column:
    """Base URL of a shop: the host for Shopify (a bare name is a myshopify.com shop),
    everything before the API path otherwise."""
    bare = F.trim(url)
    shop = F.when(bare.rlike("^https?://"), F.coalesce(host(bare), bare)).when(
        bare.contains("."), bare).otherwise(F.concat(bare, F.lit(SHOPIFY_SUFFIX)))
    own = F.rtrim(F.substring_index(bare, "/wp-json/", 1), F.lit("/"))
    looks_shopify = (platform_of(bare) == "shopify") | ~bare.rlike("[/.]")
    return F.when(looks_shopify, F.concat(F.lit("https://"), shop)).otherwise(own)


def absolute(url: Column, base: Column) -> Column:
    """Resolve a site-relative link against its shop; empty stays empty."""
    root = F.rtrim(base, F.lit("/"))
    return (F.when(F.coalesce(url, F.lit("")) == "", "")
            .when(url.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), url)
            .when(url.startswith("//"), F.concat(F.lit("https:"), url))
            .when(url.startswith("/"), F.concat(root, url))
            .otherwise(F.concat(root, F.lit("/"), url)))
