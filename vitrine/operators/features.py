"""Normalised and derived product features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.numeric import as_number, finite, min_max
from vitrine.schema import NUMERIC_CORE
from vitrine.session import one_row

# Availability patterns. The loose one misses "instock" and matches
# "indisponible"; the strict one corrects both.
AVAILABLE_PATTERN = "in.stock|true|yes|disponible"
AVAILABLE_PATTERN_STRICT = r"\bin.?stock\b|\btrue\b|\byes\b|\bdisponible\b"

# Estimated country by a word in the source file name, ISO codes,
# display names of platforms.
FILE_COUNTRY = {"shopify": "United States", "aggregated": "United States", "woocommerce": "United Kingdom"}
COUNTRY_ISO3 = {"United States": "USA", "United Kingdom": "GBR"}
PLATFORM_NAMES = {"shopify": "Shopify", "woocommerce": "WooCommerce"}


def normalize(df: DataFrame, columns: Sequence[str] = NUMERIC_CORE) -> DataFrame:
    """Add `{c}_norm` in [0, 1]; a constant column maps to 0.

    All extremes come from one aggregate over a column-pruned scan; the table itself
    is only projected, never joined or shuffled.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    values = df.select(*[F.coalesce(as_number(df, c), F.lit(0.0)).alias(c) for c in present])
    ends = one_row(values.agg(*[e for c in present for e in (F.min(c).alias(f"{c}_lo"), F.max(c).alias(f"{c}_hi"))]))
    return df.withColumns({
        f"{c}_norm": min_max(F.coalesce(as_number(df, c), F.lit(0.0)),
                             F.lit(ends[f"{c}_lo"]).cast("double"), F.lit(ends[f"{c}_hi"]).cast("double"))
        for c in present})


def derive(df: DataFrame, strict: bool = False) -> DataFrame:
    """Add prix_par_rating, engagement, disponible and log_reviews."""
    def number(c: str):
        return F.coalesce(as_number(df, c), F.lit(0.0)) if c in df.columns else F.lit(0.0)

    price, rating, reviews, stock = (number(c) for c in NUMERIC_CORE)
    ratio = F.when(rating != 0, F.try_divide(price, rating)).otherwise(price)
    in_stock = stock > 0
    if "availability" in df.columns:
        pattern = AVAILABLE_PATTERN_STRICT if strict else AVAILABLE_PATTERN
        in_stock = in_stock | F.coalesce(F.lower("availability").rlike(pattern), F.lit(False))
    return df.withColumns({
        "prix_par_rating": F.coalesce(finite(ratio), F.lit(0.0)),
        "engagement": reviews * rating,
        "disponible": in_stock.cast("int"),
        "log_reviews": F.log1p(F.greatest(reviews, F.lit(0.0))),
    })


def source_country(file_name):
    """Estimated country of a source file; unknown names give 'Unknown'."""
    name = F.lower(file_name)
    out = F.lit("Unknown")
    for word, country in reversed(FILE_COUNTRY.items()):
        out = F.when(name.contains(word), F.lit(country)).otherwise(out)
    return out


def mapped(c, table: dict[str, str]):
    """Look `c` up in a constant table; a missing key gives NULL."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(pairs, c)
