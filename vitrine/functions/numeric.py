"""Number parsing and scaling expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: what counts as a plain number in text.
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def text_to_double(c: Column) -> Column:
    """Text to double: comma is a decimal point; anything unparseable is NULL.

    The pattern test keeps out spellings a JVM cast accepts but the data does not
    mean ("nan", "inf", "1.0d"). "1,234.56" has two points after the swap: NULL.
    """
    t = F.trim(F.replace(c, F.lit(","), F.lit(".")))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def as_number(df: DataFrame, name: str) -> Column:
    """Column `name` as double, whatever its stored type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return text_to_double(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite(F.col(name).cast("double"))
    return F.col(name).cast("double")


def min_max(x: Column, lo: Column, hi: Column) -> Column:
    """Scale to [0, 1]; a constant column scales to 0."""
    return F.when(hi == lo, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


def round_dec(c: Column, digits: int) -> Column:
    """Round half up on a decimal image of the value, so float noise below 1e-8
    cannot flip a tie."""
    return F.round(c.cast("decimal(28,8)"), digits).cast("double")
