"""Locale-formatted numbers: "1.342,99 €" and "4,2 stelle su 5"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_grouped_decimal(text: Column) -> Column:
    """First space-separated token, '.' thousands separators dropped, ',' as the
    decimal mark; null when the result is not a number."""
    token = F.split(F.trim(text), " ").getItem(0)
    return F.replace(F.replace(token, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def parse_leading_decimal(text: Column, width: int = 3) -> Column:
    """The first ``width`` characters with ',' as decimal mark ("4,2 stelle" → 4.2)."""
    return F.replace(F.substring(text, 1, width), F.lit(","), F.lit(".")).try_cast("double")


def format_grouped_decimal(x: Column, decimals: int = 2, suffix: str = " €") -> Column:
    """Inverse of ``parse_grouped_decimal``: 1234.5 → "1.234,50 €"."""
    return F.concat(F.translate(F.format_number(x, decimals), ",.", ".,"), F.lit(suffix))
