"""Field extraction from stored HTML with native regex column functions.

Patterns avoid look-around so that Java regex and RE2 agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Extraction patterns (group 1 is the field).
LANG_RE = r'<html[^>]* lang="([^"]*)"'
TITLE_RE = r"<title>([^<]*)</title>"
H1_RE = r"<h1>([^<]*)</h1>"
AD_RE = r'<div class="ad">([^<]*)</div>'
LINK_RE = r'<a href="([^"]*)"'
NAV_ITEM_RE = r'<li><a href="([^"]*)">([^<]*)</a></li>'
NAV_RE = r"<nav[ >]"
QUERY_OR_FRAGMENT_RE = r"[?#].*$"


def field(html: Column, pattern: str) -> Column:
    """Group 1 of the first match; null when the element is absent."""
    v = F.regexp_extract(html, pattern, 1)
    return F.when(html.rlike(pattern), v)


def count_matches(html: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(html, F.lit(pattern), 0))


def has_element(html: Column, pattern: str) -> Column:
    return html.rlike(pattern)


def canonical_url(url: Column) -> Column:
    """URL without query string and fragment."""
    return F.regexp_replace(url, QUERY_OR_FRAGMENT_RE, "")


def item_url(prefix: str, item_id: Column, width: int = 10) -> Column:
    """Fixed prefix + the last ``width`` characters of an item id."""
    return F.concat(F.lit(prefix), F.right(item_id, F.lit(width)))
