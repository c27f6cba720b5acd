"""URL rules with redirect equivalence.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts
with the rule's; the longest fitting rule decides.  Pages that no rule fits take part in
equivalence classes: connected components over redirect and canonical-link edges, computed
as Spark joins.  A class that holds an explicitly allowed url allows its other members;
else one that holds a blocked url blocks them; else they are allowed.  Urls that are only
targets, and never pages, take part too.

Two urls are one node if they agree in host (lower case, without the scheme's default port),
path and query, after dot segments are resolved, percent-encoded unreserved characters are
decoded and other escapes are in upper case.  Scheme and fragment do not count, and an empty
path is ``/``.  A class's explicit verdicts come from all pages of its nodes, in whatever way
their urls are written, and from the ends of its links.

Defined cases
* null urls and urls without ``://``: empty host and path, no rule, no node: allowed.
* null html: no edges.  Relative targets are resolved against the page's url.
* null page_id and repeated rows: every row is answered on its own url.
* empty pages: no rows; no rules: everything is allowed.  Two equally long rules for one
  url can only be the same host and path; then allow comes first.
* other columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.graph import connected_components
from quarry.session import materialize

ALLOW, BLOCK = "allow", "block"

# (verdict, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def unescaped(text: Column) -> Column:
    """Percent-encoded letters, digits, ``-._~`` decoded; other escapes in upper case."""
    def piece(x, i):
        code = F.left(x, F.lit(2))
        char = F.char(F.conv(code, 16, 10).cast("int"))
        put = F.when(char.rlike("^[A-Za-z0-9._~-]$"), char).otherwise(F.concat(F.lit("%"), F.upper(code)))
        return F.when(i == 0, x).when(x.rlike("^[0-9A-Fa-f]{2}"), F.concat(put, F.substring(x, F.lit(3), F.char_length(x)))).otherwise(F.concat(F.lit("%"), x))

    return F.when(text.contains("%"), F.array_join(F.transform(F.split(text, "%"), piece), "")).otherwise(text)


def without_dots(path: Column) -> Column:
    """A path that starts with ``/``, its ``.`` and ``..`` segments resolved."""
    parts = F.split(F.substring(path, F.lit(2), F.char_length(path)), "/")
    dots = lambda x: x.isin(".", "..")

    def walk(kept, x):
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(x == ".", kept).when(x == "..", up).otherwise(F.concat(kept, F.array(x)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), walk)
    kept = F.when(dots(F.element_at(parts, -1)), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike("/\\.{1,2}(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """Identity of a url among aliases; null without a host."""
    scheme = F.lower(F.regexp_extract(url, "^([^:/?#]*)://", 1))
    port = F.when(scheme == "http", ":(80)?$").when(scheme == "https", ":(443)?$").otherwise(":$")
    host, path = F.regexp_replace(host_of(url), port, F.lit("")), unescaped(path_of(url))
    query = unescaped(F.regexp_extract(url, "://[^?#]*(\\?[^#]*)?", 1))
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(without_dots(path)), query))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted or bare; empty if absent."""
    value = [F.regexp_extract(tag, f"(?i)[\\s\"']{name}\\s*=\\s*{q}", 1) for q in ('"([^"]*)"', "'([^']*)'", "([^\\s\"'>]+)")]
    return F.coalesce(*(F.when(v != "", F.trim(v)) for v in value), F.lit(""))


def targets(html: Column) -> Column:
    """Targets of canonical links and of refresh redirects, as written in the page."""
    links = F.regexp_extract_all(html, F.lit("(?i)(<link\\b[^>]*>)"), F.lit(1))
    canonical = F.filter(links, lambda t: attribute(t, "rel").rlike("(?i)(^|\\s)canonical(\\s|$)"))
    metas = F.regexp_extract_all(html, F.lit("(?i)(<meta\\b[^>]*>)"), F.lit(1))
    refresh = F.filter(metas, lambda t: F.lower(attribute(t, "http-equiv")) == "refresh")
    moved = F.transform(refresh, lambda t: F.trim(F.regexp_extract(attribute(t, "content"), "(?i)^[\\s0-9.]*[;,\\s]\\s*(?:url\\s*=\\s*)?[\"']?([^\"']+)", 1)))
    both = F.concat(F.transform(canonical, lambda t: attribute(t, "href")), moved)
    return F.transform(F.filter(both, lambda u: u != ""), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))


def resolve(base: Column, target: Column) -> Column:
    """``target`` as an absolute url, seen from the page ``base``."""
    root = F.regexp_extract(base, "^([^?#]*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, "^([^?#]*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    page = F.regexp_extract(base, "^([^?#]*)", 1)
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(page, target))
        .when(target.startswith("#"), base)
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(root, F.lit("/"))), target))
    )


def edges_of(pages: DataFrame) -> DataFrame:
    """(src, dst, src_url, dst_url): redirect and canonical edges between different nodes."""
    raw = pages.select("url", F.explode(targets(F.col("html"))).alias("target")).where(F.col("url").contains("://"))
    ends = raw.select("url", resolve(F.col("url"), F.col("target")).alias("to"))
    e = ends.select(node_of(F.col("url")).alias("src"), node_of(F.col("to")).alias("dst"), F.col("url").alias("src_url"), F.col("to").alias("dst_url"))
    return e.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) for the distinct urls of column ``url`` that some rule fits:
    an equi-join on the host's suffixes, then the longest rule by a maximum, which is
    pre-aggregated."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    seen = urls.select("url").where(F.col("url").contains("://")).distinct()
    seen = seen.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    tried = seen.select("url", "path", F.explode(suffixes).alias("rule_host"))
    fits = tried.join(rules.select("verdict", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")), "rule_host")
    fits = fits.where(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = fits.groupBy("url").agg(F.max(F.struct(F.char_length(rule).alias("size"), (F.col("verdict") == ALLOW).alias("allowed"), rule.alias("rule"), "verdict")).alias("best"))
    return best.select("url", "best.rule", "best.verdict")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, via) for every page; via tells where the
    verdict comes from: rule, alias or default."""
    links = materialize(edges_of(pages.select("url", "html")).distinct(), "url-edges")
    ends = links.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.col("src_url").alias("url")), F.struct(F.col("dst").alias("node"), F.col("dst_url").alias("url")))).alias("e")).select("e.*")
    named = pages.where(F.col("url").contains("://")).select(node_of(F.col("url")).alias("node"), "url").distinct()
    ends = ends.unionByName(named.join(ends.select("node").distinct(), "node", "left_semi")).distinct()
    groups = connected_components(links.select("src", "dst"), ends.select("node"))
    explicit = ends.join(match_rules(ends, rules), "url").select("node", "verdict")
    decided = groups.join(explicit, "node").groupBy("component").agg(F.max((F.col("verdict") == ALLOW).cast("int")).alias("allowed"))
    inherited = groups.join(decided, "component").select("node", F.when(F.col("allowed") == 1, ALLOW).otherwise(BLOCK).alias("inherited"))

    url = F.col("url")
    rows = pages.select("page_id", url, host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    # rows without a node meet nobody: they stay out of the joins, however many there are
    apart = rows.where(F.col("node").isNull()).select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"), F.lit(None).cast("string").alias("inherited"))
    met = rows.where(F.col("node").isNotNull()).join(match_rules(rows, rules), "url", "left").join(inherited, "node", "left")
    rows = met.unionByName(apart)
    via = F.when(F.col("rule").isNotNull(), "rule").when(F.col("inherited").isNotNull(), "alias").otherwise("default")
    return rows.select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", "inherited", F.lit(ALLOW)).alias("verdict"), via.alias("via"))


def rule_table(spark, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
