"""URL filter with redirect equivalence.

Rules allow or block hosts (with their subdomains) and path prefixes; the
longest rule that fits a url decides.  A url that no rule fits is judged by its
aliases: redirect and canonical-link edges join urls into components, and a
component with a blocked url blocks its undecided ones, unless it also has an
explicitly allowed url, which takes precedence.  What nothing decides is allowed.

Edges are a page's ``<link rel="canonical" href=...>`` and
``<meta http-equiv="refresh" content="...url=...">``, whatever their case and
the order of their attributes, and rows of an optional redirect table.  Two
urls are the same node if host, path (a missing one is ``/``) and query agree;
scheme and fragment do not count.  Links may be relative, with dot segments.

Defined cases: a null url or one without ``://`` has empty host and path, fits
no rule, is no node and is allowed; null html has no links; repeated rows are
judged alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlint.llm.common import written
from ledgerlint.llm.components import components

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null if there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return _ascii_lower(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"\A([^/?#]*+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"\A[^/?#]*+([^?#]*+)", 1)


def _query_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"\A[^?#]*+(\?[^#]*+)?", 1)


def node_of(url: Column) -> Column:
    """The text that names a url's node; null if the url has no host."""
    path = path_of(url)
    host = host_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), _query_of(url)))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, r_host, r_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path)
        rule = F.when(fits, r_host + r_path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _without_dots(path: Column) -> Column:
    """A path that starts with ``/`` without its ``.`` and ``..`` segments."""
    segments = F.split(path, "/", -1)
    last = F.element_at(segments, -1)
    step = lambda kept, s: F.when(s == ".", kept).when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(s)))
    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"), step)
    plain = F.concat(F.lit("/"), F.array_join(kept, "/"))
    folder = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.concat(plain, F.lit("/"))).otherwise(plain)
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), folder).otherwise(path)


def _absolute(link: Column, url: Column) -> Column:
    """A link as its page means it."""
    path, rest = F.regexp_extract(link, r"\A([^?#]*+)", 1), F.regexp_extract(link, r"(?s)\A[^?#]*+(.*+)", 1)
    scheme = F.substring_index(url, "://", 1)
    origin = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"\A(.*/)", 1)
    return (
        F.when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(origin, _without_dots(path), rest))
        .when(link.startswith("?"), F.concat(origin, path_of(url), link))
        .when((link == "") | link.startswith("#"), url)
        .otherwise(F.concat(origin, _without_dots(F.concat(F.when(folder == "", "/").otherwise(folder), path)), rest))
    )


def links_of(html: Column) -> Column:
    """Canonical and refresh targets in a page, as an array."""
    # Quantifiers are possessive: they neither recurse nor go back in very long pages.
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<(?:link|meta)\b[^>]*+>"), F.lit(0))
    attribute = lambda tag, name: F.regexp_extract(tag, rf"""(?is)[\s"']{name}\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", 0)
    value = lambda tag, name: F.regexp_replace(F.regexp_replace(attribute(tag, name), r"(?is)\A.[^=]*+=\s*+", ""), r"""\A["']|["']\z""", "")
    canonical = F.transform(F.filter(tags, lambda t: F.array_contains(F.split(F.lower(value(t, "rel")), r"[\x20\x09-\x0D]+"), "canonical")), lambda t: F.trim(value(t, "href")))
    refresh = F.transform(
        F.filter(tags, lambda t: (F.lower(value(t, "http-equiv")) == "refresh") & value(t, "content").rlike("(?i)url\\s*=")),
        lambda t: F.trim(F.regexp_replace(F.regexp_replace(value(t, "content"), r"(?is)\A.*?url\s*+=\s*+", ""), r"""\A["']|["']\z""", "")),
    )
    has = F.lower(html).contains("canonical") | F.lower(html).contains("refresh")
    return F.when(has, F.concat(canonical, refresh)).otherwise(F.array().cast("array<string>"))


def edges_of(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(source, target) urls of the pages' links."""
    found = pages.select(pages[url].alias("source"), F.explode(links_of(pages[html])).alias("link")).filter(host_of(F.col("source")) != "")
    return found.select("source", _absolute(F.col("link"), F.col("source")).alias("target"))


def judged(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``redirects`` has more edges, as columns source and target."""
    edges = edges_of(pages, url, html)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target"))
    ends = edges.select(node_of(F.col("source")).alias("source"), node_of(F.col("target")).alias("target"), host_of(F.col("source")).alias("sh"), path_of(F.col("source")).alias("sp"), host_of(F.col("target")).alias("th"), path_of(F.col("target")).alias("tp"))
    ends = written(ends.filter("source is not null and target is not null and source <> target").distinct(), "url-edges")
    key = F.xxhash64  # urls' 64-bit names; components need numbers
    groups = components(ends.select(key("source").alias("a"), key("target").alias("b")))
    # Linked urls' own rules, whether or not they are pages here.
    linked = ends.select(key("source").alias("node"), rule_of(F.col("sh"), F.col("sp"), rules)[1].alias("own")).unionByName(
        ends.select(key("target").alias("node"), rule_of(F.col("th"), F.col("tp"), rules)[1].alias("own"))
    )
    decided = (
        groups.join(linked.filter("own is not null").distinct(), "node")
        .groupBy("root")
        .agg(F.when(F.max(F.col("own") == "allow"), "allow").otherwise("block").alias("alias_verdict"))
    )
    aliases = groups.join(decided, "root").select("node", "alias_verdict")
    rows = pages.select(pages[id].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"), key(node_of(pages[url])).alias("node"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    found = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("own"), "node")
    ruled = found.filter("own is not null").select("page_id", "host", "path", "rule", F.col("own").alias("verdict"))
    # A url that very many pages share makes a frequent node: the join shuffles by itself, and Spark may split it.
    more = F.crc32(F.col("node").cast("string").cast("binary"))
    open_ = found.filter("own is null").withColumn("more", more).join(aliases.withColumn("more", more), ["node", "more"], "left")
    return ruled.unionByName(open_.select("page_id", "host", "path", "rule", F.coalesce("alias_verdict", F.lit("allow")).alias("verdict")))
