"""URL rules that follow redirects and canonical links (operator 10).

A rule names a host, with all its subdomains, and the beginning of a path; the longest that fits a URL wins.
URLs joined by redirects or canonical links are aliases: connected components over those edges carry a
block from one alias to the others that no rule names, unless an alias is allowed by a rule.
"""

from __future__ import annotations

import html
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemart.llm.common import unused, written
from tidemart.llm.components import connected_components

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``host`` without a leading dot, ``path`` from its first slash, ``verdict`` allow or block."""

    host: str
    path: str
    verdict: str


def _small(text: Column) -> Column:
    """A-Z lower-cased, other letters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in small letters; else empty."""
    return F.coalesce(_small(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What aliases are joined by: host, path and query, without scheme and fragment. Null without ``://``."""
    rest = F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), F.when(rest == "", "/").otherwise(rest)))


def resolve(target: str, base: str) -> str | None:
    """A link's target as a URL, as a browser resolves it: character references, dot segments, targets of a query alone,
    and whatever scheme the page has. None for an empty target."""
    target = "".join(c for c in html.unescape(target).strip() if c not in "\t\n\r")
    if not target:
        return None
    scheme, _, rest = base.partition("://")
    # Joined under a scheme that is known to be hierarchical.
    joined = urljoin(f"http://{rest}", target)
    own = not urlsplit(target).scheme
    return f"{scheme}{joined.removeprefix('http')}" if own else joined


@F.pandas_udf(StringType())
def _resolved(target: pd.Series, base: pd.Series, page: pd.Series) -> pd.Series:
    def one(link: str, base: str | None, url: str) -> str | None:
        try:
            return resolve(link, (base and resolve(base, url)) or url)
        except ValueError:  # no URL at all, such as a broken IPv6 host
            return None

    return pd.Series([one(*row) for row in zip(target, base, page, strict=True)], dtype=object)


#: What markup is read without: comments, and contents that are not markup.
_UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style|noscript|template|textarea|title|iframe|svg|math)\b.*?(?:</\1\s*>|\z)"
_ATTRIBUTES = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
_VALUE = r"\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>\"']+)"


def _tags(markup: Column, name: str) -> Column:
    return F.regexp_extract_all(markup, F.lit(rf"(?is)<{name}\b{_ATTRIBUTES}>"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value without quotes, empty if there is none."""
    value = F.regexp_extract(tag, rf"(?is)(?<![\w-]){name}{_VALUE}", 1)
    return F.regexp_replace(value, r"^[\"']|[\"']$", "")


def link_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst, dst_url) of all canonical links and refreshing redirects in the pages' markup.

    Comments, scripts, styles and the like are left out. Targets are resolved against the page's URL, or its base
    element; that small step runs in Python, on the rows of links alone.
    """
    url, read = F.col(f"`{url_col}`"), F.regexp_replace(F.col(f"`{html_col}`"), _UNREAD, " ")
    marked = pages.filter(url.isNotNull() & F.rlike(F.col(f"`{html_col}`"), F.lit(r"(?i)canonical|refresh")))
    markup = marked.select(url.alias("url"), read.alias("markup"))
    canonical = F.filter(_tags(F.col("markup"), "link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical"))
    refresh = F.filter(_tags(F.col("markup"), "meta"), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh")
    after = F.transform(refresh, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?is)\burl\s*=\s*(?:\"([^\"]*)|'([^']*)|(.*))", 0))
    bare = F.transform(after, lambda x: F.regexp_replace(x, r"(?is)^url\s*=\s*[\"']?", ""))
    targets = F.concat(F.transform(canonical, lambda t: _attribute(t, "href")), bare)
    base = F.get(F.transform(_tags(F.col("markup"), "base"), lambda t: _attribute(t, "href")), F.lit(0))
    found = markup.select("url", base.alias("base"), F.explode(targets).alias("target")).filter("target <> ''")
    edges = found.withColumn("dst_url", _resolved("target", "base", "url"))
    return edges.select(node_of(F.col("url")).alias("src"), node_of(F.col("dst_url")).alias("dst"), "dst_url").dropna()


def ruled(places: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(host, path, rule, verdict) for those distinct (host, path) that a rule fits; the longest, an allow before a block.

    Every host meets the rules of its own name and of each domain above it, by an equality join.
    """
    spark = places.sparkSession
    listed = [(_rule_host(r), r.path, r.verdict, len(r.host) + len(r.path)) for r in rules]
    table = spark.createDataFrame(listed, "rule_host string, rule_path string, verdict string, size int")
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    each = places.select("host", "path").distinct().withColumn("rule_host", F.explode(above))
    fits = each.join(table, "rule_host").filter(F.startswith("path", "rule_path"))
    best = F.max(F.struct("size", (F.col("verdict") == ALLOW).alias("allows"), F.concat("rule_host", "rule_path").alias("rule"), "verdict"))
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def _rule_host(rule: Rule) -> str:
    if rule.verdict not in (ALLOW, BLOCK):
        raise ValueError(f"a rule allows or blocks: {rule}")
    return rule.host.lower().strip(".")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A page's own rule decides. Without one, it is allowed if a rule allows one of its aliases, else blocked
    if a rule blocks one, else allowed. ``redirects`` may add edges, as two columns of URLs. A null URL, or
    one without ``://``, has an empty host and path, no rule and no aliases. Rows with equal ids or URLs
    are all kept; an empty table gives no rows. Only URLs are shuffled, never markup.
    """
    spark = pages.sparkSession
    url = F.col(f"`{url_col}`").cast("string")
    own = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    edges = spark.createDataFrame([], "src string, dst string, dst_url string, src_url string")
    if html_col is not None:
        edges = edges.unionByName(link_edges(pages, url_col, html_col), allowMissingColumns=True)
    if redirects is not None:
        a, b = (F.col(f"`{c}`") for c in redirects.columns)
        more = redirects.select(node_of(a).alias("src"), node_of(b).alias("dst"), b.alias("dst_url"), a.alias("src_url"))
        edges = edges.unionByName(more.dropna())
    edges = written(spark, edges, "url-edges")
    ends = edges.select(F.explode(F.array("dst_url", "src_url")).alias("url")).dropna()
    ends = ends.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"))
    own = written(spark, own, "urls")
    verdicts = written(spark, ruled(own.unionByName(ends, allowMissingColumns=True), rules), "url-rules")

    aliases = connected_components(edges.select("src", "dst"))
    nodes = own.select("host", "path", "node").unionByName(ends).dropna(subset=["node"]).distinct()
    decided = nodes.join(aliases, "node").join(verdicts, ["host", "path"])
    any_of = [F.max((F.col("verdict") == v).cast("int")).alias(v) for v in (ALLOW, BLOCK)]
    spread = decided.groupBy("component").agg(*any_of).filter(f"{ALLOW} = 0 and {BLOCK} = 1")
    blocked = aliases.join(spread.select("component"), "component").select("node", F.lit(True).alias("alias_blocked"))

    out = own.join(verdicts, ["host", "path"], "left").join(blocked, "node", "left")
    followed = F.when(F.col("alias_blocked"), BLOCK).otherwise(ALLOW)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", followed).alias("verdict"))


def keep_allowed(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url_col: str = "url", html_col: str | None = "html") -> DataFrame:
    """The rows of ``pages`` whose URL is allowed, with all their columns."""
    key = unused(pages, "url_key")
    keyed = pages.withColumn(key, F.col(f"`{url_col}`"))
    blocked = judge_urls(keyed, rules, redirects, key, url_col, html_col).filter(F.col("verdict") == BLOCK)
    return keyed.join(blocked.select(F.col("page_id").alias(key)).distinct(), key, "left_anti").drop(key)
