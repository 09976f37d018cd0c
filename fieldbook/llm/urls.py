"""URL filters with redirect equivalence, in DataFrame expressions only.

Explicit rules (host and path prefix; the longest that fits wins) decide first.  Pages that
redirect to, or name as canonical, another address are its aliases.  Connected components
over these links carry decisions: a page without a rule is allowed if any address of its
component is explicitly allowed, else blocked if any is blocked, else allowed.

An address is host and path, and what follows `?`; scheme, port spelling and `#` do not
tell two apart.  Defined results: a null url or one without `://` has empty host and path,
is no alias of anything and fits no rule; null markup has no links; repeated pages are
judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.graph import components
from fieldbook.llm.store import kept, without_names

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?\s*canonical\b)[^>]*>"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?\s*refresh\b)[^>]*>"
_HREF = r"(?is)\bhref\s*=\s*[\"']?\s*([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?\s*([^\"'\s>]+)"


@dataclass(frozen=True)
class Rule:
    """A decision for a host with its subdomains, and paths that begin so."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path and query of a url; empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
    given = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(given, pattern, 1), _UPPER, _LOWER)
    return host, F.regexp_extract(given, pattern, 2), F.regexp_extract(given, pattern, 3)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct rule, verdict of the longest fitting rule; of equal ones an allow; else null."""
    found = [
        F.when(
            ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path)),
            F.struct(
                F.lit(len(rule.text)).alias("length"),
                F.lit(rule.verdict == "allow").alias("allows"),
                F.lit(rule.text).alias("rule"),
                F.lit(rule.verdict).alias("verdict"),
            ),
        )
        for rule in rules
    ]
    return F.array_max(F.array(*found))


def address(host: Column, path: Column, query: Column) -> Column:
    """What tells addresses apart; null without a host."""
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query))


def _absolute(url: Column, target: Column) -> Column:
    """`target` as seen from the page `url`."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:/[^/?#]*)*/)", 1)
    return (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(site, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """a, b: addresses of pages and of what they redirect to or name as canonical."""
    markup = F.coalesce(F.col(html), F.lit(""))
    # Few pages hold either word; the others are not searched for tags.
    tagged = pages.filter(F.rlike(markup, F.lit("(?i)canonical|refresh"))).select(
        F.col(url).alias("url"),
        F.explode(
            F.concat(
                F.transform(F.regexp_extract_all(markup, F.lit(_CANONICAL), F.lit(0)), lambda t: F.regexp_extract(t, _HREF, 1)),
                F.transform(F.regexp_extract_all(markup, F.lit(_REFRESH), F.lit(0)), lambda t: F.regexp_extract(t, _TARGET, 1)),
            )
        ).alias("target"),
    )
    target = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    ends = tagged.filter("target <> ''").select(
        address(*split(F.col("url"))).alias("a"),
        address(*split(_absolute(F.col("url"), target))).alias("b"),
    )
    return ends.filter("a is not null and b is not null and a <> b").distinct()


def component_verdicts(edges: DataFrame, rules: list[Rule]) -> DataFrame:
    """address, component_verdict: allow, block, or null where no rule touches its component."""
    placed = kept(components(edges), "url-components")
    host, path, _ = split(F.concat(F.lit("x://"), F.col("node")))
    ruled = placed.withColumn("own", fitting_rule(host, path, rules)["verdict"])
    decided = ruled.groupBy("component").agg(
        # "allow" comes before "block": the least is the allow, wherever there is one.
        F.min("own").alias("component_verdict")
    )
    return ruled.join(decided, "component").select(F.col("node").alias("address"), "component_verdict")


def judge(
    pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html"
) -> DataFrame:
    """`pages` without the markup, with host, path, rule, component_verdict and verdict.

    Columns of `pages` that have one of these names, or are called address or fits, give way.
    """
    pages = without_names(pages, "host", "path", "rule", "component_verdict", "verdict", "address", "fits")
    edges = kept(alias_edges(pages, url, html), "url-aliases")
    verdicts = kept(component_verdicts(edges, rules), "url-verdicts")
    host, path, query = split(F.col(url))
    read = (
        pages.drop(html)
        .withColumns({"host": host, "path": path, "address": address(host, path, query)})
        .withColumn("fits", fitting_rule(F.col("host"), F.col("path"), rules))
    )
    joined = read.join(verdicts, "address", "left")
    return joined.select(
        *[c for c in pages.columns if c != html],
        "host",
        "path",
        F.col("fits.rule").alias("rule"),
        "component_verdict",
        F.coalesce("fits.verdict", "component_verdict", F.lit("allow")).alias("verdict"),
    )
