"""URL filter with redirect equivalence.

Rules are (verdict, "host/path-prefix"). A rule fits its host and all subdomains when the url's path
starts with the rule's path; the longest fitting rule wins. Pages that no rule fits take the decision
of their aliases: pages are tied by the redirects that a url implies (scheme, ``www.``/``m.``,
trailing slash, ``.html``, tracking parameters, fragment), by the canonical link and by the refresh
redirect in their html, and by an optional table of known redirects. Connected components over these
edges carry the decisions: an alias that a rule allows explicitly goes first, then a blocked alias,
else the page is allowed. A page's own rule is never overruled.

The urls that links and redirects lead to (and known redirects come from) decide by the rules that fit them, whether
or not they are in the table; without ``judge_targets`` only the pages of the table do.

Defined results: null url, or one without ``://``: host and path empty, no rule, no aliases, verdict
allow. Null html: no edges. Repeated rows and repeated ids are judged row by row. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, components

# --- fixed values: the rules of the registered query
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

# --- fixed values: hosts' alias prefixes and tracking parameters
ALIAS_HOST = r"^(?:www|m)\."
TRACKING = r"(?:utm_[a-z]+|ref|fbclid|gclid)"

CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _after_scheme(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def alias_key(url: Column) -> Column:
    """The form that a url's implied redirects lead to; null without a host."""
    host = F.regexp_replace(url_host(url), ALIAS_HOST, "")
    path = F.regexp_replace(url_path(url), r"(?:\.html|/)$", "")
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    return F.when(F.length(host) > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query))
                                               .otherwise(F.lit(""))))


def resolved(base: Column, link: Column) -> Column:
    """An absolute url for a link found on page ``base``; null for an empty link."""
    host = url_host(base)
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (F.when(link.isNull() | (link == ""), F.lit(None).cast("string"))
            .when(link.contains("://"), link)
            .when(link.startswith("//"), F.concat(F.lit("http:"), link))
            .when(link.startswith("/"), F.concat(F.lit("http://"), host, link))
            .otherwise(F.concat(F.lit("http://"), host, folder, link)))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; both null when none fits. Equal rules: block first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        at = text.find("/")
        rh, rp = text[:at].lower(), text[at:]
        fits = ((host == rh) | host.endswith("." + rh)) & path.startswith(rp)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def alias_links(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Pairs (url, to) of absolute urls from canonical links, refresh redirects and known redirects
    (a table with ``from_url`` and ``to_url``)."""
    url, html = F.col("url"), F.coalesce(F.col("html"), F.lit(""))
    links = F.array(F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1),
                    F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1))
    found = (pages.select(url, F.explode(F.array_remove(links, "")).alias("link"))
             .select(url, resolved(url, F.col("link")).alias("to")))
    if redirects is not None:
        found = found.unionByName(redirects.select(F.col("from_url").alias("url"), F.col("to_url").alias("to")))
    return found


def alias_edges(links: DataFrame) -> DataFrame:
    """Edges (a, b) between the alias keys of ``alias_links``."""
    return (links.select(alias_key(F.col("url")).alias("a"), alias_key(F.col("to")).alias("b"))
            .where("a <> b").distinct())


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES,
               redirects: DataFrame | None = None, judge_targets: bool = True) -> DataFrame:
    """Per page: page_id, url, host, path, rule, verdict, reason (rule, alias or default)."""
    p = pages.select("page_id", "url", "html")
    rule, own = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = (p.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
                       alias_key(F.col("url")).alias("_key"))
              .withColumns({"rule": rule, "_own": own}))
    links = alias_links(p, redirects)
    tied = components(alias_edges(links)).withColumnsRenamed({"node": "_key", "component": "_comp"})

    def placed(rows: DataFrame) -> DataFrame:
        return rows.join(tied, "_key", "left").withColumn("_comp", F.coalesce("_comp", "_key"))

    judged = placed(judged)
    deciding = judged.select("_comp", "_own")
    if judge_targets:
        ends = links.select(F.explode(F.array("url", "to")).alias("url"))
        verdict = fitting_rule(url_host(F.col("url")), url_path(F.col("url")), rules)[1]
        ends = ends.select(alias_key(F.col("url")).alias("_key"), verdict.alias("_own")).distinct()
        deciding = deciding.unionByName(placed(ends).select("_comp", "_own"))
    decided = (deciding.where(F.col("_own").isNotNull() & F.col("_comp").isNotNull()).groupBy("_comp")
               .agg(F.min("_own").alias("_alias")))  # "allow" sorts before "block"
    out = judged.join(decided, "_comp", "left")
    return out.select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("_own", "_alias", F.lit("allow")).alias("verdict"),
        F.when(F.col("_own").isNotNull(), "rule").when(F.col("_alias").isNotNull(), "alias")
         .otherwise("default").alias("reason"))
