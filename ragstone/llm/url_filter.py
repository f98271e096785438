"""URL filters with redirect equivalence.

A page is judged by the longest rule that fits its host and path. Redirect and canonical-link edges
join URLs to components; a URL blocked by rule blocks every alias in its component for which no rule
speaks. An explicit allow stands, whatever the component. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragstone.llm.common import lookup_join, written
from ragstone.llm.components import components

#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: A link tag with canonical among the tokens of its rel, or a meta tag that refreshes.
_LINKS = r"""(?i)(?<![\w-])rel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical(?![^\s/>]))|http-equiv\s*=\s*["']?refresh\b"""
#: Up to this many rules are one conditional expression; more are joined by host suffix.
INLINE_RULES = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _SPLIT, 3), F.lit(""))


def node_of(url: Column) -> Column:
    """A URL as a node: trimmed, without its fragment and dot segments, scheme and host in lower case; null without ``://``."""
    url = F.trim(url)
    part = lambda k: F.regexp_extract(url, _SPLIT, k)
    lower = lambda c: F.translate(c, _UPPER, _LOWER)
    path = F.when(part(3).contains("/."), _without_dots(part(3))).otherwise(part(3))
    return F.when(url.contains("://"), F.concat(lower(part(1)), F.lit("://"), lower(part(2)), path, part(4)))


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..``, as RFC 3986 resolves them."""

    def step(held: Column, name: Column) -> Column:
        up = F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(1)))
        return F.when(name == ".", held).when(name == "..", up).otherwise(F.concat(held, F.array(name)))

    kept = F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")
    return F.when(path.rlike(r"/\.{1,2}$") | (kept == ""), F.concat(kept, F.lit("/"))).otherwise(kept)


def _unescaped(text: Column) -> Column:
    """Character references as addresses use them; the ampersand's come last."""
    for pattern, char in ((r"&(?:quot|#0*34|#x0*22);", '"'), (r"&(?:apos|#0*39|#x0*27);", "'"), (r"&(?:sol|#0*47|#x0*2f);", "/"), (r"&(?:colon|#0*58|#x0*3a);", ":"), (r"&(?:equals|#0*61|#x0*3d);", "="), (r"&(?:quest|#0*63|#x0*3f);", "?"), (r"&(?:amp|#0*38|#x0*26);", "&")):
        text = F.regexp_replace(text, "(?i)" + pattern, char)
    return text


def _with_rule(rows: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rows`` (with host and path) and the columns rule and rule_verdict of the longest rule that fits."""
    if len(rules) <= INLINE_RULES:
        pick = F.lit(None).cast("struct<rule:string,rule_verdict:string>")
        for host, path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
            fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
            pick = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("rule_verdict"))).otherwise(pick)
        return rows.withColumn("__rule", pick).withColumns({"rule": F.col("__rule.rule"), "rule_verdict": F.col("__rule.rule_verdict")}).drop("__rule")
    table = rows.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rules)], "rule_host string, rule_path string, rule_verdict string, place int")
    places = rows.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    fits = places.withColumn("rule_host", suffix).join(table, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule_host") + F.length("rule_path"), "place", F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict")).alias("b"))
    best = written(best.select("host", "path", "b.rule", "b.rule_verdict"), "url-rules")
    return lookup_join(rows, best, ["host", "path"])


def link_edges(pages: DataFrame) -> DataFrame:
    """u, v: nodes of a page and of the targets of its canonical links and refresh redirects.

    Absolute, scheme-relative, root-relative, plain relative and query-only targets are understood, with
    character references and dot segments.
    """
    html, url = F.col("html"), F.col("url")
    tags = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0), lambda t: t.rlike(_LINKS))
    target = lambda t: F.when(t.rlike("(?i)^<link"), F.regexp_extract(t, r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)).otherwise(F.regexp_extract(t, r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)""", 1))
    rows = pages.filter(html.rlike("(?i)(canonical|refresh)") & url.contains("://")).select(url.alias("url"), F.explode(F.transform(tags, target)).alias("to")).filter("to <> ''").withColumn("to", _unescaped(F.col("to")))
    scheme, site = F.regexp_extract("url", _SPLIT, 1), F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(path_of(F.col("url")), "[^/]*$", "")
    full = (
        F.when(F.col("to").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(site, F.col("to")))
        .when(F.col("to").startswith("?"), F.concat(site, path_of(F.col("url")), F.col("to")))
        .when(F.col("to").startswith("#"), F.col("url"))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("to")))
    )
    return rows.select(node_of(F.col("url")).alias("u"), node_of(full).alias("v"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages`` (page_id, url, html).

    ``redirects``: further edges (from_url, to_url), as a crawl log has them. Null url or html: empty
    host and path, no rule, no edges, allowed. Repeated rows are judged each for itself; among rules
    of one length the later in the list wins; an empty table gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = _with_rule(rows, rules)
    edges = link_edges(pages)
    if redirects is not None:
        edges = edges.union(redirects.select(node_of(F.col("from_url")), node_of(F.col("to_url"))))
    edges = written(edges.filter("u <> v").distinct(), "url-edges")
    if edges.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"))
    nodes = written(components(edges), "url-components")
    ruled = _with_rule(nodes.withColumns({"host": host_of(F.col("node")), "path": path_of(F.col("node"))}), rules)
    blocked = ruled.filter("rule_verdict = 'block'").select("component").distinct()
    blocked_nodes = written(nodes.join(blocked, "component", "left_semi").select("node", F.lit(True).alias("blocked")), "url-blocked")
    rows = lookup_join(rows.withColumn("node", node_of(F.col("url"))), blocked_nodes, ["node"], salt=F.xxhash64("page_id"))
    verdict = F.coalesce("rule_verdict", F.when(F.col("blocked"), F.lit("block")), F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


#: For tables whose pages hold no canonical links and refresh redirects; tests hold the rest against brute force.
ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS u FROM pages),
s AS (SELECT page_id, CASE WHEN contains(u, '://') THEN substr(u, strpos(u, '://') + 3) ELSE '' END AS r FROM p),
h AS (SELECT page_id, translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM s),
rules(rh, rp, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v
      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN f ON h.page_id = f.page_id
"""
