"""Operator 1: URL filters with redirect equivalence.

A rule names a host with its subdomains and a path prefix; the longest rule that fits a URL decides.
URLs without a rule take the decision of their aliases: redirect and canonical-link edges make
components, and a component with a blocked member blocks its members. A URL's own allow rule always
precedes what its aliases pass on.

Rules are found by equality joins on (host suffix, path prefix), never by comparing every URL with
every rule, so rule lists may be large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import joined_small, literal_rows, small
from plumbline.llm.components import components

#: The rules of the contract, host and path as one string.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return literal_rows(spark, list(rules), ["rule", "verdict"])


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict): the longest fitting rule of each distinct (host, path) that has one.

    Of equally long rules the one with the longer host wins, then the smaller string and verdict.
    """
    cut = F.instr("rule", "/")
    parsed = rules.filter("rule is not null and verdict is not null").select(
        F.when(cut > 0, F.expr("substring(rule, 1, instr(rule, '/') - 1)")).otherwise(F.col("rule")).alias("r_host"),
        F.when(cut > 0, F.expr("substring(rule, instr(rule, '/'))")).otherwise(F.lit("")).alias("r_path"),
        "rule",
        F.col("verdict").alias("rule_verdict"),
    )
    fits = small(parsed, "rule", "rule_verdict")
    # The rules of one host share few prefix lengths; only these are tried.
    lengths = parsed.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("lengths"))
    most = parsed.agg(F.max(F.size(F.split("r_host", r"\."))).alias("n")).first()["n"] or 0
    labels = F.split("host", r"\.")
    first = F.greatest(F.lit(1), F.size(labels) - most + 1)
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    hosts = places.select("host").distinct().withColumn("r_host", F.explode(suffixes))
    hosts = joined_small(hosts, lengths, "r_host", "inner", fits)
    known = hosts.groupBy("host").agg(F.collect_list(F.struct("r_host", "lengths")).alias("tries"))
    unique = places.select("host", "path").distinct()
    tried = (
        unique.join(known, "host")
        .select("host", "path", F.explode("tries").alias("t"))
        .select("host", "path", F.col("t.r_host").alias("r_host"), F.explode("t.lengths").alias("n"))
        .filter(F.length("path") >= F.col("n"))
        .withColumn("r_path", F.expr("substring(path, 1, n)"))
    )
    hits = joined_small(tried, parsed, ["r_host", "r_path"], "inner", fits)
    order = F.struct(-F.length("rule"), -F.length("r_host"), F.col("rule"), F.col("rule_verdict"))
    return hits.groupBy("host", "path").agg(F.min_by(F.struct("rule", "rule_verdict"), order).alias("best")).select(
        "host", "path", "best.*"
    )


# ---------------------------------------------------------------- aliases


def node(url: Column) -> Column:
    """A URL without its fragment."""
    return F.substring_index(url, "#", 1)


def _resolve(base: Column, href: Column) -> Column:
    """``href`` as found in the page at ``base``: absolute, scheme-, host-, or folder-relative."""
    scheme = F.substring_index(base, "://", 1)
    origin = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^?#]*/)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(base.rlike(r"://[^/?#]*/"), F.concat(folder, href))
        .otherwise(F.concat(origin, F.lit("/"), href))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): from each page to its canonical link and to where it redirects at once (meta refresh)."""
    url, html = F.col("url"), F.coalesce(F.col("html"), F.lit(""))
    quoted = r"""\s*=\s*["']?\s*([^"'\s>]+)"""
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<link\b[^>]*>"), 0), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""))
    metas = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)<meta\b[^>]*>"), 0), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    targets = F.concat(
        F.transform(links, lambda t: F.regexp_extract(t, r"(?is)\bhref" + quoted, 1)),
        F.transform(metas, lambda t: F.regexp_extract(t, r"(?is)\burl" + quoted, 1)),
    )
    href = F.regexp_replace("href", "&amp;", "&")
    found = pages.filter(F.instr(url, "://") > 0).select(url.alias("base"), F.explode(targets).alias("href")).filter("href != ''")
    return found.select(node(F.col("base")).alias("a"), node(_resolve(F.col("base"), href)).alias("b"))


def _blocked_nodes(edges: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct nodes whose component has a member that a rule blocks."""
    rooted = components(edges)
    placed = rooted.withColumn("host", host(F.col("node"))).withColumn("path", path(F.col("node")))
    blocks = match_rules(placed, rules).filter("rule_verdict = 'block'").select("host", "path")
    roots = placed.join(blocks, ["host", "path"], "left_semi").select("root").distinct()
    return rooted.join(roots, "root", "left_semi").select("node").distinct()


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, by_alias.

    ``redirects`` may add edges (columns a and b, absolute URLs) known from the crawl.
    NULL or malformed URLs have an empty host and path, no rule and are allowed. Repeated rows are
    judged alike, equal URLs share one decision, no rules allow everything but what edges block
    (nothing), an empty table gives no rows. Other columns are ignored.
    """
    given = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    edges = page_edges(given)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")))
    blocked = _blocked_nodes(edges, rules).select(F.col("node"), F.lit(True).alias("by_alias"))
    placed = given.select("page_id", node(F.col("url")).alias("node"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    # Both right sides are unique on their keys, so a URL with many rows splits on the left.
    judged = placed.join(match_rules(placed, rules), ["host", "path"], "left").join(blocked, "node", "left")
    by_alias = F.col("rule").isNull() & F.coalesce("by_alias", F.lit(False))
    verdict = F.coalesce("rule_verdict", F.when(by_alias, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), by_alias.alias("by_alias"))


def oracle() -> str:
    """Rules tried one by one, aliases by a recursive walk over the edges."""
    values = ", ".join(f"('{r[: r.index('/')]}', '{r[r.index('/'):]}', '{r}', '{v}')" for r, v in RULES)
    lower = f"translate(regexp_extract(coalesce({{0}}, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}')"
    rest = "regexp_extract(coalesce({0}, ''), '://[^/?#]*([^?#]*)', 1)"
    best = """(SELECT {0} FROM rules r WHERE (u.host = r.h OR ends_with(u.host, '.' || r.h)) AND starts_with(u.path, r.p)
               ORDER BY length(r.rule) DESC, length(r.h) DESC LIMIT 1)"""
    quoted = """\\s*=\\s*["'']?\\s*([^"''\\s>]+)"""
    return f"""
WITH RECURSIVE rules(h, p, rule, verdict) AS (VALUES {values}),
tags AS (SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\\b[^>]*>')) AS tag FROM pages WHERE contains(url, '://')),
hrefs AS (SELECT url, CASE WHEN regexp_matches(tag, '(?is)^<link.*\\brel\\s*=\\s*["'']?\\s*canonical\\b') THEN regexp_extract(tag, '(?is)\\bhref{quoted}', 1)
                           WHEN regexp_matches(tag, '(?is)^<meta.*\\bhttp-equiv\\s*=\\s*["'']?\\s*refresh\\b') THEN regexp_extract(tag, '(?is)\\burl{quoted}', 1) END AS raw FROM tags),
links AS (SELECT url, replace(raw, '&amp;', '&') AS href, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) AS origin,
                 regexp_extract(url, '^([^?#]*/)', 1) AS folder FROM hrefs WHERE raw <> ''),
edges AS (SELECT split_part(url, '#', 1) AS a, split_part(CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
            WHEN starts_with(href, '//') THEN split_part(url, '://', 1) || ':' || href
            WHEN starts_with(href, '/') THEN origin || href
            WHEN regexp_matches(url, '://[^/?#]*/') THEN folder || href ELSE origin || '/' || href END, '#', 1) AS b FROM links),
sym AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
u AS (SELECT page_id, url, {lower.format('url')} AS host, {rest.format('url')} AS path FROM pages),
ends AS (SELECT DISTINCT b, {lower.format('b')} AS host, {rest.format('b')} AS path FROM reach),
bad AS (SELECT b FROM ends u WHERE {best.format('r.verdict')} = 'block'),
aliased AS (SELECT DISTINCT a FROM reach WHERE b IN (SELECT b FROM bad)),
j AS (SELECT u.*, {best.format('r.rule')} AS rule, {best.format('r.verdict')} AS rv,
             coalesce(split_part(url, '#', 1) IN (SELECT a FROM aliased), false) AS al FROM u)
SELECT page_id, host, path, rule, coalesce(rv, CASE WHEN al THEN 'block' ELSE 'allow' END) AS verdict,
       rule IS NULL AND al AS by_alias FROM j"""
