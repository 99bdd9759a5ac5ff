"""URL filter over redirect equivalence.

Rules name a host and a path, fit the host and its subdomains where the path starts
with the rule's, and the longest decides. Pages that redirect to each other or name a
common canonical address are aliases: connected components over those links carry a
block to every alias without a rule of its own. An explicit allow goes first: an alias
set with an allowed member is allowed, and a page's own rule always holds for it.

Every canonical link and refresh of a page counts, and both ends are compared as
resources: case of the host, dot segments, ``&amp;`` and fragments make no difference.

A null url, or one without ``://``, has an empty host and path, fits no rule, and is
allowed. Repeated rows are judged alike. Only ``page_id``, ``url`` and ``html`` are
read, so other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sectorgauge.llm.common import ascii_lower
from sectorgauge.llm.components import connected_components
from sectorgauge.sources.stages import stage

#: (verdict, host, path) of the production rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

_LINK = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def rules_frame(spark, rules=RULES) -> DataFrame:
    """The rules as a table; any table of these columns will do."""
    return spark.createDataFrame(
        [(v, h, p, h + p) for v, h, p in rules], "verdict string, rule_host string, rule_path string, rule string"
    )


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules`` for hosts that some rule fits.

    Every host is looked up by its suffixes, so the join is by equality and grows with
    hosts times labels, not with hosts times rules.
    """
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )
    exploded = hosts.select("host", F.explode(F.array_distinct(suffixes)).alias("rule_host"))
    fitting = exploded.join(rules, "rule_host")
    rule = F.struct(
        F.length("rule").alias("size"), (F.col("verdict") == "allow").alias("allow"), "rule", "rule_path"
    )
    return fitting.groupBy("host").agg(F.collect_list(rule).alias("rules"))


def judge_by_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``host, path, rule, rule_allows`` (null where no rule fits) to ``page_id, url``.

    Hosts are looked up once each. Equal lengths: allow goes first, then the larger text.
    """
    pages = pages.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = host_rules(pages.select("host").distinct(), rules).withColumnRenamed("host", "h")
    joined = pages.join(known, F.col("host") == F.col("h"), "left")
    best = F.array_max(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])))
    return joined.select(*pages.columns, best["rule"].alias("rule"), best["allow"].alias("rule_allows"))


def _without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` segments resolved; at least ``/``."""
    parts = F.split(F.regexp_replace(path, r"/\.{1,2}$", "$0/"), "/", -1)
    solved = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    joined = F.array_join(solved, "/")
    return F.when(joined == "", "/").otherwise(joined)


def resource_of(url: Column) -> Column:
    """One form of an address for page and link: what a server would see as the same.

    A-Z of scheme and host are lower-cased, dot segments resolved, an empty path is ``/``
    and the fragment goes. Without ``://`` the text is left as it is.
    """
    site = ascii_lower(F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1))
    query = F.regexp_extract(_after_scheme(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.concat(site, _without_dots(path_of(url)), query)).otherwise(url)


def _absolute(link: Column, base: Column) -> Column:
    """A link as an absolute address, as seen from a page's resource; null for ``mailto:`` and the like."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^?#]*/)", 1)
    page = F.regexp_extract(base, r"(?s)^([^?]*)", 1)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(page, link))
        .when(link.startswith("#"), base)
        .when(~link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(folder, link))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """``node, target``: all redirects and canonical links of a page, between resources."""
    html = F.coalesce(F.col("html"), F.lit(""))
    found = F.concat(*(F.regexp_extract_all(html, F.lit(tag), F.lit(1)) for tag in (_LINK, _REFRESH)))
    links = pages.where(F.col("url").contains("://")).select(
        resource_of(F.col("url")).alias("node"), F.explode(F.array_distinct(found)).alias("link")
    )
    link = F.regexp_replace("link", r"(?i)&(amp|#38|#x26);", "&")
    targets = links.select("node", resource_of(_absolute(link, F.col("node"))).alias("target"))
    return targets.where(F.col("target").isNotNull())


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row."""
    slim = pages.select("page_id", "url", resource_of(F.col("url")).alias("node"))
    edges = stage(alias_edges(pages), "aliases")
    judged = judge_by_rule(slim, rules)
    aliases = connected_components(edges, "node", "target")
    ends = edges.select(F.explode(F.array("node", "target")).alias("v")).distinct()
    ends = ends.join(aliases, F.col("v") == F.col("vertex"), "left").select(
        "v", F.coalesce("component", "v").alias("alias")
    )
    targets = judge_by_rule(ends.select(F.col("v").alias("url"), "alias"), rules)
    opinion = (
        targets.groupBy("alias")
        .agg(F.max("rule_allows").alias("allowed"))
        .where(F.col("allowed").isNotNull())
        .select("alias", (~F.col("allowed")).alias("blocked"))
    )
    blocked = ends.join(opinion.where("blocked"), "alias").select("v").distinct()
    final = judged.join(blocked, F.col("node") == F.col("v"), "left")
    verdict = (
        F.when(F.col("rule_allows"), "allow")
        .when(~F.col("rule_allows"), "block")
        .when(F.col("v").isNotNull(), "block")
        .otherwise("allow")
    )
    return final.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
