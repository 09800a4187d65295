"""URL filters whose block decisions reach the aliases of a blocked page.

Rules judge the URLs that they fit, the longest rule first. Pages that redirect to one another, or name one
another as canonical, are one document under several URLs: connected components over these links carry a
block to every alias that no rule judges, unless the component also holds an explicitly allowed URL.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.shared import checkpointed, connected_components

#: Up to so many rules are part of the plan; more are joined.
INLINE_RULES = 500


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str


#: Production rules of the query.
RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))


def split_url(url):
    """Columns host and path. Null URLs and URLs without ``://`` have both empty."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(known, host).otherwise(""), F.when(known, path).otherwise("")


def judge(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule and rule_verdict; the last two are null where no rule fits.

    A rule fits its host and all subdomains if the path starts with the rule's. Of the rules that fit, the one
    whose host and path are longest wins; of equally long ones block wins, then the first in text order.
    A null URL, and one without ``://``, fits no rule.
    """
    host, path = split_url(F.col(url))
    ranked = sorted(set(rules), key=lambda r: (-len(r.host + r.path), r.verdict != "block", r.host + r.path))
    parts = urls.withColumns({"host": host, "path": path})
    if len(ranked) <= INLINE_RULES:
        found = F.coalesce(*[F.when(
            ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path),
            F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in ranked],
            F.lit(None).cast("struct<rule:string,verdict:string>"))
        fit = parts.withColumn("fit", found)
    else:
        table = urls.sparkSession.createDataFrame(
            [(i, r.host, r.path, r.host + r.path, r.verdict) for i, r in enumerate(ranked)],
            "rank long, suffix string, start string, rule string, verdict string")
        names = parts.select("host", "path").distinct()
        labels = F.split("host", r"\.")
        suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
        best = (names.withColumn("suffix", F.explode(suffixes)).join(table, "suffix")
                .where(F.col("path").startswith(F.col("start"))).groupBy("host", "path")
                .agg(F.min_by(F.struct("rule", "verdict"), "rank").alias("fit")))
        fit = parts.join(best, ["host", "path"], "left")
    return fit.withColumns({"rule": F.col("fit.rule"), "rule_verdict": F.col("fit.verdict")}).drop("fit")


def node_name(url):
    """Column: the URL that stands for a page: no fragment, scheme and host in lower case, an empty path as ``/``."""
    host, path = split_url(url)
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), query))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(src, dst)`` URLs of all canonical links and meta redirects of each page, ``&amp;`` decoded.

    Targets are made absolute: with a scheme as they are, ``//host/...`` with the page's scheme, ``/...`` with
    its host too, others beside the page's path. Null pages and pages without such tags give no link.
    """
    tag = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
    meta = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\burl\s*=\s*[\"']?([^\"'\s>]+)"
    hinted = pages.where(F.col(html).contains("canonical") | F.lower(F.col(html)).contains("canonical") | F.lower(F.col(html)).contains("http-equiv"))
    found = hinted.select(F.col(url).alias("src"), F.explode(F.concat(
        F.regexp_extract_all(html, F.lit(tag), F.lit(1)), F.regexp_extract_all(html, F.lit(meta), F.lit(1)))).alias("to")).where("to <> '' AND src IS NOT NULL")
    found = found.withColumn("to", F.regexp_replace("to", "(?i)&(amp|#38|#x26);", "&"))
    host, path = split_url(F.col("src"))
    scheme = F.regexp_extract("src", r"(?s)^(.*?)://", 1)
    base = F.concat(scheme, F.lit("://"), host)
    dst = (F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
           .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to")))
           .when(F.col("to").startswith("/"), F.concat(base, F.col("to")))
           .otherwise(F.concat(base, F.regexp_replace(path, r"[^/]*$", ""), F.when(path == "", "/").otherwise(""), F.col("to"))))
    return found.where(F.instr("src", "://") > 0).select("src", dst.alias("dst"))


def filter_urls(pages: DataFrame, links: DataFrame, rules: Sequence[Rule] = RULES, page: str = "page_id", url: str = "url") -> DataFrame:
    """``page, host, path, rule, verdict, component_block`` of every page, judged by ``rules`` and over ``links``.

    The verdict is that of the longest rule that fits the page; without one it is block if the page's component
    over redirect and canonical links holds a blocked URL and no allowed one, else allow. URLs that only occur
    as link targets take part. Rows repeat as they do in ``pages``; null and relative URLs have no aliases.

    Components are found on 64-bit hashes of URLs, on the URLs that have links only. The decision table that
    pages meet has one row for each blocked alias, so a hot URL splits; it is empty, and the join free, where
    no links exist.
    """
    names = links.select(node_name(F.col("src")).alias("a"), node_name(F.col("dst")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()
    names = checkpointed(names)
    nodes = names.select(F.explode(F.array("a", "b")).alias("name")).distinct().withColumn("node", F.xxhash64("name"))
    parts = connected_components(names.select(F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")))
    ruled = judge(nodes, rules, "name").join(parts, "node")
    blocked = (ruled.groupBy("component").agg(
        F.max(F.when(F.col("rule_verdict") == "block", 1).otherwise(0)).alias("blocks"),
        F.max(F.when(F.col("rule_verdict") == "allow", 1).otherwise(0)).alias("allows"))
        .where("blocks = 1 AND allows = 0").select("component"))
    aliases = checkpointed(ruled.join(blocked, "component").select(F.col("name").alias("__name"), F.lit(True).alias("component_block")).distinct())
    judged = judge(pages.select(F.col(page).alias("page_id"), F.col(url).alias("url")), rules)
    met = judged.withColumn("__name", node_name(F.col("url"))).join(aliases, "__name", "left")
    hit = F.coalesce("component_block", F.lit(False))
    return met.select(F.col("page_id").alias(page), "host", "path", "rule",
                      F.coalesce("rule_verdict", F.when(hit, "block").otherwise("allow")).alias("verdict"), hit.alias("component_block"))
