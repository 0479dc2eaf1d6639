"""URL filters: host and path rules, and block decisions that follow redirects and canonical links to aliases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.graph import components


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def matching_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """struct<action, name> of the longest rule that fits, or NULL; of two as long the one with the smaller name."""
    out = F.lit(None).cast("struct<action:string,name:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        out = F.when(fits(rule, host, path), F.struct(F.lit(rule.action).alias("action"), F.lit(rule.name).alias("name"))).otherwise(out)
    return out


def node_of(url: Column) -> Column:
    """The resource a url names: without its fragment and surrounding blanks; NULL where nothing is left."""
    return F.nullif(F.trim(F.substring_index(url, "#", 1)), F.lit(""))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): canonical links and ``refresh`` redirects with an absolute target that pages state in their html."""
    def attribute(tag: Column, name: str) -> Column:
        value = F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", 1)
        return F.regexp_replace(F.replace(F.trim(F.regexp_replace(value, r"""^["']|["']$""", "")), F.lit("&amp;"), F.lit("&")), r"^\s+", "")

    links = F.transform(
        F.regexp_extract_all(F.col(f"`{html}`"), F.lit(r"(?is)(<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>)"), F.lit(1)),
        lambda t: attribute(t, "href"))
    moves = F.transform(
        F.regexp_extract_all(F.col(f"`{html}`"), F.lit(r"(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>)"), F.lit(1)),
        lambda t: F.regexp_extract(attribute(t, "content"), r"(?is)url\s*=\s*[\"']?([^\"']*)", 1))
    return pages.select(node_of(F.col(f"`{url}`")).alias("a"), F.explode(F.concat(links, moves)).alias("b")) \
        .select("a", node_of(F.col("b")).alias("b")).filter(F.col("a").isNotNull() & F.col("b").contains("://"))


def judge(pages: DataFrame, rules: list[Rule], links: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict (replacing columns of these names).

    A url with a fitting rule gets that rule's verdict. Any other takes the decisions of its aliases, all urls that
    redirects and canonical links (``links``: a, b) join to it in either direction: block if one of them is blocked by
    a rule and none is allowed by one, since an explicit allow takes precedence; else allow. A link's ends are judged
    by the rules also where no page has that url. A NULL or unusable url has an empty host and path and is allowed.
    Repeated rows are judged alike.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_node", "_hit", "_blocked")]
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    own = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), node_of(F.col(f"`{url}`")).alias("_node"))
    own = own.withColumn("_hit", matching_rule(rules, F.col("host"), F.col("path")))
    members = components(links)
    hit = matching_rule(rules, host_of(F.col("node")), path_of(F.col("node")))["action"]
    decided = members.withColumn("hit", hit).groupBy("component").agg(
        F.max(F.when(F.col("hit") == "block", 1).otherwise(0)).alias("block"), F.max(F.when(F.col("hit") == "allow", 1).otherwise(0)).alias("allow"))
    blocked = members.join(decided.filter("block = 1 and allow = 0"), "component").select(F.col("node").alias("_node"), F.lit(True).alias("_blocked"))
    return own.join(blocked, "_node", "left").select(
        *[F.col(f"`{c}`") for c in kept], "host", "path", F.col("_hit.name").alias("rule"),
        F.coalesce(F.col("_hit.action"), F.when(F.col("_blocked"), "block"), F.lit("allow")).alias("verdict"))
