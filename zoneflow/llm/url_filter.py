"""URL rules and block decisions that follow redirects and canonical links, with DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import cell, materialise
from zoneflow.llm.graph import components
from zoneflow.sources.workdir import broadcast_if_small

# (host, path, verdict); a list is part of the plan, so it is meant for policy lists. Longer ones are given as a table.
Rule = tuple[str, str, str]
MAX_RULES = 1000

_AUTHORITY = r"^.*?://([^/?#]*)"
_PATH = r"^.*?://[^/?#]*([^?#]*)"
_A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_TAG_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
_TAG_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)" + _AUTHORITY, 1)
    return F.translate(host, _A_TO_Z, _A_TO_Z.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)" + _PATH, 1)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct ``(size, allow, rule, verdict)`` of the longest rule that fits, allow first at equal length; else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit into one plan, give longer lists as a DataFrame")
    fits = []
    for rule_host, rule_path, verdict in rules:
        on_host = (host == rule_host) | host.endswith("." + rule_host)
        found = F.struct(
            F.lit(len(rule_host + rule_path)).alias("size"),
            F.lit(verdict == "allow").alias("allow"),
            F.lit(rule_host + rule_path).alias("rule"),
            F.lit(verdict).alias("verdict"),
        )
        fits.append(F.when(on_host & path.startswith(rule_path), found))
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None)


def _join_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` with ``found`` as ``matched_rule`` gives it, for a table ``(host, path, verdict)`` of any length.

    Hosts are cut into their suffixes and paths into starts of just those lengths that rules of the suffix have, so
    that both meet their rules by equality. Rules with a null cell take no part.
    """
    rules = rules.select(F.col("host").alias("rhost"), F.col("path").alias("rpath"), "verdict").dropna()
    rules = rules.groupBy("rhost", "rpath").agg(F.max(F.struct((F.col("verdict") == "allow").alias("allow"), "verdict")).alias("says"))
    rules = materialise(rules)
    sizes = materialise(rules.groupBy("rhost").agg(F.collect_set(F.length("rpath")).alias("sizes")))
    labels = F.split("host", r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    names = rows.select("host", "path").distinct().select("host", "path", F.explode(ends).alias("rhost"))
    names = names.join(broadcast_if_small(sizes), "rhost")
    fitting = F.explode(F.filter("sizes", lambda n: n <= F.length("path")))
    starts = names.select("host", "path", "rhost", fitting.alias("n")).withColumn("rpath", F.expr("substring(path, 1, n)"))
    rule = F.concat("rhost", "rpath")
    found = F.struct(F.length(rule).alias("size"), F.col("says.allow").alias("allow"), rule.alias("rule"), F.col("says.verdict").alias("verdict"))
    fits = starts.join(broadcast_if_small(rules), ["rhost", "rpath"]).groupBy("host", "path").agg(F.max(found).alias("found"))
    return rows.join(broadcast_if_small(materialise(fits)), ["host", "path"], "left")


def with_rule(rows: DataFrame, rules: Sequence[Rule] | DataFrame) -> DataFrame:
    """``rows`` with columns ``host`` and ``path``, and ``found``: the longest rule that fits, else null."""
    if isinstance(rules, DataFrame):
        return _join_rules(rows, rules)
    return rows.withColumn("found", matched_rule(F.col("host"), F.col("path"), rules))


def link_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """Edges ``(a, b)`` between host-and-path names: canonical links and immediate redirects found in pages.

    Of each kind a page's first one counts, as the SQL of the registered query defines it; later ones give no edge.
    Relative targets that start with ``/`` belong to the page's host; other relative targets are resolved
    against the page's folder.
    """
    url = cell(url_col)
    html = F.coalesce(cell(html_col).cast("string"), F.lit(""))
    targets = F.array_compact(F.array(*(F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (_TAG_CANONICAL, _TAG_REFRESH))))
    at = pages.select(host_of(url).alias("host"), path_of(url).alias("path"), targets.alias("targets")).filter(
        "host <> '' AND size(targets) > 0"
    )
    one = at.select("host", "path", F.explode("targets").alias("t"))
    folder = F.regexp_replace("path", "[^/]*$", "")
    local = F.regexp_extract("t", r"^([^?#]*)", 1)
    target = (
        F.when(F.col("t").contains("://"), F.concat(host_of(F.col("t")), path_of(F.col("t"))))
        .when(F.col("t").startswith("//"), F.concat(host_of(F.concat(F.lit("x:"), "t")), path_of(F.concat(F.lit("x:"), "t"))))
        .when(F.col("t").startswith("/"), F.concat("host", local))
        .when(local == "", F.concat("host", "path"))
        .otherwise(F.concat("host", F.when(folder == "", "/").otherwise(folder), local))
    )
    return one.select(F.concat("host", "path").alias("a"), target.alias("b")).filter("b <> ''")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] | DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    redirects: DataFrame | None = None,
) -> DataFrame:
    """Per page ``(id, host, path, rule, verdict)``; ``rule`` and its verdict win wherever a rule fits.

    ``rules`` is a list of at most ``MAX_RULES``, which costs no join, or a table ``(host, path, verdict)`` of any length.

    A page without a rule follows its aliases: pages and link targets joined by canonical links and
    redirects (found in ``html``, plus ``redirects`` with columns ``a`` and ``b`` of URLs) form a
    component. It is blocked when a member is blocked by a rule and no member is allowed by one, because an
    explicit allow takes precedence; otherwise it is allowed.

    Null URLs and URLs without ``://`` have empty host and path and no aliases; they fit no rule and are
    allowed. Repeated rows are judged alike. Empty input gives no rows. Only linked names enter the graph;
    one address that a third of all pages points to is a hub there (see ``components``).
    """
    url = cell(url_col)
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        name = lambda c: F.concat(host_of(F.col(c)), path_of(F.col(c)))
        edges = edges.unionAll(redirects.select(name("a").alias("a"), name("b").alias("b")).filter("a <> '' AND b <> ''"))
    edges = materialise(edges.distinct())
    judged = pages.select(cell(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = with_rule(judged, rules)
    own = lambda *more: judged.select(
        "id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", *more, F.lit("allow")).alias("verdict")
    )
    if not rules:
        judged = judged.withColumn("found", F.expr("cast(null as struct<rule: string, verdict: string>)"))
    if not rules or not edges.take(1):
        return own()
    members = materialise(components(edges))
    # a name's first slash ends its host
    node_host, node_path = F.regexp_extract("node", r"^[^/]*", 0), F.regexp_extract("node", r"^[^/]*(.*)$", 1)
    ruled = with_rule(members.withColumns({"host": node_host, "path": node_path}), rules).withColumn("v", F.col("found.verdict"))
    blocked = ruled.groupBy("component").agg(
        F.coalesce(F.bool_or(F.col("v") == "block"), F.lit(False)).alias("block"),
        F.coalesce(F.bool_or(F.col("v") == "allow"), F.lit(False)).alias("allow"),
    )
    blocked = members.join(blocked.filter("block AND NOT allow"), "component").select("node", F.lit("block").alias("alias_verdict"))
    # only pages without a rule need their alias; the rest take part with a null key and stay where they are
    key = F.when(F.col("found").isNull() & (F.col("host") != ""), F.concat("host", "path"))
    judged = judged.withColumn("node", key).join(materialise(blocked), "node", "left")
    return own(F.col("alias_verdict"))
