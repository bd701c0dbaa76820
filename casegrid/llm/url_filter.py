"""URL filter: given rules first, then a path-template tree per host.

Under every node of a host's tree (the segments before, digits generalised) a segment keeps its value only
if it has a fair share of the node's pages; otherwise its digits become ``#``, and if that is rare too, all
of it becomes ``*``. Branches of a host whose last segments are distributed alike (shares rounded to
quarters) are merged. A template is rejected if the share of blocked pages among its labelled ones,
smoothed towards the host's share and that towards a half, reaches ``reject_at``.

Everything is DataFrame functions over grouped tables: (host, path) with counts, then nodes, templates, branches.
Groups are counted before any join, and no list is longer than a path or the few frequent leaves of a branch.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.operators.rows import quoted
from casegrid.operators.storage import stored

#: A child is kept apart if it has at least 1 / KEPT_SHARE of its node's pages.
KEPT_SHARE = 20
#: Pages that the prior counts for.
PRIOR_PAGES = 4.0
REJECT_AT = 0.8

Rule = tuple[str, str]  # "host/path", verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered, and path without query and fragment; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The rule as a struct (rule, verdict), NULL if none fits: the longest, of equal ones the least verdict last."""

    def fitting(rule: str, verdict: str) -> Column:
        of_host, slash, of_path = rule.partition("/")
        fits = ((host == of_host) | F.endswith(host, F.lit(f".{of_host}"))) & F.startswith(path, F.lit(slash + of_path))
        return F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")))

    if not rules:
        return F.lit(None).cast("struct<size:int,verdict:string,rule:string>")
    return F.array_max(F.array(*[fitting(rule, verdict) for rule, verdict in rules]))


def _shape(segment: Column) -> Column:
    return F.regexp_replace(segment, "[0-9]+", "#")


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, branch, leaf, depth) of distinct (host, path, n) rows."""
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    spread = paths.select("host", "path", "n", segments.alias("s")).select(
        "host", "path", "n", F.transform("s", _shape).alias("shapes"), F.posexplode("s").alias("at", "segment")
    )
    spread = spread.select(
        "host", "path", "n", "at", "segment", F.array_join(F.slice("shapes", F.lit(1), F.col("at")), "/").alias("node")
    )
    children = spread.groupBy("host", "node", "segment").agg(F.sum("n").alias("own"))
    children = children.withColumn("shape", _shape(F.col("segment")))
    shapes = children.groupBy("host", "node", "shape").agg(F.sum("own").alias("of_shape"))
    nodes = shapes.groupBy("host", "node").agg(F.sum("of_shape").alias("of_node"))
    kept = children.join(shapes.join(nodes, ["host", "node"]), ["host", "node", "shape"]).select(
        "host",
        "node",
        "segment",
        F.when(F.col("own") * KEPT_SHARE >= F.col("of_node"), F.col("segment"))
        .when((F.col("of_shape") * KEPT_SHARE >= F.col("of_node")) & F.contains("shape", F.lit("#")), F.col("shape"))
        .otherwise("*")
        .alias("general"),
    )
    parts = spread.join(kept, ["host", "node", "segment"]).groupBy("host", "path").agg(
        F.array_sort(F.collect_list(F.struct("at", "general"))).alias("parts")
    )
    general = F.transform("parts", lambda p: p["general"])
    return parts.select("host", "path", general.alias("g"), F.size("parts").alias("depth")).select(
        "host",
        "path",
        "depth",
        F.array_join(F.slice("g", F.lit(1), F.col("depth") - 1), "/").alias("branch"),
        F.element_at("g", -1).alias("leaf"),
    )


def merged_branches(leaves: DataFrame) -> DataFrame:
    """(host, depth, branch, merged) from (host, depth, branch, leaf, n): the least branch with the same
    distribution of leaves, in quarters."""
    branch = ["host", "depth", "branch"]
    totals = leaves.groupBy(*branch).agg(F.sum("n").alias("of_branch"))
    quarters = F.floor((F.col("n") * 8 + F.col("of_branch")) / (F.col("of_branch") * 2))
    frequent = leaves.join(totals, branch).withColumn("quarters", quarters).filter("quarters > 0")
    signatures = frequent.groupBy(*branch).agg(
        F.array_sort(F.collect_list(F.struct("leaf", "quarters"))).alias("signature")
    )
    signatures = totals.join(signatures, branch, "left").select(
        *branch, F.coalesce("signature", F.array().cast("array<struct<leaf:string,quarters:long>>")).alias("signature")
    )
    first = signatures.groupBy("host", "depth", "signature").agg(F.min("branch").alias("merged"))
    return signatures.join(first, ["host", "depth", "signature"]).select(*branch, "merged")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    id_col: str = "page_id",
    url_col: str = "url",
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``rules`` are ("host/path prefix", "allow" or "block"); a rule fits its host and all subdomains, the
    longest decides. Pages under a rule are the labelled ones; other pages are blocked if their template
    is. NULL urls and urls without ``://`` have an empty host and path and are judged like any other;
    repeated rows are judged each. Without rules everything is allowed; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(quoted(url_col)))
    rows = pages.select(F.col(quoted(id_col)).alias("page_id"), host.alias("host"), path.alias("path"))
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    paths = paths.withColumn("given", longest_rule(F.col("host"), F.col("path"), rules)).select(
        "host", "path", "n", F.col("given.rule").alias("rule"), F.col("given.verdict").alias("given")
    )
    paths = stored(paths)
    found = stored(paths.join(templates(paths), ["host", "path"]))
    labelled = F.when(F.col("given").isNotNull(), F.col("n")).otherwise(0)
    blocked = F.when(F.col("given") == "block", F.col("n")).otherwise(0)
    sums = (F.sum("n").alias("n"), F.sum(labelled).alias("labelled"), F.sum(blocked).alias("blocked"))
    leaves = found.groupBy("host", "depth", "branch", "leaf").agg(*sums)
    merged = merged_branches(leaves)
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
    hosts = hosts.select("host", ((F.col("b") + PRIOR_PAGES * 0.5) / (F.col("l") + PRIOR_PAGES)).alias("prior"))
    group = ["host", "depth", "merged", "leaf"]
    purity = (F.col("blocked") + F.col("prior") * PRIOR_PAGES) / (F.col("labelled") + PRIOR_PAGES)
    with_merged = leaves.join(merged, ["host", "depth", "branch"])
    pure = with_merged.groupBy(*group).agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    pure = pure.join(hosts, "host").select(*group, purity.alias("purity"))
    judged = with_merged.select("host", "depth", "branch", "leaf", "merged").join(pure, group)
    template = F.concat_ws("/", F.col("host"), F.when(F.col("merged") != "", F.col("merged")), F.col("leaf"))
    verdict = F.coalesce("given", F.when(F.col("purity") >= reject_at, "block").otherwise("allow"))
    judged = found.join(judged, ["host", "depth", "branch", "leaf"]).select(
        "host", "path", "rule", verdict.alias("verdict"), template.alias("template"), "purity"
    )
    return rows.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity"
    )
