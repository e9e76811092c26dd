"""URL filters: rules by host and path, and path templates judged by the labels of their pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed rules: verdict, host, path.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
#: A segment stays as it is if so many pages have it below its node, however many its siblings have; else it is a wildcard.
LEAST_PAGES = 8
#: Two-sided 95 % bound of the normal distribution.
SIMILAR = 1.96


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark or hash, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]], part: int) -> Column:
    """The longest rule that fits, as its text (``part`` 1) or verdict (0); null if none does."""
    out = F.lit(None).cast("string")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.lit((verdict, rule_host + rule_path)[part])).otherwise(out)
    return out


def wildcard(segment: Column) -> Column:
    """The kind of a segment: digits or other, with its file ending."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1)
    stem = F.substring(segment, F.lit(1), F.length(segment) - F.length(ending))
    return F.concat(F.when(stem.rlike("^[0-9]+$"), F.lit("{n}")).when(segment == "", F.lit("")).otherwise(F.lit("{s}")), ending)


def path_templates(paths: DataFrame, least: int = LEAST_PAGES) -> DataFrame:
    """``(host, path, n, blocked, allowed)`` with ``parent`` and ``template``: each host's tree, level by level.

    At each node the pages of each child segment are counted; children with fewer than ``least`` share the wildcard of their
    kind. Below a node with fewer pages than that all segments are wildcards, so its paths are finished at once; the others go on
    until none has a deeper segment. Counts are staged before they are joined, so that a node with very many paths can be split.
    """
    whole = staged(paths.groupBy("host").agg(F.sum("n").alias("room")), "rooms")
    split = paths.join(whole, "host").withColumns({"rest": F.split(F.substring(F.col("path"), 2, 1 << 30), "/", -1), "parent": F.lit(""), "template": F.lit("")})
    tree, done = staged(split, "paths"), []
    while True:
        few = F.col("room") < least
        kinds = F.transform("rest", wildcard)
        above = F.array_join(F.concat(F.array("template"), F.slice(kinds, F.lit(1), F.size("rest") - 1)), "/")
        ended = tree.where(few & (F.size("rest") > 0)).select(*paths.columns, above.alias("parent"), F.array_join(F.concat(F.array("template"), kinds), "/").alias("template"))
        done += [ended, tree.where(F.size("rest") == 0).select(*paths.columns, "parent", "template")]
        at = tree.where(~few & (F.size("rest") > 0)).withColumn("segment", F.get("rest", F.lit(0)))
        if at.isEmpty():
            return reduce(DataFrame.unionByName, done)
        name = F.when(F.col("pages") >= least, F.col("segment")).otherwise(wildcard(F.col("segment")))
        named = staged(at.groupBy("host", "template", "segment").agg(F.sum("n").alias("pages")).withColumn("name", name), "segments")
        rooms = staged(named.groupBy("host", "template", "name").agg(F.sum("pages").alias("room")), "rooms")
        joined = at.drop("room").join(named.drop("pages"), ["host", "template", "segment"]).join(rooms, ["host", "template", "name"])
        deeper = F.concat("template", F.lit("/"), "name").alias("template")
        tree = staged(joined.select(*paths.columns, "room", F.slice("rest", F.lit(2), F.size("rest")).alias("rest"), F.col("template").alias("parent"), deeper), "paths")


def judged_templates(tree: DataFrame, purity: float = 0.8) -> DataFrame:
    """``(host, template, purity, rejected)``: similar branches of one parent pooled, then smoothed block shares.

    A branch whose share of blocked pages is no further from its parent's than chance allows is pooled with the other
    such branches; a branch without labels has no share and stays by itself. One block and one allow are added to
    each count, so a template without labels has purity one half.
    """
    own = tree.groupBy("host", "parent", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    seen = F.col("blocked") + F.col("allowed")
    own = staged(own, "branches")
    parents = own.groupBy("host", "parent").agg((F.sum("blocked") / F.greatest(F.sum(seen), F.lit(1))).alias("share"))
    parents = staged(parents, "parents")
    far = F.abs(F.col("blocked") / seen - F.col("share")) > SIMILAR * F.sqrt(F.col("share") * (1 - F.col("share")) / seen)
    branches = own.join(parents, ["host", "parent"]).withColumn("pooled", F.coalesce((seen > 0) & ~far, F.lit(False)))
    pools = branches.where("pooled").groupBy("host", "parent").agg(F.sum("blocked").alias("pool_blocked"), F.sum("allowed").alias("pool_allowed"))
    pools = staged(pools, "pools")
    both = branches.join(pools, ["host", "parent"], "left")
    blocked = F.when(F.col("pooled"), F.col("pool_blocked")).otherwise(F.col("blocked"))
    allowed = F.when(F.col("pooled"), F.col("pool_allowed")).otherwise(F.col("allowed"))
    pure = (blocked + 1) / (blocked + allowed + 2)
    return both.select("host", "template", pure.alias("purity"), (pure >= purity).alias("rejected"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, least: int = LEAST_PAGES, purity: float = 0.8) -> DataFrame:
    """``(page_id, host, path, rule, verdict, template, purity)`` for each row of ``pages``.

    The longest rule that fits decides, and its pages are the labels from which the path templates of their host are
    judged; a page that no rule fits gets its template's verdict. A null url, or one without ``://``, has empty host and
    path like any other url with those. Everything is grouped by host and path and joined back, so repeated rows
    come out repeated and null ids stay; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parsed = pages.select(F.col("page_id").cast("long"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules, 1)).withColumn("said", rule_of(F.col("host"), F.col("path"), rules, 0))
    counts = [F.count("*").alias("n"), F.count_if(F.col("said") == "block").alias("blocked"), F.count_if(F.col("said") == "allow").alias("allowed")]
    tree = path_templates(staged(ruled.groupBy("host", "path").agg(*counts), "paths"), least)
    known = tree.select("host", "path", "template").join(staged(judged_templates(tree, purity), "templates"), ["host", "template"])
    verdict = F.coalesce("said", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow")))
    return ruled.join(known, ["host", "path"]).select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
