"""URL verdicts from rules and, beyond them, from a tree of path templates per host.

The rules label the urls they fit. The tree learns from those labels:

1. Each host's paths are cut into segments. Level by level, a segment becomes a wildcard where it is variable: it has digits, or its
   parent has more than ``MAX_BRANCHES`` different children there.
2. Sibling branches merge when both have labels, their shares of blocked urls do not differ significantly (two-proportion z-test) and their
   shapes below agree: they then pool their labels, and whatever is below them has one parent.
3. A template's purity is its blocked share, smoothed towards its parent's, whose own is smoothed towards the
   host's and that towards a lenient prior. A url without a rule is blocked when the purity of its deepest template reaches
   ``REJECT_AT``.

Everything is counted with aggregates over (host, template), combined before the shuffle, so a host
with a third of the urls costs no more than its number of templates. The loop runs over levels of the tree, down to the deepest label, not over rows.

Cases: null urls and urls without ``://`` have an empty host and path, no rule, and are allowed; a path of any length is looked at down to the
last level that a label of its branch reaches; repeated rows keep their own rows; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.session import stage

# A parent with more children than this has a wildcard there.
MAX_BRANCHES = 32

# Pseudo-counts of a parent's share in its child's, the share of blocked urls before any label, and the share that rejects.
SMOOTHING = 4.0
PRIOR = 0.1
REJECT_AT = 0.6

# Critical value of the two-proportion test at 5 %.
Z = 1.96

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    text: str
    block: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text of the longest rule that fits; of equally long ones the first in the list."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    """All segments of a path; digits make one a wildcard."""
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), lambda s: F.when(s.rlike("[0-9]"), F.lit("*")).otherwise(s))


def _branches(nodes: DataFrame) -> DataFrame:
    """parent, child, branch, labelled, blocked: children that do not differ become one branch, with their labels in common.

    The labelled children of a parent are taken in order of their shares, those of one shape together; each joins the branch before it unless it
    differs from all of that branch's labels. A parent has at most ``MAX_BRANCHES`` + 1 children by construction, so its array is small.
    """
    child = F.struct("shape", F.try_divide("blocked", "labelled").alias("share"), "child", "labelled", "blocked")
    families = nodes.groupBy("parent").agg(F.array_sort(F.collect_list(child)).alias("family"))
    kind = "array<struct<shape:int,names:array<string>,labelled:bigint,blocked:bigint>>"

    def joins(branch: Column, one: Column) -> Column:
        n, m = branch["labelled"], one["labelled"]
        pooled = F.try_divide(branch["blocked"] + one["blocked"], n + m)
        gap = F.abs(F.try_divide(branch["blocked"], n) - F.try_divide(one["blocked"], m))
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), n) + F.try_divide(F.lit(1), m)))
        # a child without labels has no share, and joins nothing
        return F.coalesce((branch["shape"] == one["shape"]) & (gap <= Z * error), F.lit(False))

    def add(branches: Column, one: Column) -> Column:
        last = F.element_at(branches, -1)
        alone = F.struct(one["shape"].alias("shape"), F.array(one["child"]).alias("names"), one["labelled"].alias("labelled"), one["blocked"].alias("blocked"))
        both = F.struct(
            last["shape"].alias("shape"),
            F.concat(last["names"], F.array(one["child"])).alias("names"),
            (last["labelled"] + one["labelled"]).alias("labelled"),
            (last["blocked"] + one["blocked"]).alias("blocked"),
        )
        some = F.size(branches) > 0
        return F.when(some & joins(last, one), F.concat(F.slice(branches, 1, F.size(branches) - 1), F.array(both))).otherwise(F.concat(branches, F.array(alone)))

    merged = families.select("parent", F.explode(F.aggregate("family", F.array().cast(kind), add)).alias("b"))
    names = F.array_sort("b.names")
    name = F.when(F.size(names) == 1, names[0]).otherwise(F.concat(F.lit("("), F.array_join(names, "|"), F.lit(")")))
    branch = F.concat("parent", F.lit("/"), name)
    return merged.select("parent", F.explode("b.names").alias("child"), branch.alias("branch"), F.col("b.labelled").alias("labelled"), F.col("b.blocked").alias("blocked"))


def _purity(prior: Column) -> Column:
    return (F.col("blocked") + SMOOTHING * prior) / (F.col("labelled") + SMOOTHING)


def template_scores(urls: DataFrame) -> DataFrame:
    """For ``host, key, segments, label`` (1 blocked, 0 allowed, null unknown): host, key, template, purity of each distinct path.

    A pass goes one level down and keeps the paths that end there, or below which no label is left: all labels that concern those are known. The
    others, fewer from pass to pass, are written and read by the next one, down to the deepest label.
    """
    counted = urls.where(F.col("host") != "").groupBy("host", "key", "segments")
    facts = stage(counted.agg(F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")), "url-facts")
    hosts = facts.groupBy("host").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    hosts = hosts.select("host", _purity(F.lit(PRIOR)).alias("purity"))
    level, found = 0, []
    rows = stage(facts.join(hosts, "host").withColumn("template", F.col("host")), "url-level-0")
    result = ["host", "key", "template", "purity"]
    while True:
        deeper = F.size("segments") > level
        learning = rows.where(deeper & (F.col("labelled") > 0)).select("template").distinct().withColumn("_learns", F.lit(True))
        marked = rows.join(learning, "template", "left").withColumn("_open", deeper & F.coalesce("_learns", F.lit(False))).drop("_learns")
        marked = stage(marked, "url-open")
        found.append(marked.where("NOT _open").select(*result))
        rows = marked.where("_open").drop("_open")
        if rows.isEmpty():
            return reduce(DataFrame.unionAll, found)
        segment = F.get("segments", F.lit(level))
        wide = rows.select("template", segment.alias("s")).distinct().groupBy("template").count().where(F.col("count") > MAX_BRANCHES)
        named = rows.join(wide.select("template", F.lit(True).alias("_wide")), "template", "left")
        named = stage(named.withColumn("child", F.when(F.col("_wide"), F.lit("*")).otherwise(segment)).drop("_wide"), "url-children")
        ends_below = F.max(F.when(F.size("segments") > level + 1, 1).otherwise(0)).alias("shape")
        nodes = named.groupBy(F.col("template").alias("parent"), "child").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"), ends_below)
        above = named.select(F.col("template").alias("parent"), F.col("purity").alias("prior")).distinct()
        branches = _branches(nodes).join(above, "parent").select(F.col("parent").alias("template"), "child", "branch", _purity(F.col("prior")).alias("_purity"))
        moved = named.join(branches, ["template", "child"])
        level += 1
        rows = stage(moved.select("host", "key", "segments", "labelled", "blocked", F.col("branch").alias("template"), F.col("_purity").alias("purity")), f"url-level-{level}")


def judge_urls(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row of ``page_id, url``."""
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    blocked = reduce(lambda a, r: a | (F.col("rule") == r.text), [r for r in rules if r.block], F.lit(False))
    label = F.when(F.col("rule").isNotNull(), blocked.cast("int"))
    urls = parts.withColumns({"label": label, "segments": _segments(F.col("path"))}).withColumn("key", F.array_join("segments", "/"))
    joined = urls.join(template_scores(urls), ["host", "key"], "left")
    block = F.coalesce(F.col("label") == 1, F.coalesce(F.col("purity") >= REJECT_AT, F.lit(False)))
    return joined.select("page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"), "template", "purity")
