"""URL judgement by rules and by a tree of path templates.

A rule has a verdict, a host and a path. It fits its host and all subdomains where the
path of the url starts with the rule's; of the rules that fit, the longest one decides.

Where no rule fits, the template of the path does. For each host the paths form a tree:

1. Runs of digits in a segment become ``#``. Pages are counted per host and such a shape
   first, so that the tree is built on counts however many pages a host has.
2. Level by level, the children of a node become one wildcard where they vary: at least
   ``min_children`` with fewer than ``pages_per_child`` pages on average.
3. A child whose share of blocked pages does not differ significantly from that of its
   siblings joins the wildcard too (two-proportion test, ``critical``); so does a child
   without labelled pages.
4. A template's purity is its share of blocked among labelled pages, smoothed towards the
   share of all pages with the weight of ``smoothing`` pages. From ``threshold`` on the
   template is rejected.

Labels are the verdicts of the rules. The tree is as deep as the paths; ``levels`` is the
depth of the SQL counterpart only. Only DataFrame functions are used.

Rows: one for each row of ``pages``. A url that is null or has no ``://`` has an empty host
and path. Repeated rows, urls and ids count as often as they occur. With no labelled page
at all the share of all pages counts as a half of a page in one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.session import staged

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WILDCARD = "*"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class TreeSettings(NamedTuple):
    levels: int = 4
    min_children: int = 8
    pages_per_child: float = 3.0
    critical: float = 1.96
    smoothing: float = 4.0
    threshold: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def _first_fitting(rules: Sequence[Rule], value: str) -> Column:
    """The ``value`` of the longest rule that fits columns host and path, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        host = rule.host.translate(str.maketrans(_UPPER, _UPPER.lower()))
        fits = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        fits = fits & F.startswith(F.col("path"), F.lit(rule.path))
        found = F.when(fits, F.lit(getattr(rule, value))).otherwise(found)
    return found


def _shape(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "[0-9]+", "#"), "/$", "")


def _generalise(shapes: DataFrame, level: int, settings: TreeSettings) -> DataFrame:
    """Put wildcards into the segments of one level of the tree."""
    segment = F.get("segments", F.lit(level))
    prefix = F.concat_ws("/", F.slice("segments", 1, level)) if level else F.lit("")
    at_level = shapes.withColumns({"prefix": prefix, "segment": segment})
    children = (
        at_level.where("segment is not null")
        .groupBy("host", "prefix", "segment")
        .agg(*(F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")))
    )
    nodes = children.groupBy("host", "prefix").agg(
        F.count("*").alias("node_children"),
        *(F.sum(c).alias(f"node_{c}") for c in ("pages", "labelled", "blocked")),
    )
    varies = (F.col("node_children") >= settings.min_children) & (
        F.col("node_pages") < settings.pages_per_child * F.col("node_children")
    )
    rest = F.col("node_labelled") - F.col("labelled")
    pooled = F.col("node_blocked") / F.col("node_labelled")
    spread = pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest)
    apart = F.col("blocked") / F.col("labelled") - (F.col("node_blocked") - F.col("blocked")) / rest
    tested = (F.col("labelled") > 0) & (rest > 0) & (F.col("node_blocked") > 0)
    tested = tested & (F.col("node_blocked") < F.col("node_labelled"))
    similar = F.when(tested, apart * apart < settings.critical**2 * spread).otherwise(
        (F.col("labelled") == 0) | (rest > 0)
    )
    merged = (
        children.join(nodes, ["host", "prefix"])
        .where((F.col("node_children") > 1) & (varies | similar))
        .select("host", "prefix", "segment", F.lit(True).alias("merged"))
    )
    replaced = F.transform(
        "segments", lambda s, i: F.when(F.col("merged") & (i == level), _WILDCARD).otherwise(s)
    )
    return (
        at_level.join(merged, ["host", "prefix", "segment"], "left")
        .withColumn("segments", F.when(F.col("merged"), replaced).otherwise(F.col("segments")))
        .select(*shapes.columns)
    )


def _depth(shapes: DataFrame) -> int:
    """The number of levels with a node that can have two children: two shapes of a host reach it."""
    sizes = shapes.groupBy("host", F.size("segments").alias("size")).agg(F.count("*").alias("shapes"))
    hosts = sizes.groupBy("host").agg(
        F.max_by("shapes", "size").alias("deepest"),
        F.sort_array(F.collect_list("size"), asc=False).alias("sizes"),
    )
    reached = F.get("sizes", F.when(F.col("deepest") > 1, 0).otherwise(1))
    return hosts.agg(F.max(reached)).first()[0] or 0


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], settings: TreeSettings = TreeSettings()
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, template and purity."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = parsed.withColumns(
        {
            "rule": _first_fitting(rules, "text"),
            "ruled": _first_fitting(rules, "verdict"),
            "shape": _shape(F.col("path")),
        }
    )
    shapes = (
        judged.groupBy("host", "shape")
        .agg(
            F.count("*").alias("pages"),
            F.count("ruled").alias("labelled"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        )
        .withColumn("segments", F.split(F.ltrim(F.col("shape"), F.lit("/")), "/"))
    )
    shapes = staged(shapes, "url-shapes")
    total = shapes.agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")).first()
    share = ((total.blocked or 0) + 0.5) / ((total.labelled or 0) + 1)
    for level in range(_depth(shapes)):
        shapes = staged(_generalise(shapes, level, settings), "url-shapes")
    shapes = shapes.select(
        "host", "shape", "labelled", "blocked", F.concat(F.lit("/"), F.concat_ws("/", "segments")).alias("template")
    )
    templates = (
        shapes.groupBy("host", "template")
        .agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .select(
            "host",
            "template",
            (
                (F.col("blocked") + F.lit(settings.smoothing * share))
                / (F.col("labelled") + F.lit(settings.smoothing))
            ).alias("purity"),
        )
    )
    known = shapes.select("host", "shape", "template").join(templates, ["host", "template"])
    by_template = F.when(F.col("purity") >= settings.threshold, "block").otherwise("allow")
    return judged.join(known, ["host", "shape"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", by_template).alias("verdict"),
        "template",
        "purity",
    )
