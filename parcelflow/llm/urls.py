"""Operator 9, URL filter: fixed rules first, then a path-template tree.

Rules name a host, with all its subdomains, and the start of a path; the longest that fits
decides. Every URL also has a place in a tree: suffix, host, then one level for each path
segment, however many there are, each with how many URLs rules blocked and allowed there.

1. Generalise: below a node, segments with a digit become ``*``; and where the children are many
   and nearly all different, they are variable and all become ``*``.
2. Merge: labelled children of a node become one branch, ``*0``, if their shares of blocked URLs
   scatter no more than chance explains (sum of squared deviations against its expectation
   and spread). Otherwise children of like smoothed share are pooled, and pools side by side whose
   shares differ by at most two standard errors are one branch, ``*1``, ``*2`` and so on. A merged
   branch has the counts and the subtrees of its members. Hosts, ends of paths and children without
   labels are not merged.
3. Reject: purity is smoothed from the root down, each level's counts on top of its parent's
   purity as a prior; a branch whose share lies within two standard errors of its parent's
   purity, or an only child, takes that purity. A URL that no rule fits is blocked where the
   purity of its template is ``REJECT`` or more.

The tree grows level by level until every node holds a single way, whose purity is that of the
node. Counts are combined before every shuffle; merging compares sums, never lists of children.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from parcelflow.llm.storage import write_table

# The rules of the task.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Children are variable from so many on, if so large a share of the URLs has its own.
VARIABLE_CHILDREN, VARIABLE_SHARE = 8, 0.5
PRIOR = 10.0
REJECT = 0.8
#: Pools of children by smoothed share, of equal width in the arc sine of its root.
POOLS = 16


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://`` or for null."""
    url = F.coalesce(url, F.lit(""))
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one."""
    rule = verdict = F
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0]), reverse=True):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(says))
    if not rules:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _ways(df: DataFrame) -> DataFrame:
    """URLs with ``way``, their segments; one with a digit is ``*``, an empty one ends the way."""
    segments = F.split(F.regexp_replace("path", "^/|/$", ""), "/")
    shaped = F.transform(segments, lambda s: F.when(s.rlike(r"\d"), F.lit("*")).otherwise(s))
    return df.withColumn("way", shaped)


def _within_two_errors(share: Column, other: Column, error: Column) -> Column:
    return F.abs(share - other) <= 2 * error


def _merged(children: DataFrame) -> DataFrame:
    """``node``, ``seg`` and ``label``, the branch that each child becomes. ``children`` has
    ``node``, ``purity`` (of the node), ``seg``, ``n``, ``known`` and ``blocked``."""
    inner, labelled = F.col("seg") != "", (F.col("seg") != "") & (F.col("known") > 0)
    sums = children.groupBy("node").agg(
        F.count_if(inner).alias("kinds"),
        F.sum(F.when(inner, F.col("n"))).alias("all"),
        F.count_if(labelled).alias("m"),
        F.sum(F.when(labelled, F.col("known"))).alias("k"),
        F.sum(F.when(labelled, F.col("blocked"))).alias("b"),
        F.sum(F.when(labelled, F.col("blocked") * F.col("blocked") / F.col("known"))).alias("squares"),
    )
    share, free = F.col("b") / F.col("k"), F.col("m") - 1
    spread = F.col("squares") - F.col("b") * share
    sums = sums.select(
        "node",
        ((F.col("kinds") >= VARIABLE_CHILDREN) & (F.col("kinds") > VARIABLE_SHARE * F.col("all")))
        .alias("variable"),
        ((F.col("m") > 1) & (spread <= share * (1 - share) * (free + 2 * F.sqrt(2 * free)) + 1e-9))
        .alias("alike"),
        (F.col("m") > 1).alias("several"),
    )
    smoothed = (F.col("blocked") + PRIOR * F.col("purity")) / (F.col("known") + PRIOR)
    pool = F.floor(F.asin(F.sqrt(smoothed)) * (2 * POOLS / math.pi))
    children = children.join(sums, "node").withColumn("pool", F.least(pool, F.lit(POOLS - 1)))
    apart = ~F.col("variable") & ~F.col("alike") & F.col("several") & labelled
    pools = children.where(apart).groupBy("node", "pool").agg(
        F.sum("known").alias("k"),
        F.sum("blocked").alias("b"),
        F.min("seg").alias("low"),
        F.max("seg").alias("high"),
    )
    # At most POOLS rows of a node meet in the window.
    beside = W.partitionBy("node").orderBy(F.col("b") / F.col("k"), "pool")
    k0, b0 = F.lag("k").over(beside), F.lag("b").over(beside)
    both = (F.col("b") + b0) / (F.col("k") + k0)
    error = F.sqrt(both * (1 - both) * (1 / F.col("k") + 1 / k0))
    new = ~_within_two_errors(F.col("b") / F.col("k"), b0 / k0, error)
    pools = pools.withColumn("new", F.coalesce(new, F.lit(True)).cast("int"))
    pools = pools.withColumn("group", F.sum("new").over(beside))
    group = W.partitionBy("node", "group")
    alone = F.min("low").over(group) == F.max("high").over(group)
    name = F.when(alone, F.col("low")).otherwise(F.concat(F.lit("*"), F.col("group")))
    pools = pools.select("node", "pool", name.alias("branch"))
    label = (
        F.when(~inner, F.col("seg"))
        .when(F.col("variable"), F.lit("*"))
        .when(F.col("alike") & labelled, F.lit("*0"))
        .when(apart, F.col("branch"))
        .otherwise(F.col("seg"))
    )
    return children.join(pools, ["node", "pool"], "left").withColumn("label", label)


def _branches(children: DataFrame) -> DataFrame:
    """``node``, ``label``, ``value`` (the purity) and ``single`` of every branch."""
    counts = children.groupBy("node", "label").agg(
        F.first("purity").alias("prior"),
        F.sum("known").alias("k"),
        F.sum("blocked").alias("b"),
        F.sum("ways").alias("ways"),
    )
    kinds = counts.groupBy("node").agg(F.count("*").alias("kinds"))
    smoothed = (F.col("b") + PRIOR * F.col("prior")) / (F.col("k") + PRIOR)
    k = F.greatest("k", F.lit(1))
    error = F.sqrt(F.col("prior") * (1 - F.col("prior")) / k)
    same = (
        (F.col("kinds") == 1)
        | (F.col("k") == 0)
        | _within_two_errors(F.col("b") / k, F.col("prior"), error)
    )
    value = F.when(same, F.col("prior")).otherwise(smoothed)
    return counts.join(kinds, "node").select(
        "node", "label", value.alias("value"), (F.col("ways") == 1).alias("single")
    )


def template_purity(urls: DataFrame) -> DataFrame:
    """Every template of ``urls`` (columns ``host``, ``path``, ``verdict`` of rules or null):
    its ``host`` and ``way``, ``template`` and its ``purity``, the share of blocked URLs."""
    blocked = F.count_if(F.col("verdict") == "block")
    ways = _ways(urls).groupBy("host", "way").agg(
        F.count("*").alias("n"), F.count("verdict").alias("known"), blocked.alias("blocked")
    )
    ways = write_table(ways)
    total = ways.agg(F.sum("blocked").alias("b"), F.sum("known").alias("k")).first()
    root = ((total["b"] or 0) + PRIOR / 2) / ((total["k"] or 0) + PRIOR)
    suffix = F.element_at(F.split("host", r"\."), -1)
    open_ways = ways.withColumn("node", F.lit("")).withColumn("purity", F.lit(root))
    done = []
    level = 0
    while level < 2 or not open_ways.isEmpty():
        # The suffix's node begins with a point, so it never looks like that of a host.
        if level == 0:
            seg, below = suffix, F.concat(F.lit("."), F.col("label"))
        elif level == 1:
            seg, below = F.col("host"), F.col("label")
        else:
            seg = F.coalesce(F.get("way", F.lit(level - 2)), F.lit(""))
            below = F.concat_ws("/", "node", "label")
        open_ways = open_ways.withColumn("seg", seg)
        children = open_ways.groupBy("node", "seg").agg(
            F.first("purity").alias("purity"),
            F.count("*").alias("ways"),
            *[F.sum(c).alias(c) for c in ("n", "known", "blocked")],
        )
        children = _merged(children) if level > 1 else children.withColumn("label", F.col("seg"))
        children = write_table(children.select("node", "seg", "label", "purity", "ways", "known", "blocked"))
        told = children.select("node", "seg", "label").join(_branches(children), ["node", "label"])
        # Written at every level: the plan of a level must not hold all those above it.
        grown = write_table(
            open_ways.join(told, ["node", "seg"]).select(
                "host", "way", "n", "known", "blocked",
                below.alias("node"), F.col("value").alias("purity"), "seg", "single",
            )
        )
        level += 1
        ended = (F.col("single") | (F.col("seg") == "")) if level > 2 else F.lit(False)
        # What is left of a single way is its own template.
        rest = F.slice("way", level - 1, F.greatest(F.size("way") - level + 2, F.lit(0)))
        template = F.rtrim(F.concat_ws("/", "node", F.array_join(rest, "/")), F.lit("/"))
        done.append(grown.where(ended).select("host", "way", template.alias("template"), "purity"))
        open_ways = grown.where(~ended).drop("seg", "single")
    return reduce(DataFrame.unionByName, done)


def judged(
    df: DataFrame, id_column: str = "page_id", url: str = "url", rules=RULES
) -> DataFrame:
    """One row per row of ``df``: id, ``host``, ``path``, ``rule``, ``verdict``, ``template``,
    ``purity``.

    Null URLs and URLs without ``://`` have an empty host and path, fit no rule and are judged
    by the template of empty hosts. Without any labelled URL the purity is a half everywhere
    and nothing is rejected. Ids may be null or repeated; other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    rows = df.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict)
    told = _ways(rows).join(template_purity(rows), ["host", "way"])
    by_tree = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return told.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", by_tree).alias("verdict"),
        "template",
        "purity",
    )
