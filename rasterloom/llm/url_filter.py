"""URL filter: rules by host and path, and for other URLs a tree of path templates for each host.

Segments that look like identifiers become wildcards in the row itself, so the tree is built from the distinct paths
that are left. Level by level, segments that are rare below their parent become wildcards too, and siblings whose
shares of blocked pages do not differ significantly become one branch. A template is rejected if its purity, the share of
blocked pages among the labelled ones at and below it, reaches a threshold. Purity is smoothed towards that of the
template's parent, that of a host towards a fixed one, so a branch without labels has its parent's and a host without
labels is not rejected, whatever share of other hosts the rules block. Labels are what the rules say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.common import column, lower_ascii, stored

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Segments below this depth are one wildcard.
DEPTH = 8
#: A segment keeps its name with so many pages, and such a share of its parent's; others are variable.
SUPPORT, SHARE = 3, 0.01
#: Two shares differ significantly from this many standard errors on.
APART = 1.96
#: Pages of its parent's opinion that each template is given; purity of a host without labels; purity from which a
#: template is rejected.
SMOOTH, PRIOR, REJECT = 4.0, 0.5, 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one string, and what it says; null if none fits."""
    text, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        text = F.when(fits, F.lit(own_host + own_path)).otherwise(text)
        says = F.when(fits, F.lit(verdict)).otherwise(says)
    return text, says


def segments(path: Column) -> Column:
    """The segments of a path; those with a digit or of 40 characters or more are wildcards, as is all below DEPTH."""
    named = F.filter(F.split(path, "/"), lambda s: s != "")
    general = F.transform(named, lambda s: F.when(s.rlike("[0-9]") | (F.length(s) >= 40), F.lit("*")).otherwise(s))
    deep = F.concat(F.slice(general, 1, DEPTH), F.array(F.lit("**")))
    return F.when(F.size(general) > DEPTH, deep).otherwise(general)


def templates(paths: DataFrame, depth: int) -> DataFrame:
    """(host, segs, template, purity) from (host, segs, n, labelled, blocked), level by level."""
    hosts = paths.groupBy("host").agg(F.sum("labelled").alias("of"), F.sum("blocked").alias("bad"))
    hosts = hosts.select("host", _smoothed(F.lit(PRIOR)).alias("purity"))
    tree = stored(paths.join(hosts, "host").withColumn("template", F.lit("")), "templates")
    for level in range(depth):
        seg = F.get("segs", F.lit(level))
        rows = tree.withColumn("seg", seg)
        nodes = rows.where(seg.isNotNull()).groupBy("host", "template", "seg")
        nodes = nodes.agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
        parents = nodes.groupBy("host", "template").agg(F.sum("n").alias("all"))
        named = nodes.join(parents, ["host", "template"])
        keeps = ~F.col("seg").isin("*", "**") & (F.col("n") >= SUPPORT) & (F.col("n") >= SHARE * F.col("all"))
        branches = _merged(named.where(keeps))
        rows = rows.join(branches, ["host", "template", "seg"], "left")
        branch = F.when(F.col("seg").isNotNull(), F.coalesce("branch", F.lit("*")))
        rows = rows.withColumn("branch", branch)
        sums = rows.where(F.col("branch").isNotNull()).groupBy("host", "template", "branch")
        sums = sums.agg(F.sum("labelled").alias("of"), F.sum("blocked").alias("bad"))
        rows = rows.join(sums, ["host", "template", "branch"], "left")
        step = F.coalesce(F.concat(F.lit("/"), "branch"), F.lit(""))
        purity = F.when(F.col("branch").isNull(), F.col("purity")).otherwise(_smoothed(F.col("purity")))
        tree = rows.select("host", "segs", "n", "labelled", "blocked", F.concat("template", step).alias("template"), purity.alias("purity"))
        tree = stored(tree, "templates")
    return tree.select("host", "segs", "template", "purity")


def _smoothed(above: Column) -> Column:
    return (F.col("bad") + SMOOTH * above) / (F.col("of") + SMOOTH)


def _merged(nodes: DataFrame) -> DataFrame:
    """(host, template, seg, branch): siblings in the order of their shares, cut where neighbours differ significantly.

    A parent has 1 / SHARE such children at most. Those without labelled pages have nothing to tell them apart.
    """
    own = Window.partitionBy("host", "template", F.col("labelled") > 0).orderBy("rate", "seg")
    nodes = nodes.withColumn("rate", F.when(F.col("labelled") > 0, F.col("blocked") / F.col("labelled")))
    n, m = F.col("labelled"), F.lag("labelled").over(own)
    both = (F.col("blocked") + F.lag("blocked").over(own)) / (n + m)
    error = F.sqrt(both * (1 - both) * (1 / n + 1 / m))
    differs = F.coalesce((F.col("rate") - F.lag("rate").over(own)) > APART * error, F.lit(False))
    nodes = nodes.withColumn("differs", differs.cast("int")).withColumn("part", F.sum("differs").over(own))
    group = Window.partitionBy("host", "template", F.col("labelled") > 0, "part")
    more = F.count(F.lit(1)).over(group) - 1
    name = F.min("seg").over(group)
    return nodes.select(
        "host", "template", "seg", F.when(more > 0, F.concat(name, F.lit("|+"), more)).otherwise(name).alias("branch")
    )


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", labels: DataFrame | None = None) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) of each page.

    The rule decides where one fits, else the template's purity. ``labels`` (id, blocked) adds labelled pages to those
    that rules label; of several for a page the blocking one counts. Without any label of its host a page is allowed. Null URLs and URLs without ``://`` have no host, no
    path and an empty template. Repeated rows each get their result. Other columns are not read. An empty table gives
    no rows.
    """
    host, path = host_and_path(column(url_col))
    rows = pages.select(column(id_col).alias("id"), host.alias("host"), path.alias("path"))
    text, says = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", text.alias("rule"), says.alias("says"), segments(F.col("path")).alias("segs"))
    known = rows.withColumn("label", (F.col("says") == "block").cast("long"))
    if labels is not None:
        extra = labels.select(F.col("id"), F.col("blocked").cast("long").alias("extra")).dropna()
        extra = extra.groupBy("id").agg(F.max("extra").alias("extra"))
        known = known.join(extra, "id", "left").withColumn("label", F.coalesce("label", "extra"))
    paths = known.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"),
    )
    paths = stored(paths, "paths")
    found = templates(paths, paths.agg(F.max(F.size("segs"))).first()[0] or 0)
    out = rows.join(found, ["host", "segs"])
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("says", own).alias("verdict"), "template", "purity"
    )
