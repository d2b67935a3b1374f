"""Operator 8, URL filters: rules, and a tree of path templates judged by labelled purity.

Templates: a path is cut into segments, however many it has. A segment that holds a digit, or is
long and of hexadecimal digits, is variable and becomes a wildcard. Of the others, one becomes a
wildcard if its branch of the host's tree has many children and it holds but a small share
of the branch, counted over all URLs. This is done from the root downwards, at those levels
where a branch has many children.

Sibling leaves of a host whose share of rejected labels does not differ by more than chance
(a two-proportion test) are merged and pool their labels. Labels also reach other hosts: the
templates of all hosts form one tree, in which a branch is merged with the one above it if
its share does not differ by more than chance from that one's, and otherwise has its own share,
smoothed towards the one above; the root is smoothed towards a low prior share. A host's template
is blocked if its share of rejected labels, smoothed towards that of the template in this
tree, is beyond a limit. Without any labels all is allowed.

The longest fitting rule decides first. A rule fits its host and all subdomains, if the
path begins with the rule's. Of rules of one length, the one that blocks wins.

A null URL, or one without `://`, has an empty host and path and is judged like any other.
Rows with the same page_id stay apart. An empty table gives no rows, other columns are not
read. All steps are DataFrame expressions; hosts are summed up by path template before
anything is gathered by host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow import session

MANY_CHILDREN = 20
SMALL_SHARE = 0.05
SAME_Z = 1.96
PRIOR = 0.2
SMOOTHING = 4.0
LIMIT = 0.5
_ALL = (1 << 31) - 1
#: Segments that are variable by their look.
VARIABLE = r"[0-9]|^[0-9A-Fa-f-]{16,}$"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: Column, path: Column) -> Column:
    """The fitting rule with the longest name as struct<rule, verdict>, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The best comes last, so it is the outermost condition.
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def path_templates(paths: DataFrame) -> DataFrame:
    """host, path, template for distinct (host, path, n), with rare segments as wildcards."""
    cut = F.split(F.regexp_replace("path", "^/", ""), "/")
    segments = F.transform(cut, lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))
    shapes = session.stage(paths.select("host", "path", "n", segments.alias("segments")), "url-shapes")
    # Paths of one shape go on as one row.
    tree = (
        shapes.groupBy("host", "segments").agg(F.sum("n").alias("n")).select("*", F.col("segments").alias("template"))
    )
    level = -1
    while True:
        # The children of every branch below the levels that are done, and the first level at which
        # some of them are rare. Most levels have none, so there are few rounds.
        at = tree.select("host", "n", "template", F.posexplode("template").alias("level", "here"))
        branch = F.xxhash64(F.slice("template", 1, F.col("level")))
        children = at.where(F.col("level") > level).groupBy("host", "level", branch.alias("branch"), "here").agg(
            F.sum("n").alias("held")
        )
        children = session.stage(children, "url-children")
        sizes = children.groupBy("host", "level", "branch").agg(
            F.count("*").alias("n_children"), F.sum("held").alias("of_branch")
        )
        crowded = sizes.where(F.col("n_children") > MANY_CHILDREN).drop("n_children")
        rare = session.stage(
            children.join(crowded, ["host", "level", "branch"])
            .where((F.col("held") < SMALL_SHARE * F.col("of_branch")) & (F.col("here") != "*"))
            .select("host", "level", "branch", "here"),
            "url-rare",
        )
        level = rare.agg(F.min("level")).first()[0]
        if level is None:
            break
        own = rare.where(F.col("level") == level).select("host", "branch", "here", F.lit(True).alias("rare"))
        here = F.get("template", F.lit(level))
        wild = F.concat(F.slice("template", 1, level), F.array(F.lit("*")), F.slice("template", level + 2, _ALL))
        named = tree.withColumns({"branch": F.xxhash64(F.slice("template", 1, level)), "here": here})
        wider = named.join(own, ["host", "branch", "here"], "left").select(
            "host", "segments", "n", F.when(F.col("rare"), wild).otherwise(F.col("template")).alias("template")
        )
        tree = session.stage(wider, "url-tree")
    return shapes.select("host", "path", "segments").join(
        tree.select("host", "segments", "template"), ["host", "segments"]
    ).select("host", "path", "template")


def shared_shares(labelled: DataFrame) -> DataFrame:
    """template, shared: the share of rejected labels of a template in the tree of all hosts."""
    shapes = session.stage(
        labelled.groupBy("template").agg(F.sum("n_bad").alias("bad"), F.sum("n_labelled").alias("of")), "url-templates"
    )
    root = shapes.agg(F.sum("bad").alias("bad"), F.sum("of").alias("of")).first()
    prior = ((root.bad or 0) + SMOOTHING * PRIOR) / ((root.of or 0) + SMOOTHING)
    nodes = shapes.withColumn("level", F.explode(F.sequence(F.lit(1), F.greatest(F.size("template"), F.lit(1)))))
    nodes = nodes.withColumn("node", F.slice("template", 1, F.col("level")))
    sums = nodes.where("of > 0").groupBy("node").agg(F.sum("bad").alias("bad"), F.sum("of").alias("of"))
    chains = (
        nodes.select("template", "level", "node")
        .join(sums, "node")
        .groupBy("template")
        .agg(F.array_sort(F.collect_list(F.struct("level", "bad", "of"))).alias("chain"))
    )

    def down(above: Column, node: Column) -> Column:
        alike = F.abs(node["bad"] / node["of"] - above) <= SAME_Z * F.sqrt(above * (1 - above) / node["of"])
        return F.when(alike, above).otherwise((node["bad"] + SMOOTHING * above) / (node["of"] + SMOOTHING))

    shared = F.aggregate("chain", F.lit(prior).cast("double"), down)
    return shapes.select("template").join(chains.select("template", shared.alias("shared")), "template", "left").select(
        "template", F.coalesce("shared", F.lit(prior)).alias("shared")
    )


def template_verdicts(labelled: DataFrame) -> DataFrame:
    """host, template, verdict from (host, template, n_bad, n_labelled), one row per template."""
    branch = F.slice("template", 1, F.greatest(F.size("template") - 1, F.lit(0)))
    leaves = labelled.select("*", branch.alias("branch"))
    sums = leaves.groupBy("host", "branch").agg(F.sum("n_bad").alias("bad"), F.sum("n_labelled").alias("of"))
    p = F.try_divide("bad", "of")
    own = F.try_divide("n_bad", "n_labelled")
    spread = F.sqrt(F.try_divide(p * (1 - p), F.col("n_labelled")))
    alike = (F.col("n_labelled") > 0) & (F.abs(own - p) <= F.lit(SAME_Z) * spread)
    seen = session.stage(
        leaves.join(sums, ["host", "branch"]).withColumn("alike", F.coalesce(alike, F.lit(False))), "url-leaves"
    )
    pooled = (
        seen.where("alike")
        .groupBy("host", "branch")
        .agg(F.sum("n_bad").alias("pool_bad"), F.sum("n_labelled").alias("pool_of"))
    )
    bad = F.when(F.col("alike"), F.col("pool_bad")).otherwise(F.col("n_bad"))
    of = F.when(F.col("alike"), F.col("pool_of")).otherwise(F.col("n_labelled"))
    purity = (bad + F.lit(SMOOTHING) * F.col("shared")) / (of + F.lit(SMOOTHING))
    return (
        seen.join(pooled, ["host", "branch"], "left")
        .join(shared_shares(labelled), "template")
        .select("host", "template", purity.alias("bad_share"), F.when(purity > LIMIT, "block").otherwise("allow").alias("verdict"))
    )


def judge(pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template and its share of rejected labels.

    labels has (page_id, bad); without it, URLs that a rule decides are the labelled ones.
    """
    host, path = F.col("host"), F.col("path")
    read = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    read = read.withColumn("r", rule_of(rules, host, path))
    if labels is None:
        bad = F.when(F.col("r").isNotNull(), (F.col("r.verdict") == "block").cast("long"))
        known = read.withColumn("bad", bad)
    else:
        once = labels.groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
        known = read.join(once, "page_id", "left")
    paths = known.groupBy("host", "path").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad"),
        F.count("bad").alias("n_labelled"),
    )
    paths = session.stage(paths, "url-paths")
    templates = session.stage(path_templates(paths), "url-templates")
    counts = session.stage(
        templates.join(paths, ["host", "path"])
        .groupBy("host", "template")
        .agg(F.sum("n_bad").alias("n_bad"), F.sum("n_labelled").alias("n_labelled")),
        "url-counts",
    )
    verdicts = templates.join(template_verdicts(counts), ["host", "template"])
    return read.join(verdicts, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("r.rule").alias("rule"),
        F.coalesce("r.verdict", "verdict", F.lit("allow")).alias("verdict"),
        F.array_join("template", "/").alias("template"),
        F.round("bad_share", 6).alias("bad_share"),
    )
