"""URL filters: rules, and a tree of path templates per host for the rest.

Paths become templates in two steps.  Lexically, segments that consist of
digits, dates or hexadecimal ids are wildcards at once.  Statistically, level
by level from the root of a host's tree: where a node has many children that
hardly repeat, its literal children become one wildcard; and children whose
labelled shares do not differ by more than a Hoeffding bound from what their
siblings with the same shape have are merged into one branch.  A leaf template
is rejected if the share of blocked among its labelled urls, smoothed by the
share of its host and of all hosts, is high enough.  Labels are the verdicts of
the rules, and those of a label table where there is one.

All statistics are aggregates over (host, template) with their counts, which
Spark pre-aggregates before it shuffles; a hot host is many partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import ascii_lower, materialise

#: (verdict, host, path): a rule fits its host and subdomains and paths that start with its path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: A node generalises its literal children if it has more than this many and
#: fewer than two urls a child.
FANOUT = 8
PRIOR, MIN_LABELLED, PURITY = 5.0, 3, 0.9


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_columns(rules, host: Column, path: Column) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest rule that fits; null without one.

    The rules are a parameter held in the plan, meant for hundreds of them."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def lexical(segment: Column) -> Column:
    """Segments that are numbers, dates or hexadecimal ids become wildcards; an
    extension stays."""
    s = F.regexp_replace(segment, r"^[0-9]+([-_.:][0-9]+)*(?=(\.[A-Za-z]{1,5})?$)", "*")
    return F.regexp_replace(s, r"^(?=[0-9a-fA-F-]*[0-9])[0-9a-fA-F-]{8,}(?=(\.[A-Za-z]{1,5})?$)", "*")


def template_parts(path: Column) -> Column:
    """All segments of a path, variable ones as wildcards."""
    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), lexical)


def _shape(segment: Column) -> Column:
    """What of a segment counts for the form of a branch: wildcards and empty ones."""
    return F.when(F.length(segment) == 0, F.lit("")).when(segment.startswith("*"), segment).otherwise(F.lit("w"))


def grow(nodes: DataFrame) -> DataFrame:
    """``nodes(host, parts, template, n, labelled, blocked)``: settle the templates level
    by level from the root, until no branch splits any more; returns the same rows
    with ``template``.  What is left of a path below its last split stays as it is."""
    level = 0
    while True:
        apart = nodes.groupBy("host", "template").agg(F.count(F.lit(1)).alias("k"), F.max(F.size("parts")).alias("deep"))
        if not apart.filter((F.col("k") > 1) & (F.col("deep") > level)).limit(1).count():
            break
        own = nodes.withColumn("seg", F.coalesce(F.get("parts", level), F.lit(""))).withColumn(
            "rest", F.array_join(F.transform(F.slice("parts", level + 2, F.size("parts")), _shape), "/"))
        key = ["host", "template"]
        child = own.groupBy(*key, "seg", "rest").agg(F.sum("n").alias("n"), F.sum("labelled").alias("l"), F.sum("blocked").alias("b"))
        by_shape = child.groupBy(*key, "rest").agg(
            F.sum("l").alias("sl"), F.sum("b").alias("sb"), F.sum("n").alias("sn"), F.count(F.lit(1)).alias("kids"))
        both = child.join(by_shape, [*key, "rest"])
        # ALERGIA: two observed shares are similar if they differ by less than the sum of their Hoeffding widths (95 %)
        others, others_b = F.col("sl") - F.col("l"), F.col("sb") - F.col("b")
        width = 1.36 * (1 / F.sqrt(F.greatest("l", F.lit(1))) + 1 / F.sqrt(F.greatest(others, F.lit(1))))
        similar = (F.col("l") >= MIN_LABELLED) & (others >= MIN_LABELLED) & (
            F.abs(F.col("b") / F.col("l") - others_b / others) < width)
        variable = (F.col("kids") > FANOUT) & (F.col("sn") < 2 * F.col("kids"))
        label = F.when(F.col("seg").startswith("*") | (F.col("seg") == ""), F.col("seg")).when(variable, F.lit("*")).when(
            similar, F.concat(F.lit("+"), F.when(F.col("b") * 2 > F.col("l"), F.lit("b")).otherwise(F.lit("a")))).otherwise(F.col("seg"))
        names = both.select(*key, "seg", "rest", label.alias("label"))
        grown = F.when(F.size("parts") > level, F.concat("template", F.lit("/"), "label")).otherwise(F.col("template"))
        nodes = materialise(own.join(names, [*key, "seg", "rest"]).withColumn("template", grown).drop("seg", "rest", "label"), f"level{level}")
        level += 1
    tail = F.transform(F.slice("parts", level + 1, F.greatest(F.size("parts"), F.lit(1))), lambda x: F.concat(F.lit("/"), x))
    return nodes.withColumn("template", F.concat("template", F.array_join(tail, "")))


def judged_templates(nodes: DataFrame) -> DataFrame:
    """(host, parts, template, purity, verdict) of every lexical template."""
    nodes = grow(nodes)
    total = nodes.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    base = (total.b or 0) / total.l if total and total.l else 0.0
    hosts = nodes.groupBy("host").agg(F.sum("blocked").alias("hb"), F.sum("labelled").alias("hl"))
    share = (F.col("hb") + PRIOR * base) / (F.col("hl") + PRIOR)
    leaves = nodes.groupBy("host", "template").agg(F.sum("blocked").alias("tb"), F.sum("labelled").alias("tl"))
    leaves = leaves.join(hosts, "host").withColumn("purity", (F.col("tb") + PRIOR * share) / (F.col("tl") + PRIOR))
    bad = (F.col("tl") >= MIN_LABELLED) & (F.col("purity") >= PURITY)
    leaves = leaves.withColumn("template_verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return nodes.select("host", "parts", "template").join(
        leaves.select("host", "template", "purity", "template_verdict"), ["host", "template"])


def filter_urls(pages: DataFrame, rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """``pages(page_id, url)`` -> one row each: page_id, host, path, rule,
    verdict, template, purity.

    ``labels(page_id, blocked boolean)`` adds labelled urls to those that rules
    decide.  A null url or one without ``://`` has an empty host and path, no
    rule and the verdict of its empty template (allow, as it has no labels);
    repeated rows count as often as they occur; a template without at least
    three labelled urls is allowed; an empty table gives no rows; only page_id
    and url are read."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(rules, F.col("host"), F.col("path"))
    urls = urls.withColumns({"rule": rule, "rule_verdict": verdict, "parts": template_parts(F.col("path"))})
    marked = urls.withColumn("label", F.col("rule_verdict") == "block")
    if labels is not None:
        own = labels.groupBy("page_id").agg(F.max("blocked").alias("_own"))
        marked = marked.join(own, "page_id", "left").withColumn("label", F.coalesce("label", "_own")).drop("_own")
    nodes = marked.groupBy("host", "parts").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"),
        F.coalesce(F.sum(F.col("label").cast("long")), F.lit(0)).alias("blocked")).withColumn("template", F.lit(""))
    judged = materialise(judged_templates(materialise(nodes, "nodes")), "templates")
    # a hot template is one small row against many urls: Spark splits the urls' side of the join
    out = urls.join(judged, ["host", "parts"], "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("rule_verdict", "template_verdict", F.lit("allow")).alias("verdict"), "template", "purity")
