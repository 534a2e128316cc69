"""URL rules with a path-template tree for the urls that no rule decides.

Rules (host, path) fit a host and its subdomains and every path that starts with theirs; the longest wins. Urls that a
rule decides are the labelled ones. For the others a tree of path templates is grown per host, one segment at a time:
where a node has many and rare children they become a wildcard, while children with a fair share of the node stay.
Sibling branches that differ in one literal segment are merged when their wildcard lengths and label rates don't differ
significantly. A template is rejected when the smoothed share of bad urls among its labelled ones is high, enough of
its urls are labelled, and enough of those are bad.

The tree works on distinct (host, path) with counts. Node statistics are partial sums before any shuffle, and they are
joined back from written tables, so adaptive execution splits a host that holds a third of all rows.

Nulls: a null url, or one without "://", has an empty host and an empty path, fits no rule and is judged like any other.
Null page ids and repeated rows give a row each. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import materialise, pages

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]
#: A node's children become a wildcard from so many on, when each child has less than RARE of the node's urls.
FANOUT, RARE = 8, 0.05
#: Deeper segments are one last segment together.
DEPTH = 12
#: Deviations beyond which branches differ.
DEVIATIONS = 3.0
PURITY, LEAST_BAD, LEAST_LABELLED = 0.8, 5, 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule's text and verdict, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def grow(paths: DataFrame, fanout: int = FANOUT, rare: float = RARE, depth: int = DEPTH) -> DataFrame:
    """Add ``template`` and ``wild`` (the length of what wildcards cover) to distinct (host, path, n, bad, good)."""
    parts = F.split("path", "/", depth)
    state = paths.withColumns({"segs": parts, "template": F.lit(""), "wild": F.lit(0)})
    state = materialise(state, "url-tree")
    level = 0
    deepest = state.agg(F.max(F.size("segs"))).first()[0] or 0
    while level < deepest:
        seg = F.get("segs", F.lit(level))
        here = state.withColumn("seg", seg)
        children = here.filter("seg IS NOT NULL").groupBy("host", "template", "seg").agg(F.sum("n").alias("own"))
        children = materialise(children, "url-children")
        nodes = children.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kinds"), F.sum("own").alias("all"))
        variable = (F.col("kinds") >= fanout) & (F.col("own") < rare * F.col("all"))
        wild = children.join(nodes.withColumnsRenamed({"host": "nh", "template": "nt"}), (F.col("host") == F.col("nh")) & (F.col("template") == F.col("nt"))).filter(variable)
        wild = materialise(wild.select(F.col("host").alias("wh"), F.col("template").alias("wt"), F.col("seg").alias("ws")), "url-wild")
        met = here.join(wild, (F.col("host") == F.col("wh")) & (F.col("template") == F.col("wt")) & (F.col("seg") == F.col("ws")), "left")
        starred = F.col("ws").isNotNull()
        named = F.when(F.col("seg").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/" if level else ""), F.when(starred, "*").otherwise(F.replace("seg", F.lit("*"), F.lit("%2A")))))
        state = materialise(met.select("host", "path", "n", "bad", "good", "segs", named.alias("template"), (F.col("wild") + F.when(starred, F.length("seg")).otherwise(0)).alias("wild")), "url-tree")
        level += 1
    return state.drop("segs")


def merged(tree: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """Templates of the tree (host, template, n, bad, good) with the pooled counts of the branches they are like."""
    size = F.col("wild").cast("double")
    templates = tree.groupBy("host", "template").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("k"), F.sum(size).alias("s"), F.sum(size * size).alias("ss"), F.max("wild").alias("most")
    )
    # the last literal segment gives way; templates without a wildcard have no branch below to compare
    literal = F.regexp_replace("template", r"(?s)/[^/*]+((?:/\*|/)*)$", "/+$1")
    marked = materialise(templates.withColumn("family", F.when(F.col("most") > 0, literal).otherwise(F.col("template"))), "url-templates")

    def pool(members: DataFrame) -> DataFrame:
        sums = members.groupBy("host", "family").agg(*[F.sum(c).alias(f"f_{c}") for c in ("n", "bad", "good", "k", "s", "ss")])
        return materialise(sums.withColumnsRenamed({"host": "fh", "family": "ff"}), "url-families")

    same = (F.col("host") == F.col("fh")) & (F.col("family") == F.col("ff"))
    first = marked.join(pool(marked), same)
    mean, rate = F.col("f_s") / F.col("f_k"), (F.col("f_bad") + 1) / (F.col("f_bad") + F.col("f_good") + 2)
    spread = F.sqrt(F.greatest(F.col("f_ss") / F.col("f_k") - mean * mean, F.lit(0.0)) / F.col("k"))
    labelled = F.col("bad") + F.col("good")
    near_size = F.abs(F.col("s") / F.col("k") - mean) <= deviations * spread + 1e-9
    near_rate = (labelled == 0) | (F.abs(F.col("bad") / F.greatest(labelled, F.lit(1)) - rate) <= deviations * F.sqrt(rate * (1 - rate) / F.greatest(labelled, F.lit(1))))
    alike = first.withColumn("family", F.when(near_size & near_rate, F.col("family")).otherwise(F.col("template"))).select(*marked.columns)
    alike = materialise(alike, "url-alike")
    return alike.join(pool(alike), same).select("host", "template", "family", F.col("f_n").alias("n"), F.col("f_bad").alias("bad"), F.col("f_good").alias("good"))


def rejected(templates: DataFrame, purity: float = PURITY, least_bad: int = LEAST_BAD, least_labelled: float = LEAST_LABELLED) -> Column:
    labelled = F.col("bad") + F.col("good")
    return ((F.col("bad") + 1) / (labelled + 2) >= purity) & (F.col("bad") >= least_bad) & (labelled >= least_labelled * F.col("n"))


def judge_urls(rows: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """One row per url: id, host, path, rule, verdict, template (null where a rule decides) and template_purity."""
    host, path = parsed(F.col(url_col))
    split = rows.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    split = materialise(split.withColumns({"rule": rule, "by_rule": by_rule}), "url-rows")
    flag = lambda v: F.sum(F.when(F.col("by_rule") == v, 1).otherwise(0))
    paths = split.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), flag("block").alias("bad"), flag("allow").alias("good"))
    tree = grow(paths)
    judged = merged(tree)
    judged = judged.select(F.col("host").alias("jh"), F.col("template").alias("jt"), "family", rejected(judged).alias("reject"), ((F.col("bad") + 1) / (F.col("bad") + F.col("good") + 2)).alias("purity"))
    judged = materialise(judged, "url-judged")
    open_paths = tree.filter("bad + good = 0").join(judged, (F.col("host") == F.col("jh")) & (F.col("template") == F.col("jt")))
    open_paths = materialise(open_paths.select(F.col("host").alias("oh"), F.col("path").alias("op"), "family", "reject", "purity"), "url-open")
    met = split.join(open_paths, (F.col("host") == F.col("oh")) & (F.col("path") == F.col("op")) & F.col("rule").isNull(), "left")
    verdict = F.coalesce("by_rule", F.when(F.col("reject"), "block").otherwise("allow"))
    return met.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), F.col("family").alias("template"), F.col("purity").alias("template_purity"))


def op3_url_filter(spark, sf_dir):
    return judge_urls(pages(spark, sf_dir))


QUERIES = {"op3_url_filter": op3_url_filter}
SQL: dict[str, str] = {}
