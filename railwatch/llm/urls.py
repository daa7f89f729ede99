"""URL verdicts: host and path rules, then a path-template tree with labelled purity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railwatch.sources.staging import staged

PRIOR_WEIGHT = 4.0
DISTANCE = 1.96
REJECT_FROM = 0.5

# The rules that queries are compared at.
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest rule that fits, as ``struct(rule, verdict)``; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def shape(segment: Column) -> Column:
    """A path segment with its plain variable parts written as wildcards: every run of digits is ``#``."""
    return F.regexp_replace(segment, "[0-9]+", "#")


def templates(paths: DataFrame) -> DataFrame:
    """Add ``template``, an array of segments, to rows of ``host, path, n, labelled, bad``.

    Level by level from the root of a host's tree, until no path has a further segment: segments become
    shapes; siblings whose labelled share of bad pages does not differ from that of all their siblings
    together (a test of two proportions at ``DISTANCE`` deviations, however many they are), and those
    without labels, are merged into ``*``.  An only child keeps its shape.  Below a node where all paths
    have the same shapes each node has one child, so these are taken at once.  Only counts per (host,
    node, shape) are grouped, map side first, so a host of any size is spread.
    """
    parts = F.filter(F.split("path", "/"), lambda s: s != "")
    going = staged(
        paths.withColumn("_rest", F.transform(parts, shape)).withColumn("template", F.array().cast("array<string>")), "url-tree"
    )
    ended = going.where(F.size("_rest") == 0)
    while True:
        going = going.where(F.size("_rest") > 0)
        if going.isEmpty():
            return ended.drop("_rest")
        tree = going.withColumn("_child", F.get("_rest", F.lit(0))).withColumn("_below", F.xxhash64("_rest"))
        children = tree.groupBy("host", "template", "_child").agg(
            F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), (F.min("_below") == F.max("_below")).alias("_alike")
        )
        nodes = children.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("_kinds"), F.sum("labelled").alias("_all"), F.sum("bad").alias("_all_bad")
        )
        joined = children.join(nodes, ["host", "template"])
        rest, rest_bad = F.col("_all") - F.col("labelled"), F.col("_all_bad") - F.col("bad")
        pooled = (F.col("_all_bad") + 1) / (F.col("_all") + 2)
        error = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / F.col("labelled") + F.lit(1.0) / rest))
        apart = F.coalesce(
            F.when(
                (F.col("labelled") > 0) & (rest > 0),
                F.abs(F.col("bad") / F.col("labelled") - rest_bad / rest) > DISTANCE * error,
            ), F.lit(False),
        )
        own = joined.where((F.col("_kinds") == 1) | apart).select(
            F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("_child").alias("_c"), "_alike"
        )
        named = tree.join(
            own, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("_child") == F.col("_c")), "left"
        )
        name = F.when(F.col("_c").isNotNull(), F.col("_child")).otherwise(F.lit("*"))
        going = staged(
            named.withColumn("template", F.concat("template", F.when(F.col("_alike"), F.col("_rest")).otherwise(F.array(name)))).withColumn(
                "_rest", F.when(F.col("_alike"), F.array().cast("array<string>")).otherwise(F.slice("_rest", F.lit(2), F.size("_rest")))
            ).drop("_h", "_t", "_c", "_alike", "_child", "_below"), "url-tree",
        )
        ended = ended.unionByName(going.where(F.size("_rest") == 0))


def purity(tree: DataFrame) -> DataFrame:
    """``host, template, share``: the smoothed labelled share of bad pages of every template.

    A template's share is pulled towards that of its host, and the host's towards that of all
    hosts, with the weight of ``PRIOR_WEIGHT`` pages; without labels it is the one above.
    """
    total = tree.agg(F.sum("labelled").alias("_n"), F.sum("bad").alias("_bad")).select(
        F.coalesce((F.col("_bad") + 1) / (F.col("_n") + 2), F.lit(0.5)).alias("_base")
    )
    leaves = tree.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad"))
    hosts = leaves.groupBy("host").agg(F.sum("n").alias("_n"), F.sum("bad").alias("_b"))
    base = total.first()["_base"]
    hosts = hosts.select("host", ((F.col("_b") + PRIOR_WEIGHT * F.lit(base)) / (F.col("_n") + PRIOR_WEIGHT)).alias("_host_share"))
    return leaves.join(hosts, "host").select(
        "host", "template", ((F.col("bad") + PRIOR_WEIGHT * F.col("_host_share")) / (F.col("n") + PRIOR_WEIGHT)).alias("share")
    )


def judge(
    pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, label: Column | None = None,
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``id, host, path, rule, template, verdict`` for every page.

    A rule's verdict stands.  Other pages get that of their template: ``block`` from a smoothed
    labelled purity of ``REJECT_FROM`` bad pages on.  ``label`` is a column of 1 (bad), 0 (good) or
    null; without one, pages that a rule judges are the labelled ones.

    A null url or one without ``://`` has an empty host and path, no rule, and the verdict of the
    empty template.  Null ids and repeated rows are judged each.  Any depth and length of a path is
    read whole.  Other columns are not carried.  An empty table gives an empty result.
    """
    url = F.col(url_col)
    parsed = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), *([label.alias("_label")] if label is not None else []))
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumn("_hit", hit).select(
        "*", F.col("_hit.rule").alias("rule"), F.col("_hit.verdict").alias("_ruled")
    ).drop("_hit")
    bad = F.col("_label") if label is not None else (F.col("_ruled") == "block").cast("int")
    parsed = staged(parsed.withColumn("_bad", bad), "urls")
    paths = parsed.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("_bad").alias("labelled"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad")
    )
    tree = templates(paths)
    verdicts = tree.join(purity(tree), ["host", "template"]).select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        F.when(F.col("share") >= REJECT_FROM, F.lit("block")).otherwise(F.lit("allow")).alias("_method"),
    )
    return parsed.join(verdicts, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p"))).select(
        F.col("id").alias(id_col), "host", "path", "rule", "template", F.coalesce("_ruled", "_method").alias("verdict")
    )
