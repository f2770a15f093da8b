"""URL filter by a tree of path templates, in DataFrame functions only.

Per host, paths are cut into segments.  Segments that are variable by their form (digits,
hexadecimal, dates, long mixed words) become wildcards, each of its kind.  What is left is
counted once into (host, template) groups, so a host with a third of all rows is a few
groups.  Level by level, the children of each branch are then compared with the pooled
share of good labels of their siblings (a two-sided z test); children that do not differ,
or are too rare to tell, are merged into one wildcard; an only child keeps its name.
A template is rejected if its purity ``(good + prior * weight) / (labelled + weight)``,
smoothed towards the share of good labels of all pages, is below ``min_purity``.

Hosts and paths: the host is what stands between the first ``://`` and the next ``/``,
``?``, ``#`` or the end, A-Z lowered; the path goes on to ``?``, ``#`` or the end.  Rules
(host and path prefix) come first: the longest that fits decides.

Cases: a null url or one without ``://`` has an empty host and path and is judged as the
template of the empty host; repeated rows are judged alike and count each; pages without
label count for the shape of the tree only; without any label the prior is 1; empty tables
give empty results; input columns named like a result column are replaced by it.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, without

MIN_PURITY = 0.5
WEIGHT = 10.0
MAX_Z = 1.96
SALTS = 16
RESULTS = ("host", "path", "rule", "template", "purity", "verdict")
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for kind, r in sorted(rules, key=lambda x: len(x[1])):      # longer ones are put around shorter ones
        name, _, rest = r.partition("/")
        fits = host.rlike(r"(^|\.)" + re.escape(name) + r"\z") & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """A wildcard for a segment that is variable by its form, else the segment."""
    stem = F.regexp_replace(segment, r"\.(html?|php|aspx?|jsp|xml|json|pdf)$", "")
    return (F.when(stem.rlike(r"^\d{4}-\d{2}-\d{2}$"), "{date}").when(stem.rlike(r"^\d+$"), "{n}")
            .when(stem.rlike(r"^(?=.*\d)[0-9a-fA-F-]{8,}$"), "{hex}")
            .when((F.length(stem) > 24) | (stem.rlike(r"\d") & (F.length(stem) > 8)), "{word}").otherwise(segment))


def segments(path: Column) -> Column:
    """The shapes of all segments."""
    return F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), shape)


def template_table(pages: DataFrame, min_purity: float = MIN_PURITY, weight: float = WEIGHT) -> DataFrame:
    """(host, shape, template, purity) from pages of (host, shape, good); ``good`` may be null."""
    groups = staged(pages.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("good").alias("labelled"),
        F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good")), "url-groups")
    total = groups.agg(F.sum("good").alias("g"), F.sum("labelled").alias("l"), F.max(F.size("shape")).alias("deep")).first()
    prior = float(total["g"]) / total["l"] if total["l"] else 1.0
    groups = groups.withColumn("template", F.array().cast("array<string>"))
    tree, rows, level, deep = groups.where(F.size("shape") == 0), groups.where(F.size("shape") > 0), 0, total["deep"] or 0
    while level < deep:
        level += 1
        rows = rows.withColumn("_seg", F.get(F.col("shape"), F.lit(level - 1)))
        child = rows.groupBy("host", "template", "_seg").agg(
            F.sum("labelled").alias("l"), F.sum("good").alias("g"), F.count(F.lit(1)).alias("shapes"))
        pooled = child.groupBy("host", "template").agg(
            F.sum("l").alias("all_l"), F.sum("g").alias("all_g"), F.count(F.lit(1)).alias("children"),
            (F.sum("shapes") == 1).alias("_alone"))
        rate = (F.col("all_g") + prior * weight) / (F.col("all_l") + weight)
        z = F.abs(F.col("g") - F.col("l") * rate) / F.sqrt(F.col("l") * rate * (1 - rate) + 1e-9)
        own = (F.col("children") == 1) | ((F.col("l") >= weight) & (z > MAX_Z))
        # only branches that become a wildcard or end in one shape are listed; the others keep their name
        listed = child.join(pooled, ["host", "template"]).where(~own | F.col("_alone")).select(
            "host", "template", "_seg", F.when(~own, "*").alias("_as"), "_alone")
        alone = F.coalesce("_alone", F.lit(False))            # nothing beside it from here on: it keeps its names
        rows = rows.join(listed, ["host", "template", "_seg"], "left").withColumns({
            "template": F.when(alone, F.concat("template", F.expr(f"slice(shape, {level}, size(shape))"))).otherwise(
                F.concat("template", F.array(F.coalesce("_as", "_seg")))),
            "_done": alone | (F.size("shape") == level)}).drop("_seg", "_as", "_alone")
        rows = staged(rows, "url-level")                      # the next level's plan begins here
        tree = tree.unionByName(rows.where("_done").drop("_done"))
        rows = rows.where("not _done").drop("_done")
        deep = rows.agg(F.max(F.size("shape"))).first()[0] or 0
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))
    sums = sums.withColumn("purity", (F.col("g") + prior * weight) / (F.col("l") + weight)).drop("l", "g")
    return tree.select("host", "shape", "template").join(sums, ["host", "template"]).select(
        "host", "shape", F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity",
        (F.col("purity") >= min_purity).alias("_pure"))


def judge(pages: DataFrame, good: Column | None = None, url_col: str = "url", rules=RULES,
          min_purity: float = MIN_PURITY, salts: int = SALTS) -> DataFrame:
    """``pages`` with host, path, rule, template, purity and verdict.  ``good`` is a
    boolean column of ``pages`` (null: no label)."""
    base = without(pages, *RESULTS)
    label = good if good is not None else F.lit(None)
    rows = base.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col)), "_good": label.cast("boolean")})
    rows = rows.withColumn("shape", segments(F.col("path")))
    table = template_table(rows.select("host", "shape", F.col("_good").alias("good")), min_purity)
    # a (host, template) group may hold a third of the pages: its one row of the table is dealt to every salt
    table = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64(url_col), F.lit(salts)).cast("int"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    out = rows.join(table, ["host", "shape", "_salt"])
    return out.withColumns({"rule": rule, "verdict": F.coalesce(
        verdict, F.when(F.col("_pure"), F.lit("allow")).otherwise(F.lit("block")))}).select(*base.columns, *RESULTS)
